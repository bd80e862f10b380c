"""Credit scoring: per-client features, label, random forest, credit line."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from caudal.functions.money import mean
from caudal.schemas import DEPOSIT
from caudal.operators.ranking import SLICE, range_slices
from caudal.session import materialise

# The scoring rule and the model settings.
WINDOW_DAYS = 90
APPROVED_FACTOR = 1.2
BASE_FACTOR = 1.01
TREES = 25
DEPTH = 5
SEED = 42

MEAN_BALANCE = "saldo_promedio_ultimos_90_dias"
NET_VOLUME = "volumen_total_ingresos_vs_egresos"
USES = "frecuencia_uso"
FEATURES = (MEAN_BALANCE, NET_VOLUME, USES)
CREDIT_LINE = "línea_credito_potencial"


def latest_transaction(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.max("fecha_transaccion").alias("fecha_max"))


def _recent(transactions: DataFrame) -> Column:
    """Within the window that ends at the latest transaction, its first instant included.

    The latest instant is a scalar subquery: it runs once and stays on the cluster.
    """
    start = latest_transaction(transactions).scalar() - F.make_dt_interval(F.lit(WINDOW_DAYS))
    return F.col("fecha_transaccion") >= start


def _finish(by_client: DataFrame) -> DataFrame:
    """Means and differences, with NULL replaced by zero in every numeric column, the client id included."""
    zero_if_null = (
        by_client.withColumn(MEAN_BALANCE, mean(F.col("saldo_reciente"), F.col("usos_recientes")))
        .withColumn(NET_VOLUME, F.col("total_ingresos") - F.col("total_egresos"))
        .select("id_cliente", MEAN_BALANCE, "total_ingresos", "total_egresos", USES, NET_VOLUME)
    )
    return zero_if_null.na.fill(0.0)


def client_features(pivot: DataFrame) -> DataFrame:
    """Features from the stored base table: one aggregate, partial on the map side.

    The mean balance weighs each account by its recent transactions.
    """
    recent = _recent(pivot)
    is_deposit = F.col("tipo_movimiento") == DEPOSIT
    return _finish(
        pivot.groupBy("id_cliente").agg(
            F.sum(F.when(recent, F.col("saldo"))).alias("saldo_reciente"),
            F.count(F.when(recent, F.col("saldo"))).alias("usos_recientes"),
            F.sum(F.when(is_deposit, F.col("monto")).otherwise(0)).alias("total_ingresos"),
            F.sum(F.when(~is_deposit, F.col("monto")).otherwise(0)).alias("total_egresos"),
            F.count("id_transaccion").alias(USES),
        )
    )


def client_features_from_ledger(transaccion: DataFrame, cuenta: DataFrame) -> DataFrame:
    """The same features straight from transactions and accounts.

    Transactions are added up per origin account before the account table is met, so the join sees one
    row per account and no account is hot.
    """
    is_deposit = F.col("tipo_movimiento") == DEPOSIT
    activity = transaccion.groupBy(F.col("cuenta_origen").alias("no_cuenta")).agg(
        F.count_if(_recent(transaccion)).alias("recientes"),
        F.sum(F.when(is_deposit, F.col("monto")).otherwise(0)).alias("ingresos"),
        F.sum(F.when(~is_deposit, F.col("monto")).otherwise(0)).alias("egresos"),
        F.count("id_transaccion").alias("usos"),
    )
    owned = activity.join(cuenta.select("no_cuenta", "saldo", "id_cliente"), "no_cuenta", "left")
    return _finish(
        owned.groupBy("id_cliente").agg(
            F.sum(F.when(F.col("recientes") > 0, F.col("saldo") * F.col("recientes").cast("decimal(18,0)"))).alias(
                "saldo_reciente"
            ),
            F.sum(F.when(F.col("saldo").isNotNull(), F.col("recientes")).otherwise(0)).alias("usos_recientes"),
            F.sum("ingresos").alias("total_ingresos"),
            F.sum("egresos").alias("total_egresos"),
            F.sum("usos").alias(USES),
        )
    )


def with_label(features: DataFrame) -> DataFrame:
    """Low risk (1) when the client takes in more than it pays out."""
    return features.withColumn("label", F.when(F.col(NET_VOLUME) > 0, 1).otherwise(0))


def credit_line(approved: Column) -> Column:
    factor = F.when(approved, F.lit(APPROVED_FACTOR)).otherwise(F.lit(BASE_FACTOR))
    return F.col(MEAN_BALANCE) * factor


def credit_line_by_label(labelled: DataFrame) -> DataFrame:
    """The credit line that follows from the label itself."""
    return labelled.select(
        F.col("id_cliente").alias("cliente_id"),
        F.col("label").alias("credit_aprobado"),
        credit_line(F.col("label") == 1).alias(CREDIT_LINE),
    )


class CreditModel(NamedTuple):
    model: PipelineModel
    scored: DataFrame
    auc: float
    importances: dict[str, float]

    def credit_lines(self) -> DataFrame:
        return self.scored.select(
            F.col("id_cliente").alias("cliente_id"),
            F.col("prediction").alias("credit_aprobado"),
            credit_line(F.col("prediction") == 1).alias(CREDIT_LINE),
        )

    def metrics(self) -> DataFrame:
        spark = self.scored.sparkSession
        rows = [("auc", float(self.auc)), *((f"importancia.{k}", float(v)) for k, v in self.importances.items())]
        return spark.createDataFrame(rows, "metrica string, valor double")


def train(
    features: DataFrame,
    inputs: Sequence[str] = FEATURES,
    holdout: float = 0.0,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> CreditModel:
    """Fit the forest and score every client.

    By default the model is measured on its own training rows; ``holdout`` keeps that share out of
    training and measures on it. ``inputs`` may leave out the feature the label is derived from.
    The features are stored once, as fitting reads them many times.
    """
    labelled = materialise(with_label(features))
    steps = [
        VectorAssembler(inputCols=list(inputs), outputCol="features"),
        RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
    ]
    training, measured = labelled, labelled
    if holdout > 0:
        training, measured = labelled.randomSplit([1 - holdout, holdout], seed=seed)
    # The copy leaves the training summary behind: it holds the session, and would travel with every task.
    model = Pipeline(stages=steps).fit(training).copy()
    scored = model.transform(labelled)
    judged = scored if holdout <= 0 else model.transform(measured)
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(judged)
    weights = dict(zip(inputs, model.stages[-1].featureImportances.toArray()))
    return CreditModel(model, scored, auc, weights)


def auc_by_ranks(scored: DataFrame, score: str, label: str) -> DataFrame:
    """``(positivos, negativos, auc)``: the share of pairs of a positive and a negative row in which the positive scores
    higher, ties counting half, as exact counts up to the last division.

    Equal scores become one row before any sort; distinct ones are cut into ranges, and a row a range carries what lies below.
    Rows without a score or a label are left out; without both labels the AUC is NULL.
    """
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    positive = F.count_if(F.col(label) == 1)
    ties = rows.groupBy(F.col(score).alias("score")).agg(positive.alias("pos"), (F.count(F.lit(1)) - positive).alias("neg"))
    sliced = range_slices(ties, ["score"])
    slices = sliced.groupBy(SLICE).agg(F.sum("neg").alias("slice_neg"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    below = slices.select(SLICE, F.coalesce(F.sum("slice_neg").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(SLICE).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sliced.withColumn("up_to", F.sum("neg").over(inside)).join(F.broadcast(below), SLICE)  # a row a range
    twice = 2 * (F.col("before") + F.col("up_to") - F.col("neg")) + F.col("neg")
    sums = ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positivos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negativos"),
        F.sum(F.col("pos").cast("decimal(19,0)") * twice.cast("decimal(19,0)")).alias("wins"),
    )
    pairs = F.col("positivos").cast("double") * F.col("negativos")
    return sums.select("positivos", "negativos", F.when(pairs > 0, F.col("wins").cast("double") / (2 * pairs)).alias("auc"))
