"""The credit-scoring run, and a reader for its result."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caudal.operators.credit import CREDIT_LINE, CreditModel, client_features, train
from caudal.plans.lakehouse import Lake
from caudal.session import materialise
from caudal.sources.files import check_contract, join_path, preview, write_csv, write_parquet

SCORE_COLUMNS = ("cliente_id", "credit_aprobado", CREDIT_LINE)


def score(lake: Lake, **settings) -> CreditModel:
    """Train on Silver and write ``ml_credit_score`` (Parquet) and ``ml_credit_score_csv``."""
    model = train(client_features(lake.silver()["pivot_model_credit"]), **settings)
    lines = materialise(model.credit_lines())
    check_contract(lines, SCORE_COLUMNS)
    write_parquet(lines, join_path(lake.gold_root, "ml_credit_score"))
    write_csv(lines, join_path(lake.gold_root, "ml_credit_score_csv"))
    return model


def read_scores(lake: Lake, rows: int = 20) -> tuple[DataFrame, int]:
    """The first clients scored, and how many there are."""
    scores = lake.gold("ml_credit_score")
    return preview(scores, ["cliente_id"], rows), scores.count()
