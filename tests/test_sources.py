from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from caudal.session import work_dir
from caudal.sources import files
from caudal.sources.jdbc import JdbcSource
from caudal.sources.sample import DERIVATION
from caudal.schemas import REFERENCES, TABLES
from conftest import rows

URL = "postgresql://ana:s%40l@db.host:5433/banco"


def test_url_becomes_options():
    source = JdbcSource.from_database_url(URL, partitions=8)
    assert source.options() == {
        "url": "jdbc:postgresql://db.host:5433/banco",
        "user": "ana",
        "password": "s@l",
        "driver": "org.postgresql.Driver",
        "fetchsize": "10000",
    }
    assert JdbcSource.from_database_url("postgresql://h/b", partitions=1).options()["url"] == "jdbc:postgresql://h/b"


@pytest.mark.parametrize("url", ["", None, "banco", "postgresql:///banco", "postgresql://None:None@None/None", "postgresql://u@h/None"])
def test_bad_urls(url):
    with pytest.raises(ValueError):
        JdbcSource.from_database_url(url, partitions=1)


def test_environment_overrides(monkeypatch):
    monkeypatch.setenv("DATABASE_URL", "postgresql://other/b")
    assert JdbcSource.from_environment(URL, partitions=1).url == "jdbc:postgresql://other/b"
    monkeypatch.delenv("DATABASE_URL")
    assert JdbcSource.from_environment(URL, partitions=1).url == "jdbc:postgresql://db.host:5433/banco"


def test_splits_cover_the_table():
    source = JdbcSource.from_database_url(URL, partitions=3)
    assert source.range_options("id_cliente", 1, 900) == {
        "partitionColumn": "id_cliente", "lowerBound": "1", "upperBound": "900", "numPartitions": "3",
    }
    assert source.range_options("id_cliente", 5, 5)["upperBound"] == "6"
    predicates = source.hash_predicates("no_cuenta")
    assert len(predicates) == 3 and "IS NULL" in predicates[0] and predicates[2].endswith("= 2")
    assert source.bounds_query("cliente", "id_cliente") == "SELECT MIN(id_cliente) AS lo, MAX(id_cliente) AS hi FROM cliente"


def test_sample_has_the_declared_columns(sample):
    for name, table in TABLES.items():
        files.check_contract(sample[name], table.schema)
    assert set(DERIVATION) == set(TABLES)
    assert {r.child for r in REFERENCES} | {r.parent for r in REFERENCES} == set(TABLES)


def test_bundle_round_trip_and_missing_table(spark, sample):
    root = work_dir(spark)
    files.write_bundle({"a": sample["cuenta"], "b": sample["prestamo"]}, root)
    got = files.read_bundle(spark, root, {"cuentas": "a", "prestamos": "b"})
    assert rows(got["cuentas"]) == rows(sample["cuenta"])
    with pytest.raises(AnalysisException):
        files.read_bundle(spark, root, ["a", "nada"])


def test_facts_are_prefixed(spark, sample):
    root = work_dir(spark)
    files.write_facts({"cuentas": sample["cuenta"]}, root)
    assert spark.read.parquet(f"{root}/fact_cuentas").count() == sample["cuenta"].count()


def test_overwrite_replaces(spark, sample):
    path = work_dir(spark)
    files.write_parquet(sample["cuenta"], path)
    files.write_parquet(sample["cuenta"].where("saldo < 0"), path)
    assert spark.read.parquet(path).where("saldo >= 0").isEmpty()


def test_csv_keeps_awkward_text(spark, frame):
    df = frame(
        [('dijo "hola"', "1.50", 1), ("a,b;c\\d", None, None), ("-", "0.00", 3), (None, "2.00", 4), (" espacio ", "1.00", 5)],
        "a string; b decimal(12,2); c long",
    )
    path = work_dir(spark)
    files.write_csv(df, path)
    assert rows(files.read_csv(spark, path, df.schema)) == rows(df)


def test_snapshot(spark, sample):
    folder = files.snapshot({"cuenta": sample["cuenta"]}, work_dir(spark), datetime(2024, 5, 6, 7, 8, 9))
    assert folder.endswith("/backup/20240506_070809")
    assert rows(spark.read.parquet(f"{folder}/cuenta")) == rows(sample["cuenta"])


def test_defaults_on_append(spark, frame):
    loans = files.with_defaults(frame([(1, "10", 2)], "id_prestamo long; monto decimal(12,2); id_cliente long"), "prestamo")
    files.check_contract(loans, TABLES["prestamo"].schema)
    assert loans.first()["estado"] == "Activo"
    tx = files.with_defaults(frame([(1, "2020-01-01 00:00:00"), (2, None)], "id_transaccion long; fecha_transaccion timestamp_ntz"), "transaccion")
    kept, filled = [r["fecha_transaccion"] for r in tx.orderBy("id_transaccion").collect()]
    assert kept == datetime(2020, 1, 1) and filled.year >= 2024


def test_conform_casts_and_refuses(spark):
    source = spark.sql("SELECT CAST(1 AS INT) AS id_prestamo, 'Activo' AS estado, 12.5 AS monto, CAST(2 AS INT) AS id_cliente, 1 AS sobra")
    files.check_contract(files.conform(source, "prestamo"), TABLES["prestamo"].schema)
    with pytest.raises(files.ContractError):
        files.conform(source.drop("monto"), "prestamo")


def test_preview_is_ordered(sample):
    got = [r["no_cuenta"] for r in files.preview(sample["cuenta"], ["no_cuenta"], 5).collect()]
    assert got == sorted(got) and len(got) == 5


def test_work_dir_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "x"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        work_dir(Session())


def test_materialise_keeps_rows_and_types(sample):
    from caudal.session import materialise

    df = sample["transaccion"].withColumn("x", F.lit(None).cast("boolean"))
    stored = materialise(df)
    assert stored.dtypes == df.dtypes and stored.exceptAll(df).isEmpty()


def test_the_number_of_reads_must_be_given():
    with pytest.raises(TypeError):
        JdbcSource.from_database_url(URL)
