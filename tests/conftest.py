from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "America/Mexico_City")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    from caudal.sources.sample import SampleTables

    return SampleTables(spark, SMALL)


@pytest.fixture(scope="session")
def silver(sample):
    from caudal.operators.silver import silver_tables
    from caudal.plans.extracts import bundle

    return bundle(silver_tables(sample))


@pytest.fixture(scope="session")
def frame(spark):
    """``frame(rows, ddl)``; money may be given as text."""

    def build(rows, ddl):
        fields = [part.strip().split(" ", 1) for part in ddl.split(";")]
        plain = ", ".join(f"{n} {'string' if t.startswith(('decimal', 'timestamp')) else t}" for n, t in fields)
        df = spark.createDataFrame(rows, plain)
        return df.selectExpr(*(f"CAST({n} AS {t}) AS {n}" for n, t in fields))

    return build


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
