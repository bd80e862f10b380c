"""Run every query and its SQL on the same tables and compare: ``python tests/check_oracles.py [sf] [key…]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from caudal.session import clean_work  # noqa: E402

TABLE_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, relation) -> str:
    """Empty when rows agree, else what differs. Columns are taken by name, rows in any order."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} / {sorted(relation.columns)}"
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    order = [relation.columns.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return ""


def main(sf: str, keys: list[str]) -> int:
    sf_dir = f"/root/testdata/{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "America/Mexico_City")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), e.oracle_sql(), 0
    for key, query in e.queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        df = query(spark, sf_dir)
        if key in sql:
            said = difference(df, con.sql(sql[key]))
        else:
            said = f"(no SQL) {df.count()} rows" if df.columns else "no columns"
        bad += bool(said) and key in sql
        print(f"{time.time() - start:6.1f}s {key:24s} {said or 'ok'}", flush=True)
    clean_work(spark)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*(sys.argv[1:2] or ["sf0.01"]), sys.argv[2:]))
