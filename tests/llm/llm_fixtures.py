from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from ``(doc_id, text[, lang[, source]])``, with more columns that may clash."""

    def build(rows, extra=False):
        full = [((*r, None, None)[:4] if len(r) < 4 else r[:4]) for r in rows]
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOC)
        if extra:
            names = ["id", "key", "n", "u", "v", "m", "sid", "start", "size", "block", "mark", "digest", "score", "lang_pred", "model", "tier", "runs", "component"]
            df = df.selectExpr("*", *(f"'x' AS `{n}`" for n in names))
        return df

    return build


@pytest.fixture(scope="session")
def middle_documents(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


@pytest.fixture(scope="session")
def entry():
    import __spark_entry__ as e

    return e.queries()
