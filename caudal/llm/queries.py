"""The operators of this folder as queries over the tables of a directory, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caudal.llm import (
    bit_sliced,
    html_blocks,
    hyperminhash,
    language_id,
    line_dedup,
    mask_search,
    mixing,
    nb_svm,
    packing,
    perplexity,
    url_rules,
    warc,
    whitening,
)
from caudal.sources.files import join_path

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def _table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_read(spark, sf_dir, name))


def _mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nb_svm.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def _url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_html_blocks": _table("pages", html_blocks.extract),
    "op2_line_dedup": _table("documents", lambda d: line_dedup.deduplicated(d).drop("text")),
    "op3_url_rules": _url_rules,
    "op4_hyperminhash": _table("documents", hyperminhash.near_duplicates),
    "op5_tier_packing": _table("documents", packing.pack),
    "op6_bit_sliced": _table("embeddings", bit_sliced.top_k),
    "op7_warc_zstd": _table("pages", warc.round_trip),
    "op8_rank_profiles": _table("documents", language_id.identify),
    "op9_ngram_perplexity": _table("documents", perplexity.judge),
    "op10_block_mixing": _table("documents", mixing.mixed_counts),
    "op11_cholesky_whitening": _table("embeddings", whitening.whiten),
    "op12_nb_svm": _nb_svm,
    "op13_mask_search": _mask_search,
}

# What SQL can say in full: records and their payloads, exact inner products and whole-number scores.
ORACLES: dict[str, str] = {
    "op7_warc_zstd": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""",
    "op6_bit_sliced": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM e q JOIN e c ON q.i = c.i AND q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "op13_mask_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
g AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM w SEMI JOIN q USING (term) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * (SELECT n FROM g) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p GROUP BY term),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * p.n * g.n) // g.l))))::BIGINT AS score
      FROM p JOIN f USING (term) JOIN q USING (term), g GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10""",
}
