"""URL filtering by fixed rules and by association rules mined from labels.

FP-growth finds token combinations that labelled URLs share with the mark of bad pages. Rules above
the support and confidence bounds go into an inverted index by token; a URL is looked up by its tokens and
blocked when it holds all tokens of some rule. Fixed rules come first: the longest that fits decides.

Tokens that the same labelled URLs hold are one item to FP-growth, or each of them would double the combinations.
A rule names items; a URL holds an item if it holds any of its tokens, as each of them would make the same rule.

Everything here is DataFrame expressions and Spark's own FP-growth.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.operators.skew import lookup_side
from caudal.session import materialise

# Host and path of each rule, and its verdict.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
SUPPORT, CONFIDENCE = 0.002, 0.8
# A rule stands on this many bad URLs at least, and is so many times as often right as blocking any URL would be.
LEAST_COUNT, LIFT = 5, 1.5
BAD = "\u0001bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: str = "url") -> Column:
    """After the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(host: str = "host", path: str = "path") -> Column:
    """Distinct tokens: host labels and path words with where they stand; whole numbers don't count."""
    host_words = F.transform(F.split(F.col(host), r"[.:@_-]+"), lambda x: F.concat(F.lit("h:"), x))
    path_words = F.transform(F.split(F.translate(F.col(path), _UPPER, _LOWER), r"[/.,;=&_~%+-]+"), lambda x: F.concat(F.lit("p:"), x))
    kept = F.filter(F.concat(host_words, path_words), lambda x: (F.length(x) > 2) & ~x.rlike(r"^p:[0-9]+$"))
    return F.array_distinct(kept)


def rule_for(rules: tuple = RULES, host: str = "host", path: str = "path") -> Column:
    """The longest fixed rule that fits, as ``struct(rule, verdict)``; null if none does.

    A rule fits its host and all subdomains of it, if the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        own = (F.col(host) == name) | F.col(host).endswith("." + name)
        fits = own & F.col(path).startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _items(each: DataFrame) -> DataFrame:
    """``(token, item)`` from distinct ``(row, token)``: tokens of exactly the same rows share an item, the first of them.

    Sets of rows are compared by their size and 128 bits of order-free digest, so a token that a third of the rows hold
    ships a row a task.
    """
    digest = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"x{seed}") for seed in (1, 2)]
    held = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *digest)
    first = held.groupBy("n", "x1", "x2").agg(F.min("token").alias("item"))
    return held.join(first, ["n", "x1", "x2"]).select("token", "item")


def mine_items(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least_count: int = LEAST_COUNT, lift: float = LIFT
) -> tuple[DataFrame, DataFrame]:
    """Rules over items, ``(tokens, confidence, lift, support)`` with an item named by its first token, and ``(token, item)``
    for the tokens of these items.

    ``labelled`` has ``tokens`` and a boolean ``bad``. A combination is left out when a part of it already makes a
    rule: it would block nothing more. No bad URL gives no rule. Every item that can stand in such a combination is
    mined: FP-growth is spared only items too rare among bad URLs for any rule, and items that are a rule alone.
    """
    rows = materialise(labelled.where("bad IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"))
    spark = rows.sparkSession
    n, n_bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    nothing = spark.range(0).selectExpr(
        "array('') AS tokens", "0D AS confidence", "0D AS lift", "0D AS support", "'' AS token", "'' AS item"
    )
    least = max(float(least_count), support * n)
    if least > n_bad:
        return nothing.select("tokens", "confidence", "lift", "support"), nothing.select("token", "item")
    wanted = max(confidence, lift * n_bad / n)
    each = rows.select("row", "bad", F.explode(F.array_distinct("tokens")).alias("token"))
    # A token too rare among bad URLs makes no rule, alone or with others.
    counted = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"))
    common = materialise(counted.where(F.col("n_bad") >= math.ceil(least / n * n)))
    items = materialise(_items(each.select("row", "token").join(lookup_side(common.select("token")), "token")))
    own = common.join(items.where("token = item"), "token").withColumn("confidence", F.col("n_bad") / F.col("n"))
    alone = F.col("confidence") >= wanted
    kept = each.join(lookup_side(own.where(~alone).select("token")), "token").groupBy("row").agg(F.collect_list("token").alias("kept"))
    mark = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = rows.join(kept, "row", "left").select(
        F.concat(F.coalesce("kept", F.array().cast("array<string>")), mark).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=least / n, minConfidence=min(wanted, 1.0)).fit(materialise(baskets))
    longer = model.associationRules.where((F.col("consequent")[0] == BAD) & (F.col("confidence") >= wanted)).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "lift", "support"
    )
    single = own.where(alone).select(
        F.array("token").alias("tokens"), "confidence", (F.col("confidence") * n / n_bad).alias("lift"), (F.col("n_bad") / n).alias("support")
    )
    rules = materialise(longer.union(single))
    by_token = rules.select(F.col("tokens").alias("own"), F.col("tokens")[0].alias("head"))
    part = rules.select("tokens", F.explode("tokens").alias("head")).join(by_token, "head")
    wider = part.where((F.size("own") < F.size("tokens")) & (F.size(F.array_except("own", "tokens")) == 0))
    smallest = materialise(rules.join(wider.select("tokens").distinct(), "tokens", "left_anti"))
    named = smallest.select(F.explode("tokens").alias("item")).distinct()
    return smallest, items.join(named, "item", "left_semi").select("token", "item")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least_count: int = LEAST_COUNT, lift: float = LIFT) -> DataFrame:
    """``(tokens, confidence, lift, support)``: the rules of ``mine_items`` with a row for each choice of one token an item.

    For reading: a rule of several items with many tokens each unfolds into their product.
    """
    rules, items = mine_items(labelled, support, confidence, least_count, lift)
    of_item = items.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("choices"))
    numbered = rules.withColumn("rule", F.monotonically_increasing_id())
    parts = materialise(numbered).select("rule", "confidence", "lift", "support", F.explode("tokens").alias("item")).join(of_item, "item")
    sets = parts.groupBy("rule").agg(
        F.collect_list("choices").alias("sets"), *(F.first(c).alias(c) for c in ("confidence", "lift", "support"))
    )
    none = F.array(F.array().cast("array<string>"))
    product = F.aggregate(
        "sets", none, lambda done, more: F.flatten(F.transform(done, lambda d: F.transform(more, lambda m: F.concat(d, F.array(m)))))
    )
    return sets.select(F.explode(product).alias("tokens"), "confidence", "lift", "support").withColumn("tokens", F.array_sort("tokens"))


def held_items(urls: DataFrame, items: DataFrame) -> DataFrame:
    """The distinct ``url`` of ``urls`` that hold an item, with their items as ``tokens``."""
    met = urls.select("url", F.explode("tokens").alias("token")).join(lookup_side(items), "token")
    return met.groupBy("url").agg(F.collect_set("item").alias("tokens"))


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, mined_rule)`` for the distinct urls that hold all tokens of a rule, by inverted index.

    The index lists a rule under its first token alone, so a url meets a rule at most once.
    """
    index = rules.select(F.col("tokens")[0].alias("token"), F.col("tokens").alias("rule_tokens"), "confidence")
    each = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    met = each.join(lookup_side(index), "token").where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    best = F.max_by(F.concat_ws(" ", "rule_tokens"), F.struct("confidence", F.concat_ws(" ", "rule_tokens")))
    return met.groupBy("url").agg(best.alias("mined_rule"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined_rule)``, one row for each row of ``pages``.

    A page's label is that of the document its path names by number; documents of low quality are bad. A null url,
    or one without ``://``, has an empty host and path, no rule, and is allowed. Rows that repeat are judged alike;
    labels with a null or with conflicting values count as bad if any says so. ``mined_rule`` names each item by its first token.
    """
    rows = pages.select("page_id", "url", host_of().alias("host"), path_of().alias("path"))
    urls = rows.where("host != ''").select("url", "host", "path").distinct().withColumn("tokens", tokens_of())
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:[./]|$)", 1)
    named = urls.withColumn("doc_id", F.when(number != "", number.cast("long")))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 0).alias("bad"))
    labelled = named.join(marked, "doc_id").select("tokens", "bad")
    found, items = mine_items(labelled)
    blocked = blocked_urls(held_items(urls, items), found)
    judged = rows.withColumn("fixed", rule_for(rules)).join(lookup_side(blocked), "url", "left")
    method = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", method).alias("verdict"), "mined_rule"
    )
