"""URL verdicts: fixed rules first, else logistic regression on hashed character n-grams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import let, numbers, sigmoid
from fieldlake.session import stored

#: Rules of the registered query: (verdict, host and path start). Fixed values.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#`` behind ``://``, A-Z in lower case; empty for null."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for null."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits as (rule, verdict); null if none does.

    A rule's host fits the host itself and its subdomains, its path the start of the path.
    """
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, path_start = rule.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + path_start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _hashed(starts: Column, value: Column, kind: str, n: int, buckets: int) -> Column:
    return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(value, i, F.lit(n))), F.lit(buckets)).cast("int"))


def grams(host: Column, path: Column, sizes: tuple[int, ...], buckets: int) -> Column:
    """Distinct buckets of the character n-grams of host and path, each between border marks."""
    parts = []
    for kind, value in (("h", host), ("p", path)):
        marked = F.concat(F.lit("\x02"), value, F.lit("\x03"))
        for n in sizes:
            starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1)))
            parts.append(_hashed(F.coalesce(starts, F.array().cast("array<int>")), marked, kind, n, buckets))
    return F.array_distinct(F.concat(*parts))


def margin(buckets: Column, weights: Column, bias: float) -> Column:
    """Bias plus the mean-scaled sum of the weights of a row's buckets."""
    total = lambda bs: F.aggregate(bs, F.lit(0.0), lambda a, b: a + F.get(weights, b))
    return let(buckets, lambda bs: F.lit(bias) + total(bs) / F.sqrt(F.greatest(F.size(bs), F.lit(1))))


def train(labelled: DataFrame, sizes: tuple[int, ...] = (3, 4), buckets: int = 4096, steps: int = 15,
          rate: float = 4.0, ridge: float = 1e-3, max_rows: int = 4000) -> tuple[list[float], float]:
    """Weights per bucket and the bias, by gradient descent over ``labelled`` (url, label 0/1).

    The table is small by its meaning; beyond ``max_rows`` rows it is cut to those
    with the smallest hash of their url. Each step is one aggregation of the errors
    per bucket: at most ``buckets`` numbers come back, whatever the table holds.
    Rows without url or label are left out; without both labels the bias alone decides.
    """
    rows = labelled.filter(F.col("url").isNotNull() & F.col("label").isNotNull()).select("url", F.col("label").cast("double").alias("y"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(max_rows)
    seen = stored(rows.select("y", grams(host_of(F.col("url")), path_of(F.col("url")), sizes, buckets).alias("b")), "url-train")
    count, positive = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    weights, bias = [0.0] * buckets, math.log((positive + 1.0) / (count - positive + 1.0))
    if positive in (0, count):
        return weights, bias
    for _ in range(steps):
        error = sigmoid(margin(F.col("b"), numbers(weights, "double"), bias)) - F.col("y")
        pulls = seen.select(error.alias("e"), F.explode(F.concat(F.col("b"), F.array(F.lit(-1)))).alias("bucket"), F.size("b").alias("n"))
        sums = pulls.groupBy("bucket").agg(F.sum(F.when(F.col("bucket") < 0, F.col("e")).otherwise(
            F.col("e") / F.sqrt(F.greatest("n", F.lit(1))))).alias("g")).collect()
        weights = [w * (1.0 - rate * ridge) for w in weights]
        for bucket, pull in sums:
            if bucket < 0:
                bias -= rate * pull / count
            else:
                weights[bucket] -= rate * pull / count
    return weights, bias


def judge(pages: DataFrame, rules: list[tuple[str, str]], model: tuple[list[float], float],
          sizes: tuple[int, ...] = (3, 4)) -> DataFrame:
    """Host, path, rule and verdict of every page (page_id, url).

    The longest fitting rule decides; without one, the model blocks from a
    probability of one half. Null urls have empty host and path and are judged by
    the model. Row-local: no shuffle, no join; other columns are ignored.
    """
    weights, bias = model
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = parts.withColumn("_found", rule_of(F.col("host"), F.col("path"), rules))
    chance = sigmoid(margin(grams(F.col("host"), F.col("path"), sizes, len(weights)), numbers(weights, "double"), bias))
    return found.withColumn("block_probability", chance).select(
        "page_id", "host", "path", F.col("_found.rule").alias("rule"),
        F.coalesce(F.col("_found.verdict"), F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "block_probability")


def labelled_by_rules(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The urls that a rule decides, as a labelled table (1: block)."""
    url = F.col("url")
    found = rule_of(host_of(url), path_of(url), rules)
    return pages.select("url", F.when(found["verdict"] == "block", 1.0).when(found["verdict"] == "allow", 0.0).alias("label")).filter("label IS NOT NULL")
