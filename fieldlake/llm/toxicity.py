"""Severity of toxic text by cumulative-link ordinal regression.

``P(grade >= j) = sigmoid(w . x - cut_j)``: one weight vector for all grades and
ordered cuts between them. The features are sparse: which words of a learnt
vocabulary occur in a text. The expected severity is the sum of ``P(grade >= j)``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import let, numbers, sigmoid
from fieldlake.session import stored

#: Documents read for training, at most; half of them from grade 0.
TRAIN_ROWS = 20_000
#: Words of the vocabulary, at most.
WORDS = 512
#: Texts that must hold a word of the vocabulary.
LEAST_TEXTS = 5

LETTERS = r"[^\p{L}]+"


@dataclass(frozen=True)
class Model:
    """``weights`` by word, and the ascending cuts: one for each grade from 1."""

    weights: dict[str, float]
    cuts: tuple[float, ...]


def terms(text: Column) -> Column:
    """Lower-cased words of letters; none for null."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), LETTERS)


def found(text: Column, vocabulary: list[str]) -> Column:
    """The distinct vocabulary words of a text."""
    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_distinct(F.filter(terms(text), lambda w: w.isin(*vocabulary)))


def sample(labelled: DataFrame, grade: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled rows, half of them of grade 0 where there are enough: the smallest hashes."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col(grade).isNotNull()).select("doc_id", F.col(grade).cast("int").alias("grade"))
    return known.filter("grade = 0").orderBy(*order).limit(rows // 2).union(known.filter("grade > 0").orderBy(*order).limit(rows // 2))


def vocabulary(train: DataFrame, least_texts: int = LEAST_TEXTS, z: float = 4.0) -> list[str]:
    """Words whose share of documents differs between grade 0 and the others by ``z`` standard errors.

    Counted by Spark over the distinct words of each training text, near copies once: texts
    with the same smallest and largest hash of five words count as one. A word must be in
    ``least_texts`` such texts of its side, a number that doesn't grow with the table, so
    that words of one language among several are found. At most ``WORDS`` words, the
    strongest, come back.
    """
    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - 4, F.lit(1)))
        return F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(w, i, 5), " ")))

    origin = let(let(terms(F.col("text")), hashes), lambda h: F.struct(F.array_min(h), F.array_max(h)))
    train = train.groupBy(origin.alias("origin")).agg(F.max("grade").alias("grade"), F.max_by("text", F.struct("grade", "text")).alias("text"))
    sizes = dict(train.groupBy((F.col("grade") > 0).alias("bad")).count().collect())
    good, bad = sizes.get(False, 0), sizes.get(True, 0)
    if not good or not bad:
        return []
    words = train.select((F.col("grade") > 0).cast("int").alias("bad"), F.explode(F.array_distinct(terms(F.col("text")))).alias("w")).filter("w != ''")
    per = words.groupBy("w").agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n"))
    per = per.filter((F.col("b") >= least_texts) | (F.col("n") - F.col("b") >= least_texts))
    b, g = F.col("b") + 0.5, F.col("n") - F.col("b") + 0.5
    share = F.col("n") / F.lit(good + bad)
    score = (F.col("b") / F.lit(bad) - (F.col("n") - F.col("b")) / F.lit(good)) / F.sqrt(share * (1 - share) * F.lit(1.0 / good + 1.0 / bad) + 1e-12)
    # a word must also tell much, not only surely: at least four times as frequent on one side
    ratio = F.abs(F.log(b / F.lit(bad)) - F.log(g / F.lit(good)))
    rows = per.filter((F.abs(score) >= z) & (ratio >= math.log(4.0))).orderBy(F.abs(score).desc(), "w").limit(WORDS).select("w").collect()
    return [r.w for r in rows]


def solve(rows: list[tuple[list[int], int]], n_words: int, grades: int, ridge: float = 0.05, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of least penalised loss, by accelerated gradient steps on the bounded sample.

    Cuts are a first one and positive gaps, so they stay in order.
    """
    y = np.array([g for _, g in rows])
    at = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    word = np.concatenate([np.array(b, int) for b, _ in rows]) if len(at) else np.empty(0, int)
    shares = np.clip([(y >= j).mean() for j in range(1, grades)], 1e-4, 1 - 1e-4)
    cuts = np.log1p(-shares) - np.log(shares)
    gaps = np.log(np.maximum(np.diff(cuts), 1e-2))
    params = np.concatenate([np.zeros(n_words), cuts[:1], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    s = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, steps + 1):
        w, first, gap = params[:n_words], params[n_words], np.exp(params[n_words + 1 :])
        c = first + np.concatenate([[0.0], np.cumsum(gap)])
        x = np.bincount(at, w[word], len(rows)) if len(at) else np.zeros(len(rows))
        above = s(x[:, None] - np.concatenate([[-80.0], c, [80.0]])[None, :])  # P(grade >= 0), ..., P(grade >= grades)
        i = np.arange(len(rows))
        hi, lo = above[i, y], above[i, y + 1]
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        gx = -(dhi - dlo)
        gw = np.bincount(word, gx[at], n_words) + ridge * w if len(at) else ridge * w
        gc = np.zeros(grades - 1)
        np.add.at(gc, y[y > 0] - 1, dhi[y > 0])
        np.add.at(gc, y[y < grades - 1], -dlo[y < grades - 1])
        tail = np.cumsum(gc[::-1])[::-1]
        grad = np.concatenate([gw, [tail[0]], tail[1:] * gap]) / len(rows)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    gap = np.exp(params[n_words + 1 :])
    return params[:n_words], params[n_words] + np.concatenate([[0.0], np.cumsum(gap)])


def fit(docs: DataFrame, labelled: DataFrame, grade: str, rows: int = TRAIN_ROWS) -> Model:
    """Fit on ``labelled`` (doc_id, grade from 0) and the texts of ``docs``.

    At most ``rows`` labelled documents take part; they are joined to the texts by a
    broadcast of that bounded list. With less than two grades there is nothing to
    learn: no weights, and a cut that no text reaches.
    """
    picked = sample(labelled, grade, rows)
    train = stored(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "toxic-train")
    top = train.agg(F.max("grade")).first()[0] or 0
    words = vocabulary(train)
    if top < 1 or train.filter("grade = 0").isEmpty():
        return Model({}, (40.0,) * max(top, 1))
    index = {w: i for i, w in enumerate(words)}
    # per document a few vocabulary words; the number of documents is bounded by ``rows``
    seen = train.groupBy(found(F.col("text"), words).alias("hits"), "grade").count().collect()
    sets = [([index[w] for w in r["hits"]], r["grade"]) for r in seen for _ in range(r["count"])]
    weights, cuts = solve(sets, len(words), top + 1)
    return Model({w: float(weights[i]) for w, i in index.items()}, tuple(map(float, cuts)))


def linear(text: Column, model: Model) -> Column:
    """The weight sum of a text's vocabulary words."""
    names = list(model.weights)
    if not names:
        return F.lit(0.0)
    listed = F.split(F.lit(" ".join(names)), " ")
    weights = numbers([model.weights[n] for n in names], "double")
    return F.aggregate(found(text, names), F.lit(0.0), lambda a, w: a + F.get(weights, (F.array_position(listed, w) - 1).cast("int")))


def chances(x: Column, model: Model) -> Column:
    """``P(grade >= j)`` for j from 1."""
    return let(x, lambda v: F.array(*[sigmoid(v - F.lit(c)) for c in model.cuts]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected severity, most probable grade, and the chance of each grade or more.

    Row-local. Null and empty texts have no words and get the base chances; other
    columns are ignored, repeated rows scored each. Of equally probable grades the
    smaller is taken.
    """
    rows = docs.select("doc_id", chances(linear(F.col("text"), model), model).alias("at_least"))
    edges = F.concat(F.array(F.lit(1.0)), F.col("at_least"), F.array(F.lit(0.0)))
    each = F.transform(F.sequence(F.lit(1), F.lit(len(model.cuts) + 1)), lambda i: F.element_at(edges, i) - F.element_at(edges, i + 1))
    return rows.select(
        "doc_id", F.aggregate("at_least", F.lit(0.0), lambda a, p: a + p).alias("expected_severity"),
        (F.array_position(each, F.array_max(each)) - 1).cast("int").alias("grade"), "at_least")


def rejected(text: Column, model: Model, least: float = 0.5) -> Column:
    """Whether the expected severity reaches ``least``."""
    return F.aggregate(chances(linear(text, model), model), F.lit(0.0), lambda a, p: a + p) >= least


def graded_labels(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Grades 0 (not toxic), 1 and 2 from a table with only (doc_id, toxic).

    Grade 2 are toxic documents with more distinct telling words than the median
    toxic document that has any. All counts come from the bounded sample of ``fit``.
    """
    picked = sample(labels, "toxic", rows)
    train = stored(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "toxic-words")
    counted = train.select("doc_id", "grade", F.size(found(F.col("text"), vocabulary(train))).alias("n"))
    counted = stored(counted, "toxic-graded")
    middle = counted.filter("grade > 0 AND n > 0").agg(F.percentile_approx("n", 0.5)).first()[0] or 0
    return counted.select("doc_id", F.when(F.col("grade") == 0, 0).when(F.col("n") > middle, 2).otherwise(1).alias("grade"))
