"""Hard negatives from exact integer scores in a residue number system.

Vectors become integers; a score is an integer inner product. Blocks of anchors and
rows are multiplied as float32 matrices of residues modulo several small primes, so
every partial sum is an integer that float32 holds exactly; the exact signed scores
come back by Chinese remaindering. From them a first pass selects each anchor's
positives, and a second one the negatives in the window below each positive.

Rows are dealt to stripes once; all anchors visit all stripes in batches. A stripe
sends only its best few rows per anchor and positive, and a window merges them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldlake.llm.common import bounded_batches
from fieldlake.session import stored

#: Residues are within half a prime: 1,024 products of two add up to less than 2^24, which float32 holds exactly.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
DEPTH = 1024
#: 100 times a score must fit into a long.
MOST_SCORE = (2**63 - 1) // 100
#: Vector components per stripe, rows per stripe at least, scores held at a time.
STRIPE_VALUES, STRIPE_ROWS, BLOCK = 1 << 22, 2048, 1 << 21


def primes_for(most: int) -> list[int]:
    """The primes whose product tells all scores from -most to most apart, with room to spare."""
    out, product = [], 1
    for p in PRIMES:
        if product > 4 * most:
            break
        out.append(p)
        product *= p
    assert product > 4 * most
    return out


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Centred residues of an integer matrix, one float32 matrix per prime."""
    return [((x + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two matrices given by their residues."""
    value, product = None, 1
    for x, y, p in zip(a, b, primes, strict=True):
        r = np.zeros((len(x), len(y)), np.int32)
        for k in range(0, x.shape[1], DEPTH):
            r = (r + (x[:, k : k + DEPTH] @ y[:, k : k + DEPTH].T).astype(np.int32)) % p
        if value is None:
            value = r.astype(np.int64)
        else:  # the next mixed-radix digit
            digit = (r - (value % p).astype(np.int32)) * np.int32(pow(product, -1, p)) % p
            value += digit.astype(np.int64) * product
        product *= p
    return np.where(value > product // 2, value - product, value)


@dataclass
class Rows:
    """Rows of one vector length, ascending by label; ``tie`` ranks them by id, null last."""

    row: np.ndarray
    vec_id: pa.Array
    label: np.ndarray
    x: list[np.ndarray]
    extra: list
    tie: np.ndarray

    def span(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right"))


def best(s: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by ``tie``."""
    if len(s) > k:
        places = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
    else:
        places = np.arange(len(s))
    return places[np.lexsort((tie[places], -s[places]))][:k]


POSITIVES = "array<struct<row:long,vec_id:long,score:long>>"
FOUND = "anchor_row long, anchor_id long, row long, vec_id long, score long"
MINED = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, vec_id long, score long"
Work = Callable[[Rows, Rows, list[int]], Iterator[tuple]]


def _blocks(own: Rows, anchors: Rows, same: bool) -> Iterator[tuple[int, int, int, int]]:
    """Runs of anchors of one label with the span of that label in ``own``, so short that
    their scores against that span (``same``) or against all rows fit the block."""
    first = 0
    while first < len(anchors.row):
        end = anchors.span(anchors.label[first])[1]
        lo, hi = own.span(anchors.label[first])
        step = max(1, BLOCK // max(hi - lo if same else len(own.row), 1))
        for at in range(first, end, step):
            yield at, min(at + step, end), lo, hi
        first = end


def positives_of(k: int) -> Work:
    """The best other rows of the anchor's label."""

    def work(own: Rows, anchors: Rows, primes: list[int]) -> Iterator[tuple]:
        ids = own.vec_id.to_pylist()
        for first, last, lo, hi in _blocks(own, anchors, True):
            s = scores([m[first:last] for m in anchors.x], [m[lo:hi] for m in own.x], primes)
            tie, row = own.tie[lo:hi], own.row[lo:hi]
            for a in range(first, last):
                mine = s[a - first]
                found = best(mine, tie, k + 1)  # the anchor itself may be one of them
                for j in found[row[found] != anchors.row[a]][:k]:
                    yield int(anchors.row[a]), anchors.vec_id[a].as_py(), int(row[j]), ids[lo + j], int(mine[j])

    return work


def negatives_of(k: int, least: int, most: int) -> Work:
    """Rows of another label whose score is within ``least`` to ``most`` hundredths of a positive's."""

    def work(own: Rows, anchors: Rows, primes: list[int]) -> Iterator[tuple]:
        ids = own.vec_id.to_pylist()
        for first, last, lo, hi in _blocks(own, anchors, False):
            s = scores([m[first:last] for m in anchors.x], own.x, primes)
            other = np.r_[0:lo, hi : len(own.row)]
            tie = own.tie[other]
            for a in range(first, last):
                mine = s[a - first][other]
                for p in anchors.extra[a] or []:
                    # least * score <= 100 * negative <= most * score
                    low, high = -(-least * p["score"] // 100), most * p["score"] // 100
                    inside = np.flatnonzero((mine >= low) & (mine <= high))
                    for j in inside[best(mine[inside], tie[inside], k)]:
                        yield (int(anchors.row[a]), anchors.vec_id[a].as_py(), p["row"], p["vec_id"], p["score"], int(own.row[other[j]]),
                               ids[other[j]], int(mine[j]))

    return work


def _visit(base: DataFrame, anchors: DataFrame, stripes: int, primes: list[int], work: Work, schema: str) -> DataFrame:
    """``work`` on every stripe of ``base`` and every batch of ``anchors``, lengths apart."""
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = ["row", "vec_id", "label", "v"]
    own = base.select(F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int").alias("stripe"), F.lit(0).alias("kind"), *columns, F.lit(None).cast(POSITIVES).alias("positives"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(1).alias("kind"), *columns, "positives")
    dealt = own.unionByName(asked).withColumn("dims", F.size("v")).repartitionById(stripes, "stripe")
    in_order = dealt.sortWithinPartitions("stripe", "dims", "kind", "label", F.col("vec_id").asc_nulls_last(), "row")

    def gather(parts: list[tuple[pa.RecordBatch, int, int]], dims: int) -> Rows:
        def column(name: str) -> list[pa.Array]:
            return [b.column(name).slice(i, j - i) for b, i, j in parts]

        x = np.concatenate([c.flatten().to_numpy() for c in column("v")]).astype(np.int64) if dims else np.empty(0, np.int64)
        vec_id = pa.concat_arrays(column("vec_id"))
        row = np.concatenate([c.to_numpy() for c in column("row")])
        given = vec_id.fill_null(0).to_numpy()
        tie = np.empty(len(row), np.int64)
        tie[np.lexsort((row, given, vec_id.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(row))
        return Rows(row, vec_id, np.concatenate([c.to_numpy() for c in column("label")]), residues(x.reshape(len(row), dims), primes),
                    [v for c in column("positives") for v in c.to_pylist()], tie)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, opened, rows = None, [], None, []
        for batch in batches:
            stripe, dims, kind = (batch.column(c).to_numpy() for c in ("stripe", "dims", "kind"))
            cuts = np.flatnonzero((np.diff(stripe) != 0) | (np.diff(dims) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kind)], strict=True):
                if (int(stripe[i]), int(dims[i])) != key:
                    key, parts, opened = (int(stripe[i]), int(dims[i])), [], None
                if kind[i] == 0:
                    parts.append((batch, i, j))
                elif parts:
                    opened = opened or gather(parts, key[1])
                    for one in work(opened, gather([(batch, i, j)], key[1]), primes):
                        rows.append(one)
                        if len(rows) >= 50_000:
                            yield out(rows)
                            rows = []
        if rows:
            yield out(rows)

    return in_order.mapInArrow(run, schema)


def integers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, within what lets scores fit into a long."""
    room = F.lit(float(MOST_SCORE)) / F.greatest(F.size(embedding), F.lit(1))
    most = F.floor(F.sqrt(room)) - 1
    return F.transform(embedding, lambda x: F.least(most, F.greatest(-most, F.floor(F.least(F.lit(1e15), F.greatest(F.lit(-1e15), scale * x))))).cast("int"))


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
         vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by ``every``. Their positives are the
    ``positives`` highest-scoring other rows of the same label; the negatives of a
    positive are the ``negatives`` highest-scoring rows of another label with a score
    of ``least`` to ``most`` hundredths of the positive's. Equal scores go by id, null
    last. Rows with a null label or vector, or a null or non-finite component take no
    part; a row without id is no anchor, but may be found. Each row counts on its own,
    however often its id or content is repeated. Vectors of different lengths never
    meet; empty ones score 0. Integer components are held within the range in which
    100 times a score fits a long (about 38 million for 64 components). An empty table
    gives no rows.
    """
    bounded_batches(vectors.sparkSession)
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v")).filter(
        F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    base = stored(usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", integers(F.col("v")).alias("v")), "mined-rows")
    largest = F.max(F.aggregate("v", F.lit(0), lambda a, x: F.greatest(a, F.abs(x))))
    sizes = base.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), largest.alias("most")).agg(
        F.max("n"), F.max(F.col("n") * F.greatest("dims", F.lit(1))), F.max("dims"), F.max(F.col("most").cast("long"))).first()
    n, values, dims, top = (x or 0 for x in sizes)
    primes = primes_for(dims * top * top if dims * top * top <= MOST_SCORE else MOST_SCORE)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    stripes = int(max(1, min(2 * cores, n // STRIPE_ROWS), -(-values // STRIPE_VALUES)))
    anchors = base.filter(F.col("vec_id") % every == 0)

    by_score = [F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"]
    near = _visit(base, anchors.withColumn("positives", F.lit(None).cast(POSITIVES)), stripes, primes, positives_of(positives), FOUND)
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("anchor_row").orderBy(*by_score))).filter(F.col("n") <= positives)
    chosen = stored(ranked.groupBy("anchor_row").agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("positives")), "positives")
    asking = anchors.join(chosen, anchors["row"] == chosen["anchor_row"]).drop("anchor_row")
    found = _visit(base, asking, stripes, primes, negatives_of(negatives, least, most), MINED)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "positive_row").orderBy(*by_score))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
