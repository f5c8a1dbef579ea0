"""Ranked lexical search over a length-stratified index.

A document's length only enters its score through the normaliser m, so documents of
equal m are a stratum: there a term's contribution depends on its frequency alone.
The index holds, per stratum (or part of a large one), the postings of each term
grouped by falling frequency. Impacts are worked out once per frequency, the highest
frequencies of an item's terms bound what a stratum can add, and each item visits
strata by falling bounds until none can reach its tenth-best score.

The index is a Parquet table: strata are dealt to tasks by ranges of m, and a stratum
with very many documents is several rows. Searching reads it once per block of items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fieldlake.llm.common import bounded_batches, stored_wide
from fieldlake.session import stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Postings per task that builds, per index row, and held at a time by a search.
TASK_POSTINGS, ROW_POSTINGS, HELD_POSTINGS = 4_000_000, 50_000, 1_000_000
#: Item terms per block: what a search holds of the items.
BLOCK_TERMS = 200_000

#: One row per document: its terms in one string, parted by blanks, and their frequencies as 32-bit integers.
COUNTED = "salt long, doc_id long, n long, size int, terms string, tfs binary"
INDEX = ("m long, doc_ids array<long>, terms array<string>, counts array<int>, term_at array<int>, tfs array<int>, "
         "group_at array<int>, places array<int>")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to term frequencies; texts without a term give no row. ``salt`` is a number of its own for each row."""
    salt = np.uint64(TaskContext.get().partitionId() << 40)
    done = 0
    for batch in batches:
        ids, ns, sizes, terms, tfs = [], [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            counts = Counter(TERM.findall((text.as_py() or b"").lower()))  # of bytes: only A-Z change
            if counts:
                ids.append(doc_id)
                ns.append(counts.total())
                sizes.append(len(counts))
                terms.append(b" ".join(counts))
                tfs.append(np.fromiter(counts.values(), np.int32, len(counts)).tobytes())
        own = (salt + np.arange(done, done + len(ids), dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        done += len(ids)
        yield pa.RecordBatch.from_arrays([
            pa.array(own.view(np.int64)), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(sizes, pa.int32()),
            pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.binary())], [c.split()[0] for c in COUNTED.split(", ")])


def _stratify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted documents in order of m to index rows, one per stratum or ``ROW_POSTINGS`` of one."""
    names = [c.split()[0] for c in INDEX.split(", ")]

    def row(m: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        doc_ids, sizes, texts = (pa.concat_arrays([p.column(c) for p in parts]) for c in ("doc_id", "size", "terms"))
        terms = pc.split_pattern(texts, " ").flatten().dictionary_encode()
        tf = np.frombuffer(b"".join(v for p in parts for v in p.column("tfs").to_pylist()), np.int32)
        code, doc = terms.indices.to_numpy(), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes.to_numpy())
        order = np.lexsort((doc, -tf, code))
        code, tf, doc = code[order], tf[order], doc[order]
        new_term = np.concatenate([[True], code[1:] != code[:-1]])
        new_group = new_term | np.concatenate([[True], tf[1:] != tf[:-1]])
        group_at = np.flatnonzero(new_group)
        first = np.flatnonzero(new_term)
        values = [doc_ids, terms.dictionary, np.diff(np.append(first, len(code))), np.append(np.searchsorted(group_at, first), len(group_at)),
                  tf[group_at], np.append(group_at, len(code)), doc]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int64())] + [
            pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v.astype(np.int32)))
            for v in values], names)

    held, parts, postings = None, [], 0
    for batch in batches:
        m = batch.column("m").to_numpy()
        total = np.cumsum(batch.column("size").to_numpy().astype(np.int64))
        first = 0
        while first < len(m):
            if parts and (m[first] != held or postings >= ROW_POSTINGS):
                yield row(held, parts)
                parts, postings = [], 0
            held, before = int(m[first]), int(total[first - 1]) if first else 0
            last = max(first + 1, min(int(np.searchsorted(m, held, "right")), int(np.searchsorted(total, before + ROW_POSTINGS - postings, "right"))))
            parts.append(batch.slice(first, last - first))
            postings += int(total[last - 1]) - before
            first = last
    if parts:
        yield row(held, parts)


class Index:
    """A stored index with the collection's figures: ``docs`` (N) and ``terms`` (L, with repeats)."""

    def __init__(self, rows: DataFrame, docs: int, terms: int):
        self.rows, self.docs, self.terms = rows, docs, terms


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of all rows of ``docs`` that hold a term; each row counts on its own."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = stored_wide(rows.mapInArrow(_count_terms, COUNTED), "counted-terms")
    n, length, postings = (x or 0 for x in counted.agg(F.count(F.lit(1)), F.sum("n"), F.sum("size")).first())
    dealt = counted.withColumn("m", F.lit(25) + F.expr(f"(75L * n * {n}L) div {max(length, 1)}L"))
    tasks = int(max(1, -(-postings // TASK_POSTINGS), min(2 * docs.sparkSession.sparkContext.defaultParallelism, postings // 100_000)))
    # ranges of m with equal shares of the postings; a stratum larger than a share is spread by salt. One row per m:
    # as many as there are document lengths, however many documents
    shares = dealt.groupBy("m").agg(F.sum("size").alias("own")).withColumn(
        "before", F.sum("own").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("own"))
    shares = stored(shares.withColumnRenamed("m", "of_m"), "strata-shares")
    at = F.col("before") + F.col("own") * (F.shiftrightunsigned("salt", 11).cast("double") / float(1 << 53))
    task = F.least(F.floor(at * tasks / float(max(postings, 1))), F.lit(tasks - 1)).cast("int")
    placed = dealt.join(shares, F.col("m") == F.col("of_m")).select(task.alias("task"), "m", "doc_id", "size", "terms", "tfs")
    in_order = placed.repartitionById(tasks, "task").sortWithinPartitions("m").drop("task")
    return Index(stored_wide(in_order.mapInArrow(_stratify, INDEX), "strata"), n, length)


class _Stratum:
    """One index row, cut down to the postings of the terms asked for."""

    def __init__(self, m: int, doc_ids: pa.Array, names: np.ndarray, term_at: np.ndarray, tfs: np.ndarray, group_at: np.ndarray, places: np.ndarray):
        known = np.flatnonzero(names >= 0)
        known = known[np.argsort(names[known])]
        self.doc_ids, self.null = doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False)
        self.names = names[known]
        self.span = np.stack([group_at[term_at[known]], group_at[term_at[known + 1]]], 1) if len(known) else np.empty((0, 2), np.int64)
        kinds, which = np.unique(tfs, return_inverse=True)
        impact = (1_000_000_000 * kinds) // (1000 * kinds + 8 * m)  # once per frequency
        self.impact = np.repeat(impact[which], np.diff(group_at))
        self.places = places
        self.most = self.impact[self.span[:, 0]]  # groups fall: the first is the highest


class _Best:
    """The best documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.least, self.rows = k, 1, []

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, null: np.ndarray) -> None:
        places = np.flatnonzero(scores >= self.least)
        if not len(places):
            return
        some = scores[places]
        places = places[np.lexsort((doc_ids[places], null[places], -some))][: self.k]
        self.rows = sorted(self.rows + list(zip((-scores[places]).tolist(), null[places].tolist(), doc_ids[places].tolist(), strict=True)))[: self.k]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _search(items: list[int | None], at: np.ndarray, term: np.ndarray, weight: np.ndarray, vocabulary: list[str],
            k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best ``k`` documents of each item among the index rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(vocabulary, pa.string())
        best = [_Best(k) for _ in items]
        held: list[_Stratum] = []
        postings = 0

        def visit() -> None:
            bounds = np.zeros((len(held), len(items)), np.int64)
            for u, stratum in enumerate(held):
                most = np.zeros(len(vocabulary), np.int64)
                most[stratum.names] = stratum.most
                bounds[u] = np.add.reduceat(weight * most[term], at[:-1])
            order = np.argsort(-bounds, axis=0, kind="stable")
            for i, mine in enumerate(best):
                own, w = term[at[i] : at[i + 1]], weight[at[i] : at[i + 1]]
                for u in order[:, i]:
                    if bounds[u, i] < mine.least:
                        break
                    stratum = held[u]
                    place = np.searchsorted(stratum.names, own)
                    score = np.zeros(len(stratum.doc_ids), np.int64)
                    for p, name, x in zip(place.tolist(), own.tolist(), w.tolist(), strict=True):
                        if p < len(stratum.names) and stratum.names[p] == name:
                            a, b = stratum.span[p]
                            score[stratum.places[a:b]] += x * stratum.impact[a:b]
                    mine.add(score, stratum.doc_ids, stratum.null)

        for batch in batches:
            for j in range(batch.num_rows):
                m = batch.column("m")[j].as_py()
                doc_ids, terms, term_at, tfs, group_at, places = (
                    batch.column(c)[j].values for c in ("doc_ids", "terms", "term_at", "tfs", "group_at", "places"))
                names = pc.index_in(terms, asked).fill_null(-1).to_numpy()
                if not (names >= 0).any():
                    continue
                held.append(_Stratum(m, doc_ids, names, term_at.to_numpy(), tfs.to_numpy().astype(np.int64), group_at.to_numpy(), places.to_numpy()))
                postings += len(places)
                if postings >= HELD_POSTINGS:
                    visit()
                    held, postings = [], 0
        if held:
            visit()
        rows = [(i, None if null else doc, -score) for i, b in zip(items, best, strict=True) for score, null, doc in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to one row per distinct term and how often it occurs."""
    for batch in batches:
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
            counts = Counter(TERM.findall((text or b"").lower()))
            yield pa.RecordBatch.from_arrays([
                pa.array([item] * len(counts), pa.int64()), pa.array(counts, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())],
                ["item_id", "term", "times"])


def weights(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term, weight: the terms of each item that some document holds, repeats counted in.

    Rows repeated in full count once; different texts of one item_id are one item.
    """
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    counted = rows.mapInArrow(_item_terms, "item_id long, term string, times long")
    asked = stored(counted.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "item-terms")
    held = index.rows.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    rarity = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * index.docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    return asked.join(df, "term").select("item_id", "term", (rarity * F.col("times")).alias("weight"))


def search(index: Index, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` highest-scoring documents of each item.

    Scores are exact. Only scores above 0 count; equal ones go by ascending doc_id,
    null last. Each document row counts on its own, also without or with a repeated
    doc_id. Null and empty texts have no terms: as documents they are never found and
    not counted, as items they give no rows; so do empty tables.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    asked = stored(weights(index, items, item_id, text), "item-weights")
    blocks = 1 + asked.count() // BLOCK_TERMS
    found = None
    for block in range(blocks):  # a block of bounded size goes to the tasks, each reads the index once
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "term").collect()
        if not rows:
            continue
        vocabulary = sorted({r.term for r in rows})
        number = {t: i for i, t in enumerate(vocabulary)}
        starts = [i for i, r in enumerate(rows) if i == 0 or r.item_id != rows[i - 1].item_id]
        task = _search([rows[i].item_id for i in starts], np.array([*starts, len(rows)]), np.array([number[r.term] for r in rows]),
                       np.array([r.weight for r in rows], np.int64), vocabulary, k)
        part = index.rows.mapInArrow(task, "item_id long, doc_id long, score long")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
