"""Exact duplicates by Grace hashing with recursive spilling.

Texts are equal when they are identical after each run of ASCII white space has
become one space. Records are dealt to buckets by their digest; a bucket is read as
a stream into an open-addressing table that compares whole contents. Once a table
holds ``BUDGET`` bytes it takes no further content: records equal to one in the
table still meet it there, all others go to spill files in the shared folder. The
spilled records are dealt again by another hash, to as many buckets as their bytes
need, until no bucket spills. So a content is settled on one level as a whole,
memory is bounded by the budget, and a content with any number of copies takes the
room of one.

Input tasks merge equal contents before the first shuffle: a content leaves a task
once per ``LOCAL_BYTES`` of different contents, with the ids of its rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import bounded_batches
from fieldlake.session import work_path

#: Bytes of different contents in the table of one bucket.
BUDGET = 64 << 20
#: Bytes of different contents, and rows, that an input task merges at a time.
LOCAL_BYTES, LOCAL_ROWS = 16 << 20, 1 << 16
#: Bytes of content in one batch that leaves a task.
OUT_BYTES = 8 << 20

RECORDS = "sha binary, content binary, ids array<long>"
SETTLED = "gid long, link long, ids array<long>, keep_id long, size long, sha binary, content binary, kind int"
LINK, GROUP, SPILLED = 0, 1, 2

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def normalised(texts: pa.Array) -> Iterator[bytes]:
    """Each text with every run of ASCII white space as one space; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + (4 << 20), "right")) - 1)
        part, own = data[at[first] : at[last]], at[first : last + 1] - at[first]
        white = _SPACE[part]
        keep = np.ones(len(part), bool)
        keep[1:] = ~(white[1:] & white[:-1])
        keep[own[:-1][own[:-1] < len(part)]] = True
        whole = np.where(white, np.uint8(32), part)[keep].tobytes()
        ends = np.concatenate([[0], np.cumsum(keep)])[own].tolist()
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield whole[a:b]
        first = last


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self) -> None:
        self.contents: list[bytes] = []
        self.digests: list[bytes] = []
        self.bytes = 0
        self._slots = array("q", [-1]) * 1024

    def _slot(self, digest: bytes, content: bytes) -> int:
        """The slot of the content, or the free one where it belongs."""
        slots, mask = self._slots, len(self._slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (entry := slots[at]) >= 0 and not (self.digests[entry] == digest and self.contents[entry] == content):
            at = (at + 1) & mask
        return at

    def find(self, digest: bytes, content: bytes) -> int:
        """The entry of the content, -1 if it has none."""
        return self._slots[self._slot(digest, content)]

    def add(self, digest: bytes, content: bytes) -> int:
        """A new entry for a content that has none."""
        if 2 * len(self.contents) >= len(self._slots):
            self._slots = array("q", [-1]) * (4 * len(self._slots))
            for entry, (d, c) in enumerate(zip(self.digests, self.contents, strict=True)):
                self._slots[self._slot(d, c)] = entry
        self._slots[self._slot(digest, content)] = len(self.contents)
        self.contents.append(content)
        self.digests.append(digest)
        self.bytes += len(content)
        return len(self.contents) - 1


def _order(doc_id: int | None) -> tuple[bool, int]:
    """Ascending, null last."""
    return doc_id is None, doc_id or 0


def _merge_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to records: one per content and stretch of the task's rows, ids ascending."""
    table, ids, rows = ContentTable(), [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        first = 0
        while first < len(ids):
            last, size = first, 0
            while last < len(ids) and (last == first or size + len(table.contents[last]) <= OUT_BYTES):
                size += len(table.contents[last])
                last += 1
            yield pa.RecordBatch.from_arrays([
                pa.array(table.digests[first:last], pa.binary()), pa.array(table.contents[first:last], pa.binary()),
                pa.array([sorted(i, key=_order) for i in ids[first:last]], pa.list_(pa.int64()))], ["sha", "content", "ids"])
            first = last

    for batch in batches:
        for doc_id, content in zip(batch.column("doc_id").to_pylist(), normalised(batch.column("text")), strict=True):
            digest = hashlib.sha256(content).digest()
            entry = table.find(digest, content)
            if entry < 0:
                entry = table.add(digest, content)
                ids.append([])
            ids[entry].append(doc_id)
            rows += 1
            if table.bytes >= LOCAL_BYTES or rows >= LOCAL_ROWS:
                yield from flush()
                table, ids, rows = ContentTable(), [], 0
    yield from flush()


def _settle(level: int, budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of one bucket to links (record to group), groups, and records to spill."""
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
    names = [c.split()[0] for c in SETTLED.split(", ")]

    def rows(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        table, sizes, least, keeper, n = ContentTable(), [], [], [], 0
        for batch in batches:
            links: list[tuple] = []
            for digest, content, ids in zip(*(batch.column(c).to_pylist() for c in ("sha", "content", "ids")), strict=True):
                entry = table.find(digest, content)
                if entry < 0:
                    if table.bytes and table.bytes + len(content) > budget:
                        links.append((None, None, ids, None, None, digest, content, SPILLED))
                        continue
                    entry = table.add(digest, content)
                    sizes.append(0)
                    least.append(ids[0])
                    keeper.append(base | n)
                links.append((base | entry, base | n, ids, None, None, None, None, LINK))
                sizes[entry] += len(ids)
                if _order(ids[0]) < _order(least[entry]):
                    least[entry], keeper[entry] = ids[0], base | n
                n += 1
            if links:
                yield rows(*map(list, zip(*links, strict=True)))
        for first in range(0, len(sizes), 50_000):
            last = min(first + 50_000, len(sizes))
            k = last - first
            yield rows([base | e for e in range(first, last)], keeper[first:last], [None] * k, least[first:last], sizes[first:last],
                       table.digests[first:last], [None] * k, [GROUP] * k)

    return run


def find_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    Texts are compared whole, after each run of ASCII white space has become one
    space. Of equal texts the row with the smallest doc_id stays; rows without doc_id
    come last, and of rows with the same smallest doc_id exactly one stays. Null
    counts as empty, so null and empty texts are one group; a blank text is one space.
    Each row counts on its own, however often it is repeated. keep_id is null only if
    no row of the group has a doc_id. An empty table gives no rows; other columns of
    ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    left = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pending, level, done = rows.mapInArrow(_merge_locally, RECORDS), 0, []
    while True:
        # half full on average; more than one per core while there is content for them
        least = min(2 * spark.sparkContext.defaultParallelism, 1 + left // (1 << 20))
        buckets = int(max(least, 1 + 2 * left // budget))
        dealt = pending.withColumn("bucket", F.pmod(F.xxhash64("sha", F.lit(level)), F.lit(buckets)).cast("int"))
        path = work_path(spark, f"grace-{level}")
        dealt.repartitionById(buckets, "bucket").select("sha", "content", "ids").mapInArrow(_settle(level, budget), SETTLED).write.partitionBy(
            "kind").parquet(path)
        settled = spark.read.schema(SETTLED).parquet(path)
        done.append(settled)
        spilled = settled.filter(F.col("kind") == SPILLED)
        left = spilled.agg(F.sum(F.octet_length("content"))).first()[0]
        if left is None:
            break
        pending, level = spilled.select("sha", "content", "ids"), level + 1
    links, groups = None, None
    for settled in done:
        own = settled.filter(F.col("kind") == LINK).select("gid", "link", "ids")
        of = settled.filter(F.col("kind") == GROUP).select("gid", F.col("link").alias("keeper"), "keep_id", F.col("size").alias("group_size"), "sha")
        links, groups = (own, of) if links is None else (links.union(own), groups.union(of))
    # a record stands for all its rows here: a hot content has one link per stretch of an input task
    joined = links.join(groups, "gid").select(F.posexplode("ids").alias("at", "doc_id"), "link", "keeper", "keep_id", "group_size", "sha")
    return joined.select(
        "doc_id", "keep_id", "group_size", ((F.col("link") == F.col("keeper")) & (F.col("at") == 0)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
