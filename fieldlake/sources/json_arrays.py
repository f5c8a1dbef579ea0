"""Records of large JSON arrays, read in byte ranges.

An archive file is one array of objects, in any layout. Spark's text source cuts a
file into byte ranges and lines; with ``}`` as the line end every piece ends where a
record may end. Whether it does depends on what came before: is the piece inside a
string, and how many braces are open. A range that is a whole file starts outside and
with none open, and is cut at once. For files of several ranges a first pass sums that
up per range, for both answers to the first question; a running sum over the few ranges
of a file gives each its start; a second pass cuts the records. A record that crosses a
border leaves its parts, which are put together in one small join.

Pieces are looked through a batch at a time, as numpy operations over its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fieldlake.session import stored

#: Parts of a record: up to the first end in a range, after the last one, in a range without one; and whole records.
HEAD, TAIL, MIDDLE, WHOLE = 0, 1, 2, 3
#: Ranges whose state a task is sent.
BLOCK_RANGES = 100_000
#: What cutting gives.
CUT = "path string, start long, at int, text string"
QUOTE, BACKSLASH, OPEN, CLOSE = b'"\\{}'


def _marks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For pieces that lie one after the other: opening braces, the quotes' parity at each and at the end of each piece, number of quotes."""
    quotes = np.flatnonzero(data == QUOTE)
    slashes = data == BACKSLASH
    if slashes.any():  # a quote after an odd number of backslashes of its piece is none
        plain = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(data))))
        first = np.concatenate([[0], ends])[np.searchsorted(ends, quotes, "right")]
        before = np.maximum(np.where(quotes > 0, plain[quotes - 1], -1), first - 1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    opens = np.flatnonzero(data == OPEN)
    return np.stack([opens, np.searchsorted(quotes, opens) % 2]), np.searchsorted(quotes, ends) % 2, len(quotes)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, np.ndarray, np.ndarray]]:
    """Pieces of one range at a time: its path and start, the file's size, their bytes and where each ends."""
    for batch in batches:
        path, start, value = (batch.column(c) for c in ("path", "start", "value"))
        if not len(batch):
            continue
        other = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(other) + 1), len(batch)]
        _, offsets, data = value.buffers()
        at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(value.type) else np.int32)[value.offset : value.offset + len(value) + 1].astype(np.int64)
        every = np.frombuffer(data or b"", np.uint8)
        for a, b in zip(cuts, cuts[1:]):
            yield (path[a].as_py(), start[a].as_py()), batch.column("file_size")[a].as_py(), every[at[a] : at[b]], at[a + 1 : b + 1] - at[a]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: the change of depth and of being inside a string, for a start outside and inside one."""
    key, file_size, depth, flips, size = None, 0, [0, 0], 0, 0

    def out() -> pa.RecordBatch:
        row = (*key, file_size, *depth, bool(flips), size)
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["path", "start", "file_size", "depth_outside", "depth_inside", "flips", "bytes"])

    for own, whole, data, ends in _pieces(batches):
        if own != key:
            if key:
                yield out()
            key, file_size, depth, flips, size = own, whole, [0, 0], 0, 0
        (_, at_open), at_end, quotes = _marks(data, ends)
        for inside in (0, 1):
            outside = inside ^ flips
            depth[inside] += int(np.count_nonzero(at_open == outside)) - int(np.count_nonzero(at_end == outside))
        flips ^= quotes % 2
        size += len(data) + len(ends)
    if key:
        yield out()


class _Range:
    """Cuts the pieces of one range into records: whole ones, and the parts of those at its borders."""

    def __init__(self, key: tuple[str, int], start: tuple[int, bool, bool] | None):
        self.key, self.lone = key, start is None
        self.depth, self.inside, self.unclosed = start or (0, False, None)
        self.parts: list[bytes] = []
        self.size, self.ended = 0, False
        self.held = np.empty(0, np.uint8)
        self.holds = False

    def out(self, kind: int, data, offsets) -> pa.RecordBatch:
        n = len(offsets) - 1
        text = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]).cast(pa.string())
        path, start = self.key
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(path, pa.string()), n), pa.repeat(pa.scalar(start, pa.int64()), n), pa.repeat(pa.scalar(kind, pa.int32()), n), text], ["path", "start", "at", "text"])

    def add(self, data: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The next pieces. The last one is held: it may be one that no brace closes."""
        self.size += len(data) + len(ends)
        if self.holds:
            data, ends = np.concatenate([self.held, data]), np.concatenate([[len(self.held)], ends + len(self.held)])
        last = int(ends[-2]) if len(ends) > 1 else 0
        self.held, self.holds = data[last:].copy(), True
        if len(ends) > 1:
            yield from self._cut(data[:last], ends[:-1])

    def _cut(self, data: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        (opens, at_open), at_end, quotes = _marks(data, ends)
        outside = int(self.inside)
        opened = np.searchsorted(opens[at_open == outside], ends)
        closed = at_end == outside
        depth = self.depth + opened - np.cumsum(closed)
        done = np.flatnonzero(closed & (depth == 0))
        self.depth, self.inside = int(depth[-1]), self.inside != bool(quotes % 2)
        closes = ends + np.arange(len(ends))
        text = np.empty(len(data) + len(ends), np.uint8)
        given = np.ones(len(text), bool)
        given[closes] = False
        text[given], text[closes] = data, CLOSE
        if not len(done):
            self.parts.append(text.tobytes())
            return
        stops = closes[done] + 1
        if self.parts or not (self.ended or self.lone):
            first = b"".join(self.parts) + text[: stops[0]].tobytes()
            yield self.out(WHOLE if self.ended or self.lone else HEAD, first, np.array([0, len(first)]))
        else:
            stops = np.concatenate([[0], stops])
        if len(stops) > 1:
            yield self.out(WHOLE, text, stops)
        self.parts, self.ended = [text[stops[-1] :].tobytes()] if stops[-1] < len(text) else [], True

    def close(self, file_size: int) -> Iterator[pa.RecordBatch]:
        if self.holds and not (self.size > file_size if self.lone else self.unclosed):
            yield from self._cut(self.held, np.array([len(self.held)]))
        if self.parts and not self.lone:
            rest = b"".join(self.parts)
            yield self.out(TAIL if self.ended else MIDDLE, rest, np.array([0, len(rest)]))


def _cut(starts: dict[tuple[str, int], tuple[int, bool, bool]] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces to records: whole ones, and the parts of those at the borders of a range.

    ``starts`` says of a range how many braces are open, whether a string is, and whether
    the range ends with a piece that no brace closes. Without it every range is a whole file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size = None, 0
        for key, file_size, data, ends in _pieces(batches):
            if now is None or key != now.key:
                if now:
                    yield from now.close(size)
                if starts is not None and key not in starts:
                    raise RuntimeError("files or the size of their ranges have changed since they were summed up")
                now, size = _Range(key, None if starts is None else starts[key]), file_size
            yield from now.add(data, ends)
        if now:
            yield from now.close(size)

    return run


def records(spark: SparkSession, path: str, suffix: str = "json") -> DataFrame:
    """path and text of every object in the arrays below a folder.

    Braces, quotes and backslashes inside strings are data. A file may hold an array,
    one or more objects, or nothing. What follows the last complete object of a file
    is left out.
    """
    length, size = F.col("_metadata.file_block_length"), F.col("_metadata.file_size")
    every = (
        spark.read.option("lineSep", "}").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", size.alias("file_size"), (length == size).alias("lone")))
    lone, pieces = every.filter("lone").drop("lone"), every.filter("NOT lone").drop("lone")
    whole = lone.mapInArrow(_cut(None), CUT).select("path", "text")
    sums = stored(pieces.mapInArrow(_summaries, "path string, start long, file_size long, depth_outside long, depth_inside long, flips boolean, bytes long"), "json-ranges")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("flips").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    change = F.when(F.col("inside"), F.col("depth_inside")).otherwise(F.col("depth_outside"))
    starts = sums.withColumn("inside", inside).withColumn("change", change).withColumn(
        "depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    # a piece and its brace for each byte, and one more if the last piece has none
    whole_file = Window.partitionBy("path")
    unclosed = (F.col("start") == F.max("start").over(whole_file)) & (F.sum("bytes").over(whole_file) > F.col("file_size"))
    starts = starts.select("path", "start", "depth", "inside", unclosed.alias("unclosed"))
    ranges = sums.count()
    blocks = 1 + ranges // BLOCK_RANGES
    cut = None
    for block in range(blocks):  # files in blocks, so that a task is sent a bounded number of ranges
        mine = F.pmod(F.xxhash64("path"), F.lit(blocks)) == block
        known = {(r.path, r.start): (r.depth, r.inside, r.unclosed) for r in starts.filter(mine).collect()}
        part = pieces.filter(mine).mapInArrow(_cut(known), CUT)
        cut = part if cut is None else cut.union(part)
    borders = cut.filter(F.col("at") != WHOLE)
    # a record goes from a tail over middles to the next head: it is numbered by the heads before it
    number = F.coalesce(F.sum((F.col("at") == HEAD).cast("int")).over(
        Window.partitionBy("path").orderBy("start", "at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = borders.withColumn("number", number).groupBy("path", "number").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "at", "text"))), lambda p: p["text"]), "").alias("text"),
        F.bool_or(F.col("at") == HEAD).alias("complete")).filter("complete")
    if ranges:
        whole = whole.unionByName(cut.filter(F.col("at") == WHOLE).select("path", "text")).unionByName(joined.select("path", "text"))
    return whole.select("path", F.expr("substring(text, instr(text, '{'))").alias("text"))
