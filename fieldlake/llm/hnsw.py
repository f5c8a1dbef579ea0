"""Nearest neighbours by inner product, with a small-world graph per shard.

Distinct vectors are dealt to shards by hash. Each shard builds a hierarchical
navigable small-world graph and stores it as flat arrays: vectors, row ids, and one
neighbour array per layer, and the search width at which it finds what it should,
measured against all its vectors. Queries visit every shard; the shards' best are merged.

The arrays of a shard are stored and sent in pieces, so no row is large. Shards are
dealt to groups: a task holds the queries of its group in a temporary file, opens one
shard after the other, and sends the best of all of them.

Inside a shard vectors get one more component that makes all norms equal, so that
the nearest direction is the largest inner product. Nodes are numbered by falling
level, so a layer is the first so many nodes. Insertion and search run for many
nodes in step, as numpy operations.
"""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterable, Iterator
from typing import IO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fieldlake.llm.common import bounded_batches, stored_wide, tidy
from fieldlake.session import stored

#: Links chosen for a new node; twice as many are kept in the lowest layer.
LINKS = 14
BUILD_WIDTH, SEARCH_WIDTH = 64, 96
#: Share of the true nearest that a shard's search must find, on so many of its vectors (spread evenly over it).
RECALL, TRIALS = 0.97, 128
#: Most bytes of a shard's vectors: a shard is one row of the index.
SHARD_BYTES = 128 << 20
#: Nodes expanded at a time by one search.
EXPAND = 4
#: Most bytes of a piece of the index or of the queries, if it has more than one vector.
PIECE_BYTES = 1 << 20
#: Numbers that a step gathers, and candidates that it scores, at a time.
GATHERED, SCORED = 1 << 21, 1 << 19
#: Numbers copied for products at a time: they stay in a core's cache.
COPIED = 1 << 17


def shard_rows(n: int, dims: int) -> int:
    """Vectors per shard: a 64th of all, between 4,096 and 262,144, and no more than ``SHARD_BYTES`` hold."""
    return int(max(1, min(262_144, max(4_096, n // 64), SHARD_BYTES // (8 * dims))))


class Graph:
    """Layers of neighbour lists over rows of ``x`` (float32, equal norms), by falling level."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray, sizes: list[int]) -> Graph:
        """``sizes``: nodes of each layer from the lowest up; each at most the one before."""
        graph = cls(x, [np.empty((0, 0), np.int32)] * len(sizes))
        for layer in reversed(range(len(sizes))):
            graph._fill(layer, sizes[layer])
        return graph

    def _fill(self, layer: int, n: int) -> None:
        room = LINKS * (2 if layer == 0 else 1)
        nbr = np.full((n, room), -1, np.int32)
        self.layers[layer] = nbr
        done = 0
        while done < n:
            size = min(n - done, 1024, max(128, done))
            new = np.arange(done, done + size)
            q = self.x[new]
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            k = min(BUILD_WIDTH, size)
            near = np.argpartition(-own, k - 1, axis=1)[:, :k]
            ids, sims = near + done, np.take_along_axis(own, near, 1)
            if done:
                found, found_sims = self.search(q, BUILD_WIDTH, layer, live=done)
                ids, sims = np.concatenate([ids, found], 1), np.concatenate([sims, found_sims], 1)
            ids = np.where(np.isfinite(sims), ids, -1)
            chosen = self._diverse(ids, sims, LINKS)
            nbr[new, :LINKS] = chosen
            self._tie_back(nbr, np.repeat(new, LINKS), chosen.ravel(), room)
            done += size

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` ids per row, nearest first: those nearer to the row than to one chosen before, then the rest."""
        out = np.full((len(ids), most), -1, np.int32)
        step = max(1, min(256, 2 * GATHERED // (ids.shape[1] * self.x.shape[1])))
        for at in range(0, len(ids), step):
            i, s = ids[at : at + step], np.where(ids[at : at + step] >= 0, sims[at : at + step], -np.inf)
            order = np.argsort(-s, axis=1, kind="stable")
            i, s = np.take_along_axis(i, order, 1), np.take_along_axis(s, order, 1)
            v = self.x[np.maximum(i, 0)]
            between = np.matmul(v, v.transpose(0, 2, 1))
            good, closest = np.zeros(i.shape, bool), np.full(i.shape, -np.inf, np.float32)
            left = np.minimum(np.isfinite(s).sum(1), most)
            for j in range(i.shape[1]):
                good[:, j] = np.isfinite(s[:, j]) & (closest[:, j] < s[:, j]) & (left > 0)
                some = np.flatnonzero(good[:, j])
                left[some] -= 1
                if not left.any():
                    break
                closest[some] = np.maximum(closest[some], between[some, j])
            rank = np.where(np.isfinite(s), np.where(good, 0, 1), 2)
            take = np.argsort(rank, axis=1, kind="stable")[:, :most]
            kept = np.where(np.take_along_axis(rank, take, 1) < 2, np.take_along_axis(i, take, 1), -1)
            out[at : at + step, : kept.shape[1]] = kept
        return out

    def _products(self, ids: np.ndarray, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Products of nodes ``ids`` with ``rows`` of ``q``, so many pairs at a time that few vectors are copied."""
        out, step = np.empty(len(ids), np.float32), max(1, COPIED // q.shape[1])
        for at in range(0, len(ids), step):
            out[at : at + step] = np.einsum("ij,ij->i", self.x.take(ids[at : at + step], 0), q.take(rows[at : at + step], 0))
        return out

    def _tie_back(self, nbr: np.ndarray, source: np.ndarray, target: np.ndarray, room: int) -> None:
        """Adds ``source`` to the lists of ``target``; full lists keep a diverse choice."""
        ok = target >= 0
        source, target = source[ok], target[ok]
        sims = self._products(source, self.x, target)
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        rows, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        keep = place < 2 * room
        wide = np.full((len(rows), room + min(2 * room, int(count.max(initial=0)))), -1, np.int32)
        wide[:, :room] = nbr[rows]
        wide[np.repeat(np.arange(len(rows)), count)[keep], room + place[keep]] = source[keep]
        old = wide[:, :room]
        wide[:, room:][(wide[:, room:, None] == old[:, None, :]).any(2)] = -1
        fits = (wide >= 0).sum(1) <= room
        packed = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), 1)[:, :room]
        nbr[rows[fits]] = packed[fits]
        over = np.flatnonzero(~fits)
        step = max(1, min(512, 2 * GATHERED // (wide.shape[1] * self.x.shape[1])))
        for at in range(0, len(over), step):
            some = over[at : at + step]
            s = np.einsum("rkd,rd->rk", self.x[np.maximum(wide[some], 0)], self.x[rows[some]])
            nbr[rows[some]] = self._diverse(wide[some], s, room)

    def search(self, q: np.ndarray, width: int, layer: int = 0, live: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found in ``layer`` for each row of ``q``, and their products; -1 and -inf fill up."""
        entry = np.zeros(len(q), np.int64)
        for upper in range(len(self.layers) - 1, layer, -1):
            if len(self.layers[upper]):
                entry = self._layer(q, entry, 1, upper, None)[0][:, 0]
        return self._layer(q, entry, width, layer, live)

    def _layer(self, q: np.ndarray, entry: np.ndarray, width: int, layer: int, live: int | None) -> tuple[np.ndarray, np.ndarray]:
        nbr = self.layers[layer]
        n = len(nbr)
        out_ids, out_sims = np.full((len(q), width), -1, np.int64), np.full((len(q), width), -np.inf, np.float32)
        block = int(max(16, min(512, 32_000_000 // max(n, 1), GATHERED // width)))
        for at in range(0, len(q), block):
            b = q[at : at + block]
            seen = np.zeros(len(b) * n, bool)
            ids, sims = out_ids[at : at + block], out_sims[at : at + block]
            open_ = np.zeros(ids.shape, bool)
            start = entry[at : at + block] if live is None else np.where(entry[at : at + block] < live, entry[at : at + block], 0)
            ids[:, 0], sims[:, 0], open_[:, 0] = start, np.einsum("ij,ij->i", self.x[start], b), True
            seen[np.arange(len(b)) * n + start] = True
            while len(rows := np.flatnonzero(open_.any(1))):
                o = open_[rows]
                r, c = np.nonzero(o & (np.cumsum(o, 1, dtype=np.int32) <= EXPAND))
                r = rows[r]
                open_[r, c] = False
                nb = nbr[ids[r, c]]
                key = (nb + (r * n)[:, None])[nb >= 0]  # of row and node
                key = np.sort(key[~seen[key]])
                key = key[np.diff(key, prepend=-1) != 0]
                seen[key] = True
                r, new = np.divmod(key, n)
                near = self._products(new, b, r)
                # what is behind a full list stays out; rows are in order
                better = np.flatnonzero(~(near <= sims[r, -1]))
                r, new, near = r[better], new[better], near[better]
                first = np.flatnonzero(np.diff(r, prepend=-1))
                rows, count = r[first], np.diff(first, append=len(r))
                if not len(rows):
                    continue
                to = np.repeat(np.arange(len(rows)), count), np.arange(len(r)) - np.repeat(first, count) + width
                all_ids, all_sims = np.full((len(rows), width + count.max()), -1, np.int64), np.full((len(rows), width + count.max()), -np.inf, np.float32)
                all_open = np.zeros(all_ids.shape, bool)
                all_ids[:, :width], all_sims[:, :width], all_open[:, :width] = ids[rows], sims[rows], open_[rows]
                all_ids[to], all_sims[to], all_open[to] = new, near, True
                best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width] + (np.arange(len(rows)) * all_ids.shape[1])[:, None]
                ids[rows], sims[rows], open_[rows] = all_ids.ravel()[best], all_sims.ravel()[best], all_open.ravel()[best]
        return out_ids, out_sims


def layer_sizes(n: int) -> list[int]:
    """Nodes per layer: each layer has a ``LINKS``-th of the one below, at least one."""
    sizes = [n]
    while sizes[-1] > 4 * LINKS:
        sizes.append(sizes[-1] // LINKS)
    return sizes


def search_width(graph: Graph, k: int, recall: float = RECALL) -> int:
    """The least width, doubled from ``SEARCH_WIDTH`` on, that finds ``recall`` of the ``k`` nearest of trial vectors.

    Trials are measured against all nodes, in blocks. Of equally near nodes any counts.
    """
    n = len(graph.x)
    k = min(k, n)
    trial = graph.x[np.unique(np.linspace(0, n - 1, min(n, TRIALS)).astype(np.int64))].copy()
    trial[:, -1] = 0  # as queries come, without the filling component
    best = np.full((len(trial), k), -np.inf, np.float32)
    for at in range(0, n, 16_384):
        both = np.concatenate([best, trial @ graph.x[at : at + 16_384].T], 1)
        best = -np.partition(-both, k - 1, axis=1)[:, :k]
    least = best.min(axis=1) - 1e-5 * np.abs(best).max(axis=1)
    width = max(SEARCH_WIDTH, 2 * k)
    while width < n:
        sims = graph.search(trial, width)[1]
        if (sims >= least[:, None]).sum(axis=1).clip(max=k).mean() >= recall * k:
            break
        width *= 2
    return min(width, max(n, SEARCH_WIDTH))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added up from the first component on."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    kind = vectors.schema[embedding].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(embedding) if single else F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0.0)).distinct()


#: ``part`` names the array that ``data`` is a piece of; pieces are numbered through the shard.
INDEX = "shard long, dims int, piece int, part string, data binary"
PARTS = ("header", "vectors", "row_at", "row_ids", "neighbours")
QUERIES = "dims int, data binary"


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _cut(a: np.ndarray) -> Iterator[bytes]:
    """The rows of ``a`` as bytes, in pieces of ``PIECE_BYTES`` or one row."""
    step = max(1, PIECE_BYTES // (a.itemsize * (a.shape[1] if a.ndim > 1 else 1)))
    return (a[at : at + step].tobytes() for at in range(0, len(a), step))


def _fill_norms(wide: np.ndarray, x: np.ndarray) -> None:
    """Sets the last component of ``wide`` so that all norms are equal; ``x`` has the vectors as given."""
    square, step = np.empty(len(x)), max(1, GATHERED // x.shape[1])
    for at in range(0, len(x), step):
        some = x[at : at + step].astype(np.float64)
        square[at : at + step] = np.einsum("ij,ij->i", some, some)
    wide[:, -1] = np.sqrt(np.maximum(square.max() - square, 0))


def pieces(xs: list[np.ndarray], counts: np.ndarray, ids: np.ndarray, keep: int) -> Iterator[tuple[str, bytes]]:
    """Builds the graph of vectors given in blocks (taken from ``xs``) and gives its arrays: part and bytes.

    ``counts`` has the number of ids of each vector, ``ids`` all of them.
    """
    n, dims, exact = sum(map(len, xs)), xs[0].shape[1], xs[0].dtype != np.float32
    wide, at = np.empty((n, dims + 1), np.float32), 0
    x = np.empty((n, dims)) if exact else wide[:, :-1]
    while xs:
        some = xs.pop(0)
        wide[at : at + len(some), :-1] = x[at : at + len(some)] = some
        at += len(some)
    _fill_norms(wide, x)
    sizes = layer_sizes(n)
    graph = Graph.build(wide, sizes)
    yield "header", np.array([n, len(ids), search_width(graph, keep), exact, *sizes], np.int64).tobytes()
    for part, arrays in (("vectors", [x]), ("row_at", [np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]), ("row_ids", [ids]), ("neighbours", [layer.ravel() for layer in graph.layers])):
        yield from ((part, data) for a in arrays for data in _cut(a))


def build(base: DataFrame, shards: int, keep: int) -> DataFrame:
    """The index of ``base`` (vec_id, v): flat arrays per shard, in pieces.

    Equal vectors are one node that carries its ``keep`` smallest ids; no search for
    fewer neighbours can need more. Ranks are limited before the shuffle, so a vector
    with many copies sends few rows.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = base.withColumn("rank", rank).filter(F.col("rank") <= keep).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    double = F.col("v").cast("array<double>")
    dealt = nodes.withColumn("shard", F.size("v").cast("long") * shards + F.pmod(F.xxhash64(double), F.lit(shards))).withColumn("order", F.xxhash64(double, F.lit("level")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
            """Runs of one shard: its number, vectors, how many ids each has, and the ids."""
            for batch in batches:
                shard, v, own = (batch.column(c) for c in ("shard", "v", "ids"))
                shard, at, of = shard.to_numpy(), v.offsets.to_numpy(), own.offsets.to_numpy()
                starts = np.flatnonzero(np.diff(shard, prepend=shard[:1] - 1))
                for a, b in zip(starts, [*starts[1:], len(shard)], strict=True):
                    flat = v.values.slice(at[a], at[b] - at[a]).to_numpy(zero_copy_only=False)
                    yield int(shard[a]), flat.reshape(b - a, -1).copy(), np.diff(of[a : b + 1]), own.values.slice(of[a], of[b] - of[a]).to_numpy().copy()

        for shard, runs in itertools.groupby(rows(), key=lambda r: r[0]):
            xs, counts, ids = [], [], []
            for _, x, count, own in runs:
                xs.append(x)
                counts.append(count)
                ids.append(own)
            dims = xs[0].shape[1]
            for k, (part, data) in enumerate(pieces(xs, np.concatenate(counts), np.concatenate(ids), keep)):
                yield _batch([[shard], [dims], [k], [part], [data]], INDEX)

    sorted_ = dealt.repartitionById(shards, F.pmod("shard", F.lit(shards)).cast("int")).sortWithinPartitions("shard", "order")
    return sorted_.select("shard", "v", "ids").mapInArrow(tidy(run), INDEX)


def open_index(dims: int, parts: Iterable[tuple[str, memoryview]]) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray, int]:
    """Graph, vectors as given, the ids of each node, and the search width of a shard, from its pieces in order."""
    parts = iter(parts)
    n, n_ids, width, exact, *sizes = np.frombuffer(next(parts)[1], np.int64).tolist()
    wide = np.empty((n, dims + 1), np.float32)
    x = np.empty((n, dims)) if exact else wide[:, :-1]
    rooms = [LINKS * (2 if k == 0 else 1) for k in range(len(sizes))]
    into = {"row_at": np.empty(n + 1, np.int64), "row_ids": np.empty(n_ids, np.int64), "neighbours": np.empty(sum(map(int.__mul__, sizes, rooms)), np.int32)}
    done = dict.fromkeys(PARTS, 0)
    for part, data in parts:
        if part == "vectors":
            some = np.frombuffer(data, x.dtype).reshape(-1, dims)
            at = slice(done[part], done[part] + len(some))
            wide[at, :-1] = x[at] = some
        else:
            some = np.frombuffer(data, into[part].dtype)
            into[part][done[part] : done[part] + len(some)] = some
        done[part] += len(some)
    _fill_norms(wide, x)
    layers, at = [], 0
    for size, room in zip(sizes, rooms, strict=True):
        layers.append(into["neighbours"][at : at + size * room].reshape(size, room))
        at += size * room
    return Graph(wide, layers), x, into["row_at"], into["row_ids"], width


def _best(row: np.ndarray, neg: np.ndarray, vec: np.ndarray, n: int, k: int) -> tuple[np.ndarray, ...]:
    """Of entries (row under ``n``, negated score, id): the best ``k`` of each row in order, and how many each row has."""
    order = np.lexsort((vec, neg, row))
    row, neg, vec = row[order], neg[order], vec[order]
    top = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[top], neg[top], vec[top], np.bincount(row[top], minlength=n)


def answer(opened: tuple, q: np.ndarray, k: int, width: int | None) -> tuple[np.ndarray, ...]:
    """The best ``k`` rows of a shard for each of ``q``: row of ``q``, negated score and id."""
    graph, x, at, ids, own_width = opened
    wanted = max(width or own_width, 2 * k)
    step, pairs = max(16, min(512, SCORED // wanted)), max(1, GATHERED // 2 // q.shape[1])
    out = []
    for a in range(0, len(q), step):
        some = q[a : a + step]
        wide = np.concatenate([some, np.zeros((len(some), 1), some.dtype)], 1).astype(np.float32)
        nodes, _ = graph.search(wide, wanted)
        r, c = np.nonzero(nodes >= 0)
        score = np.full(nodes.shape, -np.inf)
        for b in range(0, len(r), pairs):
            to = slice(b, b + pairs)
            score[r[to], c[to]] = product(some[r[to]].astype(np.float64), x[nodes[r[to], c[to]]].astype(np.float64))
        # a node has at least one id: nodes below the k-th score have none of the best
        least = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        r, c = np.nonzero((nodes >= 0) & ~(score < least))
        node = nodes[r, c]
        count = at[node + 1] - at[node]
        vec = ids[np.repeat(at[node] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        row, neg, vec, _ = _best(np.repeat(r, count), np.repeat(-score[r, c], count), vec, len(some), k)
        out.append((row + a, neg, vec))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _record(kind: np.dtype, dims: int) -> np.dtype:
    """A query among others: its id and its vector."""
    return np.dtype([("query", np.int64), ("v", kind, (dims,))])


def _packed(queries: DataFrame) -> DataFrame:
    """Queries (query, v) in pieces of records of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, names = batch.column("v"), batch.column("query").to_numpy()
            at, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
            size = np.diff(at)
            for dims in np.unique(size).tolist():
                rows, kind = np.flatnonzero(size == dims), _record(flat.dtype, dims)
                step = max(1, PIECE_BYTES // kind.itemsize)
                for some in (rows[a : a + step] for a in range(0, len(rows), step)):
                    records = np.empty(len(some), kind)
                    records["query"], records["v"] = names[some], flat[at[some][:, None] + np.arange(dims)]
                    yield _batch([[dims], [records.tobytes()]], QUERIES)

    return queries.select("query", "v").mapInArrow(tidy(run), QUERIES)


class Held:
    """Pieces of one group in a file: the queries, and the arrays of each shard."""

    def __init__(self, file: IO[bytes]) -> None:
        self.file, self.queries, self.shards = file, [], {}

    def add(self, shard: int, piece: int, part: str, data: pa.Buffer) -> None:
        at = self.file.seek(0, 2)
        self.file.write(data)
        (self.queries if part == "queries" else self.shards.setdefault(shard, [])).append((piece, part, at, len(data)))

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def shard(self, dims: int, shard: int) -> tuple:
        return open_index(dims, ((part, self._read(at, size)) for _, part, at, size in sorted(self.shards[shard])))

    def asked(self, kind: np.dtype) -> Iterator[np.ndarray]:
        """The queries, as many pieces at a time as make up the bytes of one."""
        some, size = [], 0
        for _, _, at, n in self.queries:
            if some and size + n > PIECE_BYTES:
                yield np.frombuffer(b"".join(some), kind)
                some, size = [], 0
            some.append(self._read(at, n))
            size += n
        if some:
            yield np.frombuffer(b"".join(some), kind)


def _search_group(held: Held, dims: int, kind: np.dtype, k: int, width: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries, and records of the best ``k`` of a group's shards for each: how many, negated scores, ids."""
    asked, best = _record(kind, dims), np.dtype([("n", np.int64), ("neg", np.float64, (k,)), ("vec", np.int64, (k,))])
    with tempfile.TemporaryFile() as tops:
        for some in held.asked(asked):
            tops.write(bytes(best.itemsize * len(some)))
        for shard in sorted(held.shards):
            opened, at = held.shard(dims, shard), 0
            for some in held.asked(asked):
                tops.seek(at)
                top = np.frombuffer(bytearray(tops.read(best.itemsize * len(some))), best)
                r, c = np.nonzero(np.arange(k) < top["n"][:, None])
                found = answer(opened, some["v"], k, width)
                row, neg, vec, n = _best(*map(np.concatenate, zip((r, top["neg"][r, c], top["vec"][r, c]), found, strict=True)), len(some), k)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                top["n"], top["neg"][row, place], top["vec"][row, place] = n, neg, vec
                tops.seek(at)
                tops.write(top.tobytes())
                at += top.nbytes
            del opened
        tops.seek(0)
        for some in held.asked(asked):
            yield some["query"], np.frombuffer(tops.read(best.itemsize * len(some)), best)


def _visit(index: DataFrame, queries: DataFrame, single: bool, shards: int, groups: int, k: int, width: int | None) -> DataFrame:
    """For every query and group of shards the best ``k`` (negated score and id). ``single``: components are floats."""
    kind = np.dtype(np.float32 if single else np.float64)
    both = index.select((F.pmod("shard", F.lit(shards)) % groups).cast("int").alias("group"), "dims", "shard", "piece", "part", "data").unionByName(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "dims", F.lit(-1).cast("long").alias("shard"), F.lit(0).alias("piece"), F.lit("queries").alias("part"), "data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:
            held: dict[tuple[int, int], Held] = {}
            for batch in batches:
                for i, (group, dims, *rest) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("group", "dims", "shard", "piece", "part")), strict=True)):
                    held.setdefault((group, dims), Held(file)).add(*rest, batch.column("data")[i].as_buffer())
            for (_, dims), one in held.items():
                for names, top in _search_group(one, dims, kind, k, width):
                    r, c = np.nonzero(np.arange(k) < top["n"][:, None])
                    entries = pa.StructArray.from_arrays([pa.array(top["neg"][r, c]), pa.array(top["vec"][r, c])], ["neg", "vec_id"])
                    best = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(top["n"])]), pa.int32()), entries)
                    yield pa.RecordBatch.from_arrays([pa.array(names), best], ["query", "best"])

    return both.repartitionById(groups, "group").mapInArrow(tidy(run), "query long, best array<struct<neg: double, vec_id: long>>")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, width: int | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for each query.

    Queries are the rows whose id is divisible by ``every``; every other row is a
    candidate. Nearest is the largest inner product in double precision on the vectors
    as given; ties go to the smaller id. Rows with a null id, and vectors that are
    null, empty, zero or hold null or non-finite components take no part; vectors of
    different lengths never meet. Rows repeated in full count once. Every row is
    indexed: copies of a vector beyond the ``k + 1`` smallest ids share its node and
    can't be among anyone's nearest. The result of the graph search is approximate; each
    shard has measured its search width (``search_width``) unless ``width`` is given.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    base = stored(_usable(vectors, vec_id, embedding), "hnsw-base")
    single = isinstance(base.schema["v"].dataType.elementType, T.FloatType)
    dims = [(r.d, r.n) for r in base.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()]
    shards = max((-(-n // shard_rows(n, d)) for d, n in dims), default=1)
    index = stored_wide(build(base, shards, k + 1), "hnsw-index")
    asking = base.filter(F.pmod("vec_id", F.lit(every)) == 0)
    names = stored(asking.groupBy("v").agg(F.min("vec_id").alias("query")), "hnsw-queries")
    # each group gets all queries: as few groups as keep all cores busy
    groups = min(shards, 2 * spark.sparkContext.defaultParallelism)
    found = _visit(index, stored_wide(_packed(names), "hnsw-packed"), single, shards, groups, k + 1, width)
    best = found.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k + 1).alias("best"))
    asked = asking.join(names, "v").select("vec_id", "query").join(stored(best, "hnsw-best"), "query")
    others = F.filter("best", lambda b: b["vec_id"] != F.col("vec_id"))
    return asked.select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", (-F.col("b.neg")).alias("score"))
