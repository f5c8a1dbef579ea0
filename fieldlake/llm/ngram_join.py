"""Similarity join of documents on their n-gram sets, by prefix trees.

Sets are ordered by one global order, rare n-grams first. Two sets of Jaccard
similarity 0.8 share an n-gram among their first ``n - ceil(0.8 n) + 1``; so every
similar pair lies in one component of the graph that ties sets to the n-grams of
their prefix (a *block*). The sets of a block go into a prefix tree, in which sets
that begin alike share their path; a traversal counts overlaps along the paths and
leaves a subtree as soon as what remains of the tree and of the probe can't reach
the overlap needed. All comparisons are exact integers.

How frequent an n-gram is only steers the order. Frequent ones are known from counts
of n-grams that repeat inside a batch, added up over all documents in a table of
fixed size; the others' sets are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fieldlake.llm import shingles
from fieldlake.llm.common import bit_map, in_map, numbers, tidy
from fieldlake.llm.components import components
from fieldlake.session import stored

#: Bits of the frequency table.
BITS = 20
#: Sets of a batch from which on its count of an n-gram goes into the table. Half of it on
#: average over all batches makes a place of the table frequent: a share of the
#: documents, so that frequent n-grams stay few however many documents there are.
OFTEN = 8
#: Share of the hash range in which n-grams of one set only are looked for.
RANGE = 0.4
#: N-grams of a block, or of one side of a pair of block parts, that a task holds.
PART = 1_500_000
#: N-grams looked at between two bounds of a traversal.
STEP = 64


def prefix_size(n: int) -> int:
    """N-grams of which two sets of similarity 0.8 must share one."""
    return n - (4 * n + 4) // 5 + 1


def needed(a, b):
    """Least overlap of sets of sizes a and b for 100 * overlap >= 80 * union."""
    return (4 * (a + b) + 8) // 9


# -- the prefix tree ------------------------------------------------------------------------


class Tree:
    """A path-compressed prefix tree of ascending rank lists, as flat arrays.

    A node covers the lists ``lo`` to ``hi`` (in lexicographic order) and the places
    ``start`` to ``end`` that they share; a leaf's list ends there.
    """

    def __init__(self, lists: list[np.ndarray]):
        order = sorted(range(len(lists)), key=lambda i: lists[i].astype(">u4").tobytes())
        self.ids = np.array(order, np.int64)
        rows = [lists[i] for i in order]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.flat = np.concatenate(rows)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        common = [self._common(a, b) for a, b in zip(rows, rows[1:], strict=False)]
        lo, hi, start, end, kids = [], [], [], [], []

        def node(a: int, b: int, depth: int, upto: int) -> int:
            lo.append(a), hi.append(b), start.append(depth), end.append(upto), kids.append([])
            return len(lo) - 1

        self.roots: list[int] = []
        todo = [(0, len(rows), 0, -1)]
        depths = np.array(common, np.int64)
        while todo:
            a, b, depth, parent = todo.pop()
            cuts = [a] + (np.flatnonzero(depths[a : b - 1] <= depth) + a + 1).tolist() + [b]
            for x, y in zip(cuts, cuts[1:], strict=False):
                upto = len(rows[x]) if y - x == 1 else min(int(depths[x : y - 1].min()), len(rows[x]))
                n = node(x, y, depth, upto)
                (kids[parent] if parent >= 0 else self.roots).append(n)
                if y - x > 1:
                    todo.append((x, y, upto, n))
        self.lo, self.hi, self.start, self.end = (np.array(v, np.int64) for v in (lo, hi, start, end))
        self.least = np.minimum.reduceat(self.sizes, self.lo) if len(rows) == 0 else np.array([self.sizes[a:b].min() for a, b in zip(lo, hi, strict=True)])
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(lo, hi, strict=True)])
        self.kid_at = np.concatenate([[0], np.cumsum([len(k) for k in kids])])
        self.kids = np.array([k for ks in kids for k in ks], np.int64)
        self.leaf = (self.hi - self.lo == 1)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        return int(differ[0]) if len(differ) else m

    def similar(self, probe: np.ndarray, mark: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Ids of the lists similar to ``probe``; ``mark`` is a clear work array over all ranks.

        Only lists for which ``alive`` (by id) holds are looked for.
        """
        mark[probe] = True
        n = len(probe)
        live = np.concatenate([[0], np.cumsum(alive[self.ids])])
        node = np.array(self.roots, np.int64)
        place, overlap = self.start[node], np.zeros(len(node), np.int64)
        hits = []
        while len(node):
            fits = (live[self.hi[node]] > live[self.lo[node]]) & (5 * self.most[node] >= 4 * n) & (4 * self.least[node] <= 5 * n)
            node, place, overlap = node[fits], place[fits], overlap[fits]
            if not len(node):
                break
            upto = np.minimum(place + STEP, self.end[node])
            count = upto - place
            full = np.flatnonzero(count > 0)
            last = np.full(len(node), -1, np.int64)
            if len(full):
                c = count[full]
                begin = np.cumsum(c) - c
                where = np.repeat(self.at[self.lo[node[full]]] + place[full] - begin, c) + np.arange(int(c.sum()))
                ranks = self.flat[where]
                overlap[full] += np.add.reduceat(mark[ranks].astype(np.int64), begin)
                last[full] = ranks[begin + c - 1]
            left = n - np.searchsorted(probe, last, "right")
            bound = overlap + np.minimum(self.most[node] - upto, left)
            keep = bound >= needed(n, np.maximum(self.least[node], (4 * n + 4) // 5))
            node, place, overlap = node[keep], upto[keep], overlap[keep]
            done = place == self.end[node]
            ended = done & self.leaf[node]
            if ended.any():
                rows = self.lo[node[ended]]
                good = overlap[ended] >= needed(n, self.sizes[rows])
                hits.append(self.ids[rows[good]])
            inner = np.flatnonzero(done & ~ended)
            per = self.kid_at[node[inner] + 1] - self.kid_at[node[inner]]
            begin = np.cumsum(per) - per
            kids = self.kids[np.repeat(self.kid_at[node[inner]] - begin, per) + np.arange(int(per.sum()))]
            more = np.repeat(overlap[inner], per)
            node = np.concatenate([node[~done], kids])
            place = np.concatenate([place[~done], self.start[kids]])
            overlap = np.concatenate([overlap[~done], more])
        mark[probe] = False
        found = np.concatenate(hits) if hits else np.empty(0, np.int64)
        return found[alive[found]]


def ranked(sets: list[np.ndarray], levels: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The sets as ascending ranks in the global order of their n-grams, and the number of ranks."""
    every = np.unique(np.concatenate(sets))
    order = np.lexsort((every, levels[every >> np.uint64(64 - BITS)]))
    rank = np.empty(len(every), np.int64)
    rank[order] = np.arange(len(every))
    return [np.sort(rank[np.searchsorted(every, s)]) for s in sets], len(every)


def join(left: list[np.ndarray], right: list[np.ndarray] | None, levels: np.ndarray, every: bool) -> list[tuple[int, int]]:
    """Similar pairs (index in ``left``, index in ``right``), or inside ``left`` without ``right``.

    With ``every`` all of them; otherwise as many as connect all that are linked: a
    list that is already in the probe's component is not looked for again.
    """
    lists, ranks = ranked(left + (right or []), levels)
    n = len(left)
    tree, mark = Tree(lists[:n]), np.zeros(ranks, bool)
    part = np.arange(len(lists))
    out = []
    for i in range(n) if right is None else range(n, len(lists)):
        alive = np.ones(n, bool) if every else part[:n] != part[i]
        if right is None:
            alive[i if not every else slice(0, i + 1)] = False
        if not alive.any():
            continue
        for j in tree.similar(lists[i], mark, alive).tolist():
            if every or part[j] != part[i]:
                out.append((i, j) if right is None else (j, i - n))
                part[part == part[j]] = part[i]
    return out


# -- Spark steps ------------------------------------------------------------------------


def _classes(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: per document its set's two names and size, and counts of repeated n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingles.sets(batch.column(1))
            names = [shingles.name(s) for s in sets]
            distinct = {k: s for k, s in zip(names, sets, strict=True) if len(s)}
            size = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array(size, pa.int64()), pa.nulls(len(sets), pa.int32())],
                ["doc_id", "node", "check", "n", "bucket"])
            if not distinct:
                continue
            grams, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            again = counts >= OFTEN
            sums = np.bincount((grams[again] >> np.uint64(64 - BITS)).astype(np.int64), counts[again], 1 << BITS).astype(np.int64)
            full = np.flatnonzero(sums)
            sums, full = np.append(sums, 1), np.append(full, 1 << BITS)  # one more place counts the batches
            for at in range(0, len(full), 50_000):
                some = full[at : at + 50_000]
                none = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(some), batch.column(0).type), none, none, pa.array(sums[some]), pa.array(some.astype(np.int32))], ["doc_id", "node", "check", "n", "bucket"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, node long, check long, n long, bucket int")


def _levels(rows: DataFrame) -> np.ndarray:
    """The order of magnitude of the n-grams' frequency by bucket: at most 2^BITS small numbers."""
    sums = rows.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n"))
    batches = (sums.filter(F.col("bucket") == 1 << BITS).first() or [0, 1])[1]
    hot = sums.filter((F.col("bucket") < 1 << BITS) & (F.col("n") >= OFTEN // 2 * batches))
    table = hot.select("bucket", F.least(F.lit(40), F.floor(F.log2("n"))).cast("byte").alias("level")).toArrow()
    levels = np.zeros(1 << BITS, np.uint8)
    levels[table["bucket"].to_numpy()] = table["level"].to_numpy()
    return levels


def _spread(levels: np.ndarray, below: float | None):
    """A mapInArrow function from (node, text) to rows (key, node, level) of n-grams.

    With ``below``, only the n-grams of level 0 in that share of the hash range, and
    the node is named from the text. Without, all that can matter: those of level 0,
    and of the others the first ones in order, as many as a prefix has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingles.sets(batch.column("text"))
            if below is None:
                own = dict(zip(batch.column("node").to_pylist(), sets, strict=True))
            else:
                own = {shingles.name(s)[0]: s for s in sets if len(s)}
            keys, nodes, ranks = [], [], []
            for node, s in own.items():
                level = levels[s >> np.uint64(64 - BITS)]
                if below is None:
                    hot = np.flatnonzero(level)
                    first = hot[np.lexsort((s[hot].view(np.int64), level[hot]))]  # by the signed key, as the window in _ties
                    some = np.concatenate([np.flatnonzero(level == 0), first[: prefix_size(len(s))]])
                else:
                    some = np.flatnonzero((level == 0) & (s < np.uint64(int(below * 2**64))))
                keys.append(s[some])
                ranks.append(level[some])
                nodes.append(np.full(len(some), node, np.int64))
            key = np.concatenate(keys or [np.empty(0, np.uint64)]).view(np.int64)
            node = np.concatenate(nodes or [np.empty(0, np.int64)])
            rank = np.concatenate(ranks or [np.empty(0, np.uint8)]).astype(np.int8)
            for at in range(0, len(key), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in (key, node, rank)], ["key", "node", "level"])

    return run


KEYS = "key long, node long, level byte"


def _candidates(docs: DataFrame, classes: DataFrame, levels: np.ndarray) -> DataFrame:
    """(node, n, text) of the sets that can have a partner at all.

    In the global order n-grams of a single set come first. A set with a whole prefix
    of them shares none of its prefix, so it has no partner. They are looked for in a
    fixed share of the hash range, where every set lists its rare n-grams.
    """
    rare = docs.select("text").mapInArrow(tidy(_spread(levels, RANGE)), KEYS)
    alone = rare.groupBy("key").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    prefix = F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1
    rest = classes.join(own, "node", "left").filter(F.coalesce("alone", F.lit(0)) < prefix)
    rest = stored(rest.select("node", "n", F.col("doc_id").alias("own")), "ngram-rest")
    hashed = lambda c: F.xxhash64(F.col(c))
    bits = bit_map(rest.select(hashed("own").alias("h")))
    near = docs.select("doc_id", "text").filter(in_map(hashed("doc_id"), numbers(bits, "bigint"), len(bits)))
    texts = near.join(rest, F.col("doc_id").eqNullSafe(F.col("own"))).select("node", "n", "text")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # other rows with the same doc_id go
            names = [shingles.name(s)[0] for s in shingles.sets(batch.column("text"))]
            yield batch.filter(pa.compute.equal(batch.column("node"), pa.array(names, pa.int64())))

    same = texts.mapInArrow(tidy(named), "node long, n long, text string")
    return stored(same.groupBy("node").agg(F.first("n").alias("n"), F.first("text").alias("text")), "ngram-candidates")


def _ties(candidates: DataFrame, levels: np.ndarray) -> DataFrame:
    """Edges (a, b) between sets that share an n-gram of their prefixes.

    The order is: n-grams of one set, n-grams of level 0 by their number of sets, then
    the frequent ones by level. Each n-gram ties its sets to the smallest of them, so
    the edges are as many as the prefixes' n-grams, not as their pairs.
    """
    # read anew for each use: the n-grams of all candidates are never stored, only those that some share
    rows = candidates.select("node", "text").mapInArrow(tidy(_spread(levels, None)), KEYS)
    counted = rows.filter("level = 0").withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("key")))
    rare = stored(counted.filter("sets > 1"), "ngram-rare")
    listed = rows.filter("level = 0").groupBy("node").agg(F.count(F.lit(1)).alias("listed"))
    shared = rare.groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    alone = F.coalesce("listed", F.lit(0)) - F.coalesce("shared", F.lit(0))
    room = candidates.select("node", (F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1).alias("p")).join(listed, "node", "left").join(shared, "node", "left")
    room = stored(room.select("node", (F.col("p") - alone).alias("room")).filter("room > 0"), "ngram-room")
    shared = rare.unionByName(rows.filter("level > 0").withColumn("sets", F.lit(0).cast("long")))
    order = Window.partitionBy("node").orderBy("level", "sets", "key")
    prefix = shared.join(room, "node").withColumn("place", F.row_number().over(order)).filter("place <= room").select("key", "node")
    prefix = stored(prefix, "ngram-prefixes")
    hubs = stored(prefix.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").drop("last"), "ngram-hubs")
    return prefix.join(hubs, "key").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def _links(members: DataFrame, levels: np.ndarray, every: bool) -> DataFrame:
    """Similar pairs (a, b) of sets inside the blocks of ``members`` (node, n, text, block).

    A block with more n-grams than ``PART`` is cut into parts by hash, and each pair of
    parts is a unit of its own.
    """
    weight = members.groupBy("block").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
    spread = members.join(stored(weight, "ngram-blocks"), "block").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least("part", p).alias("i"), F.greatest("part", p).alias("j")))
    rows = spread.select("block", "part", "node", "text", F.explode(units).alias("u")).select("block", "u.i", "u.j", "part", "node", "text")
    rows = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")

    def unit(held: list[tuple], key: tuple) -> list[tuple[int, int]]:
        sides: list[dict[int, np.ndarray]] = [{}, {}]
        for part, node, s in held:
            sides[part != key[1]][node] = s
        names = [list(side) for side in sides]
        if key[1] == key[2]:
            found = join(list(sides[0].values()), None, levels, every) if len(names[0]) > 1 else []
            return [(names[0][a], names[0][b]) for a, b in found]
        found = join(list(sides[0].values()), list(sides[1].values()), levels, every) if names[0] and names[1] else []
        return [(names[0][a], names[1][b]) for a, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        key, held = None, []
        for batch in batches:
            sets = shingles.sets(batch.column("text"))
            cols = [batch.column(c).to_pylist() for c in ("block", "i", "j", "part", "node")]
            pairs: list[tuple[int, int]] = []
            for *now, part, node, s in zip(*cols, sets, strict=True):
                if (now := tuple(now)) != key:
                    pairs += unit(held, key) if held else []
                    key, held = now, []
                held.append((part, node, s))
            yield out(pairs)
        if held:
            yield out(unit(held, key))

    return rows.mapInArrow(tidy(run), "a long, b long")


def linked(docs: DataFrame, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their sets' names (doc_id, node, n), and the links (a, b) between sets.

    Documents with equal sets have one name. With ``every``, all links between
    different sets are returned, otherwise as many as connect the same components.
    """
    rows = stored(_classes(docs), "ngram-classes")
    levels = _levels(rows)
    named = rows.filter("bucket IS NULL").select("doc_id", "node", "check", "n")
    classes = named.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.min("check").alias("c"), F.max("check").alias("d"))
    classes = stored(classes, "ngram-sets")
    if not classes.filter("c <> d").isEmpty():
        raise ValueError("two different sets have one name")
    candidates = _candidates(docs, classes.select("node", "doc_id", "n"), levels)
    blocks = components(_ties(candidates, levels)).select("node", F.col("label").alias("block"))
    members = stored(candidates.join(stored(blocks, "ngram-members"), "node"), "ngram-texts")
    return named.drop("check"), stored(_links(members, levels, every), "ngram-links")


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row its set's name, size and component (doc_id, node, n, label); the rows without words apart (doc_id, n)."""
    named, links = linked(docs)
    named = stored(named, "ngram-documents")
    label = components(links)
    with_label = named.filter("n > 0").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return stored(with_label.select("doc_id", "node", "n", "label"), "ngram-labels"), named.filter("n = 0").select("doc_id", "n")


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links), one row per row.

    Two documents link from a Jaccard similarity of 0.8 of their sets of five-word
    shingles on. Documents without words have no set, link with nothing and are their
    own component. Repeated rows get equal results; a null doc_id takes part but is
    never the smallest unless the component has no other. Whole texts are read; other
    columns are ignored.
    """
    with_label, bare = _labelled(docs)
    least = stored(with_label.groupBy("label").agg(F.min("doc_id").alias("component_id")), "ngram-components")
    out = with_label.join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(bare.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each component, of the smallest doc_id in it; all columns stay.

    Rows are told apart by doc_id and set, so rows of one doc_id, or without one, stay
    or go each by its own text; of several sets of that doc_id in a component one
    stays. Rows without words stay, each. Ids of which all rows go, or the only row
    stays, are decided by the id alone; the sets of the others are named anew.
    """
    with_label, bare = _labelled(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "node")).alias("f")
    chosen = stored(with_label.groupBy("label").agg(first).select(F.col("f.doc_id").alias("_own"), F.col("f.node").alias("_set")), "ngram-chosen")
    rows = with_label.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.unionByName(bare.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))).groupBy("doc_id").agg(F.sum("rows").alias("rows"))
    # a row without words always stays, so its id is not one of which all rows go
    staying = chosen.select(F.col("_own").alias("doc_id")).unionByName(bare.select("doc_id")).distinct().withColumn("stays", F.lit(True))
    ids = rows.filter("doc_id IS NOT NULL").join(staying, "doc_id", "left")
    ids = stored(ids.select("doc_id", "rows", F.coalesce("stays", F.lit(False)).alias("stays")), "ngram-ids")
    gone = ids.filter("NOT stays").select(F.col("doc_id").alias("_gone"))
    mixed = stored(ids.filter("stays AND rows > 1").select(F.col("doc_id").alias("_mixed")), "ngram-mixed")
    named = docs.filter("doc_id IS NOT NULL")
    kept = named.join(gone, named["doc_id"] == gone["_gone"], "left_anti")
    nameless = not rows.filter("doc_id IS NULL").isEmpty()
    if mixed.isEmpty() and not nameless:
        return kept
    once = kept.join(mixed, kept["doc_id"] == mixed["_mixed"], "left_anti")
    more = named.join(mixed, named["doc_id"] == mixed["_mixed"], "left_semi").unionByName(docs.filter("doc_id IS NULL"))
    schema = T.StructType([*more.schema.fields, T.StructField("_node", T.LongType())])
    at = more.columns.index("text")

    def named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [shingles.name(s)[0] if len(s) else None for s in shingles.sets(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], [*batch.schema.names, "_node"])

    more = more.mapInArrow(tidy(named_sets), schema)
    by_set = more.filter("_node IS NOT NULL").join(chosen, F.col("doc_id").eqNullSafe(F.col("_own")) & (F.col("_node") == F.col("_set")), "left_semi")
    wordless = more.filter("_node IS NULL")
    return once.unionByName(by_set.dropDuplicates(["doc_id", "_node"]).unionByName(wordless).drop("_node"))
