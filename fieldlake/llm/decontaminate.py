"""Benchmark passages inside documents, by SimHash of item-sized windows.

An item's fingerprint is the 256-bit SimHash of its word shingles; a window of a
document has as many words as an item, and a shorter document is a window as a whole.
Windows and items of one size meet in a multi-index: the fingerprint is cut into
blocks; two fingerprints within ``radius`` bits differ by at most ``radius // blocks``
bits in one block. Items are listed under the block values within some of these
changes and windows under those within the others, so no pair within the radius is
missed. Candidates are then compared exactly: the sum of the smaller over the sum
of the larger shingle weights, a shingle's weight being its number of occurrences.

Only windows that can reach the similarity are fingerprinted: at least that share
of a window's shingles must occur in items of its size, otherwise the sums cannot
be near enough. A bit map of the item shingles lets nearly all other documents go
in the scan; the shingles that pass it are looked up exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import bit_map, in_map, let, numbers, words
from fieldlake.session import stored

SHINGLE = 5
BLOCKS, BLOCK_BITS = 4, 16  # of each 64-bit part of a fingerprint
PARTS = 4
#: Bits of an item's 256-bit fingerprint within which windows are compared.
RADIUS = 63
#: Changes of a block under which a window is listed; items are listed under the rest.
WINDOW_CHANGES = 1


def shingles(tokens: Column, size: int) -> Column:
    """Hashes of the ``size``-word shingles of a word list, in order; a shorter list has none."""
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: F.when(F.size(h) < size, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))))


def fingerprints(lists: DataFrame, key: list[str], parts: int = 1) -> DataFrame:
    """SimHash of the shingle list ``w`` of each key (keys are unique), of ``parts`` times 64 bits in blocks of 16.

    Each part votes by its own hash of a shingle; the first one by the shingle itself.
    Votes are counted in 16-bit lanes, four bits to a number: 16 sums give all 64
    counts. A lane holds 65,535 votes, more than any item has shingles (``leaks``
    refuses longer ones).
    """
    one = F.lit(1).cast("bigint")
    lane = lambda bit: F.shiftleft(F.shiftrightunsigned("h", bit).bitwiseAND(one), 16 * (bit % 4))
    sums = [F.sum(lane(b) + lane(b + 1) + lane(b + 2) + lane(b + 3)).alias(f"v{b // 4}") for b in range(0, 64, 4)]
    hashes = F.array(*[F.struct(F.lit(j).alias("part"), (F.xxhash64("h", F.lit(j)) if j else F.col("h")).alias("h")) for j in range(parts)])
    each = lists.select(*key, F.explode("w").alias("h")).select(*key, F.inline(hashes))
    votes = each.groupBy(*key, "part").agg(*sums, F.count(F.lit(1)).alias("n"))
    count = lambda bit: F.shiftrightunsigned(f"v{bit // 4}", 16 * (bit % 4)).bitwiseAND(F.lit(65535).cast("bigint"))
    block = lambda at: sum((F.when(count(b) * 2 > F.col("n"), F.lit(1 << (b - at))).otherwise(F.lit(0)) for b in range(at, at + BLOCK_BITS)), F.lit(0))
    cut = votes.select(*key, F.struct("part", F.array(*[block(i * BLOCK_BITS) for i in range(BLOCKS)]).alias("print")).alias("p"))
    return cut.groupBy(*key).agg(F.flatten(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["print"])).alias("print"))


def distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def near_values(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Changes of a block that the radius allows in at least one of the blocks."""
    return [x for x in range(1 << BLOCK_BITS) if x.bit_count() <= radius // blocks]


def listed_under(prints: DataFrame, key: list[str], changes: int) -> DataFrame:
    """A row (block, value) for each block value within so many changed bits of a fingerprint's own."""
    near = F.explode(numbers(near_values(changes, 1), "int")).alias("change")
    own = prints.select(*key, F.posexplode("print").alias("block", "own")).select(*key, "block", "own", near)
    return own.select(*key, "block", F.col("own").bitwiseXOR(F.col("change")).alias("value"))


def similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger occurrence counts of two shingle lists."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda x, h: F.size(F.filter(x, lambda y: y == h))
    smaller = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_distinct(a), F.lit(0), lambda n, h: n + F.least(times(a, h), times(b, h))))
    return smaller / (F.size(a) + F.size(b) - smaller)


def leaks(docs: DataFrame, items: DataFrame, least: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """Pairs (doc_id, item_id) with the best window: similarity, start_word, n_words.

    ``docs`` has doc_id and text, ``items`` item_id and text. Items of fewer than five
    words are one shingle of all their words; items without words and null texts match
    nothing. A document shorter than an item is compared as a whole, from five words on;
    ``n_words`` is the window's number of words. Of equally similar windows the first is named. Repeated items are found
    under each id, rows that repeat a document give one pair. Whole texts are read.
    Window contents that occur often are compared once. Raises for items of more than
    65,535 shingles.
    """
    cut = items.select("item_id", words(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0)
    cut = stored(cut.withColumn("m", F.size("tokens")).distinct(), "leak-items")
    sizes = [r.m for r in cut.select("m").distinct().collect()]  # distinct item lengths: few numbers
    if sizes and max(sizes) - SHINGLE >= 65535:
        raise ValueError("an item has more than 65,535 shingles")
    found = [_leaks(docs, cut, k, least, radius) for k in sorted({min(m, SHINGLE) for m in sizes})]
    if not found:
        kind = lambda df, c: df.schema[c].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind(docs, 'doc_id')}, item_id {kind(items, 'item_id')}, similarity double, start_word int, n_words int")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _leaks(docs: DataFrame, cut: DataFrame, k: int, least: float, radius: int) -> DataFrame:
    """The leaks of the items that have ``k``-word shingles: those of k words, for the full k also longer ones."""
    own = cut.filter(F.col("m") >= k if k == SHINGLE else F.col("m") == k)
    listed = stored(own.select("item_id", "m", shingles(F.col("tokens"), k).alias("w")), "leak-lists")
    known = stored(listed.select("m", F.explode("w").alias("h")).distinct(), "leak-shingles")
    bits = bit_map(known.select("h").distinct())
    shortest = listed.agg(F.min("m")).first()[0]
    need = lambda m: F.ceil(F.lit(least) * (m - (k - 1)) - 1e-9)

    # documents with enough listed shingles for the shortest window, numbered once and for all
    mapped = numbers(bits, "bigint")
    cut_docs = docs.select("doc_id", shingles(words(F.col("text")), k).alias("all"))
    hits = F.filter(F.transform("all", lambda h, i: F.when(in_map(h, mapped, len(bits)), F.struct(i.alias("at"), h.alias("h")))), lambda x: x.isNotNull())
    enough = cut_docs.withColumn("hits", hits).filter(F.size("hits") >= max(1, math.ceil(least * (shortest - (k - 1)) - 1e-9)))
    some = stored(enough.withColumn("row", F.monotonically_increasing_id()), "leak-documents")

    # windows with enough shingles of items of their size: of the starts between two hits, those near enough to the last hit needed
    placed = some.select("row", F.size("all").alias("n"), F.explode("hits").alias("x")).select("row", "n", "x.at", "x.h").join(known, "h")
    spots = placed.groupBy("row", "m").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("at")).alias("ats"))
    spots = spots.filter(F.size("ats") >= need(F.col("m")))
    last = F.greatest(F.lit(0), F.col("n") - (F.col("m") - (k - 1)))
    spans = F.transform("ats", lambda at, j: F.struct(
        F.greatest(F.lit(0), F.coalesce(F.get("ats", j - 1), F.lit(-1)) + 1, F.get("ats", (j + need(F.col("m")) - 1).cast("int")) - (F.col("m") - k)).alias("a"),
        F.least(at, last).alias("b"),
        (j + need(F.col("m")) <= F.size("ats")).alias("enough")))
    spans = spots.select("row", "m", F.explode(F.filter(spans, lambda x: x["enough"] & (x["a"] <= x["b"]))).alias("x"))
    windows = spans.select("row", "m", F.explode(F.sequence("x.a", "x.b")).alias("start"))
    filled = windows.join(some.select("row", "doc_id", "all"), "row").select(
        "doc_id", "m", "start", F.slice("all", F.col("start") + 1, F.col("m") - (k - 1)).alias("w"))
    filled = stored(filled.withColumn("key", F.xxhash64("m", "w")), "leak-windows")
    contents = stored(filled.groupBy("key").agg(F.first("m").alias("m"), F.first("w").alias("w")), "leak-contents")

    # multi-index on blocks of the fingerprints; written tables, so that the joins see their true sizes
    blocks = PARTS * BLOCKS
    own_changes = min(WINDOW_CHANGES, radius // blocks)
    item_prints = stored(fingerprints(listed, ["item_id", "m"], PARTS), "leak-item-prints")
    prints = stored(fingerprints(contents, ["key", "m"], PARTS), "leak-prints")
    dealt = item_prints.repartition(docs.sparkSession.sparkContext.defaultParallelism, "item_id", "m")
    index = stored(listed_under(dealt, ["item_id", "m"], radius // blocks - own_changes), "leak-index")
    met = listed_under(prints, ["key", "m"], own_changes).join(index, ["m", "block", "value"]).select("key", "item_id", "m").distinct()
    near = met.join(item_prints.withColumnRenamed("print", "item_print"), ["item_id", "m"]).join(prints.select("key", "print"), "key")
    pairs = near.filter(distance(F.col("print"), F.col("item_print")) <= radius).select("key", "item_id", "m")
    exact = pairs.join(contents.select("key", "w"), "key").join(listed.select("item_id", "m", F.col("w").alias("v")), ["item_id", "m"])
    exact = stored(exact.withColumn("similarity", similarity(F.col("w"), F.col("v"))).filter(F.col("similarity") >= least - 1e-12).select("key", "item_id", "similarity"), "leak-pairs")

    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "words"))
    return filled.select("doc_id", (F.size("w") + (k - 1)).alias("words"), "start", "key").join(exact, "key").groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.similarity", (-F.col("b.back")).alias("start_word"), F.col("b.words").alias("n_words"))


def without_leaks(docs: DataFrame, items: DataFrame, least: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay. Each row goes by its own text, whatever other rows have its doc_id."""
    text = F.xxhash64("text")
    own = docs.select(F.struct("doc_id", text.alias("text")).alias("doc_id"), "text")
    found = leaks(own, items, least, radius).select(F.col("doc_id.doc_id").alias("_leak"), F.col("doc_id.text").alias("_text")).distinct()
    found = stored(found, "leak-ids")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_leak"]) & (text == found["_text"]), "left_anti")
