"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake.session import work_path

#: Word borders of the text operators: ASCII white space.
WHITE = r"[\x20\x09-\x0D]+"
#: Largest bit map in 64-bit parts; a fuller map only lets more rows through.
MOST_PARTS = 1 << 18


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Arrow batches sent to Python hold at most ``size`` bytes, however long the rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def stored_wide(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for rows of up to megabytes: small row groups, so that neither writer nor reader holds many of them."""
    path = work_path(df.sparkSession, name)
    df.write.options(**{"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 4, "parquet.page.size.row.check.max": 100}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """A ``mapInArrow`` function that ends by handing freed memory back.

    Python workers outlive their tasks; without this they keep, idle too, the most they ever held.
    """
    def tidied(batches: Iterable) -> Iterator:
        import ctypes
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
            trim(0)

    return tidied


def numbers(values: Iterable[float], kind: str) -> Column:
    """A list of bounded length as an array literal: one folded constant, not one node per value."""
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unit(*seed: Column) -> Column:
    """A draw in (0, 1) that only depends on the given values."""
    high = F.shiftrightunsigned(F.xxhash64(*seed), 11)
    return (high.cast("double") + 0.5) / F.lit(float(1 << 53))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def log_odds(p: float) -> float:
    return math.log(p / (1.0 - p))


def _bits(parts: int) -> list[tuple[Column, Column]]:
    """The two places of ``h`` in a map: part and bit."""
    out = []
    for shift in (0, 32):
        x = F.shiftrightunsigned("h", shift)
        out.append((F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(parts - 1)).cast("int"), x.bitwiseAND(F.lit(63)).cast("int")))
    return out


def bit_map(hashes: DataFrame) -> list[int]:
    """A bit map of the distinct ``h``, of a size bounded by ``MOST_PARTS``: two bits each."""
    count = hashes.count()
    parts = min(MOST_PARTS, 1 << max(8, math.ceil(math.log2(max(count, 1)))))
    rows = hashes.select(F.explode(F.array(*[
        F.struct(part.alias("part"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mask")) for part, bit in _bits(parts)])).alias("b"))
    out = [0] * parts
    for part, mask in rows.groupBy("b.part").agg(F.bit_or("b.mask")).collect():
        out[part] = mask
    return out


def in_map(h: Column, bits: Column, parts: int) -> Column:
    """Whether a map may hold ``h``; never false for one it was made of."""
    test = F.lit(True)
    for shift in (0, 32):
        x = F.shiftrightunsigned(h, shift)
        part = F.get(bits, F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(parts - 1)).cast("int"))
        test = test & (F.call_function("shiftrightunsigned", part, x.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return test
