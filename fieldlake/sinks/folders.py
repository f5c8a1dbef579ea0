"""Tables whose content changes by one small file.

Rows lie in Parquet folders ``bucket columns/commit=<id>``. Which folders are the
table is said by the newest file under ``_versions``: a commit writes new folders
first and then one version file, so a run that stops at any point leaves the old
table or the new one. Only the folders of touched buckets are read and written
again. ``marks`` keep the last batch of each writer, so a repeated batch is not
applied twice. Folders of older versions stay until ``vacuum``.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fieldlake.session import file_system

Mark = tuple[str, int]


class Conflict(RuntimeError):
    """Another writer has committed in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int = -1
    live: tuple[str, ...] = ()
    marks: dict[str, int] = field(default_factory=dict)


class FolderTable:
    """``schema`` names all columns, ``buckets`` those that lie in folder names; they come last."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[str]):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), list(buckets)
        inner = [f for f in schema.fields if f.name not in self.buckets]
        self.schema = T.StructType(inner + [schema[b] for b in self.buckets])

    @functools.cached_property
    def _store(self):
        return file_system(self.spark, self.path)

    @property
    def _files(self):
        return self._store[0]

    @property
    def _path(self):
        return self._store[1]

    # versions

    def version(self) -> Version:
        """The newest complete version."""
        for number in sorted(self._numbers(), reverse=True):
            stream = self._files.open(self._path(self._file(number)))
            try:
                said = json.loads(bytes(stream.readAllBytes()))
            except ValueError:  # its writer stopped half-way
                continue
            finally:
                stream.close()
            return Version(number, tuple(said["live"]), said["marks"])
        return Version()

    def _file(self, number: int) -> str:
        return f"{self.path}/_versions/{number:012d}.json"

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.path}/_versions")
        if not self._files.exists(folder):
            return []
        return [int(s.getPath().getName().split(".")[0]) for s in self._files.listStatus(folder) if s.getPath().getName().endswith(".json")]

    def _commit(self, seen: Version, live: Sequence[str], mark: Mark | None, notes: dict[str, int] | None = None) -> None:
        """One version more than those that exist; fails if another writer had the place."""
        number = max(self._numbers(), default=-1) + 1
        if self.version().number != seen.number:
            raise Conflict(f"{self.path} was changed during this write")
        marks = dict(seen.marks) | (notes or {}) | ({mark[0]: mark[1]} if mark else {})
        try:
            stream = self._files.create(self._path(self._file(number)), False)
        except Exception as error:
            raise Conflict(f"{self.path} was changed during this write") from error
        stream.write(bytearray(json.dumps({"live": sorted(live), "marks": marks}), "utf-8"))
        stream.close()

    def applied(self, mark: Mark | None, version: Version | None = None) -> bool:
        """Whether a writer's batch is in the table already."""
        return mark is not None and (version or self.version()).marks.get(mark[0], -1) >= mark[1]

    # reading

    def load(self, live: Sequence[str]) -> DataFrame:
        """The rows of some folders."""
        if not live:
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField("commit", T.StringType())])
        reader = self.spark.read.schema(whole).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{folder}" for folder in live]).drop("commit")

    def read(self) -> DataFrame:
        """The table as of now; filters on bucket columns prune folders."""
        return self.load(self.version().live)

    # writing

    def _write(self, rows: DataFrame, watch: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[str]:
        """Rows to new folders, sized by a rebalance; returns the folders. ``watch`` may count them in the writing stage."""
        commit = uuid.uuid4().hex
        sized = watch(rows.select(*self.schema.names).hint("rebalance", *self.buckets))
        sized.withColumn("commit", F.lit(commit)).write.mode("append").partitionBy(*self.buckets, "commit").parquet(self.path)
        found = self._files.globStatus(self._path("/".join([self.path, *["*"] * len(self.buckets), f"commit={commit}"])))
        return [self._relative(s.getPath()) for s in found or []]

    def _name(self, values: Sequence[str | None]) -> str:
        """The folder of a bucket, spelt as Spark spells it."""
        spelling = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return "/".join(spelling.getPartitionPathString(b, v) for b, v in zip(self.buckets, values, strict=True))

    def _relative(self, path) -> str:
        parts = []
        for _ in range(len(self.buckets) + 1):
            parts.append(path.getName())
            path = path.getParent()
        return "/".join(reversed(parts))

    def append(self, rows: DataFrame, mark: Mark | None = None, watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
               notes: Callable[[], dict[str, int]] = dict) -> list[str] | None:
        """Add rows; the new folders, or None if that batch is in the table already. ``notes`` are further marks, asked for after writing."""
        seen = self.version()
        if self.applied(mark, seen):
            return None
        new = self._write(rows, watch)
        self._commit(seen, [*seen.live, *new], mark, notes())
        return new

    def rewrite(self, touched: DataFrame, combine: Callable[[DataFrame], DataFrame], mark: Mark | None = None) -> bool:
        """Replace the buckets listed in ``touched`` by ``combine(their rows)``; others are neither read nor written.

        All rows that ``combine`` gives must lie in those buckets.
        """
        seen = self.version()
        if self.applied(mark, seen):
            return False
        names = {self._name(row) for row in touched.select(*[F.col(b).cast("string") for b in self.buckets]).distinct().collect()}
        old = [f for f in seen.live if f.rsplit("/", 1)[0] in names]
        new = self._write(combine(self.load(old)))
        stray = {f.rsplit("/", 1)[0] for f in new} - names
        if stray:
            raise ValueError(f"rows outside the touched buckets: {sorted(stray)[:3]}")
        self._commit(seen, [*(f for f in seen.live if f not in set(old)), *new], mark)
        return True

    def compact(self, most: int = 8, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
        """Put the folders of each bucket with more than ``most`` into one; returns the number of such buckets.

        ``merge`` may reduce their rows, each bucket for itself.
        """
        seen, per = self.version(), {}
        for folder in seen.live:
            per.setdefault(folder.rsplit("/", 1)[0], []).append(folder)
        small = {f for own in per.values() if len(own) > most for f in own}
        if small:
            new = self._write(merge(self.load(sorted(small))))
            self._commit(seen, [*(f for f in seen.live if f not in small), *new], None)
        return sum(len(own) > most for own in per.values())

    def drop(self, buckets: Sequence[Sequence[str | None]]) -> None:
        """Take whole buckets out of the table."""
        seen, gone = self.version(), {self._name(b) for b in buckets}
        self._commit(seen, [f for f in seen.live if f.rsplit("/", 1)[0] not in gone], None)

    def vacuum(self, keep: int = 2) -> int:
        """Delete folders that none of the newest ``keep`` versions names; no writer may be at work."""
        numbers = sorted(self._numbers())
        named: set[str] = set()
        for number in numbers[-keep:]:
            stream = self._files.open(self._path(self._file(number)))
            try:
                named |= set(json.loads(bytes(stream.readAllBytes()))["live"])
            except ValueError:
                continue
            finally:
                stream.close()
        found = self._files.globStatus(self._path("/".join([self.path, *["*"] * len(self.buckets), "commit=*"]))) or []
        gone = [s.getPath() for s in found if self._relative(s.getPath()) not in named]
        for path in gone:
            self._files.delete(path, True)
        for number in numbers[:-keep]:
            self._files.delete(self._path(self._file(number)), False)
        return len(gone)


class KeyedTable(FolderTable):
    """A table dealt to ``parts`` buckets by the hash of its keys."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], parts: int = 64):
        self.keys, self.parts, self.columns = list(keys), parts, schema.names
        super().__init__(spark, path, T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]), ["bucket"])

    def _placed(self, rows: DataFrame) -> DataFrame:
        kinds = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return rows.withColumn("bucket", F.pmod(F.hash(*kinds), F.lit(self.parts)))

    def rows(self) -> DataFrame:
        return self.read().drop("bucket")

    def add(self, rows: DataFrame, mark: Mark | None = None) -> bool:
        return self.append(self._placed(rows), mark) is not None

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], mark: Mark | None = None) -> bool:
        """``combine(old rows, changes)`` for the buckets of the changed keys. ``changes`` is read twice."""
        placed = self._placed(changes)
        return self.rewrite(placed, lambda old: self._placed(combine(old.drop("bucket"), changes)), mark)

    def replace(self, rows: DataFrame, keys: DataFrame, mark: Mark | None = None) -> bool:
        """All rows whose key is among ``keys`` give way to ``rows``, which must have such keys."""
        wanted = keys.select(*self.keys).distinct()
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.keys]

        def combine(old: DataFrame) -> DataFrame:
            kept = old.drop("bucket").alias("o").join(wanted.alias("k"), same, "left_anti")
            return self._placed(kept.select(*self.columns).unionByName(rows.select(*self.columns)))

        return self.rewrite(self._placed(wanted), combine, mark)
