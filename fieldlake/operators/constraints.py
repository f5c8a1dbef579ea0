"""The declared constraints of the relational tables, checked in one pass per table.

All rules of a row become one array of violations, so a table is scanned once however
many rules it has. The primary key takes part as one more entry per row: after the
aggregation by key and rule, keys met more than once are its violations. Nearly every
key is met once, so combining on the map side would only hold all of them: entries are
dealt by key over as many tasks as the table needs, and counted there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake import constants as K, schemas
from fieldlake.session import tasks_for

KEY_RULE = "primary_key"


@dataclass(frozen=True)
class Constraints:
    """Rules of one table: key columns, columns that must be set, longest texts, ranges (column, least, most)."""

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    ranges: tuple[tuple[str, float | None, float | None], ...] = ()

    def columns(self) -> set[str]:
        return {*self.key, *self.required, *self.lengths, *(c for c, _, _ in self.ranges)}


def declared(table: str) -> Constraints:
    """The constraints of a declared table."""
    ranges = {"analytics_summary": (("avg_moisture", *next((lo, hi) for c, lo, hi in K.READING_RANGES if c == "moisture")),)}
    return Constraints(schemas.PRIMARY_KEYS[table], schemas.REQUIRED[table], schemas.TEXT_LENGTHS[table], ranges.get(table, ()))


def row_violations(rules: Constraints) -> Column:
    """The violations of one row: column and rule. A key is required, too."""
    def hit(test: Column, column: str, rule: str) -> Column:
        return F.when(test, F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule")))

    found = [hit(F.col(c).isNull(), c, "not_null") for c in (*rules.key, *(r for r in rules.required if r not in rules.key))]
    found += [hit(F.length(c) > n, c, "length") for c, n in rules.lengths.items()]
    for c, low, high in rules.ranges:
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col(c) < low)
        if high is not None:
            outside = outside | (F.col(c) > high)
        found.append(hit(outside, c, "range"))
    return F.array_compact(F.array(*found))


def violations(rows: DataFrame, rules: Constraints, size: int | None = None) -> DataFrame:
    """row_key, column_name, rule and n_rows: what breaks the rules, per key value.

    ``size`` is about how many rows there are; without it they are counted. A rule for a
    column that the table does not have is an error: it would pass unseen.
    """
    missing = rules.columns() - set(rows.columns)
    if missing:
        raise ValueError(f"no column for the rules of {', '.join(sorted(missing))}")
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rules.key])
    whole = F.lit(True)
    for c in rules.key:
        whole = whole & F.col(c).isNotNull()
    mark = F.array_compact(F.array(F.when(whole, F.struct(F.lit(",".join(rules.key)).alias("column_name"), F.lit(KEY_RULE).alias("rule")))))
    entries = rows.select(key.alias("row_key"), F.inline(F.concat(mark, row_violations(rules))))
    dealt = entries.repartition(tasks_for(rows.count() if size is None else size), "row_key")
    counted = dealt.groupBy("row_key", "column_name", "rule").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("rule") != KEY_RULE) | (F.col("n_rows") > 1))


def declared_violations(tables: dict[str, DataFrame], sizes: dict[str, int] | None = None) -> DataFrame:
    """The violations of several declared tables, with the table's name; one scan each. ``sizes`` as in ``violations``."""
    out = None
    for name, rows in tables.items():
        own = violations(rows, declared(name), (sizes or {}).get(name)).select(F.lit(name).alias("table_name"), "*")
        out = own if out is None else out.unionByName(own)
    return out
