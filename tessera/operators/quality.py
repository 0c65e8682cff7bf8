"""Data-quality checks standing in for database constraints.

Spark enforces no keys.  All key constraints of all tables are checked in one
pass: every table is read once and gives one row per constraint it takes part
in, tagged with the constraint, the key and the side; one aggregation by
(constraint, key) then tells duplicates and orphans, whatever the number of
constraints.  Equal keys are combined map-side, so a hot key is one row a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Unique:
    """The columns of a table hold no value twice (NULLs aside)."""
    name: str
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """A table's columns hold only values of the parent's (NULLs aside)."""
    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def name_violations(df: DataFrame, col: str = "name", pattern: str = r"(?i)^\w+$") -> DataFrame:
    """Rows whose name does not match the alphanumeric check."""
    return df.where(~F.col(col).rlike(pattern))


def violations(tables: dict[str, DataFrame], constraints: list[Unique | Reference]) -> DataFrame:
    """(constraint, key, n_rows): key values that occur more than once
    against a :class:`Unique`, or that have no parent against a
    :class:`Reference`; ``key`` is the values as a JSON list."""
    rows = None
    for table, df in tables.items():
        tags = []
        for c in constraints:
            sides = [(c.columns, 0 if isinstance(c, Unique) else 1)] if c.table == table else []
            if isinstance(c, Reference) and c.parent == table:
                sides.append((c.parent_columns, 2))
            for columns, side in sides:
                there = F.lit(True)
                for k in columns:
                    there = there & F.col(k).isNotNull()
                # Types of the two sides may differ: keys are compared as text.
                key = F.to_json(F.array(*[F.col(k).cast("string") for k in columns]))
                tags.append(F.when(there, F.struct(F.lit(c.name).alias("constraint"), key.alias("key"), F.lit(side).alias("side"))))
        if tags:
            one = df.select(F.inline(F.array_compact(F.array(*tags))))
            rows = one if rows is None else rows.unionByName(one)
    n = {side: F.count(F.when(F.col("side") == side, 1)) for side in (0, 1, 2)}
    seen = rows.groupBy("constraint", "key").agg(n[0].alias("own"), n[1].alias("child"), n[2].alias("parent"))
    return seen.where("own > 1 OR child > 0 AND parent = 0").select("constraint", "key", F.greatest("own", "child").alias("n_rows"))


def integrity(tables: dict[str, DataFrame], constraints: list[Unique | Reference]) -> DataFrame:
    """Violating keys and rows per constraint, zeros included."""
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(c.name,) for c in constraints], "constraint string")
    found = violations(tables, constraints).groupBy("constraint").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    return names.join(found, "constraint", "left").select(
        "constraint", F.coalesce("n_keys", F.lit(0)).cast("long").alias("n_keys"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))
