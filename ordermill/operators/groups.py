"""Folding rows into arrays, one row per key, and numbering parts of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions that one task numbers at a time; a group of any size has many such runs.
RUN = 1_024


def collect_entries(order_by: list[str | Column], entry: Column) -> Column:
    """Aggregate: the entries of a group as an array sorted by ``order_by``.

    A null entry is left out. Equal sort keys are told apart by the entry.
    """
    sortable = F.struct(*order_by, entry.alias("entry"))
    collected = F.sort_array(F.collect_list(F.when(entry.isNotNull(), sortable)))
    # Not by a lambda: its variable has a new name in each call, so that equal plans
    # would not be seen as equal and their shuffles not be shared.
    return collected["entry"]


def check_limit(limit: int) -> None:
    if limit < 1:
        raise ValueError(f"limit must be at least 1, got {limit}")


def number_parts(
    rows: DataFrame, key: str, pos: str, order_by: list[str], weight: Column, limit: int
) -> DataFrame:
    """Add ``part``: consecutive runs of a group's rows of about ``limit`` weight.

    A part ends with the row that reaches the limit. Rows are ordered by ``pos``,
    then ``order_by``. Only sums of runs of positions are brought together, so a
    group is numbered by many tasks.
    """
    check_limit(limit)
    # One column that is never null, so that rows, sums and the join are partitioned alike.
    group = F.struct(F.col(key), F.expr(f"`{pos}` div {RUN}").alias("_run"))
    rows = rows.withColumns({"_weight": weight, "_group": group})
    runs = rows.groupBy("_group").agg(F.sum("_weight").alias("_sum"))
    earlier = (
        Window.partitionBy(F.col("_group")[key])
        .orderBy(F.col("_group")["_run"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = runs.select("_group", F.sum("_sum").over(earlier).alias("_before"))
    inside = (
        Window.partitionBy("_group")
        .orderBy(pos, *order_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_inside", F.sum("_weight").over(inside))
    # Most groups have one run, and nothing before it.
    placed = placed.join(runs.where("_before <> 0"), "_group", "left")
    before = F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    part = F.floor(before / F.lit(limit)).cast("bigint")
    columns = [c for c in rows.columns if c not in ("_weight", "_group")]
    return placed.select(*columns, part.alias("part"))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row for each non-null key: the least of its rows, column by column."""
    others = [c for c in df.columns if c != key]
    # Not by ``min``: Spark does not see two equal plans as equal above an aggregate, and
    # would not share their shuffles. Before the shuffle one row of a key is left, too.
    least = F.row_number().over(Window.partitionBy(key).orderBy(*others))
    numbered = df.where(F.col(key).isNotNull()).select(key, *others, least.alias("_least"))
    return numbered.where("_least = 1").drop("_least")
