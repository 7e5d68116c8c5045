"""Uniform seeded draws of table rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.functions.draws import draw
from ordermill.operators.joins import lookup_join
from ordermill.scratch import materialize

#: Hexadecimal digits of a bucket's name, at every size of table.
DIGITS = 4
#: Rows of one key that are numbered together; more are spread over the buckets.
RUN = 10_000
RUN_BLOCK = 1_000


class RowIndex(NamedTuple):
    """``table`` maps ``idx`` in 0..rows-1 to ``key``."""

    table: DataFrame
    key: str
    rows: int
    small: bool | None = None


def dense_index(df: DataFrame, key: str, *, digits: int = DIGITS, run: int = RUN) -> RowIndex:
    """Number the rows of ``df`` that have a key, 0..rows-1.

    The order is by hash bucket, then key: stable under any partitioning and
    without a global sort, and one rule at every size. Equal keys are counted
    first and cut into runs; the first run of a key hashes by the key, each
    further one by key and number, so neither a key nor a bucket ends up in one
    task with a large share of the rows. The counts are kept, so ``df`` is
    computed once.
    """
    keyed = df.where(F.col(key).isNotNull())
    total = Observation()
    counted = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counted.observe(total, F.sum("n").alias("rows")), "counts")
    rows = total.get["rows"]
    if not rows:
        raise ValueError(f"no row with a {key} to draw from")
    # Two explodes, since the numbers of one key's runs may not fit one array.
    last = counts.withColumn("last", F.expr(f"(n - 1) div {run}"))
    block = F.sequence(F.lit(0).cast("bigint"), F.expr(f"last div {RUN_BLOCK}"))
    first_run = F.col("block") * RUN_BLOCK
    inside_block = F.sequence(first_run, F.least("last", first_run + (RUN_BLOCK - 1)))
    pieces = (
        last.withColumn("block", F.explode(block))
        .withColumn("piece", F.explode(inside_block))
        .withColumn("size", F.least(F.lit(run), F.col("n") - F.col("piece") * run))
        .withColumn(
            "label",
            F.when(F.col("piece") == 0, F.col(key).cast("string")).otherwise(
                F.concat_ws(":", F.col(key).cast("string"), F.col("piece"))
            ),
        )
        .withColumn("bucket", F.substring(F.md5("label"), 1, digits))
    )

    # At most 16**digits rows from here to the broadcast, whatever df holds.
    sizes = pieces.groupBy("bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = sizes.select(
        "bucket", (F.sum("bucket_size").over(before) - F.col("bucket_size")).alias("offset")
    )

    inside = (
        Window.partitionBy("bucket")
        .orderBy(key, "piece")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    first = F.col("offset") + F.col("end") - F.col("size")
    table = (
        pieces.withColumn("end", F.sum("size").over(inside))
        .join(F.broadcast(offsets), "bucket")
        .select(key, F.explode(F.sequence(first, first + F.col("size") - 1)).alias("idx"))
    )
    return RowIndex(table, key, rows)


def draw_rows(
    df: DataFrame, index: RowIndex, seed: int, tag: str, *ids: Column
) -> DataFrame:
    """Add the key of a uniformly drawn row of the indexed table to each row."""
    drawn = df.withColumn("idx", F.pmod(draw(seed, tag, *ids), F.lit(index.rows)))
    return lookup_join(drawn, index.table, ["idx"], small=index.small).drop("idx")
