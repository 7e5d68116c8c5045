"""Tables laid out so that a lookup by key reads little.

Rows are sorted by key over all files, so a key lies in one file, or in neighbouring
ones. A small table of the files' first and last keys, kept beside them, tells which:
the other files are not even opened. Inside a file, row groups and pages are small
and carry their least and greatest key, which the scan compares before it reads.
Further columns may get a Bloom filter for each row group; a lookup by these opens
all files, but reads only groups that may hold the value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.tables import read_table

RANGES = "_ranges"
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2_000


def write_sorted(
    df: DataFrame,
    path: str,
    key: str,
    *,
    bloom: Iterable[str] = (),
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write a Parquet table for ``lookup`` by ``key``; an old one is replaced.

    A key that holds many rows is cut into several files by a hash of its rows.
    Rows without a key are written too, and found by no lookup.
    """
    path = path.rstrip("/")
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
    order = [F.col(f"`{key}`"), F.xxhash64(*[f"`{c}`" for c in df.columns])]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    rows = dealt.sortWithinPartitions(f"`{key}`", *[f"`{c}`" for c in bloom])
    rows.write.options(**{k: str(v) for k, v in options.items()}).mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(f"`{key}`").alias("first"), F.max(f"`{key}`").alias("last")
    )
    # One row for each file.
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")


def lookup(spark: SparkSession, path: str, key: str, values: Iterable) -> DataFrame:
    """Rows of a table of ``write_sorted`` whose ``key`` is one of a few values."""
    path, values = path.rstrip("/"), sorted(set(values))
    table = read_table(spark, path)
    if not values:
        return table.where(F.lit(False))
    ranges = read_table(spark, f"{path}/{RANGES}")
    within = [(F.col("first") <= F.lit(v)) & (F.col("last") >= F.lit(v)) for v in values]
    may = within[0]
    for other in within[1:]:
        may = may | other
    files = [f"{path}/{row['file']}" for row in ranges.where(may).select("file").collect()]
    if not files:
        return table.where(F.lit(False))
    rows = spark.read.schema(table.schema).parquet(*files)
    return rows.where(F.col(f"`{key}`").isin(values))
