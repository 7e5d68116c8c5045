"""Tables that are joined on one key again and again without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, *, path: str | None = None
) -> DataFrame:
    """Save a table in ``buckets`` parts by the hash of ``key``, each sorted by it.

    Tables that are saved with one number of buckets are joined on the key bucket by
    bucket: no row is shuffled, however often the join runs. Rows are dealt as they
    will be read, so each bucket is one file.

    A bucket is read by one task. A key that holds more than a bucket's share of the
    rows is better joined by ``hot_join``, which needs no layout.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join two bucketed tables bucket by bucket.

    The hint keeps the planner from sending a small side to all tasks, which would
    be dearer in each of many runs than reading the buckets where they lie.
    """
    return left.join(right.hint("merge"), key, how)
