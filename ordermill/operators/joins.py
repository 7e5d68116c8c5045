"""Joins against a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` (rows, and bytes as JSON text with null fields) once.

    For a kept table; on any other its whole plan runs for the measurement.
    """
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    size = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length(text)).alias("n_bytes")
    ).first()
    return size["n_rows"] <= max_rows and (size["n_bytes"] or 0) <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    small: bool | None = None,
) -> DataFrame:
    """Join ``left`` (inner or left outer) with a lookup table on equal keys.

    ``small`` hands over a measurement: True broadcasts ``right``, so ``left`` is
    not shuffled. Otherwise the planner broadcasts what it knows to be small;
    beyond that both sides are shuffled, and adaptive execution splits the
    partitions of hot or null keys of ``left``, however many rows they have.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    return left.join(F.broadcast(right) if small else right, keys, how)


def lookup_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with one key; the filter reaches the scan."""
    return df.where(F.col(key) == F.lit(value))
