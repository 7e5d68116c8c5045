"""Joins whose hot keys are split by plan, not by chance.

Adaptive execution splits hot partitions while a query runs, if it is on and sees
their sizes. ``hot_join`` needs neither: a sketch of the keys names the hot ones
before the join, and their rows never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.joins import fits_broadcast

#: Keys that may count as hot; each holds at least this part of the rows.
MOST = 256
#: Distinct keys that the sketch follows at a time.
TRACKED = 16_384
#: Pieces of a hot key where the other side is too large to broadcast.
SALTS = 64


def hot_keys(df: DataFrame, key: str, *, most: int = MOST, tracked: int = TRACKED) -> list:
    """Keys that hold at least the ``most``-th part of the rows, by a sketch.

    The sketch has a fixed size in every task and is merged, so nothing is shuffled
    by key. It never misses such a key; one that holds a little less may be named.
    """
    top = F.expr(f"approx_top_k(`{key}`, {most}, {tracked})")
    keyed = df.where(F.col(f"`{key}`").isNotNull())
    found = keyed.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [entry["item"] for entry in found["top"] or [] if entry["count"] * most >= found["n"]]


def hot_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    *,
    hot: Sequence | None = None,
    most: int = MOST,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``left`` (inner or left outer) with ``right`` on ``key``, at any skew.

    Rows of ``left`` with a hot key (at most ``most``, from ``hot_keys`` unless they
    are given) stay where they are, and meet the rows of ``right`` with these keys by
    broadcast, if these are measured to be few; else each hot key is cut into
    ``salts`` pieces on the left and repeated for them on the right. Rows without a
    key match nothing and stay too. All others are shuffled by key. ``left`` is read
    for the sketch, for its hot rows and for the others, so one that is dear to
    compute is better kept as a table first.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    hot = list(hot_keys(left, key, most=most) if hot is None else hot)
    column = F.col(f"`{key}`")
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(column.isin(hot), F.lit(True))
    hot_left, hot_right = left.where(is_hot), right.where(column.isin(hot))
    if fits_broadcast(hot_right):
        joined = hot_left.join(F.broadcast(hot_right), key, how)
    else:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        joined = (
            hot_left.withColumn("_salt", salt)
            .join(hot_right.withColumn("_salt", every), [key, "_salt"], how)
            .drop("_salt")
        )
    rest = left.where(~is_hot).join(right.where(~column.isin(hot)), key, how)
    return joined.unionByName(rest)
