"""Exact duplicates by sorting contents.

Rows are dealt to ranges of normalised bytes by sampled splitters, sorted inside
their range, so that equal bytes are adjacent, and compared with their neighbours
in full. A splitter is the first ``PREFIX`` bytes, a hash and the piece of a group,
so what a sample sends to the driver does not depend on the length of texts, and
texts that begin alike are still dealt to many ranges.

A group of copies that outgrows the ``PIECES``-th part of the table (in rows or in
bytes; ``least_rows`` and ``least_bytes`` at least) is cut into pieces before the
sort. Each piece finds its own best id; one row of each piece then meets those of
the other pieces, again by full text. So there are never more than 4 * ``PIECES``
such rows, whatever the table holds, and they may be broadcast.

Defined results: a null text is empty, and equal to an empty one. Rows without an
id belong to a group like others, but one stays only where no member has an id;
``keep_id`` is null then. Of repeated rows of one id one stays. An empty table
gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ordermill.scratch import materialize

PREFIX = 64
PIECES = 1 << 17
LEAST_ROWS = 1_000
LEAST_BYTES = 16 << 20
KEEP = ("smallest", "largest")


def _hot_hashes(contents: DataFrame, least_rows: int, least_bytes: int) -> DataFrame:
    """``hash`` and ``pieces`` of contents too common for one task.

    At most 2 * ``PIECES`` rows, with 4 * ``PIECES`` pieces together: sizes are
    measured against the whole table.
    """
    total = Observation()
    counted = contents.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("content")).alias("bytes")
    )
    counted = counted.observe(
        total,
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )
    many = (F.col("n") > least_rows) | (F.col("bytes") > least_bytes)
    common = materialize(counted.where((F.col("n") > 1) & many), "common")
    rows = max(least_rows, total.get["n"] // PIECES)
    size = max(least_bytes, total.get["bytes"] // PIECES)
    pieces = F.greatest(F.ceil(F.col("n") / F.lit(rows)), F.ceil(F.col("bytes") / F.lit(size)))
    # No more pieces than rows: a piece of one row may be larger than the limit.
    return common.select("hash", F.least(pieces, "n").alias("pieces")).where("pieces > 1")


def content_groups(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
    least_rows: int = LEAST_ROWS,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    ``normalise`` maps the text column (null as empty) to what is compared; the
    default compares texts as they are. ``keep`` names the id that stays.
    """
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}, got {keep!r}")
    plain = F.coalesce(F.col(text), F.lit(""))
    content = (normalise(plain) if normalise else plain).cast("binary")
    contents = docs.select(F.col(doc_id).alias("doc_id"), content.alias("content"))
    contents = contents.withColumn("hash", F.xxhash64("content"))
    hot = _hot_hashes(contents, least_rows, least_bytes)
    # Pieces are dealt in turn, so copies that share even their id are split.
    piece = F.when(
        F.col("pieces").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("pieces"))
    )
    place = ["prefix", "hash", "piece"]
    dealt = (
        contents.join(F.broadcast(hot), "hash", "left")
        .select(
            "doc_id",
            "content",
            F.substring("content", 1, PREFIX).alias("prefix"),
            "hash",
            piece.alias("piece"),
        )
        .repartitionByRange(*place)
        .withColumn("row", F.monotonically_increasing_id())
    )
    best = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    # The ranges already hold all rows of a group, so the window only sorts them.
    group = Window.partitionBy(*place, "content").orderBy(best, "row")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = dealt.select(
        "doc_id",
        "content",
        "piece",
        F.row_number().over(group).alias("number"),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.first("row").over(whole).alias("group"),
        F.count(F.lit(1)).over(whole).alias("size"),
    ).select(
        "doc_id",
        F.sha2("content", 256).alias("text_sha256"),
        (F.col("number") == 1).alias("first"),
        "keep_id",
        "group",
        "size",
        F.when((F.col("number") == 1) & F.col("piece").isNotNull(), F.col("content")).alias("piece_of"),
    )
    found = materialize(found, "groups")
    return _joined_pieces(found, keep)


def _joined_pieces(found: DataFrame, keep: str) -> DataFrame:
    """Give the rows of a group that was cut the values of the whole group."""
    pieces = found.where(F.col("piece_of").isNotNull()).select("piece_of", "group", "keep_id", "size")
    has_id = F.col("keep_id").isNotNull()
    if keep == "largest":
        best = F.max(F.struct(has_id.alias("a"), "keep_id", (-F.col("group")).alias("of")))
    else:
        best = F.min(F.struct((~has_id).alias("a"), "keep_id", F.col("group").alias("of")))
    of_text = pieces.groupBy("piece_of").agg(best.alias("best"), F.sum("size").alias("whole_size"))
    joined = pieces.join(of_text, "piece_of").select(
        "group",
        F.col("best.keep_id").alias("whole_keep"),
        "whole_size",
        (F.abs("best.of") == F.col("group")).alias("wins"),
    )
    cut = F.col("wins").isNotNull()
    return found.join(F.broadcast(joined), "group", "left").select(
        "doc_id",
        F.when(cut, F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(cut, F.col("whole_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("first") & F.coalesce("wins", F.lit(True))).alias("kept"),
        "text_sha256",
    )
