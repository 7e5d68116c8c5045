"""Token ids as Parquet files, in ascending document order.

One row per document: ``doc_id``, ``part`` (number of the file's range),
``start_in_part`` (ids of the range before it), ``n_tokens`` and ``tokens``. Ids
are dictionary encoded, the other columns are delta encoded; row groups and pages
are kept small, and every page is in the file's page index, so single documents
and the columns without ids can be read on their own.

A null text is empty and has the end id alone. Repeated rows are written each,
rows of one id in the order of a hash of their texts, so that one id may fill many
ranges; rows without an id come first. An
empty table makes files without rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.text import blocks
from ordermill.llm.tokens import crc32, encoder

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 1_000

FILE_COLUMNS = "doc_id long, part int, start_in_part long, n_tokens int, tokens array<int>"


def tokenized(
    docs: DataFrame, vocabulary: str, end_id: int, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of the files: documents dealt by id ranges, sorted, then encoded."""
    kind = docs.select(doc_id).dtypes[0][1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bpe = encoder(vocabulary)
        before = 0
        for batch in batches:
            for block in blocks(batch.column("text")):
                ids, at = bpe.encode(block)
                ends = at[1:] + np.arange(1, block.rows + 1)
                ids = np.insert(ids, at[1:], end_id)
                sizes = np.diff(ends, prepend=0)
                offsets = np.append(0, ends).astype(np.int32)
                tokens = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(np.full(block.rows, part, dtype=np.int32)),
                        pa.array(before + ends - sizes),
                        pa.array(sizes.astype(np.int32)),
                        tokens,
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "tokens"],
                )
                before += int(ends[-1])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # An id with many rows is cut by their texts, and equal rows in turn.
    keys = {"hash": F.xxhash64("text"), "turn": F.monotonically_increasing_id()}
    dealt = (
        chosen.withColumns(keys)
        .repartitionByRange("doc_id", "hash", "turn")
        .sortWithinPartitions("doc_id", "hash", "text")
        .select("doc_id", "text")
    )
    return dealt.mapInArrow(encode, FILE_COLUMNS.replace("doc_id long", f"doc_id {kind}"))


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    *,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
    **columns: str,
) -> None:
    """Encode all documents into Parquet files under ``path`` (must be new)."""
    options = {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": "true",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "compression": "zstd",
    }
    rows = tokenized(docs, vocabulary, end_id, **columns)
    rows.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def part_starts(files: DataFrame) -> DataFrame:
    """``part`` and ``part_start``: ids of all parts before. One row per file range."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("part_start"))


def read_documents(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before.

    Columns that are not named are not read; a filter on ``doc_id`` reads the
    pages that hold it.
    """
    files = spark.read.parquet(path)
    # One row per file: bounded by the number of files, not of documents.
    starts = F.broadcast(part_starts(files))
    chosen = files.select("doc_id", "part", "start_in_part", *columns)
    return chosen.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), *columns
    )


def with_crc32(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` from rows with ``tokens``."""
    kind = dict(documents.dtypes)["doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            at = tokens.offsets.to_numpy()
            ids = tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start"),
                    pa.array(np.diff(at).astype(np.int64)),
                    pa.array(sums, type=pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    chosen = documents.select("doc_id", "start", "tokens")
    return chosen.mapInArrow(
        digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    )
