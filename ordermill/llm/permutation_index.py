"""Nearest neighbours by largest inner product, with a permutation index.

Some vectors of the table are pivots, chosen from a sample by hash so that no two
are near each other: a group of near copies, however large, gets no more of them than
any other place. Every vector is represented by its ``NEAR`` nearest pivots in their
order, and posted in the inverted files of these alone, by its place. A query reads
the files of its own nearest pivots. The difference of places, or ``NEAR`` for a
vector that is not in the file, summed over these files, is the footrule distance:
vectors are alike when they see the same pivots in a like order. The share of a block
with the least distance is reranked by the exact inner product in double precision,
and with it all that see the pivots in almost the query's own order, which places
cannot rank. ``share=1.0`` reranks every row, and is the exact way. Of the reranked
only those that may be among the nearest so far are merged with them.

Rows are indexed in blocks of bounded size, dealt by the hash of their ids; a
block's files are one list of rows by pivot and place. Equal vectors of a block are
one entry with their ids. Queries are broadcast in blocks of bounded size and go through
every index block; a task keeps the best of each query over its blocks.

For inner products of vectors of unequal length, all are scaled by the greatest
length and given one more component that makes them unit vectors; queries get 0.

Vectors that are null, zero, of another length than the most common one, or that
hold null or non-finite components take no part, nor do rows without an id. Rows
of one id are never neighbours of each other. An empty table gives no rows. Ties
go to the smaller id. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.scratch import materialize

#: Pivots, and how many of them, the nearest, represent a vector.
PIVOTS = 512
NEAR = 64
#: Distinct vectors, by hash, that pivots are chosen from.
SAMPLE = 4_096
#: Pivots have inner products below this (unit vectors), if the sample has enough.
APART = 0.8
BLOCK_ROWS = 8_192
QUERY_BLOCK = 32_768
#: Of each block, the share of rows reranked by the exact measure.
SHARE = 0.12
LEAST = 1_000
#: Rows within this share of the greatest footrule distance are all reranked.
CLOSE = 1 / 8


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    chosen = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    )
    chosen = chosen.where(finite & F.exists("v", lambda x: x != 0))
    sizes = chosen.groupBy(F.size("v").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), "size").first()
    return chosen.where(F.size("v") == (most["size"] if most else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors whose inner products keep the order of the rows' own."""
    scaled = rows / longest
    rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
    return np.hstack([scaled, rest[:, None]])


def spread(rows: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` rows (lifted) that are not near an earlier one.

    Where the sample has too few such rows, nearer ones are let in step by step.
    """
    chosen: list[int] = []
    nearness = np.full(len(rows), -np.inf)
    gap = 1 - APART
    while len(chosen) < min(n, len(rows)):
        bound = 1 - gap if gap > 1e-12 else np.inf
        for k in range(len(rows)):
            if nearness[k] < bound and len(chosen) < n:
                chosen.append(k)
                nearness = np.maximum(nearness, rows @ rows[k])
                nearness[chosen] = np.inf
        gap /= 2
    return rows[chosen]


def orders(rows: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """For each row (lifted), its nearest pivots, the nearest first."""
    seen = rows @ pivots.T
    near = min(near, len(pivots))
    some = np.argpartition(-seen, near - 1, axis=1)[:, :near]
    some.sort(axis=1)
    order = np.argsort(-np.take_along_axis(seen, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.uint16)


class Files(NamedTuple):
    """Inverted files: ``rows`` by pivot and place, and where each place begins."""

    starts: np.ndarray
    rows: np.ndarray


def post(order: np.ndarray, pivots: int) -> Files:
    """Post every row in the files of its nearest pivots."""
    n, near = order.shape
    key = (order.astype(np.int64) * near + np.arange(near)).ravel()
    by_key = np.argsort(key, kind="stable")
    starts = np.searchsorted(key[by_key], np.arange(pivots * near + 1))
    return Files(starts.astype(np.int32), (by_key // near).astype(np.int32))


def footrule(files: Files, query: np.ndarray, n: int) -> np.ndarray:
    """Distance of ``n`` rows to a query, from the files of the query's pivots."""
    near = len(query)
    begin = query.astype(np.int64) * near
    ends = files.starts[begin[:, None] + np.arange(near + 1)]
    found = np.concatenate([files.rows[a:b] for a, b in ends[:, [0, -1]].tolist()])
    gained = np.repeat(_gains(near), np.diff(ends, axis=1).ravel())
    return near * near - np.bincount(found, gained, n)


@cache
def _gains(near: int) -> np.ndarray:
    """What a place of a file takes off the distance, for each place of a query's pivot."""
    place = np.arange(near)
    return (near - np.abs(place[:, None] - place)).ravel().astype(float)


def _ranks(begins: np.ndarray) -> np.ndarray:
    """Each row's number within its run."""
    at = np.arange(len(begins))
    return at - np.maximum.accumulate(np.where(begins, at, 0))


def build_index(
    vectors: DataFrame, n: int, pivots: np.ndarray, longest: float, top: int, near: int
) -> DataFrame:
    """One row for each block: ids, vectors and the pivots' files."""
    blocks = max(1, -(-n // BLOCK_ROWS))

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        rows = matrix(group.column("v"))
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], np.ascontiguousarray(rows[order])
        # Equal vectors are one entry. The first ``top`` rows of each id and, of these,
        # the first twice ``top`` are all that can be found: a query passes over its own.
        keys = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
        _, first, entry = np.unique(keys, return_index=True, return_inverse=True)
        kept = np.argsort(entry, kind="stable")
        new = np.append(True, (np.diff(entry[kept]) != 0) | (np.diff(ids[kept]) != 0))
        kept = kept[_ranks(new) < top]
        kept = kept[_ranks(np.append(True, np.diff(entry[kept]) != 0)) < 2 * top]
        files = post(orders(lifted(rows[first], longest), pivots, near), len(pivots))
        return pa.table(
            {
                "ids": pa.array([ids[kept].astype("<i8").tobytes()], type=pa.binary()),
                "entries": pa.array([entry[kept].astype("<i4").tobytes()], type=pa.binary()),
                "vectors": pa.array([rows[first].astype("<f8").tobytes()], type=pa.binary()),
                "starts": pa.array([files.starts.astype("<i4").tobytes()], type=pa.binary()),
                "files": pa.array([files.rows.astype("<i4").tobytes()], type=pa.binary()),
            }
        )

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(
        build, "ids binary, entries binary, vectors binary, starts binary, files binary"
    )


def nearest(distance: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` least distances, ties to the earlier."""
    if n >= len(distance):
        return np.arange(len(distance))
    bound = np.partition(distance, n - 1)[n - 1]
    below = np.flatnonzero(distance < bound)
    return np.concatenate([below, np.flatnonzero(distance == bound)[: n - len(below)]])


def _search_block(
    index: DataFrame, queries: tuple[np.ndarray, np.ndarray, np.ndarray], top: int, share: float
) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors, seen = shared.value
        best_ids = np.full((len(own), top), np.iinfo(np.int64).max)
        best = np.full((len(own), top), -np.inf)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, entries, flat, starts, listed = (
                    np.frombuffer(batch.column(c)[row].as_py(), dtype=kind)
                    for c, kind in (
                        ("ids", "<i8"), ("entries", "<i4"), ("vectors", "<f8"), ("starts", "<i4"), ("files", "<i4")
                    )
                )
                rows = flat.reshape(-1, vectors.shape[1])
                files = Files(starts, listed)
                bounds = np.searchsorted(entries, np.arange(len(rows) + 1))
                n = max(LEAST, int(share * len(rows)))
                close = CLOSE * seen.shape[1] ** 2
                for k in range(len(own)):
                    distance = footrule(files, seen[k], len(rows))
                    chosen = nearest(distance, max(n, np.count_nonzero(distance <= close)))
                    exact = (rows[chosen] * vectors[k]).sum(axis=1)
                    able = exact >= best[k, -1]
                    chosen, exact = chosen[able], exact[able]
                    if not len(chosen):
                        continue
                    many = bounds[chosen + 1] - bounds[chosen]
                    reach = np.cumsum(many)
                    at = np.repeat(bounds[chosen] - (reach - many), many) + np.arange(reach[-1])
                    found, value = ids[at], np.repeat(exact, many)
                    other = found != own[k]
                    found = np.concatenate([best_ids[k], found[other]])
                    value = np.concatenate([best[k], value[other]])
                    order = np.lexsort((found, -value))[:top]
                    best_ids[k], best[k] = found[order], value[order]
        real = np.isfinite(best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(own, real.sum(axis=1))),
                pa.array(best_ids[real]),
                pa.array(best[real]),
            ],
            names=["query_id", "vec_id", "score"],
        )

    return index.mapInArrow(search, "query_id long, vec_id long, score double")


def search(
    df: DataFrame,
    is_query: Column,
    *,
    top: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    near: int = NEAR,
    share: float = SHARE,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` nearest of each query.

    ``is_query`` is a condition on ``vec_id``; every other row is a candidate. Of each
    block the ``share`` of rows of least distance is reranked; all of them with 1.0.
    """
    spark = df.sparkSession
    vectors = materialize(valid_vectors(df, vec_id, vector), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n, longest = vectors.agg(F.count(F.lit(1)), F.max(length)).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    sample = vectors.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h", "v").limit(SAMPLE)
    chosen = spread(lifted(matrix(sample.select("v").toArrow()["v"]), longest), pivots)
    index = materialize(build_index(vectors, n, chosen, longest, top, near), "index")

    asked = vectors.where(is_query).distinct()  # a repeated row asks once
    n_queries = asked.count()
    parts = max(1, -(-n_queries // query_block))
    found = []
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).orderBy("vec_id")
        rows = mine.toPandas()  # about ``query_block`` rows
        if not len(rows):
            continue
        own = np.stack(rows["v"].to_numpy())
        unit = own / np.linalg.norm(own, axis=1, keepdims=True)
        seen = orders(np.hstack([unit, np.zeros((len(own), 1))]), chosen, near)
        result = _search_block(index, (rows["vec_id"].to_numpy(), own, seen), top, share)
        found.append(result if parts == 1 else materialize(result, "found"))
    if not found:
        return spark.createDataFrame([], empty)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
