"""Lexical retrieval packing: a seed's nearest unused documents fill its window.

A document is its ids and the end id. One that is longer than a window fills
windows of its own; what is left of it, like any short document, is indexed. The
index is an inverted BM25 index over token ids, in shards of ``SHARD`` documents
that are alike: documents are dealt in the order of several min-hashes of their
ids, in which an id counts by the square of its idf, and then of their content. So
copies are neighbours and texts that share rare ids are near, and a shard never
grows with the input. Document frequencies and the mean length are those of the whole corpus. In a shard the
first unused document is the seed; its neighbours are taken by falling score and
the last is cut where the window ends, its rest being the next seed. What a shard
leaves over goes on to the next one of its task, so only the last window of a
task is padded.

A null or empty text is its end id alone. Repeated rows are packed each. Equal
scores go to the earlier document of the shard. An empty table gives no pieces.
Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ordermill.llm.text import blocks, mix
from ordermill.llm.tokens import crc32, encoder
from ordermill.scratch import materialize

WINDOW = 1024
SHARD = 256
K1, B = 1.2, 0.75
#: Min-hashes of a remainder: how many, and the power of the idf an id counts with.
SIGNS, POWER = 4, 2
#: Sequence numbers: those of a task follow each other.
_TASK = 1 << 36
_RETRIEVED = 1 << 62
_COUNTS = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))


class Statistics(NamedTuple):
    """Of all indexed remainders: documents, mean length, documents of each id."""

    n: int
    mean: float
    df: np.ndarray

    def idf(self) -> np.ndarray:
        return np.log1p((self.n - self.df + 0.5) / (self.df + 0.5))

    def ranks(self) -> np.ndarray:
        """For each min-hash, the ids' places in an order that high idf comes early in."""
        weight = self.idf() ** POWER
        ids = np.arange(len(self.df), dtype=np.uint64) + np.uint64(1)
        places = np.empty((SIGNS, len(ids)), dtype=np.uint32)
        for k in range(SIGNS):
            drawn = mix(ids * np.uint64(2 * k + 3)) >> np.uint64(11)
            wait = -np.log((drawn.astype(float) + 0.5) / (1 << 53)) / weight
            places[k, np.argsort(wait, kind="stable")] = np.arange(len(ids))
        return places


def _encoded(docs: DataFrame, vocabulary: str, end_id: int, window: int, keep_ids: bool) -> DataFrame:
    """Documents with their full windows and their remainder, and the statistics.

    The last row of each task has no document but ``df``, the task's counts of the
    ids that it has seen.
    """
    kind = dict(docs.dtypes)["doc_id"]
    doc_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        size = bpe.tokenizer.get_vocab_size()
        df = np.zeros(size, dtype=np.int64)
        sequence = TaskContext.get().partitionId() * _TASK
        for batch in batches:
            for block in blocks(batch.column("text")):
                ids, at = bpe.encode(block)
                rows: list[tuple] = []
                for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
                    mine = np.append(ids[low:high], np.uint32(end_id))
                    full = len(mine) // window
                    pieces = [mine[k * window : (k + 1) * window] for k in range(full)]
                    tail = mine[full * window :]
                    terms = np.unique(tail)
                    df[terms] += 1
                    rows.append(
                        (
                            len(mine),
                            [crc32(p) for p in pieces],
                            [p.tobytes() for p in pieces] if keep_ids else None,
                            sequence,
                            tail.astype("<u2" if size <= 1 << 16 else "<u4").tobytes(),
                        )
                    )
                    sequence += full
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(columns[0], type=pa.int64()),
                        pa.array(columns[1], type=pa.list_(pa.int64())),
                        pa.array(columns[2], type=pa.list_(pa.binary())),
                        pa.array(columns[3], type=pa.int64()),
                        pa.array(columns[4], type=pa.binary()),
                        pa.nulls(block.rows, _COUNTS),
                    ],
                    names=["doc_id", "doc_tokens", "crcs", "windows", "sequence", "tail", "df"],
                )
        nothing = [pa.nulls(1, batch_type) for batch_type in _types(doc_type)]
        seen = np.flatnonzero(df)
        counts = pa.StructArray.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(df[seen])], fields=list(_COUNTS.value_type)
        )
        listed = pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), counts)
        yield pa.RecordBatch.from_arrays(
            [*nothing, listed.cast(_COUNTS)],
            names=["doc_id", "doc_tokens", "crcs", "windows", "sequence", "tail", "df"],
        )

    return docs.select("doc_id", "text").mapInArrow(
        encode,
        f"doc_id {kind}, doc_tokens long, crcs array<long>, windows array<binary>, "
        "sequence long, tail binary, df array<struct<id:int,n:long>>",
    )


def _types(doc_type: pa.DataType) -> list[pa.DataType]:
    listed = pa.list_(pa.int64())
    return [doc_type, pa.int64(), listed, pa.list_(pa.binary()), pa.int64(), pa.binary()]


class Rest(NamedTuple):
    """An indexed remainder: where it starts in its document, and its ids."""

    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int


class Shard:
    """The inverted index of a few remainders."""

    def __init__(self, rests: list[Rest], idf: np.ndarray, mean: float) -> None:
        n = len(rests)
        lengths = np.array([len(r.ids) for r in rests])
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        ids = np.concatenate([r.ids for r in rests]).astype(np.int64)
        # Postings ordered by id, then by document.
        keys, counts = np.unique(ids * n + owner, return_counts=True)
        term, self.doc = keys // n, keys % n
        norm = K1 * (1 - B + B * lengths / max(mean, 1.0))
        self.weight = idf[term] * counts * (K1 + 1) / (counts + norm[self.doc])
        terms, self.first = np.unique(term, return_index=True)
        self.count = np.diff(np.append(self.first, len(term)))
        # The terms of each document, as positions among the terms.
        by_doc = np.argsort(self.doc, kind="stable")
        self.terms = np.searchsorted(terms, term)[by_doc]
        self.bounds = np.searchsorted(self.doc[by_doc], np.arange(n + 1))
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents of the shard for the terms of one."""
        mine = self.terms[self.bounds[seed] : self.bounds[seed + 1]]
        count = self.count[mine]
        reach = np.cumsum(count)
        at = np.repeat(self.first[mine] - (reach - count), count) + np.arange(reach[-1])
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack_shard(
    rests: list[Rest], idf: np.ndarray, mean: float, window: int
) -> Iterator[list[Rest]]:
    """Full windows as lists of pieces; the last list may be short."""
    shard = Shard(rests, idf, mean)
    unused = np.ones(len(rests), dtype=bool)
    begun: tuple[int, Rest] | None = None
    while True:
        if begun is None:
            free = np.flatnonzero(unused)
            if not len(free):
                return
            begun = (int(free[0]), rests[free[0]])
        seed, rest = begun
        unused[seed] = False
        begun = None
        pieces, room = [rest], window - len(rest.ids)
        if room and unused.any():
            score = np.where(unused, shard.scores(seed), -1.0)
            for k in np.argsort(-score, kind="stable").tolist():
                if not room or not unused[k]:
                    break
                unused[k] = False
                other = rests[k]
                cut = min(room, len(other.ids))
                pieces.append(other._replace(ids=other.ids[:cut]))
                room -= cut
                if cut < len(other.ids):
                    begun = (k, other._replace(start=other.start + cut, ids=other.ids[cut:]))
        yield pieces


def _signed(tails: DataFrame, shared: Broadcast, width: str) -> DataFrame:
    """The remainders with ``sign``, their min-hashes in a row."""
    kinds = ", ".join(f"{c} {k}" for c, k in tails.dtypes)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value.ranks()
        for batch in batches:
            signs = []
            for tail in batch.column("tail"):
                ids = np.frombuffer(tail.as_py(), dtype=width)
                signs.append(ranks[:, ids].min(axis=1).astype(">u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signs, type=pa.binary())], names=[*batch.schema.names, "sign"]
            )

    return tails.mapInArrow(sign, f"{kinds}, sign binary")


_PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _retrieved(
    tails: DataFrame, statistics: Statistics, window: int, shard: int, keep_ids: bool, width: str
) -> DataFrame:
    kind = dict(tails.dtypes)["doc_id"]
    doc_type = to_arrow_type(tails.schema["doc_id"].dataType)
    shared = tails.sparkSession.sparkContext.broadcast(statistics)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value.idf(), shared.value.mean
        sequence = _RETRIEVED + TaskContext.get().partitionId() * _TASK

        def table(sequences: list[list[Rest]]) -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    ids = p.ids.astype("<u4")
                    kept = ids.tobytes() if keep_ids else None
                    rows.append(
                        (p.doc_id, p.start, len(ids), crc32(ids), p.doc_tokens, sequence, offset, kept)
                    )
                    offset += len(ids)
                sequence += 1
            columns = list(zip(*rows)) or [[]] * 8
            types = [doc_type, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

        waiting: list[Rest] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "doc_tokens", "tail")]
            for doc, total, tail in zip(*columns):
                ids = np.frombuffer(tail.as_py(), dtype=width)
                waiting.append(Rest(doc.as_py(), total.as_py() - len(ids), ids, total.as_py()))
                if len(waiting) >= shard:
                    *whole, last = pack_shard(waiting, idf, mean, window)
                    waiting = last if sum(len(p.ids) for p in last) < window else []
                    yield table(whole if waiting else [*whole, last])
        if waiting:
            yield table(list(pack_shard(waiting, idf, mean, window)))

    signed = _signed(tails, shared, width).withColumn("content", F.crc32("tail"))
    order = ("sign", "content", "doc_id")
    dealt = signed.repartitionByRange(*order).sortWithinPartitions(*order, "tail")
    return dealt.mapInArrow(fill, f"doc_id {kind}, {_PIECE}")


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    end_id: int = 0,
    window: int = WINDOW,
    shard: int = SHARD,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, with ``keep_ids``, ``ids``
    (little-endian unsigned 32-bit integers).

    Texts are encoded where they are read; only remainders, shorter than a
    window, are shuffled.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    encoded = materialize(_encoded(chosen, vocabulary, end_id, window, keep_ids), "encoded")
    counts = encoded.where("df is not null").select(F.inline("df"))
    per_id = counts.groupBy("id").agg(F.sum("n").alias("df"))
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    width = "<u2" if size <= 1 << 16 else "<u4"
    tails = encoded.where("octet_length(tail) > 0")
    seen = tails.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.octet_length("tail")).alias("mean")
    ).first()
    df = np.zeros(size, dtype=np.int64)
    for row in per_id.collect():  # at most one row per id of the vocabulary
        df[row["id"]] = row["df"]
    statistics = Statistics(seen["n"], (seen["mean"] or 0) / int(width[-1]), df)

    whole = encoded.where("df is null").select(
        "doc_id", "doc_tokens", "sequence", "windows", F.posexplode("crcs").alias("k", "crc")
    )
    alone = whole.select(
        "doc_id",
        (F.col("k") * F.lit(window)).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        (F.col("sequence") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.expr("windows[k]").alias("ids"),
    )
    rests = tails.select("doc_id", "doc_tokens", "tail")
    together = _retrieved(rests, statistics, window, shard, keep_ids, width)
    pieces = alone.unionByName(together)
    return pieces if keep_ids else pieces.drop("ids")
