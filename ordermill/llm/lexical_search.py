"""Ranked lexical search over a length-stratified index.

A document's normaliser ``m`` depends on its number of terms alone, so documents
fall into strata of equal ``m``. A segment is about ``SEGMENT_DOCS`` documents of
one stratum or fewer, as one row of a Parquet table: its ids, its terms with the greatest
tf of each, and for each term runs of documents that share a tf. Documents of one
run get the same points from the term, so points are computed once for each tf and
not for each document.

A search reads the index up to four times, each time fewer columns or rows:

1. document frequencies of the items' terms;
2. a bound for each item and segment, from the greatest tf of each term; the
   ``FIRST_VISITS`` segments of greatest bound are noted for each item;
3. these segments are scored, which gives each item a score that its last result
   reaches at least;
4. all other segments are visited, in the order of their bounds, and passed over
   where the bound is lower than that score.

Items are taken in blocks of about ``ITEM_BYTES`` of text and ``ITEM_ROWS`` rows;
what a block sends to the workers and what they send back (document frequencies,
and one score for each item) are bounded by that. Each task gives at most ``top``
documents for an item. A segment is a few MB, so the session should bound Arrow
batches by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``).

Scores are whole numbers: a term's weight w is floor(1000 ln((2N+2)/(2df+1))), a
document's m is 100 - 25 + (25 n N) div L, and a document gets, for each term of
the item with its repeats, w * ((10^9 tf) div (1000 tf + 12 m)).

Defined results: a null, empty or blank text has no term and is in no result. A
document without an id counts and is ranked, behind others of its score; repeated
rows are ranked each. Items without terms, or without a hit, give no row; a
repeated item id is ranked for each of its texts, equal ones once. Empty tables
give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ordermill.llm.text import ALNUM, LOWER, Block, blocks, words
from ordermill.scratch import materialize, scratch_path

TOP = 20
SEGMENT_DOCS = 1_024
SEGMENT_POSTINGS = 1 << 18
#: Segments in a row group: a reader holds a whole group of such rows.
GROUP_ROWS = 8
FIRST_VISITS = 3
ITEM_BYTES = 1 << 20
ITEM_ROWS = 1_024
#: Postings that are scored at a time.
_EXPAND = 1 << 19


# --- terms ------------------------------------------------------------------


class Bags(NamedTuple):
    """Terms of the rows of a block, each once, with its number in the row."""

    terms: pa.StringArray
    tf: np.ndarray
    offsets: np.ndarray
    n: np.ndarray


def bags(block: Block) -> Bags:
    """Distinct terms of each row."""
    data = LOWER[block.data]
    found = words(block, data, ALNUM)
    n = np.diff(found.first)
    lengths = found.ends - found.starts
    at = np.append(0, np.cumsum(lengths)).astype(np.int32)
    inside = data[ALNUM[data]]
    every = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(at), pa.py_buffer(inside))
    coded = every.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    row = np.repeat(np.arange(block.rows), n)
    both, tf = np.unique(row * size + codes, return_counts=True)
    offsets = np.searchsorted(both, np.arange(block.rows + 1) * size)
    return Bags(coded.dictionary.take(pa.array(both % size)), tf, offsets, n)


def _lists(offsets: np.ndarray, values: pa.Array | np.ndarray) -> pa.ListArray:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _bag_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n``, and the distinct terms (``size`` of them, separated by
    blanks) with their ``tf``, of rows with terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = bags(block)
                ids = batch.column("doc_id").slice(block.first, block.rows)
                made = pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(found.n.astype(np.int64)),
                        pa.array(np.diff(found.offsets).astype(np.int32)),
                        pc.binary_join(_lists(found.offsets, found.terms), " "),
                        _lists(found.offsets, found.tf.astype(np.int32)),
                    ],
                    names=["doc_id", "n", "size", "terms", "tf"],
                )
                yield made.filter(pa.array(found.n > 0))

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(count, f"doc_id {kind}, n long, size int, terms string, tf array<int>")


# --- index ------------------------------------------------------------------


class Index(NamedTuple):
    """``segments`` and the totals that weights and normalisers are made of."""

    segments: DataFrame
    documents: int
    terms: int


_NUMBERS = ("df", "max_tf", "run_tf", "run_at", "postings")


def _segment(bag: pa.Table) -> tuple[pa.Array, ...]:
    """Ids, terms and number lists of one segment.

    Documents are numbered by id; postings lie by term, then falling tf, then document.
    """
    by_id = pc.sort_indices(
        bag.select(["doc_id"]), sort_keys=[("doc_id", "ascending")], null_placement="at_end"
    )
    bag = bag.take(by_id).combine_chunks()
    terms, tf, ids = (bag.column(c).combine_chunks() for c in ("terms", "tf", "doc_id"))
    doc = np.repeat(np.arange(len(bag)), pc.list_value_length(tf).to_numpy())
    tf = tf.flatten().to_numpy()
    coded = pc.split_pattern(terms, " ").flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((doc, -tf, code))
    code, tf, doc = code[order], tf[order], doc[order]
    new_term = np.append(True, code[1:] != code[:-1])
    new_run = new_term | np.append(True, tf[1:] != tf[:-1])
    term_at, run_at = np.flatnonzero(new_term), np.flatnonzero(new_run)
    df = np.diff(np.append(term_at, len(code)))
    numbers = (df, tf[term_at], tf[run_at], run_at, doc)
    return (ids, coded.dictionary, *[pa.array(x.astype(np.int32)) for x in numbers])


def _in_slots(counted: DataFrame, segment_docs: int, segment_postings: int) -> DataFrame:
    """Add ``slot``: parts of about one segment, of neighbouring strata.

    Documents are laid out by stratum, and within it by chance, on a line on which
    each takes the room of its postings; a slot is a stretch of this line. So long
    documents, which have few companions in their strata, are dealt as evenly as
    short ones, and a stratum of any size is cut into many slots.
    """
    room = F.greatest(F.col("size"), F.lit(-(-segment_postings // segment_docs)))
    # One row for each normaliser: 26 and 25 times the longest document's share of the
    # mean length at most.
    strata = materialize(counted.groupBy("m").agg(F.sum(room).alias("room")), "strata")
    before = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("begin", F.coalesce(F.sum("room").over(before), F.lit(0)))
    chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 31)) / float(1 << 31)
    at = F.col("begin") + F.floor(chance * F.col("room"))
    slot = F.floor(at / F.lit(segment_postings)).cast("long")
    return counted.join(strata, "m").withColumn("slot", slot)


def build_index(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    segment_docs: int = SEGMENT_DOCS,
    segment_postings: int = SEGMENT_POSTINGS,
) -> Index:
    """Index all documents; the index is a table in shared scratch storage."""
    counted = materialize(_bag_table(docs, doc_id, text), "terms")
    totals = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents, terms = int(totals[0]), int(totals[1])
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("m", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(counted.schema["doc_id"].dataType)),
            T.StructField("terms", T.ArrayType(T.StringType())),
            *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in _NUMBERS],
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        place, n_docs, n_postings = None, 0, 0

        def segment() -> pa.RecordBatch:
            lists = [_lists(np.array([0, len(x)]), x) for x in _segment(pa.Table.from_batches(held))]
            keys = [pa.array([number], type=pa.int64()), pa.array([place[1]], type=pa.int64())]
            return pa.RecordBatch.from_arrays(keys + lists, names=schema.names)

        for batch in batches:
            places = zip(*[batch.column(c).to_pylist() for c in ("slot", "m")])
            sizes = pc.list_value_length(batch.column("tf")).to_pylist()
            low = 0
            for k, (here, size) in enumerate(zip(places, sizes)):
                # Slots are of about one segment; only much larger ones are cut.
                full = n_docs >= 2 * segment_docs or n_postings + size > 2 * segment_postings
                if n_docs and (here != place or full):
                    if low < k:
                        held.append(batch.slice(low, k - low))
                    yield segment()
                    number, low, n_docs, n_postings = number + 1, k, 0, 0
                    held.clear()
                place = here
                n_docs += 1
                n_postings += size
            held.append(batch.slice(low))
        if n_docs:
            yield segment()

    m = F.expr(f"75 + cast((25 * cast(n as decimal(38, 0)) * {documents}) div {max(1, terms)} as long)")
    dealt = (
        _in_slots(counted.withColumn("m", m), segment_docs, segment_postings)
        .select("doc_id", "terms", "tf", "m", "slot")
        .repartition("slot")
        .sortWithinPartitions("slot", "m")
    )
    path = scratch_path(docs.sparkSession, "segments")
    segments = dealt.mapInArrow(build, schema).write
    segments.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)
    return Index(docs.sparkSession.read.schema(schema).parquet(path), documents, terms)


# --- search -----------------------------------------------------------------


class Items(NamedTuple):
    """A block of items: its terms with weights; pairs of item and term, by item."""

    ids: list
    vocabulary: pa.Array
    weight: np.ndarray
    item: np.ndarray
    term: np.ndarray
    repeats: np.ndarray


def item_block(rows: list[tuple]) -> Items:
    """Items from rows of id and text, weights still zero."""
    terms, repeats, item = [], [], []
    for block in blocks(pa.array([r[1] for r in rows], type=pa.string())):
        found = bags(block)
        terms.append(found.terms)
        repeats.append(found.tf)
        item.append(block.first + np.repeat(np.arange(block.rows), np.diff(found.offsets)))
    coded = pa.concat_arrays(terms or [pa.array([], pa.string())]).dictionary_encode()
    none = [np.zeros(0, dtype=np.int64)]
    return Items(
        [r[0] for r in rows],
        coded.dictionary,
        np.zeros(len(coded.dictionary), dtype=np.int64),
        np.concatenate(none + item),
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.concatenate(none + repeats),
    )


def points(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term gives a document of a stratum, before its weight."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1_000 * tf + 12 * m)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    ratios = [(2 * documents + 2) / (2 * d + 1) for d in df.tolist()]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def _places(items: Items, terms: pa.Array) -> np.ndarray:
    """Where a segment has each term of the block; -1 where it has not."""
    found = pc.index_in(items.vocabulary, value_set=terms)
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Matched(NamedTuple):
    """Bounds of a segment by item, and its pairs of item and term."""

    bound: np.ndarray
    item: np.ndarray
    factor: np.ndarray
    place: np.ndarray


def _match(items: Items, segment: dict) -> Matched:
    """No document of the segment gets more for an item than its bound."""
    place = _places(items, segment["terms"])[items.term]
    has = place >= 0
    item, place = items.item[has], place[has]
    factor = (items.repeats * items.weight[items.term])[has]
    bound = np.zeros(len(items.ids), dtype=np.int64)
    np.add.at(bound, item, factor * points(segment["max_tf"][place], segment["m"]))
    return Matched(bound, item, factor, place)


class Best:
    """The best documents of one item so far, and the score the next must reach."""

    def __init__(self, top: int, least: int) -> None:
        self.top, self.least = top, max(1, least)
        self.found: list[tuple] = []

    def offer(self, scores: np.ndarray, ids: pa.Array) -> None:
        """Scores of the documents of a segment, which are in the order of their ids."""
        worth = np.flatnonzero(scores >= self.least)
        if not len(worth):
            return
        worth = worth[np.argsort(-scores[worth], kind="stable")[: self.top]]
        self.found += zip(scores[worth].tolist(), ids.take(pa.array(worth)).to_pylist())
        self.found.sort(key=lambda f: (-f[0], f[1] is None, f[1]))
        del self.found[self.top :]
        if len(self.found) == self.top:
            self.least = max(self.least, self.found[-1][0])


def _score(segment: dict, matched: Matched, wanted: np.ndarray, best: list[Best]) -> None:
    """Score the documents of one segment for the wanted items, all at once."""
    postings, run_tf, n_docs = segment["postings"], segment["run_tf"], len(segment["doc_ids"])
    by_tf = points(np.arange(run_tf.max() + 1), segment["m"])
    gain = np.repeat(by_tf[run_tf], np.diff(np.append(segment["run_at"], len(postings))))
    number = np.full(len(best), -1)
    number[wanted] = np.arange(len(wanted))
    row = number[matched.item]
    row, factor, place = (x[row >= 0] for x in (row, matched.factor, matched.place))
    starts = np.cumsum(segment["df"], dtype=np.int64) - segment["df"]
    sizes = segment["df"][place].astype(np.int64)
    reach = np.cumsum(sizes)
    scores = np.zeros(len(wanted) * n_docs, dtype=np.int64)
    # Whole numbers below this are exact as doubles, which are added faster.
    small = int(matched.bound.max(initial=0)) < 1 << 53
    low = 0
    while low < len(place):
        high = int(np.searchsorted(reach, reach[low] - sizes[low] + _EXPAND, side="right"))
        high = max(high, low + 1)
        n = sizes[low:high]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(starts[place[low:high]], n) + inside
        cell = np.repeat(row[low:high] * n_docs, n) + postings[at]
        value = np.repeat(factor[low:high], n) * gain[at]
        if small:
            scores += np.bincount(cell, value, len(scores)).astype(np.int64)
        else:
            np.add.at(scores, cell, value)
        low = high
    table = scores.reshape(len(wanted), n_docs)
    reached = table.max(axis=1) >= [best[k].least for k in wanted.tolist()]
    for k in np.flatnonzero(reached).tolist():
        best[wanted[k]].offer(table[k], segment["doc_ids"])


def _segments(batch: pa.RecordBatch) -> list[dict]:
    """Rows of a batch; lists as arrays, numbers as numpy arrays."""
    made = []
    for k in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns):
            if not pa.types.is_list(column.type):
                row[name] = column[k].as_py()
            elif name in ("terms", "doc_ids"):
                row[name] = column[k].values
            else:
                row[name] = column[k].values.to_numpy()
        made.append(row)
    return made


def _frequencies(index: Index, items: Items) -> np.ndarray:
    """Documents that hold each term of a block."""
    shared = index.segments.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        total = np.zeros(len(items.vocabulary), dtype=np.int64)
        for batch in batches:
            for segment in _segments(batch):
                place = _places(items, segment["terms"])
                total[place >= 0] += segment["df"][place[place >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counted = index.segments.select("terms", "df").mapInArrow(count, "term long, df long")
    df = np.zeros(len(items.vocabulary), dtype=np.int64)
    # One number for each term of the block.
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


def _promising(segments: DataFrame, shared, visits: int) -> DataFrame:
    """``segment`` and ``for_items``: the segments of greatest bound of each item."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, _ = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([_match(items, s).bound for s in _segments(batch)])
            best = np.argsort(-table, axis=0, kind="stable")[:visits]
            bound = np.take_along_axis(table, best, axis=0).ravel()
            item = np.broadcast_to(np.arange(len(items.ids)), best.shape).ravel()
            some = bound > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item[some].astype(np.int32)),
                    pa.array(bound[some]),
                    batch.column("segment").take(pa.array(best.ravel()[some])),
                ],
                names=["item", "bound", "segment"],
            )

    columns = segments.select("segment", "m", "terms", "max_tf")
    found = columns.mapInArrow(bounds, "item int, bound long, segment long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "segment")
    best = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= visits)
    return best.groupBy("segment").agg(F.collect_list("item").alias("for_items"))


def _visit(segments: DataFrame, shared, top: int) -> DataFrame:
    """``item``, ``score``, ``doc_id``: the best of each task.

    Segments that have ``for_items`` are scored for these alone.
    """
    doc_type = segments.schema["doc_ids"].dataType.elementType
    arrow_type = to_arrow_type(doc_type)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = shared.value
        best = [Best(top, x) for x in least]
        for batch in batches:
            ready = []
            for segment in _segments(batch):
                matched = _match(items, segment)
                if "for_items" in segment:
                    only = np.zeros_like(matched.bound)
                    only[segment["for_items"]] = matched.bound[segment["for_items"]]
                    matched = matched._replace(bound=only)
                ready.append((matched, segment))
            # High bounds first: they raise the scores that later ones must reach.
            ready.sort(key=lambda x: -int(x[0].bound.max(initial=0)))
            for matched, segment in ready:
                wanted = np.flatnonzero(matched.bound >= [b.least for b in best])
                if len(wanted):
                    _score(segment, matched, wanted, best)
        rows = [(k, *found) for k, b in enumerate(best) for found in b.found]
        item, score, doc = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, arrow_type)],
            names=["item", "score", "doc_id"],
        )

    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("score", T.LongType()),
            T.StructField("doc_id", doc_type),
        ]
    )
    return segments.mapInArrow(visit, schema)


def _search_block(index: Index, rows: list[tuple], top: int, visits: int, id_type: T.DataType) -> DataFrame:
    spark = index.segments.sparkSession
    items = item_block(rows)
    items = items._replace(weight=weights(_frequencies(index, items), index.documents))
    share = spark.sparkContext.broadcast
    nothing = share((items, [0] * len(rows)))
    for_items = _promising(index.segments, nothing, visits)
    # At most ``visits`` rows for each item of the block.
    first = index.segments.join(F.broadcast(for_items), "segment").drop("segment")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.row_number().over(order).alias("rank")
    last = _visit(first, nothing, top).select("item", "score", rank).where(F.col("rank") == top)
    least = [0] * len(rows)
    for row in last.collect():
        least[row["item"]] = row["score"]
    found = _visit(index.segments.drop("segment"), share((items, least)), top)
    named = spark.createDataFrame(
        list(enumerate(items.ids)),
        T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]),
    )
    ranked = found.select("item", rank, "doc_id", "score").where(F.col("rank") <= top)
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(
    index: Index,
    items: DataFrame,
    *,
    item_id: str = "item_id",
    text: str = "text",
    top: int = TOP,
    visits: int = FIRST_VISITS,
    item_bytes: int = ITEM_BYTES,
    item_rows: int = ITEM_ROWS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``top`` documents of each item."""
    chosen = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    size = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    packs = max(1, -(-size[0] // item_rows), -(-size[1] // item_bytes))
    id_type = chosen.schema["item_id"].dataType
    found = None
    for pack in range(packs):
        mine = chosen
        if packs > 1:
            mine = chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(packs)) == pack)
        part = _search_block(index, [tuple(r) for r in mine.collect()], top, visits, id_type)
        if packs > 1:
            part = materialize(part, "ranked")
        found = part if found is None else found.unionByName(part)
    return found
