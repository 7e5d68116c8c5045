"""Exact n-gram Jaccard join with signature trees.

A document is the set of hashes of its shingles. Sets that are equal are one node.
Two nodes link when 100 * common >= 80 * all of their shingles.

Which nodes can meet: in any one order of shingles, linked sets share one of their
first n - ceil(0.8 n) + 1. The order is by hash, but shingles that a sample of the
documents shows often come last, so common passages seldom bring nodes together.
All nodes that share such a shingle form a group, named by its least node; groups
with the same name are one.

Who is compared in a group: nodes have bitmaps, a bit for each shingle hash, in
widths that follow the set's size. A tree over the group's bitmaps keeps in each
inner node the OR of the bitmaps below and the range of sizes. It is traversed
against itself, level by level: a pair of nodes is left when the sizes differ too
much, or when the bits in common, and what several shingles on one bit can hide,
do not reach the least overlap. What is left at the leaves is first only marked;
then the sets of marked nodes are made from their texts, the trees are traversed
once more, and pairs are compared shingle by shingle unless links join them
already. Groups over ``CELL`` shingles are cut into parts, and each pair of parts
is a cell, so a cell has a bound. Links are contracted to components.

A null or empty text has no shingles and is linked with nothing; with fewer words
than a shingle has, all of them are one. Copies and repeated rows share a
component. Rows without an id take part; a component's id is its least id that is
not null. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import components
from ordermill.llm.text import LOWER, NOT_BLANK, blocks, mix, span_hashes, window_hashes, words
from ordermill.scratch import materialize

SHINGLE = 5
#: Links: ``NEED[0] * common >= NEED[1] * all``, as 4/5.
NEED = (5, 4)
#: Shingles of a part of a group; a cell has two parts.
CELL = 1 << 20
FAN = 16
#: One document in ``SAMPLE`` tells which shingles are common; only costs depend on it.
SAMPLE = 16
COMMON = 4
_COMMON_BITS = 22
_MARK_BITS = 24
_LEAST_WIDTH = 64
_PAIRS = 1 << 17
#: Bitmaps compared at a time, and rows of cells handled at a time.
_BITMAP_BYTES = 4 << 20
_ROW_BYTES = 8 << 20


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for block in blocks(column):
        data = LOWER[block.data]
        found = words(block, data, NOT_BLANK)
        hashes = span_hashes(data, found.starts, found.ends)
        every = window_hashes(hashes, size)
        for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
            n = high - low
            if n >= size:
                yield np.unique(every[low : high - size + 1])
            elif n:
                yield window_hashes(hashes[low:high], n)
            else:
                yield np.zeros(0, np.uint64)


def fingerprint(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    if not len(shingles):
        return 0
    total = np.array([mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    return int((mix(total) + mix(np.array([len(shingles)], np.uint64))).view(np.int64)[0])


def prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles, common ones last: any linked set shares one of them."""
    n = len(shingles)
    if not n:
        return shingles
    length = n + (-n * NEED[1] // NEED[0]) + 1
    slot = (shingles >> np.uint64(64 - _COMMON_BITS)).astype(np.int64)
    often = common[slot]
    rare = shingles[~often]
    if len(rare) >= length:
        return rare[:length]
    return np.concatenate([rare, shingles[often][: length - len(rare)]])


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A power of two of bits, at least two for each shingle."""
    width = max(_LEAST_WIDTH, 1 << max(0, 2 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common shingles that sets of sizes ``a`` and ``b`` need at least."""
    return -(-(a + b) * NEED[1] // (NEED[0] + NEED[1]))


def tree_pairs(
    bits: np.ndarray, size: np.ndarray, cell: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) of rows of one cell that the trees cannot rule out.

    ``bits`` has one bitmap (64-bit pieces) for each row; rows of a cell follow
    each other. Every cell has a tree of its own; all are traversed together.
    """
    levels = []
    excess = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    low, high, owner, first = size, size, cell, np.arange(len(size))
    count = np.ones(len(size), dtype=np.int64)
    while True:
        levels.append((bits, low, high, excess, first, count))
        start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        if len(start) == len(owner):
            break
        inside = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
        first = np.flatnonzero(inside % FAN == 0)
        count = np.diff(np.append(first, len(owner)))
        bits = np.bitwise_or.reduceat(bits, first, axis=0)
        low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        excess, owner = np.maximum.reduceat(excess, first), owner[first]

    def kept(level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits, low, high, excess, _, _ = levels[level]
        near = (NEED[0] * high[i] >= NEED[1] * low[j]) & (NEED[0] * high[j] >= NEED[1] * low[i])
        i, j = i[near], j[near]
        common = np.empty(len(i), dtype=np.int64)
        step = max(1, _BITMAP_BYTES // (8 * bits.shape[1]))
        for at in range(0, len(i), step):
            both = bits[i[at : at + step]] & bits[j[at : at + step]]
            common[at : at + step] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        most = np.minimum(common + np.minimum(excess[i], excess[j]), np.minimum(high[i], high[j]))
        enough = most >= least_overlap(low[i], low[j])
        return i[enough], j[enough]

    def below(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of children, in pieces."""
        _, _, _, _, first, count = levels[level]
        total = count[i] * count[j]
        done = 0
        reach = np.cumsum(total)
        while done < len(i):
            base = reach[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(reach, base + _PAIRS, side="right")))
            a, b, n = i[done:stop], j[done:stop], total[done:stop]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(count[b], n)
            left = np.repeat(first[a], n) + inside // wide
            right = np.repeat(first[b], n) + inside % wide
            yield left, right
            done = stop

    def descend(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(i):
            return
        if level == 0:
            real = i < j
            i, j = kept(0, i[real], j[real])
            if len(i):
                yield i, j
            return
        i, j = kept(level, i, j)
        for left, right in below(level, i, j):
            ordered = left <= right
            yield from descend(level - 1, left[ordered], right[ordered])

    roots = np.arange(len(levels[-1][1]))
    yield from descend(len(levels) - 1, roots, roots)


def _folded(raw: bytes, width: int) -> np.ndarray:
    """A bitmap folded to ``width`` bits."""
    bits = np.frombuffer(raw, dtype="<u8")
    return np.bitwise_or.reduce(bits.reshape(-1, width // 64), axis=0)


def _cells(
    batches: Iterator[pa.RecordBatch], handle: Callable[[pa.Table], pa.RecordBatch | None], rows: int
) -> Iterator[pa.RecordBatch]:
    """Hand over whole cells, several together; the rows come sorted by cell."""
    waiting: list[pa.RecordBatch] = []
    n = size = 0

    def ready(table: pa.Table) -> Iterator[pa.RecordBatch]:
        out = handle(table)
        if out is not None and out.num_rows:
            yield out

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        n += batch.num_rows
        size += batch.nbytes
        if n >= rows or size >= _ROW_BYTES:
            table = pa.Table.from_batches(waiting)
            cell = table.column("cell").to_numpy()
            others = np.flatnonzero(cell != cell[-1])
            last = int(others[-1]) + 1 if len(others) else 0
            if last:
                yield from ready(table.slice(0, last))
                waiting = table.slice(last).combine_chunks().to_batches()
                n = table.num_rows - last
                size = sum(b.nbytes for b in waiting)
    if waiting:
        yield from ready(pa.Table.from_batches(waiting))


def _by_width(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of one bitmap width: their positions, bitmaps, sizes and cells."""
    width = table.column("width").to_numpy()
    cell = table.column("cell").to_numpy()
    size = table.column("n").to_numpy().astype(np.int64)
    raw = table.column("bits")
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        # Close sizes and like beginnings are neighbours in the tree.
        bits = np.stack([_folded(raw[int(k)].as_py(), w) for k in at])
        lead = bits[:, 0]
        order = np.lexsort((lead, size[at], cell[at]))
        at, bits = at[order], bits[order]
        yield at, bits, size[at], cell[at]


def _mark(table: pa.Table) -> pa.RecordBatch:
    """(leader, node) of the rows with a partner that the trees leave."""
    marked = np.zeros(table.num_rows, dtype=bool)
    for at, bits, size, cell in _by_width(table):
        for i, j in tree_pairs(bits, size, cell):
            marked[at[i]] = True
            marked[at[j]] = True
    chosen = table.select(["leader", "node"]).filter(pa.array(marked)).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in chosen.columns],
        names=["leader", "node"],
    )


def _link(table: pa.Table) -> pa.RecordBatch:
    """Exact links of the rows' sets, as edges to the least node of each part."""
    node = table.column("node").to_numpy()
    raw = table.column("shingles")
    sets = [np.frombuffer(raw[k].as_py(), dtype="<u8") for k in range(table.num_rows)]
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.zeros(int(flat.max()) + 1 if len(flat) else 1, dtype=bool)
    names, label = np.unique(node, return_inverse=True)
    root = np.arange(len(names))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return int(k)

    for at, bits, size, cell in _by_width(table):
        for i, j in tree_pairs(bits, size, cell):
            i, j = at[i], at[j]
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            edge = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
            for low, high in zip(edge.tolist(), [*edge[1:].tolist(), len(i)]):
                one = int(i[low])
                mine = find(label[one])
                others = [k for k in j[low:high].tolist() if find(label[k]) != mine]
                if not others:
                    continue
                own = flat[starts[one] : starts[one] + lengths[one]]
                seen[own] = True
                many = lengths[others]
                reach = np.cumsum(many)
                index = np.repeat(starts[others] - (reach - many), many) + np.arange(reach[-1])
                common = np.add.reduceat(seen[flat[index]].astype(np.int64), reach - many)
                seen[own] = False
                union = lengths[one] + many - common
                for k in np.flatnonzero(NEED[0] * common >= NEED[1] * union).tolist():
                    a, b = find(label[one]), find(label[others[k]])
                    root[max(a, b)] = min(a, b)
    final = np.array([find(k) for k in range(len(names))], dtype=np.int64)
    moved = np.flatnonzero(final != np.arange(len(names)))
    return pa.RecordBatch.from_arrays(
        [pa.array(names[moved]), pa.array(names[final[moved]])], names=["a", "b"]
    )


def _in_cells(members: DataFrame, described: DataFrame, narrow: DataFrame) -> DataFrame:
    """Groups' rows with ``described`` columns, copied to cells and widths and sorted.

    ``narrow`` has the nodes' sizes.
    """
    sizes = members.join(narrow.select("node", "n"), "node").groupBy("leader")
    counts = sizes.agg(F.ceil(F.sum("n") / CELL).cast("int").alias("parts"))
    rows = members.join(counts.where("parts > 1"), "leader", "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1))).join(described, "node")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    # Also with bitmaps of half the width, where a set a fifth smaller has those.
    widest = F.octet_length("bits") * 8
    both = (widest > _LEAST_WIDTH) & (4 * NEED[1] * F.col("n") <= NEED[0] * widest)
    widths = F.when(both, F.array(widest, F.shiftright(widest, 1))).otherwise(F.array(widest))
    rows = rows.withColumn("width", F.explode(widths))
    cell = F.xxhash64("leader", F.least("part", "other"), F.greatest("part", "other"), "width")
    rows = rows.withColumn("cell", cell).drop("parts", "part", "other")
    return rows.repartition("cell").sortWithinPartitions("cell")


def _common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """A table of fixed size: True where a common shingle may be."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"), size)]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat)], names=["h"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")
    often = (
        sample.mapInArrow(read, "h long").groupBy("h").count().where(F.col("count") >= COMMON)
    )
    slot = F.shiftrightunsigned("h", 64 - _COMMON_BITS)
    words_ = often.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - _COMMON_BITS}) & 63 as int))")).alias("bits")
    )
    return _bit_table(words_, _COMMON_BITS)


def _bit_table(words_: DataFrame, size: int) -> np.ndarray:
    """A bit table of fixed size from its words (at, bits) that are not zero."""
    table = np.zeros(1 << (size - 6), dtype=np.int64)
    for row in words_.collect():  # at most 2**(size - 6) rows
        table[row["at"]] = row["bits"]
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _described(docs: DataFrame, common: np.ndarray, size: int) -> DataFrame:
    """``doc_id``, ``copy``, ``n``, ``node``, ``prefix``, ``bits`` of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    kind = dict(docs.dtypes)["doc_id"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, prefixes, bits = [], [], [], []
            for shingles in shingle_sets(batch.column("text"), size):
                n.append(len(shingles))
                nodes.append(fingerprint(shingles))
                prefixes.append(prefix(shingles, shared.value).view(np.int64))
                bits.append(bitmap(shingles).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("copy"),
                    pa.array(n, type=pa.int64()),
                    pa.array(nodes, type=pa.int64()),
                    pa.array(prefixes, type=pa.list_(pa.int64())),
                    pa.array(bits, type=pa.binary()),
                ],
                names=["doc_id", "copy", "n", "node", "prefix", "bits"],
            )

    return docs.select("doc_id", "copy", "text").mapInArrow(
        describe, f"doc_id {kind}, copy long, n long, node long, prefix array<long>, bits binary"
    )


def _sets_of(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``node`` and ``shingles`` of chosen nodes (node, copy), from one copy's text.

    A bit table of fixed size tells most other texts apart where they are read;
    the join leaves the chosen ones.
    """
    slot = F.shiftrightunsigned("copy", 64 - _MARK_BITS)
    words_ = chosen.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(copy, {64 - _MARK_BITS}) & 63 as int))")).alias("bits")
    )
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(_bit_table(words_, _MARK_BITS)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            copy = batch.column("copy").to_numpy().view(np.uint64)
            at = (copy >> np.uint64(64 - _MARK_BITS)).astype(np.int64)
            wanted = (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            some = batch.filter(pa.array(wanted.astype(bool)))
            sets = [s.astype("<u8").tobytes() for s in shingle_sets(some.column("text"), size)]
            yield pa.RecordBatch.from_arrays(
                [some.column("copy"), pa.array(sets, type=pa.binary())], names=["copy", "shingles"]
            )

    sets = docs.select("copy", "text").mapInArrow(read, "copy long, shingles binary")
    return chosen.join(sets, "copy").dropDuplicates(["copy"]).select("node", "shingles")


def copy_hash(doc_id: str, text: str) -> Column:
    """Tells rows apart that are not repeated."""
    return F.xxhash64(f"`{doc_id}`", f"`{text}`")


def jaccard_rows(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``doc_id``, ``copy`` (``copy_hash``), ``n_shingles``, ``component_id`` and
    ``root``, one number for each component and null without shingles."""
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), copy_hash(doc_id, text).alias("copy")
    )
    common = _common_shingles(chosen, size)
    described = materialize(_described(chosen, common, size), "described")
    nodes = described.where("n > 0")

    rows = nodes.select("node", F.explode("prefix").alias("shingle"))
    leaders = rows.groupBy("shingle").agg(F.min("node").alias("leader"), F.max("node").alias("most"))
    leaders = leaders.where("leader < most").select("shingle", "leader")
    members = materialize(rows.join(leaders, "shingle").select("leader", "node").distinct(), "members")

    # One row for each node that is in a group: narrow, but for its bitmap.
    narrow = nodes.groupBy("node").agg(F.min("n").alias("n"), F.min("copy").alias("copy"))
    grouped = narrow.join(members.select("node").distinct(), "node", "left_semi")
    bitmaps = grouped.join(nodes.select("node", "copy", "bits"), ["node", "copy"])
    bitmaps = materialize(bitmaps.dropDuplicates(["node", "copy"]), "bitmaps")
    marked = _in_cells(members, bitmaps.drop("copy"), bitmaps).mapInArrow(
        lambda batches: _cells(batches, _mark, 8_192), "leader long, node long"
    )
    marked = materialize(marked.distinct(), "marked")

    needed = bitmaps.join(marked.select("node").distinct(), "node", "left_semi")
    needed = materialize(needed, "needed")
    sets = _sets_of(chosen, needed.select("node", "copy"), size)
    full = needed.drop("copy").join(sets, "node")
    edges = _in_cells(marked, full, needed).mapInArrow(
        lambda batches: _cells(batches, _link, 2_048), "a long, b long"
    )
    roots = components(edges)

    classes = nodes.groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(ids, "root").select("node", "root", "component_id"), "named")
    columns = ["doc_id", "copy", F.col("n").alias("n_shingles"), "component_id", "root"]
    linked = nodes.select("doc_id", "copy", "n", "node").join(named, "node")
    alone = described.where("n = 0").withColumns(
        {"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")}
    )
    return linked.select(*columns).unionByName(alone.select(*columns))


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each document."""
    return jaccard_rows(docs, **options).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, of least id (any id before none), and all
    documents without shingles. All columns of ``docs`` stay, whatever their names."""
    rows = materialize(jaccard_rows(docs, doc_id=doc_id, text=text), "linked")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copy"))
    chosen = rows.where("root is not null").groupBy("root").agg(first.alias("first"))
    kept = chosen.select(F.col("first.copy").alias("copy")).distinct()
    words_ = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    carried = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        copy_hash(doc_id, text).alias("copy"),
        words_.alias("words"),
    )
    one = carried.where("words").join(kept, "copy", "left_semi").dropDuplicates(["copy"])
    return one.unionByName(carried.where("not words")).select("row.*")
