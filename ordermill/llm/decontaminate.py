"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is ``size`` consecutive words of a benchmark item, or all of them if
it has fewer. Windows of one length are searched together: a table gives for
every block of two words how far the search may jump, blocks that end a window
lead to the bucket of the windows ending so, and these are compared word by word
and then byte by byte. All texts of a block are searched side by side, each lane
jumping by its own shift. The tables of a pack of items are arrays that are made
once, on the driver, and broadcast; a window is a place among the words of all items.

A null or empty text has no words and no hits. Repeated documents are searched
each; repeated items and windows count once. An item without an id marks words
as hit but is neither counted nor listed. An empty benchmark hits nothing. Only
the id and text columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.text import ALNUM, LOWER, blocks, mix, span_hashes, words
from ordermill.scratch import materialize

WINDOW = 13
#: Bytes of benchmark text in one broadcast; a larger benchmark takes several passes. A
#: word is two bytes or more with its separator, so this bounds the windows as well.
PACK_BYTES = 16 << 20
_TABLE = 1 << 16
_LANE = 512
_EXPAND = 1 << 20


class Words(NamedTuple):
    """Words of many items: numbers in a vocabulary, and where they stand in ``text``."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    symbols: np.ndarray
    first: np.ndarray
    vocabulary: pa.Array


def item_words(texts: list[str | None]) -> Words:
    """A-Z lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of items."""
    column = pa.array(texts, type=pa.large_string())
    none = np.zeros(0, dtype=np.int64)
    for block in blocks(column, 1 << 62):
        data = LOWER[block.data]
        found = words(block, data, ALNUM)
        at = np.append(0, np.cumsum(found.ends - found.starts))
        inside = pa.py_buffer(data[ALNUM[data]])
        every = pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(at), inside)
        coded = every.dictionary_encode()
        symbols = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        return Words(data, found.starts, found.ends, symbols, found.first, coded.dictionary)
    return Words(none, none, none, none.astype(np.int32), np.zeros(1, np.int64), pa.array([], pa.large_string()))


def _block_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) * 40503 + b.astype(np.int64) * 2654435761) & (_TABLE - 1)


class WindowGroup:
    """Different windows of one length with their shift table and suffix buckets.

    A window is where it begins among the words of all items; ``owners`` are numbers
    of items, those of window k from ``owned[k]`` to ``owned[k + 1]``.
    """

    def __init__(self, length: int, symbols: np.ndarray, begins: np.ndarray, items: np.ndarray) -> None:
        self.length = length
        self.block = min(2, length)
        # Equal windows become neighbours: by a hash, told apart by their words.
        hashes = np.zeros(len(begins), dtype=np.uint64)
        for k in range(length):
            hashes = mix(hashes + symbols[begins + k].astype(np.uint64))
        order = np.lexsort((items, hashes))
        begins, items, hashes = begins[order], items[order], hashes[order]
        new = np.append(True, hashes[1:] != hashes[:-1])
        for k in range(length):
            new[1:] |= symbols[begins[1:] + k] != symbols[begins[:-1] + k]
        self.begins = begins[new].astype(np.int32)
        # An item that repeats a window owns it once.
        first = new | np.append(True, items[1:] != items[:-1])
        self.owners = items[first].astype(np.int32)
        self.owned = np.append(np.flatnonzero(new[first]), len(self.owners)).astype(np.int32)
        widest = length - self.block + 1
        self.shift = np.full(_TABLE, widest, dtype=np.int32)
        # Later blocks allow smaller jumps, and overwrite.
        for end in range(self.block - 1, length):
            self.shift[self.slots(symbols, end)] = length - 1 - end
        last = self.slots(symbols, length - 1)
        self.order = np.argsort(last, kind="stable").astype(np.int32)
        self.bucket = np.searchsorted(last[self.order], np.arange(_TABLE + 1))

    def slots(self, symbols: np.ndarray, end: int) -> np.ndarray:
        here = symbols[self.begins + end]
        before = symbols[self.begins + end - 1] if self.block == 2 else np.zeros_like(here)
        return _block_slot(before, here)

    def slots_at(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        before = text[ends - 1] if self.block == 2 else np.zeros(len(ends), np.int32)
        return _block_slot(before, text[ends])

    def candidates(self, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Ends of windows that the shifts do not exclude."""
        m = self.length
        lows, highs = first[:-1] + m - 1, first[1:]
        some = highs > lows
        lows, highs = lows[some], highs[some]
        pieces = (highs - lows + _LANE - 1) // _LANE
        index = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(lows, pieces) + index * _LANE
        stop = np.minimum(at + _LANE, np.repeat(highs, pieces))
        found = []
        while len(at):
            jump = self.shift[self.slots_at(text, at)]
            # A word of no window lets the search jump past it.
            jump = np.where(text[at] == 0, m, jump)
            ends = at[jump == 0]
            if len(ends):
                found.append(ends)
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def matches(
        self, text: np.ndarray, first: np.ndarray, symbols: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(end of the window in the text, window number), word by word equal."""
        ends = self.candidates(text, first)
        slots = self.slots_at(text, ends) if len(ends) else ends
        sizes = self.bucket[slots + 1] - self.bucket[slots]
        low = 0
        reach = np.cumsum(sizes)
        while low < len(ends):
            done = reach[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(reach, done + _EXPAND, side="right")))
            n = sizes[low:high]
            at = np.repeat(ends[low:high], n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            which = self.order[np.repeat(self.bucket[slots[low:high]], n) + inside]
            for k in range(self.length):
                same = text[at - k] == symbols[self.begins[which] + (self.length - 1 - k)]
                at, which = at[same], which[same]
            if len(at):
                yield at, which
            low = high


class Matcher:
    """All windows of a pack of items, in arrays: made once and sent to the workers."""

    def __init__(self, items: list[tuple[object, str | None]], size: int = WINDOW) -> None:
        self.items = [None if i is None else str(i) for i, _ in items]
        found = item_words([text for _, text in items])
        self.text, self.symbols = found.text, found.symbols
        self.starts, self.ends = found.starts.astype(np.int32), found.ends.astype(np.int32)
        vocabulary = found.vocabulary
        at = np.frombuffer(vocabulary.buffers()[1], dtype=np.int64)[: len(vocabulary) + 1] if len(vocabulary) else np.zeros(1, np.int64)
        data = np.frombuffer(vocabulary.buffers()[2], dtype=np.uint8) if len(vocabulary) else np.zeros(0, np.uint8)
        hashes = span_hashes(data, at[:-1], at[1:]) if len(data) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.numbers = (order + 1).astype(np.int32)
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        n_words = np.diff(found.first)
        n_windows = np.where(n_words > 0, np.maximum(n_words - size, 0) + 1, 0)
        item = np.repeat(np.arange(len(items)), n_windows)
        begins = np.repeat(found.first[:-1], n_windows) + (
            np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        )
        length = np.minimum(n_words, size)[item]
        self.groups = [
            WindowGroup(int(m), self.symbols, begins[length == m], item[length == m])
            for m in np.unique(length)
        ]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Words as vocabulary numbers, 0 for words of no window."""
        text = np.zeros(len(hashes), dtype=np.int32)
        if not len(self.hashes):
            return text
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[at] == hashes[maybe]
        text[maybe[same]] = self.numbers[at[same]]
        return text

    def search(self, block) -> tuple[np.ndarray, dict[int, list], dict[int, set]]:
        """Of a block: words by row, hit spans and items of rows that have any."""
        data = LOWER[block.data]
        found = words(block, data, ALNUM)
        n_words = np.diff(found.first)
        text = self.numbered(span_hashes(data, found.starts, found.ends))
        spans: dict[int, list] = defaultdict(list)
        items: dict[int, set] = defaultdict(set)
        for group in self.groups:
            for ends, which in group.matches(text, found.first, self.symbols):
                rows = np.searchsorted(found.first, ends, side="right") - 1
                for end, k, row in zip(ends.tolist(), which.tolist(), rows.tolist()):
                    start, begin = end - group.length + 1, int(group.begins[k])
                    if all(
                        data[a:b].tobytes() == self.text[c:d].tobytes()
                        for a, b, c, d in zip(
                            found.starts[start : end + 1], found.ends[start : end + 1],
                            self.starts[begin : begin + group.length],
                            self.ends[begin : begin + group.length],
                        )
                    ):
                        base = int(found.first[row])
                        spans[row].append((start - base, end - base + 1))
                        owners = group.owners[group.owned[k] : group.owned[k + 1]]
                        items[row].update(owners.tolist())
        named = {row: {self.items[k] for k in own} - {None} for row, own in items.items()}
        return n_words, spans, named


def merged(spans: list) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _pass(df: DataFrame, items: list, size: int, keep_text: bool) -> DataFrame:
    """Adds the spans and items of one pack to those found before."""
    shared = df.sparkSession.sparkContext.broadcast(Matcher(items, size))
    schema = T.StructType([df.schema["row"], *[df.schema["text"]] * keep_text, *_FOUND])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first, block.rows)
                n_words, spans, found = matcher.search(block)
                old_spans = part.column("spans").to_pylist()
                old_items = part.column("items").to_pylist()
                for row in range(block.rows):
                    if row in spans or old_spans[row]:
                        known = [(s["start"], s["stop"]) for s in old_spans[row]]
                        old_spans[row] = [
                            {"start": a, "stop": b} for a, b in merged(known + spans.get(row, []))
                        ]
                        old_items[row] = sorted({*old_items[row], *found.get(row, ())})
                yield pa.RecordBatch.from_arrays(
                    [part.column("row")]
                    + [part.column("text")] * keep_text
                    + [
                        pa.array(n_words, type=pa.int64()),
                        pa.array(old_spans, type=_SPANS),
                        pa.array(old_items, type=pa.list_(pa.string())),
                    ],
                    names=["row", *["text"] * keep_text, "n_words", "spans", "items"],
                )

    return df.mapInArrow(scan, schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = WINDOW,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    pack_bytes: int = PACK_BYTES,
) -> DataFrame:
    """``row`` (the columns of ``keep``), ``n_words``, ``spans`` (of words inside any
    window) and ``items``. The struct lets kept columns have any name.

    Documents are read once for each ``pack_bytes`` of benchmark text and never
    shuffled.
    """
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = max(1, -(-total // pack_bytes))
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(text).alias("text"),
        F.array().cast("array<struct<start:long,stop:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for pack in range(packs):
        mine = items
        if packs > 1:
            mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(packs)) == pack)
        last = pack == packs - 1
        found = _pass(found, [tuple(r) for r in mine.collect()], size, not last)
        if not last:
            found = materialize(found)
    return found


def judged(found: DataFrame) -> DataFrame:
    """``row``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]
    )
    return found.select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
