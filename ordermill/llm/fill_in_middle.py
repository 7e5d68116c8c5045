"""Fill-in-the-middle: texts cut at line ends and put in another order.

Lines are found by arithmetic on 64-bit words: the UTF-8 bytes of many texts are
viewed as ``uint64``, the bytes that end a line are marked in every word at once,
``bitwise_count`` gives the marks of each word, and their running sum is searched
for the word that holds the k-th line end; the byte inside that word is found by
clearing lower marks. Code points are counted by the same marks and sums.

The cuts and the form depend on the document's id and the salt alone. A text that
is empty or holds one of the three markers stays plain. Defined results: a null
text is empty; a row without an id is drawn as if its id were an empty text;
repeated rows give equal results; an empty table gives no rows. Only the id and
text columns are read, whole texts of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.text import Block, blocks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FORMS = ("plain", "psm", "spm")

_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES = np.uint64(0x0101010101010101)
_ONE = np.uint64(1)


class Marks:
    """Marked bytes of a buffer: how many before a byte, and where the k-th is."""

    def __init__(self, marks: np.ndarray) -> None:
        """``marks``: words of which the top bit of each marked byte is set."""
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.marks, np.uint64(0))[word]
        below = inside & ((_ONE << (byte * np.uint64(8))) - _ONE)
        return self.before[word] + np.bitwise_count(below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th marked byte, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        rest = self.marks[word]
        skip = k - self.before[word]
        for step in range(7):
            rest = np.where(skip > step, rest & (rest - _ONE), rest)
        lowest = rest & (~rest + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3)


def _words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, zeros behind."""
    padded = np.zeros(-(-len(data) // 8) * 8, dtype=np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def line_ends(words: np.ndarray) -> Marks:
    """Marks of the bytes that are a line feed, exact in every byte."""
    other = words ^ (_ONES * np.uint64(10))
    return Marks(~(((other & _LOW) + _LOW) | other | _LOW))


def inner_bytes(words: np.ndarray) -> Marks:
    """Marks of bytes that go on a code point (10xxxxxx)."""
    return Marks(words & ~(words << _ONE) & ~_LOW)


class Cuts(NamedTuple):
    """Of each row: lines, byte positions of both cuts, code points of two parts."""

    lines: np.ndarray
    first: np.ndarray
    second: np.ndarray
    prefix_chars: np.ndarray
    middle_chars: np.ndarray


def cut_lines(block: Block, draws: np.ndarray) -> Cuts:
    """Cut each row behind two numbers of lines, drawn from 0 to all of them.

    ``draws`` has two numbers for each row; each counts modulo lines + 1.
    """
    words = _words(block.data)
    ends = line_ends(words)
    starts, stops = block.offsets[:-1], block.offsets[1:]
    before, until = ends.rank(starts), ends.rank(stops)
    feeds = until - before
    full = stops > starts
    open_end = np.zeros(block.rows, dtype=bool)
    open_end[full] = block.data[stops[full] - 1] != 10
    lines = feeds + open_end

    def position(units: np.ndarray) -> np.ndarray:
        at = np.where(units > feeds, stops, starts)
        fed = (units > 0) & (units <= feeds)
        at[fed] = ends.select(before[fed] + units[fed] - 1) + 1
        return at

    drawn = draws % (lines + 1)[:, None]
    first, second = position(drawn.min(axis=1)), position(drawn.max(axis=1))
    inner = inner_bytes(words)
    at_start, at_first, at_second = inner.rank(starts), inner.rank(first), inner.rank(second)
    return Cuts(
        lines,
        first,
        second,
        first - starts - (at_first - at_start),
        second - first - (at_second - at_first),
    )


def draws_of(doc_id, salt: str) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of an id."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{salt}:{name}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def fill_in_middle(
    docs: DataFrame,
    *,
    salt: str,
    doc_id: str = "doc_id",
    text: str = "text",
    rate: int = 100,
    spm_rate: int = 50,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``rate`` of a hundred texts are transformed, ``spm_rate`` of a hundred of these
    with the suffix first. ``n`` counts lines; the numbers of code points are null
    where the text stays plain.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(batch.column("text")):
                part = ids.slice(block.first, block.rows)
                draws = np.array([draws_of(i, salt) for i in part.to_pylist()], dtype=np.int64)
                cuts = cut_lines(block, draws[:, :2])
                forms, outputs = [], []
                places = zip(
                    block.offsets[:-1].tolist(), cuts.first.tolist(),
                    cuts.second.tolist(), block.offsets[1:].tolist(),
                )
                for (_, _, share, order), (start, first, second, stop) in zip(draws.tolist(), places):
                    whole = block.data[start:stop].tobytes()
                    marked = any(m in whole for m in (PREFIX, SUFFIX, MIDDLE))
                    if not whole or marked or share % 100 >= rate:
                        forms.append("plain")
                        outputs.append(whole)
                        continue
                    a, b = first - start, second - start
                    head, middle, tail = whole[:a], whole[a:b], whole[b:]
                    if order % 100 < spm_rate:
                        forms.append("spm")
                        parts = (SUFFIX, tail, PREFIX, head, MIDDLE, middle)
                    else:
                        forms.append("psm")
                        parts = (PREFIX, head, SUFFIX, tail, MIDDLE, middle)
                    outputs.append(b"".join(parts))
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [
                        part,
                        pa.array(cuts.lines),
                        pa.array(forms, type=pa.string()),
                        pa.array(cuts.prefix_chars, mask=plain),
                        pa.array(cuts.middle_chars, mask=plain),
                        pa.array(outputs, type=pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        transform,
        f"doc_id {dict(chosen.dtypes)['doc_id']}, n long, form string, "
        "prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form were made of."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
