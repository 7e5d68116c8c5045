"""Fuzzy search for short licence notices.

A notice of length n may differ by k = n * ``error_rate`` edits. It is cut into
k + 1 pieces, of which any such occurrence holds one unchanged: these seeds are
found exactly, and only around them the regex library searches the notice with
at most k edits and tells its span. Phrases are found exactly, word by word.

Texts are searched whole, as lower-cased words joined by single blanks; edits
count bytes of that form. A null or empty text has no words and no labels.
Repeated rows are scanned each; only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases of the base labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the mozilla public license version 2 0": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under a creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
}
ERROR_RATE = 0.1
#: Notice lengths that are searched together.
PIECE = 3

_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


class Place(NamedTuple):
    """A notice found: words ``start`` to ``stop`` (exclusive) and its edits."""

    label: str
    start: int
    stop: int
    edits: int
    score: float
    text: str


class Notice:
    """A notice, its seeds with their offsets, and its bounded-error pattern."""

    def __init__(self, text: str, label: str, error_rate: float) -> None:
        self.label = label
        self.text = f" {text} ".encode()
        n = len(self.text)
        self.edits = max(1, int(n * error_rate))
        cuts = [n * k // (self.edits + 1) for k in range(self.edits + 2)]
        self.seeds = [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        bounded = b"(?:" + regex.escape(self.text) + b"){e<=%d}" % self.edits
        self.pattern = regex.compile(bounded, regex.BESTMATCH)

    def windows(self, text: bytes) -> list[tuple[int, int]]:
        """Where the notice may be, overlapping windows joined."""
        around = []
        for seed, offset in self.seeds:
            at = text.find(seed)
            while at >= 0:
                low = at - offset - self.edits
                around.append((max(0, low), min(len(text), low + len(self.text) + 2 * self.edits)))
                at = text.find(seed, at + 1)
        joined: list[tuple[int, int]] = []
        for low, high in sorted(around):
            if joined and low <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
            else:
                joined.append((low, high))
        return joined

    def unedited(self, text: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """Exact occurrences in a window; two of them may share the blank between."""
        found = []
        at = text.find(self.text, low, high)
        while at >= 0:
            found.append((0, at, at + len(self.text)))
            at = text.find(self.text, at + len(self.text) - 1, high)
        return found

    def edited(self, text: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """Edits and span of the best match of a piece, and of those before and behind it."""
        found = []
        pending = [(low, high)]
        while pending:
            low, high = pending.pop()
            if high - low < len(self.text) - self.edits:
                continue
            match = self.pattern.search(text, low, high)
            if match:
                start, stop = match.span()
                found.append((sum(match.fuzzy_counts), start, stop))
                # Two notices may share the blank between them.
                pending.append((low, start + (text[start] == 32)))
                pending.append((stop - (text[stop - 1] == 32), high))
        return found

    def matches(self, text: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """Matches of a window that do not overlap, better ones first, in text order.

        Between exact occurrences, pieces of ``PIECE`` notice lengths are searched,
        each reaching a whole notice into the next, so the time for a window follows
        its length.
        """
        exact = self.unedited(text, low, high)
        reach = len(self.text) + self.edits
        found = []
        for _, start, stop in [*exact, (0, high + 1, high)]:
            # The gap before this occurrence; its blanks may be shared.
            end = min(high, start + 1)
            while end - low >= len(self.text) - self.edits:
                found += self.edited(text, low, min(end, low + PIECE * reach))
                if low + PIECE * reach >= end:
                    break
                low += (PIECE - 1) * reach
            low = stop - 1
        chosen = exact
        taken = [(start, stop) for _, start, stop in exact]
        for edits, start, stop in sorted(set(found)):
            k = bisect_left(taken, (start, stop))
            left = k == 0 or self._apart(text, taken[k - 1], (start, stop))
            if left and (k == len(taken) or self._apart(text, (start, stop), taken[k])):
                taken.insert(k, (start, stop))
                chosen.append((edits, start, stop))
        return sorted(chosen, key=lambda m: m[1])

    @staticmethod
    def _apart(text: bytes, left: tuple[int, int], right: tuple[int, int]) -> bool:
        """Whether two spans overlap by no more than a blank."""
        return left[1] <= right[0] or (left[1] == right[0] + 1 and text[right[0]] == 32)

    def places(self, text: bytes, blanks: np.ndarray | None = None) -> Iterator[Place]:
        """Notices of a text; ``blanks`` are the places of its blanks."""
        if blanks is None:
            blanks = blank_places(text)
        for low, high in self.windows(text):
            for edits, start, stop in self.matches(text, low, high):
                said = text[start:stop].strip(b" ")
                start += text[start:stop].find(said)
                first, last = np.searchsorted(blanks, (start, start + len(said))).tolist()
                yield Place(
                    self.label,
                    first - 1,
                    last,
                    edits,
                    1 - edits / len(self.text),
                    said.decode(errors="replace"),
                )


def blank_places(text: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return (text or "").encode().translate(_NORMAL).split()


def phrase_places(text: bytes, phrase: bytes, blanks: np.ndarray) -> list[int]:
    """Numbers of the words at which a phrase starts."""
    places = []
    at = text.find(phrase)
    while at >= 0:
        places.append(at)
        at = text.find(phrase, at + 1)
    return np.searchsorted(blanks, places).tolist()


_SPAN = pa.struct(
    [
        ("label", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        ("edits", pa.int32()),
        ("score", pa.float64()),
        ("text", pa.string()),
    ]
)


def scan_licenses(
    df: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    error_rate: float = ERROR_RATE,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``bases`` (label, start) and ``spans`` of notices."""
    exact = [(f" {p} ".encode(), label) for p, label in phrases.items()]
    base = pa.struct([("label", pa.string()), ("start", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fuzzy = [Notice(p, label, error_rate) for p, label in notices.items()]
        for batch in batches:
            counts, bases, spans = [], [], []
            for cell in batch.column("text"):
                found = normal_words(cell.as_py())
                whole = b" " + b" ".join(found) + b" "
                blanks = blank_places(whole)
                counts.append(len(found))
                bases.append(
                    [{"label": b, "start": k} for p, b in exact for k in phrase_places(whole, p, blanks)]
                )
                spans.append([x._asdict() for notice in fuzzy for x in notice.places(whole, blanks)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, type=pa.int64()),
                    pa.array(bases, type=pa.list_(base)),
                    pa.array(spans, type=pa.list_(_SPAN)),
                ],
                names=["doc_id", "n_words", "bases", "spans"],
            )

    chosen = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        scan,
        f"doc_id {dict(chosen.dtypes)['doc_id']}, n_words long, "
        "bases array<struct<label:string,start:long>>, spans array<struct<label:string,"
        "start:long,stop:long,edits:int,score:double,text:string>>",
    )


def license_digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts, labels and the score of its best notice."""
    starts = F.transform("bases", lambda b: b["start"])
    base_labels = F.transform("bases", lambda b: b["label"])
    labels = F.concat(base_labels, F.transform("spans", lambda s: s["label"]))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("bases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("bases") > 0, 1.0).otherwise(best).alias("score"),
        "spans",
    )
