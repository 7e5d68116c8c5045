"""Byte-level BPE of whole texts by the tokenizers library, each piece once.

The vocabulary's own pattern splits texts before any merge, so ids of a text are
the ids of its pieces in order. Texts are cut only where that pattern always
cuts, whatever stands around: before white space that follows or precedes a
visible character, after white space other than a blank, and between a letter or
digit and ASCII punctuation. Equal pieces are encoded once and kept in a table of
fixed size. Texts that have the name of a special token keep it as plain text.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd

from ordermill.llm.text import Block, span_hashes

#: Lead byte of U+00C0 to U+00FF: letters, but for the signs at 0x97 and 0xB7.
_LATIN = 0xC3
# Classes of bytes, as bits: white space, white space that is no blank, visible
# ASCII, letters and digits, punctuation, the lead byte above, the two signs.
_WS, _BREAKING, _GRAPH, _ALNUM, _PUNCT, _LEAD, _SIGN = (1 << k for k in range(7))
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13]] = _WS | _BREAKING
_CLASS[32] = _WS
_CLASS[33:127] = _GRAPH | _PUNCT
for _first, _stop in ((48, 58), (65, 91), (97, 123)):
    _CLASS[_first:_stop] = _GRAPH | _ALNUM
_CLASS[_LATIN] = _LEAD
_CLASS[[0x97, 0xB7]] = _SIGN

SLOTS = 1 << 21
POOL = 1 << 23
_JOIN = 1 << 15


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where a piece begins, among them the start of each row."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = _CLASS[data]
    before, here = kind[:-1], kind[1:]
    # The character that ends at each byte but the last: visible, letter or digit.
    seen = before & (_GRAPH | _ALNUM)
    tail = before[:-1] & _LEAD != 0
    seen[1:][tail] = _GRAPH | _ALNUM
    seen[1:][tail & (before[1:] & _SIGN != 0)] = _GRAPH
    visible = here & (_GRAPH | _LEAD) != 0
    cut = np.zeros(n, dtype=bool)
    cut[1:] = (
        ((here & _WS != 0) & (seen & _GRAPH != 0))
        | ((before & _BREAKING != 0) & visible)
        | ((here & _PUNCT != 0) & (seen & _ALNUM != 0))
    )
    rows = offsets[:-1]
    rows = rows[rows < n]
    joins = (before & _WS != 0) & visible
    joins[rows[rows > 0] - 1] = False  # the visible character is another row's
    cut[:-1] |= joins
    cut[rows] = True
    return np.flatnonzero(cut)


def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which pieces keep their ids when a line break stands before and after."""
    size = ends - starts
    first = data[starts]
    second = data[np.minimum(starts + 1, ends - 1)]
    first = np.where((first == 32) & (size > 1), second, first)
    last = data[ends - 1]
    before_last = data[np.maximum(ends - 2, starts)]
    lines = np.append(0, np.cumsum(data == 10))
    return (
        (_CLASS[first] & (_GRAPH | _LEAD) != 0)
        & ((_CLASS[last] & _GRAPH != 0) | ((size > 1) & (before_last == _LATIN)))
        & (lines[ends] == lines[starts])
    )


class Encoder:
    """Ids of whole blocks of texts."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.at = np.zeros(SLOTS, dtype=np.int32)
        self.size = np.zeros(SLOTS, dtype=np.int32)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.pool = np.zeros(POOL, dtype=np.uint16 if small else np.uint32)
        self.used = 0

    def _ids(self, pieces: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of pieces (in any order), where each piece's begin, and how many."""
        at = np.zeros(len(pieces), dtype=np.int64)
        size = np.zeros(len(pieces), dtype=np.int64)
        parts, used = [], 0
        rest = np.flatnonzero(~plain).tolist()
        together = np.flatnonzero(plain)
        for low in range(0, len(together), _JOIN):
            some = together[low : low + _JOIN]
            text = b"\n".join([pieces[k] for k in some.tolist()]).decode()
            encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(encoded[0].ids, dtype=np.uint32)
            ends = np.flatnonzero(ids == self.line) - np.arange(len(some) - 1)
            ids = ids[ids != self.line]
            ends = np.append(ends, len(ids))
            size[some] = np.diff(ends, prepend=0)
            at[some] = used + ends - size[some]
            parts.append(ids)
            used += len(ids)
        texts = [pieces[k].decode() for k in rest]
        for k, enc in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(enc.ids, dtype=np.uint32)
            at[k], size[k] = used, len(ids)
            parts.append(ids)
            used += len(ids)
        return np.concatenate(parts), at, size

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end (uint32), and where each row starts (rows + 1)."""
        data = block.data
        starts = piece_starts(data, block.offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(block.rows + 1, np.int64)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends) | np.uint64(1)
        slots = (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        known = self.keys[slots] == hashes
        at, size = self.at[slots].astype(np.int64), self.size[slots].astype(np.int64)
        pool = self.pool
        missing = np.flatnonzero(~known)
        if len(missing):
            codes, _ = pd.factorize(hashes[missing])
            _, first = np.unique(codes, return_index=True)
            which = missing[first]
            whole = data.tobytes()
            pieces = [whole[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())]
            ids, new_at, sizes = self._ids(pieces, _plain(data, starts[which], ends[which]))
            if self.used + len(ids) > POOL:
                self.keys[:] = 0
                self.used = 0
                pool = np.concatenate([self.pool, ids.astype(self.pool.dtype)])
                shift = POOL
            else:
                self.pool[self.used : self.used + len(ids)] = ids
                shift = self.used
                self.used += len(ids)
                where = slots[which]
                self.keys[where] = hashes[which]
                self.at[where] = shift + new_at
                self.size[where] = sizes
                # Of two new pieces in one slot the later is kept.
            at[missing] = shift + new_at[codes]
            size[missing] = sizes[codes]
        out_at = np.cumsum(size)
        index = np.repeat(at - (out_at - size), size) + np.arange(out_at[-1])
        row_piece = np.searchsorted(starts, block.offsets)
        return pool[index].astype(np.uint32), np.append(0, out_at)[row_piece]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)
