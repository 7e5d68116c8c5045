import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm.text import ALNUM, LOWER, NOT_BLANK, blocks, span_hashes, window_hashes, words
from ordermill.llm.tokens import Encoder, vocabulary
from tests.llm.conftest import alnum_words, lower

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_are_those_of_the_pattern(texts, limit):
    for table, expected in ((ALNUM, alnum_words), (NOT_BLANK, lambda t: lower(t).translate(
            dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" "))):
        found = []
        for block in blocks(pa.array(texts, pa.string()), limit):
            data = LOWER[block.data]
            w = words(block, data, table)
            for a, b in zip(w.first[:-1], w.first[1:]):
                found.append([data[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])])
        assert found == [[x for x in expected(t) if x] for t in texts]


def test_hashes_depend_on_the_words_and_their_order():
    rng = random.Random(1)
    vocabulary_ = ["to", "of", "a", "the"]
    seen, windows = {}, {}
    for _ in range(300):
        text = " ".join(rng.choice(vocabulary_) for _ in range(12))
        (block,) = blocks(pa.array([text]))
        w = words(block, block.data, NOT_BLANK)
        hashes = span_hashes(block.data, w.starts, w.ends)
        parts = text.split()
        for word, h in zip(parts, hashes.tolist()):
            assert seen.setdefault(word, h) == h
        for k, h in enumerate(window_hashes(hashes, 5).tolist()):
            assert windows.setdefault(h, parts[k : k + 5]) == parts[k : k + 5]
    assert len(set(seen.values())) == 4
    assert len({tuple(w) for w in windows.values()}) == len(windows)


@pytest.fixture(scope="module")
def bpe():
    return Encoder(vocabulary())


ALPHABET = "aé 's\n\t ,.'tll0× Çñ_\r re日<|>\u2028z"


def test_ids_are_those_of_the_library(bpe):
    rng = random.Random(3)
    odd = ["", None, "  lead", "trail  ", "it's I'll 'tis", "x\r\n\r\n y  z\n", "<|endoftext|> a", " ", "a" * 5000]
    for _ in range(40):
        texts = odd + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(40)]
        found = []
        for block in blocks(pa.array(texts, pa.string()), rng.choice([50, 1000, 10**6])):
            ids, at = bpe.encode(block)
            found += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert found == [bpe.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_full_pool_starts_again(bpe, monkeypatch):
    from ordermill.llm import tokens

    monkeypatch.setattr(tokens, "POOL", 300)
    small = Encoder(vocabulary())
    for n in range(60):
        text = " ".join(f"word{n}x{k}" for k in range(20))
        (block,) = blocks(pa.array([text]))
        assert small.encode(block)[0].tolist() == bpe.tokenizer.encode(text).ids
