import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm.fill_in_middle import (
    _words,
    cut_lines,
    draws_of,
    fill_in_middle,
    inner_bytes,
    line_ends,
    restored,
)
from ordermill.llm.text import blocks
from tests.conftest import rows


def brute(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm_rate:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(deadline=None, max_examples=200)
@given(st.binary(max_size=80))
def test_marks(raw):
    data = np.frombuffer(raw, dtype=np.uint8)
    words = _words(data)
    for marks, is_marked in (
        (line_ends(words), data == 10),
        (inner_bytes(words), (data & 0xC0) == 0x80),
    ):
        at = np.flatnonzero(is_marked)
        assert marks.rank(np.arange(len(data) + 1)).tolist() == [int(is_marked[:k].sum()) for k in range(len(data) + 1)]
        assert marks.select(np.arange(len(at))).tolist() == at.tolist()


TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="ab\n\r é漢😀", max_size=40)), min_size=1, max_size=8
)


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.integers(16, 1 << 20))
def test_cuts(texts, limit):
    ids = list(range(len(texts)))
    for block in blocks(pa.array(texts, type=pa.string()), limit):
        draws = np.array([draws_of(i, "7")[:2] for i in ids[block.first : block.first + block.rows]], dtype=np.int64)
        cuts = cut_lines(block, draws)
        for k in range(block.rows):
            of = block.first + k
            _, n, form, p, m, _ = brute(of, texts[of])
            assert cuts.lines[k] == n
            if form != "plain":
                assert (cuts.prefix_chars[k], cuts.middle_chars[k]) == (p, m)


MORE = [
    (20, "one line"), (21, "\n"), (22, "\n\n\n"), (23, "a\nb\nc"), (24, "a\nb\nc\n"), (25, "é\n漢字\n😀 x\r\n"),
    (26, "has <S> inside\nit"), (27, "<P>"), (28, "ends with <\n<P\n<M"), (29, "line\n" * 5_000), (30, "x" * 700_000),
    (30, "x" * 700_000),
]


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (50, 0), (50, 100), (0, 50)])
def test_against_brute_force(spark, odd_docs, rate, spm_rate):
    docs = odd_docs.select("doc_id", "text", "n").unionAll(spark.createDataFrame([(*m, 1) for m in MORE], "doc_id long, text string, n long"))
    made = fill_in_middle(docs, salt="7", rate=rate, spm_rate=spm_rate)
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(made) == sorted((brute(*p, rate, spm_rate) for p in pairs), key=repr)
    back = made.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert rows(back) == sorted(((i, t or "") for i, t in pairs), key=repr)


def test_empty_table(spark, no_docs):
    assert fill_in_middle(no_docs, salt="7").count() == 0
