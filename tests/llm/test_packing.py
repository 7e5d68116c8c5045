import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ordermill.llm.packing import B, K1, Rest, Shard, pack, pack_shard
from ordermill.llm.tokens import vocabulary


def check(pieces, docs, window, end_id=0):
    """Each document's ids lie in one piece each; sequences have no gaps and little padding."""
    library = Tokenizer.from_file(vocabulary())
    streams = [library.encode(t or "", add_special_tokens=False).ids + [end_id] for _, t in docs]
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for doc_id in {d for d, _ in docs}:
        mine = [s for (d, _), s in zip(docs, streams) if d == doc_id]
        packed = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id])
        assert sum(p[1] for p in packed) == sum(map(len, mine))
        if len(mine) == 1:
            at = 0
            for start, length, crc, total in packed:
                ids = mine[0][at : at + length]
                assert (start, total) == (at, len(mine[0]))
                assert crc == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
                at += length
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        short += at < window
    return short


@pytest.mark.parametrize("shard", [2, 7, 1000])
def test_pieces_cover_all_ids_once(spark, odd_docs, shard):
    words = ["the", "cat", "sat", "on", "mat", "dog", "Straße", "naïve"]
    rng = np.random.default_rng(0)
    docs = [(100 + k, " ".join(rng.choice(words, rng.integers(0, 90)))) for k in range(80)]
    docs += [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    pieces = pack(frame, vocabulary(), window=64, shard=shard).collect()
    short = check(pieces, docs, 64)
    assert short <= frame.rdd.getNumPartitions() + 8
    for p in pieces:
        assert len(p.ids) == 4 * p.length and zlib.crc32(bytes(p.ids)) == p.ids_crc32


def test_empty_table(spark, no_docs):
    assert pack(no_docs, vocabulary()).count() == 0


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    rests = [Rest(k, 0, rng.integers(0, 30, rng.integers(1, 40)), 0) for k in range(20)]
    idf, mean = rng.random(30), 17.0
    shard = Shard(rests, idf, mean)
    for seed in range(20):
        wanted = []
        for other in rests:
            tf = Counter(other.ids.tolist())
            norm = K1 * (1 - B + B * len(other.ids) / mean)
            wanted.append(sum(idf[t] * tf[t] * (K1 + 1) / (tf[t] + norm) for t in set(rests[seed].ids.tolist())))
        assert np.allclose(shard.scores(seed), wanted)


def test_the_nearest_unused_neighbours_fill_a_window():
    ids = [[1, 2, 3], [7, 8, 9], [1, 2, 4], [7, 8, 5], [1, 9, 9]]
    rests = [Rest(k, 0, np.array(x), 3) for k, x in enumerate(ids)]
    windows = list(pack_shard(rests, np.ones(10), 3.0, 6))
    assert [[p.doc_id for p in w] for w in windows] == [[0, 2], [1, 3], [4]]
    cut = list(pack_shard(rests, np.ones(10), 3.0, 5))
    assert [(p.doc_id, p.start, len(p.ids)) for p in cut[0]] == [(0, 0, 3), (2, 0, 2)]
    assert (cut[1][0].doc_id, cut[1][0].start) == (2, 2)


def test_copies_far_apart_share_a_window(spark):
    rng = np.random.default_rng(3)
    rare = [f"{a}{b}" for a in ("zor", "quil", "vex", "bram", "tol", "wug") for b in range(100, 900)]
    texts = [" ".join(["the of and to in", *rng.choice(rare, 3)]) for _ in range(1000)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(5000 + 7 * k, texts[7 * k]) for k in range(100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    windows = defaultdict(set)
    for p in pack(frame, vocabulary(), window=64, shard=32).collect():
        windows[p.doc_id].add(p.sequence_id)
    assert sum(bool(windows[7 * k] & windows[5000 + 7 * k]) for k in range(100)) >= 90


def test_ids_of_any_type(spark):
    docs = spark.sql("select cast(id as decimal(20,0)) as doc_id, concat('some text ', id) as text from range(9)")
    pieces = pack(docs, vocabulary(), window=16)
    assert dict(pieces.dtypes)["doc_id"] == "decimal(20,0)"
    assert sorted(int(p.doc_id) for p in pieces.where("start = 0").collect()) == list(range(9))
