import random
from itertools import combinations

import numpy as np
import pytest

from ordermill.llm import shingle_join
from ordermill.llm.components import components
from ordermill.llm.shingle_join import bitmap, fingerprint, jaccard_components, one_of_each, prefix, tree_pairs
from tests.conftest import rows
from tests.llm.conftest import shingles


def brute(docs):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return sorted(((d, len(s), least.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["new"], ["x", words[at]]])
        yield " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("the of a cat dog sat on mat ran".split()) + str(rng.randint(0, 9)) for _ in range(n))
    passage = text(60)
    docs = []
    for n in (3, 5, 8, 40, 150, 400):
        docs += near_copies(rng, text(n), 12, max(1, n // 60))
    docs += [text(rng.randint(20, 80)) + " " + passage + " " + text(rng.randint(0, 60)) for _ in range(40)]
    docs += [passage] * 5 + ["word " * 30, "word " * 31, "One", "one"]
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, cell", [(1, 1 << 20), (2, 200)])
def test_components_equal_all_pairs(spark, monkeypatch, odd_docs, seed, cell):
    """A small cell cuts every group into many parts."""
    monkeypatch.setattr(shingle_join, "CELL", cell)
    docs = corpus(seed) + [(d and d + 10_000, t) for d, t in map(tuple, odd_docs.select("doc_id", "text").collect())]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, node long, copy long")
    assert rows(jaccard_components(frame)) == brute(docs)


def test_one_of_each(spark, odd_docs, no_docs):
    kept = one_of_each(odd_docs)
    assert kept.dtypes == odd_docs.dtypes
    assert rows(kept, "doc_id") == sorted([(1,), (2,), (3,), (4,), (5,), (7,)], key=repr)
    nameless = one_of_each(odd_docs.where("doc_id is null"))
    assert nameless.count() == 1
    assert one_of_each(no_docs).count() == 0 and jaccard_components(no_docs).count() == 0


def test_a_null_id_belongs_to_the_group(odd_docs):
    found = {r for r in rows(jaccard_components(odd_docs)) if r[0] in (None, 7)}
    assert found == {(None, 3, 7), (7, 3, 7)}


def random_sets(rng, n):
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for _ in range(n):
        size = int(rng.integers(1, 200))
        start = int(rng.integers(0, 30))
        own = rng.integers(0, 1 << 63, int(rng.integers(0, 1 + size // 6)), dtype=np.uint64)
        yield np.unique(np.concatenate([base[start : start + size], own]))


def linked(a, b):
    common = len(np.intersect1d(a, b))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def test_trees_lose_no_link():
    rng = np.random.default_rng(0)
    for cells in (1, 3):
        sets = list(random_sets(rng, 120))
        cell = np.sort(rng.integers(0, cells, 120))
        width = 1 << 9
        bits = np.zeros((120, width // 64), dtype=np.uint64)
        for k, s in enumerate(sets):
            for bit in (s & np.uint64(width - 1)).tolist():
                bits[k, bit >> 6] |= np.uint64(1 << (bit & 63))
        found = set()
        for i, j in tree_pairs(bits, np.array([len(s) for s in sets]), cell):
            pairs = set(zip(i.tolist(), j.tolist()))
            assert not pairs & found
            found |= pairs
        wanted = {(a, b) for a, b in combinations(range(120), 2) if cell[a] == cell[b] and linked(sets[a], sets[b])}
        assert wanted and wanted <= found
        assert all(cell[a] == cell[b] and a < b for a, b in found)
        assert len(found) < 120 * 119 / 2 / cells


def test_linked_sets_share_a_shingle_of_their_beginnings():
    rng = np.random.default_rng(4)
    common = rng.random(1 << 22) < 0.5
    for a, b in combinations(list(random_sets(rng, 60)), 2):
        if linked(a, b):
            assert len(np.intersect1d(prefix(a, common), prefix(b, common)))
    assert len(bitmap(np.arange(100, dtype=np.uint64))) == 32
    assert fingerprint(np.array([1, 2], np.uint64)) != fingerprint(np.array([3], np.uint64))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (70, 71), (71, 70)]
    found = rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "root")
    wanted = [(k, 0) for k in range(61)] + [(k, 1000) for k in range(1000, 1300)] + [(70, 70), (71, 70)]
    assert sorted(found) == sorted(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
