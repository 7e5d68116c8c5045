import hashlib
import random

import pytest

from ordermill.llm.decontaminate import find_benchmark, judged
from tests.llm.conftest import LONG, alnum_words


def brute(items, text, size=13):
    w = alnum_words(text)
    hit, found = set(), set()
    for item, said in items:
        s = alnum_words(said)
        for k in range(max(0, len(s) - size) + 1 if s else 0):
            window = s[k : k + size]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found |= {item} if item is not None else set()
    ids = sorted(map(str, found))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def results(docs, items, **options):
    found = judged(find_benchmark(docs, items, keep=["doc_id", "text"], **options))
    return [(r.row.doc_id, r.row.text, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()]


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "of", "a", "Cat", "dog", "é", "x1", "zu"])
    sentence = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(k, sentence(rng.choice([3, 12, 13, 14, 30]))) for k in range(12)]
    items += [(20, items[0][1]), (20, items[1][1]), (21, None), (22, ""), (None, sentence(13)), (23, "one")]
    texts = [sentence(rng.randint(0, 60)) for _ in range(60)]
    texts += [a + " " + said + " " + b for _, said in items if said for a, b in [(sentence(4), sentence(5))]]
    return items, texts


@pytest.mark.parametrize("pack_bytes", [1 << 20, 100])
def test_hits_equal_brute_force(spark, case, odd_docs, pack_bytes):
    items, texts = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    found = results(docs, benchmark, pack_bytes=pack_bytes)
    every = [*enumerate(texts), *map(tuple, odd_docs.select("doc_id", "text").collect())]
    assert sorted(found, key=repr) == sorted(((k, t, *brute(items, t)) for k, t in every), key=repr)


def test_kept_columns_may_have_any_name(odd_docs, no_docs, spark):
    benchmark = spark.createDataFrame([(1, LONG[:200])], "item_id long, text string")
    found = judged(find_benchmark(odd_docs, benchmark, keep=odd_docs.columns)).where("contaminated = false")
    assert found.select("row.*").dtypes == odd_docs.dtypes and found.count() == 9
    assert find_benchmark(no_docs, benchmark, keep=["doc_id"]).count() == 0
    assert {r[4] for r in results(odd_docs, benchmark.limit(0))} == {0}
