import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ordermill.llm.content_sort import content_groups
from tests.conftest import plan_of, rows

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(pairs, keep):
    """Groups of (id, text); of repeated rows of the id that stays only one does."""
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max(known) if keep == "largest" else min(known)) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = True
        for i in sorted(ids, key=lambda i: i != best):
            out.append((i, best, len(ids), stays, digest))
            stays = False
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_odd_documents(spark, odd_docs, keep):
    found = content_groups(odd_docs, keep=keep)
    pairs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert found.columns == COLUMNS and rows(found) == brute(pairs, keep)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_hot_groups_are_cut_into_pieces(spark, keep):
    """A third copies of one text, some of one id or of none; long texts that begin alike."""
    data = [(k, "hot") for k in range(150)] + [(149, "hot"), (0, "hot")] * 5
    data += [(7, "one id")] * 60 + [(None, "no id")] * 40
    data += [(k, "x" * 300 + str(k % 50)) for k in range(200, 400)]
    data += [(k, "y" * 5_000) for k in range(500, 520)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    for limits in ({"least_rows": 10}, {"least_bytes": 6_000}, {"least_rows": 1, "least_bytes": 1}):
        assert rows(content_groups(docs, keep=keep, **limits)) == brute(data, keep)


def test_other_columns_ids_and_normalised_texts(spark):
    data = [("b", " One  two "), ("a", "one two"), ("c", "ONE TWO"), ("d", None), ("e", "")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in data], "name string, body string, content string")

    def normalise(text):
        return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))

    found = content_groups(docs, doc_id="name", text="body", normalise=normalise, least_rows=1)
    plain = [(i, " ".join((t or "").lower().split())) for i, t in data]
    assert rows(found) == brute(plain, "smallest")
    assert rows(content_groups(docs, doc_id="name", text="body")) == brute(data, "smallest")


def test_empty_table_and_wrong_keep(spark, no_docs):
    assert content_groups(no_docs).count() == 0
    with pytest.raises(ValueError):
        content_groups(no_docs, keep="any")


def test_native_and_sorted_once(spark, odd_docs, monkeypatch):
    plans = []

    def noted(df, name):
        plans.append(plan_of(df))
        return df

    monkeypatch.setattr("ordermill.llm.content_sort.materialize", noted)
    monkeypatch.setattr("ordermill.llm.content_sort._hot_hashes", lambda c, *_: c.sparkSession.createDataFrame([], "hash long, pieces long"))
    content_groups(odd_docs)
    (plan,) = plans
    assert "Python" not in plan and "Arrow" not in plan
    # The texts are shuffled by range, and the window needs no other exchange.
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
