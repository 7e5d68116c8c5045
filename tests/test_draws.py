import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordermill.functions import (
    draw,
    keyed_id,
    random_id,
    reciprocal_choice,
    reciprocal_weights,
)
from tests.conftest import plan_of


def expected_draw(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_draw_is_the_hash_of_seed_tag_and_ids(spark):
    df = spark.range(50).select("id", draw(3, "n", F.col("id"), F.lit(2)).alias("d"))
    assert all(r.d == expected_draw(f"3:n:{r.id}:2") for r in df.collect())


def test_weights():
    assert reciprocal_weights(3) == [6, 3, 2]
    assert reciprocal_weights(5) == [60, 30, 20, 15, 12]


@pytest.mark.parametrize("n", [0, -1, 2.0, True, "3", None])
def test_choice_range_is_checked(n):
    with pytest.raises(ValueError):
        reciprocal_choice(F.lit(1), n)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 20])
def test_every_slot_goes_to_its_choice(spark, n):
    weights = reciprocal_weights(n)
    if sum(weights) > 1000:
        ends = [sum(weights[:k]) for k in range(1, n + 1)]
        slots = [(e - 1, k) for k, e in enumerate(ends, 1)]
        slots += [(e, k + 1) for k, e in enumerate(ends[:-1], 1)]
    else:
        slots = [(s, k) for s, k in enumerate(
            k for k, w in enumerate(weights, 1) for _ in range(w))]
    df = spark.createDataFrame(slots, "d bigint, k int")
    wrong = df.where(reciprocal_choice(F.col("d"), n) != F.col("k"))
    assert wrong.count() == 0


@pytest.mark.parametrize("n", [21, 30, 200])
def test_many_choices(spark, n):
    weights = reciprocal_weights(n)
    cuts = [2**60 * sum(weights[:k]) // sum(weights) for k in range(1, n)]
    slots = [(0, 1), (2**60 - 1, n)]
    slots += [(c - 1, k) for k, c in enumerate(cuts, 1)] + [(c, k + 1) for k, c in enumerate(cuts, 1)]
    df = spark.createDataFrame(slots, "d bigint, k int")
    assert df.where(reciprocal_choice(F.col("d"), n) != F.col("k")).count() == 0


def test_ids_of_different_parts_differ(spark):
    a, five = F.lit("a"), F.lit("5")
    row = spark.range(1).select(
        keyed_id("x", a, five), keyed_id("x", F.lit("a:5"), F.lit(None)), keyed_id("x", F.lit("a|1:5"))
    ).first()
    assert len(set(row)) == 3


def test_choice_follows_the_weights(spark):
    total = 20_000
    df = spark.range(total).select(draw(7, "n", F.col("id")).alias("d"))
    counts = Counter(r.k for r in df.select(reciprocal_choice(F.col("d"), 5).alias("k")).collect())
    for k, weight in enumerate([60, 30, 20, 15, 12], start=1):
        assert abs(counts[k] / total - weight / 137) < 0.02


def test_draws_do_not_depend_on_partitioning(spark):
    base = spark.range(1000)
    drawn = [
        sorted(map(tuple, base.repartition(n).select("id", draw(1, "x", F.col("id"))).collect()))
        for n in (1, 4, 200)
    ]
    assert drawn[0] == drawn[1] == drawn[2]


def test_choice_stays_in_the_jvm(spark):
    df = spark.range(10).select(reciprocal_choice(draw(1, "x", F.col("id")), 5))
    assert "Python" not in plan_of(df)


def test_ids(spark):
    row = spark.range(1).select(
        keyed_id("ord-", F.lit("order"), F.col("id")).alias("keyed"),
        random_id("ev-").alias("random"),
    ).first()
    digest = hashlib.md5(b"5:order|1:0").hexdigest()
    parts = [digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:]]
    assert row.keyed == "ord-" + "-".join(parts)
    assert row.random.startswith("ev-") and len(row.random) == 39
