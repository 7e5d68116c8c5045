import statistics

import pytest
from pyspark.sql import functions as F

from ordermill.operators import hot_join, hot_keys, skew
from tests.conftest import rows


@pytest.fixture
def plain_planner(spark):
    """No help from adaptive execution or small broadcasts."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows on one key, a tenth on none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 10 != 1, n % 997)
    left = spark.range(30_000, numPartitions=8).select(key.alias("k"), n.alias("a"))
    right = spark.range(900).select(n.alias("k"), (n * 3).alias("b"))
    return left, right


def test_hot_keys_are_named(spark, sides):
    assert hot_keys(sides[0], "k") == [7]
    assert hot_keys(sides[0], "k", most=2) == []
    assert hot_keys(sides[0].where("k is null"), "k") == [] and hot_keys(sides[0].limit(0), "k") == []
    texts = sides[0].select(F.concat(F.lit("key "), "k").alias("a b"))
    assert hot_keys(texts, "a b") == ["key 7"]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [1_000_000, -1], ids=["broadcast", "salted"])
def test_the_rows_of_a_plain_join(spark, sides, plain_planner, monkeypatch, how, limit):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: limit > 0)
    left, right = sides
    twice = right.unionAll(right.where("k = 7")).unionAll(right.where("k = 8"))
    for other in (right, twice, right.where("k <> 7")):
        assert rows(hot_join(left, other, "k", how)) == rows(left.join(other, "k", how))
    with pytest.raises(ValueError):
        hot_join(left, right, "k", "full")


def test_no_task_holds_the_hot_key(spark, sides, plain_planner):
    left, right = sides

    def sizes(df):
        counted = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted(r["count"] for r in counted)

    plain, split = sizes(left.join(right, "k", "left")), sizes(hot_join(left, right, "k"))
    assert max(plain) > 5 * statistics.median(plain)
    assert max(split) <= 2 * statistics.median(split) and sum(split) == sum(plain)
