import pytest
from pyspark.sql import functions as F

from ordermill.operators import fits_broadcast, lookup_by_key, lookup_join
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a third on null, copies among both."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, 3000, 1, 4).select(key.alias("key"), (F.col("id") % 2).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 2000).select(
        F.when(F.col("id") != 4, F.col("id")).alias("key"),
        F.concat(F.lit("name "), "id").alias("name"),
    )


@pytest.fixture
def settings(spark):
    """Changes settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = f"spark.sql.{name.replace('_', '.')}"
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("small", [True, False, None])
def test_join_equals_plain_join(facts, lookup, how, small):
    plain = facts.join(lookup.unionAll(lookup), ["key"], how)
    joined = lookup_join(facts, lookup.unionAll(lookup), ["key"], how, small=small)
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)


@pytest.mark.parametrize("scale", [1, 4])
def test_a_hot_key_is_split_however_large_the_table(spark, lookup, settings, scale):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive_advisoryPartitionSizeInBytes="8k",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="8k",
        adaptive_skewJoin_skewedPartitionFactor="1.5",
        shuffle_partitions="16",
    )
    n = 20_000 * scale
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id") % 2000)
    facts = spark.range(0, n, 1, 16).select(key.alias("key"), F.col("id").alias("v"))
    joined = lookup_join(facts, lookup, ["key"], "left", small=False)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n
    joined.collect()
    assert "skew=true" in plan_of(joined)


def test_broadcast_is_measured(spark, lookup):
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=1999)
    assert not fits_broadcast(lookup, max_bytes=1000)
    assert fits_broadcast(lookup.limit(0))


def test_null_fields_and_bytes_are_measured(spark):
    wide = spark.range(10).select(*[F.lit(None).cast("string").alias(f"column_{k}") for k in range(50)])
    assert not fits_broadcast(wide, max_bytes=5_000)
    two_bytes = spark.range(1).select(F.repeat(F.lit("é"), 1000).alias("x"))
    assert not fits_broadcast(two_bytes, max_bytes=2_000)


def test_small_lookup_does_not_shuffle_the_facts(facts, lookup):
    plan = plan_of(lookup_join(facts, lookup, ["key"], "left", small=True))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_other_join_kinds_are_refused(facts, lookup):
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["key"], "full")


def test_lookup_by_key_reaches_the_scan(spark, lookup, tmp_path):
    lookup.write.parquet(str(tmp_path / "t"))
    found = lookup_by_key(spark.read.parquet(str(tmp_path / "t")), "name", "name 7")
    assert "EqualTo(name,name 7)" in plan_of(found)
    assert rows(found) == [(7, "name 7")]
