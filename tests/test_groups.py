import pytest
from pyspark.sql import functions as F

from ordermill.operators import number_parts, one_per_key
from ordermill.operators import groups
from ordermill.operators.groups import collect_entries
from tests.conftest import rows


@pytest.fixture(scope="module")
def grouped(spark):
    """Key a: 5000 positions of weight 1 to 3; key b: ten rows at one position."""
    long = spark.range(5000).select(
        F.lit("a").alias("key"), F.col("id").cast("int").alias("pos"), (1 + F.col("id") % 3).alias("w"),
        F.lit("x").alias("name"),
    )
    same = spark.range(10).select(
        F.lit("b").alias("key"), F.lit(7).alias("pos"), F.lit(2).cast("bigint").alias("w"),
        F.concat(F.lit("n"), "id").alias("name"),
    )
    return long.unionAll(same)


@pytest.mark.parametrize("limit", [1, 4, 100, 10**6])
@pytest.mark.parametrize("partitions", [1, 7])
def test_parts_are_consecutive_runs_of_bounded_weight(grouped, limit, partitions):
    numbered = number_parts(grouped.repartition(partitions), "key", "pos", ["name"], F.col("w"), limit)
    assert numbered.columns == [*grouped.columns, "part"]
    for key in ("a", "b"):
        found = sorted((r.pos, r.name, r.w, r.part) for r in numbered.where(F.col("key") == key).collect())
        before = 0
        for _, _, weight, part in found:
            assert part == before // limit
            before += weight


def test_a_group_is_numbered_in_many_runs(grouped):
    runs = grouped.where("key = 'a'").select(F.expr(f"pos div {groups.RUN}").alias("r")).distinct()
    assert runs.count() == 5


def test_limit_is_checked(grouped):
    with pytest.raises(ValueError):
        number_parts(grouped, "key", "pos", ["name"], F.col("w"), 0)


def test_entries_are_sorted_and_null_ones_left_out(grouped):
    entry = F.when(F.col("name") != "n3", F.col("name"))
    folded = grouped.groupBy("key").agg(collect_entries(["pos", "name"], entry).alias("names"))
    found = {r.key: r.names for r in folded.collect()}
    assert found["b"] == [f"n{k}" for k in range(10) if k != 3] and len(found["a"]) == 5000


def test_one_per_key(spark):
    df = spark.createDataFrame(
        [("x", 2, "b"), ("x", 1, "z"), ("y", 5, "q"), (None, 0, "n")],
        "key string, a int, b string",
    )
    assert rows(one_per_key(df, "key")) == [("x", 1, "z"), ("y", 5, "q")]
