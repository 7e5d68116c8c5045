import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordermill.operators import dense_index, draw_rows
from tests.conftest import rows
from tests.test_draws import expected_draw


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def numbered(keys, digits=4):
    return sorted(keys, key=lambda k: (md5(k)[:digits], k))


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))


@pytest.mark.parametrize("partitions", [1, 9])
@pytest.mark.parametrize("digits", [1, 2, 4])
def test_index_order(keyed, partitions, digits):
    index = dense_index(keyed.repartition(partitions), "key", digits=digits)
    expected = numbered([f"k{i}" for i in range(2000)], digits)
    assert index.rows == 2000
    assert rows(index.table, "idx", "key") == sorted(enumerate(expected), key=repr)


def test_rows_with_one_key_each_get_a_number(spark):
    """A third of the rows share a key; it is cut into runs over the buckets."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key")
    )
    index = dense_index(df, "key", run=7)
    found = rows(index.table, "idx", "key")
    assert index.rows == 900
    assert sorted(i for i, _ in found) == list(range(900))
    assert Counter(k for _, k in found)["hot"] == 300
    hot = sorted(i for i, k in found if k == "hot")
    assert hot[-1] - hot[0] > 600  # not in one stretch


def test_null_keys_are_never_drawn(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "key string")
    index = dense_index(df, "key")
    assert index.rows == 2
    assert sorted(k for _, k in rows(index.table, "idx", "key")) == ["a", "b"]


def test_empty_table(spark):
    for data in ([], [(None,)]):
        with pytest.raises(ValueError):
            dense_index(spark.createDataFrame(data, "key string"), "key")


@pytest.mark.parametrize("small", [True, False])
def test_drawn_rows(spark, keyed, small):
    index = dense_index(keyed, "key")._replace(small=small)
    drawn = draw_rows(spark.range(3000), index, 5, "client", F.col("id"))
    order = numbered([f"k{i}" for i in range(2000)])
    expected = {i: order[expected_draw(f"5:client:{i}") % 2000] for i in range(3000)}
    assert dict(rows(drawn, "id", "key")) == expected


def test_duplicated_rows_are_drawn_as_often_as_they_occur(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "key string")
    drawn = draw_rows(spark.range(4000), dense_index(df, "key"), 1, "x", F.col("id"))
    share = drawn.where("key = 'a'").count() / 4000
    assert abs(share - 0.75) < 0.03


def test_numbers_do_not_depend_on_the_size(spark, keyed):
    """A longer table has the same keys in the same order."""
    order = lambda df: [k for _, k in rows(dense_index(df, "key").table, "idx", "key")]
    longer = keyed.unionAll(spark.range(2000, 2600).select(F.concat(F.lit("k"), "id").alias("key")))
    short = {f"k{i}" for i in range(2000)}
    found = [r.key for r in dense_index(longer, "key").table.orderBy("idx").collect()]
    assert [k for k in found if k in short] == [
        r.key for r in dense_index(keyed, "key").table.orderBy("idx").collect()
    ]
    assert len(order(longer)) == 2600
