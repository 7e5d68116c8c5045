"""Tables laid out for lookups and joins, and tables in versions."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import lookup_by_key
from ordermill.sources import (
    bucket_join,
    lookup,
    newest_version,
    pin_versions,
    read_pinned_dimensions,
    read_table,
    read_version,
    save_bucketed,
    versions,
    write_sorted,
    write_version,
)
from tests.conftest import plan_of, rows


def scanned(df):
    """Rows and files that the scans of a query without shuffles have read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = {"numOutputRows": 0, "numFiles": 0}
    for k in range(leaves.size()):
        metrics = leaves.apply(k).metrics()
        for name in found:
            if metrics.contains(name):
                found[name] += metrics.apply(name).value()
    return found["numOutputRows"], found["numFiles"]


@pytest.fixture(scope="module")
def sorted_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sorted") / "t")
    data = spark.range(60_000).select(
        F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % 6_000).cast("string"), 5, "0")).alias("key"),
        F.md5(F.col("id").cast("string")).alias("other"),
        F.col("id"),
    )
    hot = spark.range(30_000).select(F.lit("k03000").alias("key"), F.lit("hot").alias("other"), "id")
    data = data.unionAll(hot).unionAll(
        spark.createDataFrame([(None, "none", -1)], data.schema)
    )
    write_sorted(data, path, "key", bloom=["other"], files=24, row_group_bytes=1 << 16, page_rows=500)
    return path, data


def test_a_lookup_reads_few_files_and_few_rows(spark, sorted_table):
    path, data = sorted_table
    for keys in (["k00017"], ["k00017", "k05999"], ["k03000"]):
        found = lookup(spark, path, "key", keys)
        assert rows(found) == rows(data.where(F.col("key").isin(keys)))
        read, files = scanned(lookup(spark, path, "key", keys))
        if keys != ["k03000"]:
            assert read <= 2_500 * len(keys) and files <= 2 * len(keys)
    # The hot key is not in one file.
    assert scanned(lookup(spark, path, "key", ["k03000"]))[1] > 4
    assert lookup(spark, path, "key", ["a", "k00017x", "z"]).count() == 0
    assert lookup(spark, path, "key", []).count() == 0
    assert read_table(spark, path).count() == 90_001


def test_a_bloom_filter_rules_out_row_groups(spark, sorted_table):
    path, data = sorted_table
    one = data.where("id = 4711 and other <> 'hot'").first()
    found = lookup_by_key(read_table(spark, path), "other", one.other)
    assert rows(found) == [tuple(one)]
    read, _ = scanned(lookup_by_key(read_table(spark, path), "other", one.other))
    assert read < 9_000
    assert scanned(lookup_by_key(read_table(spark, path), "other", "absent"))[0] < 4_500


def test_bucketed_tables_are_joined_without_a_shuffle(spark, tmp_path):
    left = spark.range(500).select((F.col("id") % 37).alias("k"), F.col("id").alias("a"))
    left = left.unionAll(spark.createDataFrame([(None, 900)], left.schema))
    right = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    try:
        tables = [
            save_bucketed(df, name, "k", 4, path=str(tmp_path / name))
            for name, df in (("left_side", left), ("right_side", right))
        ]
        for how in ("left", "inner"):
            joined = bucket_join(*tables, "k", how)
            assert "Exchange" not in plan_of(joined)
            assert rows(joined) == rows(left.join(right, "k", how))
        assert len(list((tmp_path / "left_side").glob("*.parquet"))) == 4
    finally:
        spark.sql("drop table if exists left_side")
        spark.sql("drop table if exists right_side")


def test_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t") + "/"
    assert newest_version(spark, path) == 0
    with pytest.raises(IOError):
        read_version(spark, path)
    assert write_version(spark.range(3), path) == 1
    kept = read_version(spark, path)
    assert write_version(spark.range(5), path) == 2
    assert kept.count() == 3 and read_version(spark, path).count() == 5
    assert read_version(spark, path, 1).count() == 3
    # A writer that is killed before its record changes nothing.
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            write_version(spark.range(9), path)
    assert newest_version(spark, path) == 2
    # Two writers of one number: the later takes the next.
    commit = versions.commit

    def overtaken(*args):
        monkeypatch.setattr(versions, "commit", commit)
        assert write_version(spark.range(7), path) == 3
        return commit(*args)

    monkeypatch.setattr(versions, "commit", overtaken)
    assert write_version(spark.range(8), path) == 4
    assert [read_version(spark, path, n).count() for n in (3, 4)] == [7, 8]


def test_a_run_keeps_to_its_versions(spark, shop, tmp_path):
    base = str(tmp_path)
    with pytest.raises(IOError, match="products"):
        pin_versions(spark, base, "monday", ["products"])
    names = ("clients_address", "products", "packages")
    for name, df in zip(names, (shop.clients, shop.products, shop.packages)):
        write_version(df, f"{base}/{name}")
    before = read_pinned_dimensions(spark, base, "monday")
    write_version(shop.products.where("product_id = 'cup'"), f"{base}/products")
    # A later batch, or the same run after a restart.
    again = read_pinned_dimensions(spark, base + "/", "monday")
    assert rows(again.products) == rows(before.products) == rows(shop.products)
    assert rows(again.clients) == rows(shop.clients)
    assert read_pinned_dimensions(spark, base, "tuesday").products.count() == 1
    with pytest.raises(ValueError):
        pin_versions(spark, base, "monday", ["products"])
