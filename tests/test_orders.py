import time

import pytest
from pyspark.sql import functions as F

from ordermill.operators import (
    attach_client,
    build_items,
    client_addresses,
    compose_orders,
    order_documents,
    order_totals,
    product_measures,
    to_envelope,
    to_events,
)
from ordermill.functions import item_total, package_measure_total
from ordermill.schemas import order_event_schema
from tests.conftest import LINES, plan_of, rows

TOTALS = ["order_id", "n_items", "total_amount", "total_volume", "total_weight"]
PRICE = 19.989999771118164

EXPECTED = {
    # lamp: 2 * price, volume 2 * (3*10 + 2*1), weight 2 * (3*2.5 + 2*1)
    "plain": (2, 2 * PRICE + 7.5, 64.0 + 30.0, 19.0 + 7.5),
    "repeat": (2, 5.0, 20.0, 5.0),
    "twins": (1, 10.0, 2 * (6 + 50.0), 2 * (6 + 12.5)),
    "loose": (1, 2.0, 10.0, 10.0),
}
REJECTED = {
    "holey": "empty_product",
    "stray": "unknown_product",
    "unpriced": "null_value",
    "uncounted": "null_value",
    "unsized": "null_value",
    None: "no_order_id",
}


@pytest.fixture(scope="module")
def items(shop):
    return build_items(shop.products, shop.packages).cache()


@pytest.fixture(scope="module")
def measures(shop):
    return product_measures(shop.products, shop.packages).cache()


HEADERS = "order_id string, address_id string"


@pytest.fixture(scope="module")
def headers(spark):
    return spark.createDataFrame(
        [("plain", "a1"), ("repeat", "a2"), ("twins", "nowhere"), ("loose", None), ("many", "a1"),
         ("holey", "a1"), ("no lines", "a1"), ("plain", "a1")],
        HEADERS,
    )


def reasons(orders):
    return {r.order_id: r.reason for r in orders.rejected.collect()}


def by_order(df):
    return {r[0]: tuple(r[1:]) for r in df.select(*TOTALS).collect()}


def test_nested_totals(lines, items):
    orders = order_documents(lines, items)
    assert by_order(orders.accepted) == EXPECTED
    assert reasons(orders) == REJECTED


def test_flat_totals(lines, measures):
    orders = order_totals(lines, measures)
    assert by_order(orders.accepted) == EXPECTED
    assert reasons(orders) == REJECTED


@pytest.mark.parametrize("small", [True, False])
def test_large_lookup_tables_give_the_same(lines, items, measures, small):
    assert by_order(order_documents(lines, items, items_small=small).accepted) == EXPECTED
    assert by_order(order_totals(lines, measures, small=small).accepted) == EXPECTED


def test_drop_item(lines, items, measures):
    expected = {**EXPECTED, "holey": (1, 2.5, 10.0, 2.5)}
    for orders in (
        order_documents(lines, items, on_empty="drop_item"),
        order_totals(lines, measures, on_empty="drop_item"),
    ):
        assert by_order(orders.accepted) == expected
        wanted = {k: v for k, v in REJECTED.items() if k != "holey"}
        assert reasons(orders) == wanted


@pytest.mark.parametrize("on_empty", ["drop_order", "drop_item", "keep"])
def test_no_order_is_lost(spark, shop, lines, headers, items, measures, on_empty):
    more = spark.createDataFrame(
        [("only unknown", 1, "unheard", 1), ("only empty", 1, "void", 1), ("both", 1, "unheard", 1),
         ("both", 2, "void", 1), (None, 2, "cup", 1)], LINES,
    )
    every = lines.unionAll(more)
    composed = compose_orders(
        headers, every, items, client_addresses(shop.clients), on_empty=on_empty, as_of="2024-01-01 00:00:00"
    )
    ids = {r[0] for r in rows(every, "order_id")}
    for orders, wanted in (
        (order_documents(every, items, on_empty=on_empty), ids),
        (order_totals(every, measures, on_empty=on_empty), ids),
        (composed, ids | {"many", "no lines"}),
    ):
        accepted, rejected = rows(orders.accepted, "order_id"), rows(orders.rejected, "order_id")
        assert sorted([*accepted, *rejected], key=repr) == sorted(((k,) for k in wanted), key=repr)
        found = reasons(orders)
        assert found["only unknown"] == found["both"] == "unknown_product"
        assert found.get("only empty") == (
            "empty_product" if on_empty != "keep" else "unknown_client" if orders is composed else None
        )
        stray = orders.rejected.where("order_id is null").first()
        assert (stray.reason, stray.n_lines) == ("no_order_id", 2)
    assert reasons(composed)["no lines"] == "no_lines"


def test_keep(lines, items, measures):
    expected = {**EXPECTED, "holey": (2, 10.5, 10.0, 2.5)}
    for orders in (
        order_documents(lines, items, on_empty="keep"),
        order_totals(lines, measures, on_empty="keep"),
    ):
        assert by_order(orders.accepted) == expected
        assert reasons(orders)["stray"] == "unknown_product"


def test_unknown_policy(lines, items):
    with pytest.raises(ValueError):
        order_documents(lines, items, on_empty="ignore")


def test_items_keep_the_order_of_the_lines(lines, items):
    documents = order_documents(lines, items).accepted
    plain = documents.where("order_id = 'plain'").first()
    assert [(i.product_id, i.quantity) for i in plain["items"]] == [("lamp", 2), ("cup", 3)]
    assert [tuple(p) for p in plain["items"][0].packages] == [
        ("box", 1, 3, 2.5, 10.0),
        ("box", 2, 2, None, None),
    ]


def test_nested_functions_agree_with_the_documents(lines, items):
    documents = order_documents(lines, items).accepted
    again = documents.select(
        item_total(F.col("items"), "price").alias("a"),
        package_measure_total(F.col("items"), "volume").alias("v"),
        package_measure_total(F.col("items"), "weight").alias("w"),
        "total_amount", "total_volume", "total_weight",
    )
    assert again.where("a != total_amount or v != total_volume or w != total_weight").count() == 0


@pytest.mark.parametrize("seed_partitions", [1, 4, 200])
def test_result_does_not_depend_on_partitions(lines, items, seed_partitions):
    documents = order_documents(lines.repartition(seed_partitions), items).accepted
    assert by_order(documents) == EXPECTED


@pytest.fixture(scope="module")
def huge(spark, lines):
    """One order of 500 lines and one of 300 copies of a line."""
    many = spark.range(500).select(
        F.lit("many").alias("order_id"),
        F.col("id").cast("int").alias("pos"),
        F.when(F.col("id") % 2 == 0, "cup").otherwise("lamp").alias("product_id"),
        F.lit(1).alias("quantity"),
    )
    same = spark.range(300).selectExpr(
        "'same' as order_id", "1 as pos", "'cup' as product_id", "2 as quantity"
    )
    return lines.unionAll(many).unionAll(same)


@pytest.mark.parametrize("max_packages", [1, 4, 20, None])
def test_parts_add_up_and_have_one_schema(huge, items, measures, max_packages):
    whole = order_documents(huge, items).accepted
    parts = order_documents(huge, items, max_packages=max_packages).accepted
    assert parts.dtypes == whole.dtypes
    assert whole.where("part != 0 or n_parts != 1").count() == 0
    sums = parts.groupBy("order_id").agg(*[F.sum(t).alias(t) for t in TOTALS[1:]])
    totals = {k: pytest.approx(v) for k, v in by_order(order_totals(huge, measures).accepted).items()}
    assert by_order(sums) == totals
    numbers = parts.groupBy("order_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"), F.max("n_parts").alias("n")
    )
    assert all(r.parts == list(range(r.n)) for r in numbers.collect())

    def lines_of(df):
        each = df.select("order_id", "part", F.posexplode("items").alias("k", "i"))
        found = sorted(each.select("order_id", "part", "k", "i.product_id", "i.quantity").collect())
        return [(r.order_id, r.product_id, r.quantity) for r in found]

    assert lines_of(parts) == lines_of(whole)
    if max_packages == 20:
        most = parts.select(F.aggregate("items", F.lit(0), lambda n, i: n + F.size(i["packages"])))
        assert max(r[0] for r in most.collect()) <= 21
        assert parts.where("order_id = 'many'").count() > 10


def test_orders_in_parts_are_rejected_whole(spark, huge, items):
    bad = spark.createDataFrame([("many", 501, "void", 1)], LINES)
    orders = order_documents(huge.unionAll(bad), items, max_packages=20)
    assert "many" not in by_order(orders.accepted)
    assert reasons(orders) == {**REJECTED, "many": "empty_product"}


def test_addresses_are_one_per_id(shop):
    addresses = client_addresses(shop.clients)
    assert rows(addresses, "address_id", "customer_id") == [("a1", "c1"), ("a2", "c2")]


def test_attach_client(shop, headers):
    attached = attach_client(headers, client_addresses(shop.clients))
    assert set(rows(attached, "order_id", "customer_id")) >= {("plain", "c1"), ("twins", None)}


@pytest.mark.parametrize("small", [True, False])
def test_compose(shop, lines, headers, items, small):
    orders = compose_orders(
        headers, lines, items, client_addresses(shop.clients),
        as_of="2024-02-29 23:59:59", items_small=small, addresses_small=small,
    )
    details = {r.order_id: r.order_details for r in orders.accepted.collect()}
    assert set(details) == {"plain", "repeat"}
    plain = details["plain"]
    assert plain.customer_id == "c1"
    assert (plain.order_timestamp, plain.order_date) == ("2024-02-29 23:59:59", "2024-02-29")
    assert plain.status == "RECEIVED"
    assert tuple(plain.payment_details) == ("", "", "")
    assert plain.destination_address.lat == PRICE
    assert plain.destination_address.road == "Calle Ñ"
    assert plain.destination_address.coordinates == [1.5, 2.5]
    assert (2, plain.total_amount, plain.total_volume, plain.total_weight) == EXPECTED["plain"]
    assert reasons(orders) == {
        **REJECTED, "twins": "unknown_client", "loose": "unknown_client",
        "many": "no_lines", "no lines": "no_lines",
    }


def test_events_of_parts(shop, huge, headers, items):
    orders = compose_orders(
        headers, huge, items, client_addresses(shop.clients), max_packages=20, as_of="2024-01-01 00:00:00"
    )
    events = to_events(orders.accepted, run="r", parts=True)
    many = events.where("order_id = 'many'")
    assert many.count() > 10
    assert many.select("order_details.customer_id", "n_parts").distinct().count() == 1
    assert many.select("event_id").distinct().count() == many.count()
    assert many.agg(F.sum(F.size("order_details.items"))).first()[0] == 500
    record = to_envelope(many).first()
    assert [h.key for h in record.headers] == ["part", "n_parts"]
    assert b"n_parts" not in bytes(record.value)


@pytest.mark.parametrize("max_packages", [None, 1])
def test_one_moment_for_a_run(shop, lines, headers, items, max_packages):
    orders = compose_orders(headers, lines, items, client_addresses(shop.clients), max_packages=max_packages)
    events = to_events(orders.accepted)
    moments = lambda: rows(events.select("event_timestamp").distinct())
    first = moments()
    time.sleep(1.1)
    assert len(first) == 1 and moments() == first


def test_headers_join_without_sorting_documents(shop, lines, headers, items):
    orders = compose_orders(headers, lines, items, client_addresses(shop.clients), items_small=True)
    plan = plan_of(to_events(orders.accepted))
    above = plan[: plan.index("ObjectHashAggregate")]
    assert "Sort" not in above and "Join" not in above


def test_events_have_the_event_schema(shop, lines, headers, items):
    orders = compose_orders(headers, lines, items, client_addresses(shop.clients))
    events = to_events(orders.accepted)
    names = lambda s: s.simpleString()
    assert names(events.schema) == names(order_event_schema)
    row = events.where("order_id = 'plain'").first()
    assert row.event_type == "ORDER_CREATED" and row.event_id.startswith("ev-")
    assert row.event_timestamp == row.order_details.order_timestamp


def test_as_of_may_be_a_column(spark, shop, lines, headers, items):
    dated = headers.withColumn("at", F.lit("2001-02-03 04:05:06").cast("timestamp"))
    orders = compose_orders(dated, lines, items, client_addresses(shop.clients), as_of=F.col("at"))
    assert {r.order_details.order_date for r in orders.accepted.collect()} == {"2001-02-03"}


def test_replayed_and_random_ids(shop, lines, headers, items):
    orders = compose_orders(headers, lines, items, client_addresses(shop.clients)).accepted
    ids = lambda **kw: rows(to_events(orders, **kw), "event_id")
    assert ids() == ids()
    assert ids(run="a") != ids(run="b")
    assert ids(ids="random") != ids(ids="random")
    with pytest.raises(ValueError):
        to_events(orders, ids="other")


def test_lines_are_shuffled_narrow_and_once(spark, shop, tmp_path, lines):
    path = str(tmp_path / "lines")
    lines.withColumn("note", F.lit("unused")).write.parquet(path)
    stored = spark.read.parquet(path)
    items = build_items(shop.products, shop.packages)
    documents = order_documents(stored, items, items_small=True).accepted
    plan = plan_of(documents)
    assert plan.count("hashpartitioning(order_id") == 1
    assert "note" not in plan
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("max_packages", [1, 20])
def test_parts_of_small_items_are_those_of_others(huge, items, max_packages):
    plain = order_documents(huge, items, max_packages=max_packages)
    small = order_documents(huge, items, max_packages=max_packages, items_small=True)
    assert rows(small.accepted) == rows(plain.accepted)
    assert rows(small.rejected) == rows(plain.rejected)


def test_parts_split_a_hot_order_of_small_items(spark, items):
    """A third of the lines in one order, without help from adaptive execution."""
    n = F.col("id")
    lines = spark.range(24_000).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), n % 997)).alias("order_id"),
        n.cast("int").alias("pos"),
        F.lit("cup").alias("product_id"),
        F.lit(1).alias("quantity"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        found = order_documents(lines, items, max_packages=50, items_small=True).accepted
        sizes = found.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n_items").alias("n")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    held = sorted(r.n for r in sizes)
    assert sum(held) == 24_000 and held[-1] <= 2 * held[len(held) // 2]


@pytest.mark.parametrize("max_packages", [None, 2])
def test_rows_with_their_items_are_shuffled_once(lines, items, max_packages):
    """And as they are: not collected before, and not to number parts or for flags."""
    documents = order_documents(lines, items, max_packages=max_packages, items_small=False)
    query = documents.accepted._jdf.queryExecution()
    mode = documents.accepted.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    nodes = query.explainString(mode).split("\n\n")
    shuffled = [n for n in nodes if "Exchange\n" in n and "order_id#" in n.split("Arguments")[0]]
    assert len([n for n in shuffled if "packages#" in n]) == 1
    assert not [n for n in shuffled if "items#" in n]


@pytest.mark.parametrize("max_packages", [1, 2, 5])
def test_parts_of_short_and_long_orders_of_odd_positions(spark, shop, items, max_packages):
    """Null, negative, repeated and far positions, dropped and unknown products, no lines."""
    data = [("long", pos, ("cup", "lamp", "void")[pos % 3], 1 + pos % 4) for pos in range(1000, 1050)]
    data += [("odd", pos, "lamp", 1) for pos in (None, None, -5, 3, 3, 2000)]
    data += [("short", pos, "cup", 2) for pos in (7, None, 3, 3, 3, 1023)] + [("short", 4, "void", 1)]
    data += [("lost", 1, "unheard", 1), ("lost", 2, "cup", 1), ("nobody's", 1, "cup", 1), (None, 1, "cup", 1)]
    lines = spark.createDataFrame(data, LINES)
    headers = spark.createDataFrame(
        [("long", "a1"), ("odd", "a2"), ("short", "a1"), ("short", "a2"), ("lost", "a1"), ("bare", "a1"), (None, "a1")],
        HEADERS,
    )
    options = {"as_of": "2024-01-01 00:00:00", "on_empty": "drop_item", "max_packages": max_packages}
    found = [
        compose_orders(headers, lines, items, client_addresses(shop.clients), items_small=small, **options)
        for small in (True, None)
    ]
    assert rows(found[0].accepted) == rows(found[1].accepted)
    assert rows(found[0].rejected) == rows(found[1].rejected)
    assert {r.order_id for r in found[1].accepted.collect()} == {"long", "odd", "short"}
