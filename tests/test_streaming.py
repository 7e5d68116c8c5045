import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordermill.operators import compose_orders, to_events
from ordermill.plans import prepare_catalog
from ordermill.schemas import order_event_schema
from ordermill.sources import append_events, publish, read_table
from ordermill.streaming import gather_orders, stream_orders
from tests.conftest import rows

AS_OF = "2024-01-01 00:00:00"
ORDERS = "order_id string, address_id string, lines array<struct<pos:int,product_id:string,quantity:int>>"


@pytest.fixture(scope="module")
def catalog(shop):
    return prepare_catalog(shop.clients, shop.products, shop.packages)


def some_orders(spark, first, last):
    """Every fifth order has an empty product, every seventh no lines."""
    data = []
    for k in range(first, last):
        second = "void" if k % 5 == 0 else "lamp"
        lines = None if k % 7 == 0 else [(1, "cup", 1 + k % 3), (2, second, 2)]
        data.append((f"o{k}", "a1" if k % 2 else "a2", lines))
    return spark.createDataFrame(data, ORDERS)


def content(df):
    return sorted(repr(r.asDict(recursive=True)) for r in df.collect())


def events_of(spark, path):
    return read_table(spark, path, schema=order_event_schema).drop("batch_id")


def expected_events(orders, catalog):
    lines = orders.select("order_id", F.inline("lines"))
    composed = compose_orders(
        orders.drop("lines"), lines, catalog.items, catalog.addresses, as_of=AS_OF
    )
    return to_events(composed.accepted)


def run_stream(spark, catalog, tmp_path, **options):
    orders = (
        spark.readStream.schema(ORDERS)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "orders"))
    )
    return stream_orders(
        orders, catalog, str(tmp_path / "events"), str(tmp_path / "checkpoint"), as_of=AS_OF, **options
    )


def test_stream_equals_batch_and_is_not_repeated(spark, catalog, tmp_path):
    orders = some_orders(spark, 1, 60)
    orders.repartition(3).write.parquet(str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path).awaitTermination()
    expected = content(expected_events(orders, catalog))
    assert expected and content(events_of(spark, str(tmp_path / "events"))) == expected
    assert len(list((tmp_path / "events").glob("batch_id=*"))) == 3

    run_stream(spark, catalog, tmp_path).awaitTermination()
    assert content(events_of(spark, str(tmp_path / "events"))) == expected

    more = some_orders(spark, 60, 70)
    more.coalesce(1).write.mode("append").parquet(str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path).awaitTermination()
    every = content(expected_events(orders.unionAll(more), catalog))
    assert content(events_of(spark, str(tmp_path / "events"))) == every


def test_another_checkpoint_on_a_full_table_is_refused(spark, catalog, tmp_path):
    some_orders(spark, 1, 10).coalesce(1).write.parquet(str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path).awaitTermination()
    stream = spark.readStream.schema(ORDERS).parquet(str(tmp_path / "orders"))
    with pytest.raises(ValueError):
        stream_orders(stream, catalog, str(tmp_path / "events"), str(tmp_path / "new"))


def test_rejected_orders_are_kept(spark, catalog, tmp_path):
    some_orders(spark, 1, 41).coalesce(1).write.parquet(str(tmp_path / "orders"))
    run_stream(
        spark, catalog, tmp_path, rejected_path=str(tmp_path / "rejected"),
        trigger={"processingTime": "1 second"},
    ).processAllAvailable()
    for query in spark.streams.active:
        query.stop()
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    accepted = events_of(spark, str(tmp_path / "events"))
    assert rejected.count() + accepted.count() == 40 and rejected.count() > 0
    assert {r.reason for r in rejected.collect()} == {"empty_product", "no_lines"}


def test_published_stream(spark, catalog, tmp_path):
    events = expected_events(some_orders(spark, 1, 30), catalog)
    append_events(events, str(tmp_path / "events"))
    stream = spark.readStream.schema(order_event_schema).parquet(str(tmp_path / "events"))
    with pytest.raises(ValueError):
        publish(stream, "text", {"path": str(tmp_path / "out")})
    publish(
        stream, "text", {"path": str(tmp_path / "out")}, checkpoint=str(tmp_path / "checkpoint")
    ).awaitTermination()
    back = read_table(spark, str(tmp_path / "out"), "json", order_event_schema)
    assert content(back) == content(events)


def two_files(spark, orders, path):
    for _ in range(2):
        orders.coalesce(1).write.mode("append").parquet(path)


def test_an_order_that_comes_again_makes_one_event(spark, catalog, tmp_path):
    orders = some_orders(spark, 1, 30)
    two_files(spark, orders, str(tmp_path / "orders"))
    options = {"rejected_path": str(tmp_path / "rejected")}
    run_stream(spark, catalog, tmp_path, **options).awaitTermination()
    expected = content(expected_events(orders, catalog))
    assert expected and content(events_of(spark, str(tmp_path / "events"))) == expected
    # Again after a restart from the checkpoint, with new orders beside.
    more = some_orders(spark, 20, 40)
    two_files(spark, more, str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path, **options).awaitTermination()
    every = some_orders(spark, 1, 40)
    assert content(events_of(spark, str(tmp_path / "events"))) == content(expected_events(every, catalog))
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    assert rejected.count() == rejected.select("order_id").distinct().count()
    assert rejected.count() + events_of(spark, str(tmp_path / "events")).count() == 39


def test_orders_without_an_id_are_all_counted(spark, catalog, tmp_path):
    nameless = spark.createDataFrame([(None, "a1", [(1, "cup", 1), (2, "cup", 1)])] * 3, ORDERS)
    two_files(spark, nameless, str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path, rejected_path=str(tmp_path / "rejected")).awaitTermination()
    rejected = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert [(r.order_id, r.reason, r.n_lines) for r in rejected] == [(None, "no_order_id", 6)] * 2


def test_every_row_is_taken_on_demand(spark, catalog, tmp_path):
    two_files(spark, some_orders(spark, 1, 5), str(tmp_path / "orders"))
    run_stream(spark, catalog, tmp_path, repeats_within=None).awaitTermination()
    events = events_of(spark, str(tmp_path / "events"))
    assert events.count() == 2 * events.select("event_id").distinct().count() > 0


LINES = "order_id string, address_id string, n_lines int, pos int, product_id string, quantity int"


def run_lines(spark, catalog, tmp_path, files, **options):
    for data in files:
        frame = spark.createDataFrame([(o, "a1", *rest) for o, *rest in data], LINES)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "lines"))
    lines = (
        spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "lines"))
    )
    stream_orders(
        gather_orders(lines, **options), catalog, str(tmp_path / "events"), str(tmp_path / "checkpoint"),
        as_of=AS_OF, rejected_path=str(tmp_path / "rejected"),
    ).awaitTermination()
    found = {}
    for row in events_of(spark, str(tmp_path / "events")).collect():
        assert row.order_id not in found
        found[row.order_id] = [(i.product_id, i.quantity) for i in row.order_details["items"]]
    try:
        rejected = rows(spark.read.parquet(str(tmp_path / "rejected")), "order_id", "reason", "n_lines")
    except Exception:
        rejected = []
    return found, rejected


def test_an_order_closes_when_its_lines_are_in(spark, catalog, tmp_path):
    first = [("o1", 2, 2, "lamp", 4), ("o2", 3, 1, "cup", 1), ("o3", 1, 1, "cup", None), ("o4", None, 1, "cup", 1)]
    second = [("o1", 2, 1, "cup", 3), ("o2", 3, 1, "cup", 1), ("o2", 3, 2, "cup", 1), ("o5", 1, 1, "cup", 7)]
    found, rejected = run_lines(spark, catalog, tmp_path, [first, second])
    # o2 has a line twice and waits for its third, o4 does not say how many it has.
    assert found == {"o1": [("cup", 3), ("lamp", 4)], "o5": [("cup", 7)]}
    assert rejected == [("o3", "null_value", 1)]
    # After a restart from the checkpoint the state is still there.
    found, rejected = run_lines(spark, catalog, tmp_path, [[("o2", 3, 3, "lamp", 2)]])
    assert found["o2"] == [("cup", 1), ("cup", 1), ("lamp", 2)] and len(found) == 3


def test_late_lines_are_counted_and_time_runs_out(spark, catalog, tmp_path):
    first = [("o1", 1, 1, "cup", 1), ("o2", 3, 1, "cup", 2), (None, 1, 1, "cup", 2)]
    late = [("o1", 1, 2, "cup", 1), ("o1", 1, 3, "cup", 1), (None, 1, 1, "cup", 2), (None, 1, 2, "cup", 2)]
    last = [("o2", 3, 2, "cup", 2), ("o1", 1, 4, "cup", 1), ("o6", 1, 1, "cup", 6)]
    found, rejected = run_lines(spark, catalog, tmp_path, [first, late, last], wait="1 millisecond")
    assert found == {"o1": [("cup", 1)], "o2": [("cup", 2)], "o6": [("cup", 6)]}
    assert rejected == sorted(
        [("o1", "late_line", 1), ("o1", "late_line", 2), ("o2", "late_line", 1),
         (None, "no_order_id", 1), (None, "no_order_id", 2)], key=repr,
    )


class KeptState:
    """What ``gather_orders`` uses of the state of a group."""

    def __init__(self):
        self.get, self.exists, self.now, self.timeout = None, False, 0, None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutDuration(self, duration):
        self.timeout = duration

    def remove(self):
        self.get, self.exists = None, False


def test_orders_of_a_group_are_kept_together_and_each_by_its_own_time():
    from ordermill.streaming import lines

    step, state = lines._step(wait=10, remember=100), KeptState()
    columns = ["order_id", "address_id", "n_lines", "line"]

    def called(now, *data):
        state.now = now
        frames = iter([pd.DataFrame(list(data), columns=columns)])
        return sorted(tuple(r) for frame in step((7,), frames, state) for r in frame.itertuples(index=False))

    first = [("a", "x", 2, "l2"), ("b", "y", 2, "l1"), ("a", "w", 2, "l1"), ("a", None, None, "l1")]
    assert called(1000, *first) == [("a", "w", ["l1", "l2"], 0, True)]
    assert list(state.get[0]) == ["a", "b"] and list(state.get[1]) == [1100, 1010] and state.timeout == 10
    # b's time is not up at the moment itself; a line of a is late.
    assert called(1010, ("a", "x", 2, "l3")) == [("a", None, None, 1, False)]
    assert called(1011, ("c", "x", None, "l1")) == [("b", "y", ["l1"], 0, False)]
    assert list(state.get[1]) == [1100, 1111, 1021] and state.timeout == 10
    # a is forgotten and starts anew, b and c are closed.
    assert called(1105) == [("c", "x", ["l1"], 0, False)] and list(state.get[0]) == ["b", "c"]
    assert called(1106, ("a", "v", 1, "l1")) == [("a", "v", ["l1"], 0, True)]
    assert called(2000) == [] and not state.exists
