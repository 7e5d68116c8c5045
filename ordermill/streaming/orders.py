"""Order events as a stream."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators.events import to_events
from ordermill.operators.orders import LATE_LINE, check_orders, split_checked, without_id
from ordermill.plans.catalog import Catalog
from ordermill.scratch import holds_files, kept
from ordermill.sources.tables import write_table

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _write_batch(
    df: DataFrame, path: str, format: str, batch_id: int, application: str
) -> None:
    """Write a micro-batch so that writing it again changes nothing."""
    if format.lower() == "delta":
        # Delta takes each number of an application only once.
        once = {"txnAppId": application, "txnVersion": str(batch_id)}
        write_table(df, path, format, "append", once)
    else:
        folder = f"{path.rstrip('/')}/batch_id={batch_id}"
        write_table(df, folder, format, "overwrite")


def first_arrivals(stream: DataFrame, key: str, within: str) -> DataFrame:
    """Rows of a stream whose key has not arrived in the time ``within`` before.

    Time is the moment of arrival, so no row is late for the watermark. Rows without
    a key all stay.
    """
    marked = stream.withColumns(
        {"_arrived": F.current_timestamp(), "_apart": F.when(F.col(key).isNull(), F.uuid())}
    )
    first = marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark([key, "_apart"])
    return first.drop("_arrived", "_apart")


def stream_orders(
    orders: DataFrame,
    catalog: Catalog,
    path: str,
    checkpoint: str,
    *,
    format: str = "parquet",
    rejected_path: str | None = None,
    trigger: dict | None = None,
    ids_run: str = "",
    repeats_within: str | None = "7 days",
    **options,
) -> StreamingQuery:
    """Turn a stream of orders into a table of order events.

    ``orders`` has ``order_id``, ``address_id`` and ``lines``, an array of
    ``pos, product_id, quantity``, and may come from ``gather_orders``. Each
    micro-batch runs ``check_orders`` once (with ``options``) and writes accepted events
    and, with ``rejected_path``, rejected orders from its kept result. It
    overwrites its own folder ``batch_id=N``, so a batch that is run again after a
    failure replaces what it left behind; a batch without rows writes none. A table
    and its checkpoint belong together: a new checkpoint on a table that holds files
    is refused, since its batches would mix with those that are there. ``trigger``
    paces the stream, e.g. ``{"processingTime": "10 seconds"}``; the default takes
    what is there and stops.

    An order that comes again within ``repeats_within`` of its arrival is left out,
    in whatever batch and after any restart from the checkpoint, so it makes one
    event. The stream keeps the ids that arrived in that time (on many ids, set
    Spark's RocksDB state store). Of different rows with one id in one batch any one
    counts. None takes every row, and is needed to go on with a checkpoint that was
    made without. Late lines are counted among the rejected (``late_line``).
    """
    spark = orders.sparkSession
    file_table = format.lower() != "delta"
    if file_table and holds_files(spark, path) and not holds_files(spark, checkpoint):
        raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # A batch that stems from state must be computed once.
        with kept(batch, "orders") as taken:
            if not taken.isEmpty():
                write_orders(taken, batch_id)

    def write_orders(batch: DataFrame, batch_id: int) -> None:
        late = None
        if "n_late" in batch.columns:
            late = batch.where("n_late > 0").select(
                "order_id", F.lit(LATE_LINE).alias("reason"), F.col("n_late").alias("n_lines")
            )
            batch = batch.where("n_late = 0").drop("n_late", "complete")
        headers = batch.drop("lines")
        lines = batch.select("order_id", F.inline("lines"))
        checked = check_orders(
            headers,
            lines,
            catalog.items,
            catalog.addresses,
            items_small=catalog.items_small,
            addresses_small=catalog.addresses_small,
            **options,
        )
        # Only a result that is written to two tables has to be kept for it.
        with nullcontext(checked) if rejected_path is None else kept(checked, "batch") as result:
            found = split_checked(result, without_id(lines, headers))
            events = to_events(found.accepted, run=ids_run)
            _write_batch(events, path, format, batch_id, checkpoint)
            if rejected_path is not None:
                rejected = found.rejected if late is None else found.rejected.unionByName(late)
                _write_batch(rejected, rejected_path, format, batch_id, checkpoint)

    # Gathered orders come once: their closing is remembered.
    gathered = "n_late" in orders.columns
    if repeats_within is not None and not gathered:
        orders = first_arrivals(orders, "order_id", repeats_within)
    trigger = trigger or {"availableNow": True}
    writer = (
        orders.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if not (gathered and trigger.get("availableNow")):
        return writer.start()
    # Open orders have timers, for which Spark would run empty batches without end. A
    # query takes its settings along when it starts.
    before = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)
