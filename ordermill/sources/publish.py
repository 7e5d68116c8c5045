"""Publishing events as JSON records, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators.events import split_valid, to_envelope


def _records(events: DataFrame, format: str, key: str, shape: str) -> DataFrame:
    records = to_envelope(events, key=key, shape=shape)
    if format != "text":
        return records
    return records.select(F.decode(F.col(records.columns[1]), "UTF-8").alias("value"))


def publish(
    events: DataFrame,
    format: str,
    options: dict[str, str] | None = None,
    *,
    key: str = "order_id",
    shape: str = "kafka",
    mode: str = "append",
    checkpoint: str | None = None,
    trigger: dict | None = None,
    rejected_path: str | None = None,
) -> StreamingQuery | None:
    """Send valid events to any Spark sink; the others go to ``rejected_path``.

    ``format="text"`` writes one JSON document per line. Any other sink gets the
    record of ``to_envelope``; ``"kafka"`` and ``"kinesis"`` need their connector
    on the class path and their options (servers, topic). Rejected events are
    Parquet, one folder ``batch_id=N`` for each batch of a stream; without a path
    they are left out. A streaming DataFrame starts a query with ``checkpoint``
    and ``trigger`` and returns it.
    """
    format = format.lower()
    options = options or {}
    if events.isStreaming and checkpoint is None:
        raise ValueError("a streaming publish needs a checkpoint location")
    if not events.isStreaming:
        valid = split_valid(events)
        records = _records(valid.accepted, format, key, shape)
        records.write.format(format).mode(mode).options(**options).save()
        if rejected_path is not None:
            valid.rejected.write.mode(mode).parquet(rejected_path)
        return None
    if rejected_path is None:
        records = _records(split_valid(events).accepted, format, key, shape)
        writer = records.writeStream.format(format).outputMode("append").options(**options)
    else:

        def both(batch: DataFrame, batch_id: int) -> None:
            valid = split_valid(batch)
            folder = f"{rejected_path.rstrip('/')}/batch_id={batch_id}"
            valid.rejected.write.mode("overwrite").parquet(folder)
            records = _records(valid.accepted, format, key, shape)
            records.write.format(format).mode("append").options(**options).save()

        writer = events.writeStream.foreachBatch(both)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
