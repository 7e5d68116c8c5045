"""Orders gathered from a stream of order lines.

Lines of an order arrive in any number of micro-batches. Per order the stream keeps
its lines until all have come or its time is up, and then a note that it is closed,
so that lines which come later are told from those of a new order. Orders are kept by
the group, since a call of Python costs more than the work on an order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LINE = ["pos", "product_id", "quantity"]
#: Groups of orders that are kept together, by hash of the id. A checkpoint holds to it.
GROUPS = 1 << 16
_STATE = (
    "ids array<string>, due array<long>, closed array<boolean>, addresses array<string>, "
    "n_lines array<long>, lines array<array<string>>"
)
_OUT = "order_id string, address_id string, lines array<string>, n_late long, complete boolean"


def _milliseconds(duration: str) -> int:
    return pd.Timedelta(duration) // pd.Timedelta("1ms")


class _Kept:
    """An order: its time, whether it is closed, and what is known of it while it is open."""

    __slots__ = ("due", "closed", "address_id", "n_lines", "lines", "n_late")

    def __init__(self, due, closed=False, address_id=None, n_lines=None, lines=()):
        self.due, self.closed, self.address_id, self.n_lines = due, closed, address_id, n_lines
        self.lines, self.n_late = list(lines), 0

    def take(self, address_id, n_lines, line) -> None:
        if self.closed:
            self.n_late += 1
            return
        self.lines.append(line)
        if n_lines is not None and n_lines == n_lines:
            self.n_lines = max(int(n_lines), self.n_lines or 0)
        # The least address counts, in whatever order lines arrive.
        if address_id is not None and (self.address_id is None or address_id < self.address_id):
            self.address_id = address_id

    def settle(self, order_id, now: int, remember: int, timed_out: bool) -> tuple | None:
        """The row that new lines, or a time that is up, make of the order, if any."""
        if self.closed:
            row = (order_id, None, None, self.n_late, False)
        else:
            # A line that is sent again is the same line.
            self.lines = sorted(set(self.lines))
            complete = self.n_lines is not None and len(self.lines) >= self.n_lines
            row = (order_id, self.address_id, self.lines, 0, complete)
            if not (complete or timed_out):
                row = None
            else:
                self.closed, self.due = True, now + remember
                self.address_id, self.n_lines, self.lines = None, None, []
        self.due = max(now + 1, self.due)
        return row


def _step(wait: int, remember: int):
    """What the orders of a group do with new lines, or when the time of one is up."""

    def step(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        orders = {}
        if state.exists:
            orders = {order_id: _Kept(*rest) for order_id, *rest in zip(*state.get)}
        arrived = {}
        for frame in frames:
            columns = [frame[c].tolist() for c in ("order_id", "address_id", "n_lines", "line")]
            for order_id, address_id, n_lines, line in zip(*columns):
                order = orders.get(order_id)
                if order is None:
                    order = orders[order_id] = _Kept(now + wait)
                order.take(address_id, n_lines, line)
                arrived[order_id] = order
        found = [order.settle(i, now, remember, False) for i, order in arrived.items()]
        for order_id, order in list(orders.items()):
            if order_id not in arrived and order.due < now:
                if order.closed:
                    del orders[order_id]
                else:
                    found.append(order.settle(order_id, now, remember, True))
        if orders:
            fields = ("due", "closed", "address_id", "n_lines", "lines")
            columns = [[getattr(order, f) for order in orders.values()] for f in fields]
            state.update((list(orders), *columns))
            state.setTimeoutDuration(max(1, min(columns[0]) - now))
        elif state.exists:
            state.remove()
        found = [row for row in found if row is not None]
        if found:
            yield pd.DataFrame(found, columns=["order_id", "address_id", "lines", "n_late", "complete"])

    return step


def gather_orders(
    lines: DataFrame, *, wait: str = "1 hour", remember: str = "7 days"
) -> DataFrame:
    """A stream of orders from a stream of lines, for ``stream_orders``.

    ``lines`` has ``order_id, address_id, n_lines, pos, product_id, quantity``;
    ``n_lines`` is how many lines the order has, null if it is not known. An order
    closes when it has that many different lines, or ``wait`` after its first one
    with those that are there (``complete`` is false). Lines that come in the
    ``remember`` after that make a row of their own: no lines, and their number in
    ``n_late``. After that the id is free again. Lines without an order id are
    handed on as they come.

    Times are those of arrival, so no line is too old to be taken up. They run out
    with the next batch; a stream that takes what is there and stops has batches only
    while there are new lines. State is bounded by the lines of the orders that are open
    at a time, and by a note for each closed one. A row of state holds the orders of one
    of ``GROUPS`` groups, and is written anew when one of them has news.
    """
    wait_ms, remember_ms = _milliseconds(wait), _milliseconds(remember)
    kind = T.StructType([lines.schema[c] for c in LINE])
    id_type = lines.schema["order_id"].dataType
    # One text for a line: types and nulls pass through pandas unchanged.
    packed = lines.where(F.col("order_id").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("address_id").cast("string").alias("address_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.to_json(F.struct(*LINE), {"ignoreNullFields": "false"}).alias("line"),
    )
    packed = packed.withColumn("group", F.pmod(F.xxhash64("order_id"), F.lit(GROUPS)))
    gathered = packed.groupBy("group").applyInPandasWithState(
        _step(wait_ms, remember_ms), _OUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    orders = gathered.select(
        F.col("order_id").cast(id_type).alias("order_id"),
        F.col("address_id").cast(lines.schema["address_id"].dataType).alias("address_id"),
        F.transform("lines", lambda text: F.from_json(text, kind)).alias("lines"),
        "n_late",
        "complete",
    )
    nameless = lines.where(F.col("order_id").isNull()).select(
        "order_id",
        "address_id",
        F.array(F.struct(*LINE)).alias("lines"),
        F.lit(0).cast("long").alias("n_late"),
        F.lit(False).alias("complete"),
    )
    return orders.unionByName(nameless)
