"""Orders to tables, computed once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from ordermill.operators.events import to_events
from ordermill.operators.orders import check_orders, split_checked, without_id
from ordermill.plans.catalog import Catalog
from ordermill.scratch import kept
from ordermill.sources.runs import append_run, has_run
from ordermill.sources.tables import append_events


class Written(NamedTuple):
    """Whether the events and the rejected orders of a run were added by this call."""

    events: bool
    rejected: bool


def write_orders(
    orders: DataFrame,
    lines: DataFrame,
    catalog: Catalog,
    path: str,
    rejected_path: str,
    *,
    run: str,
    by_date: bool = False,
    **options,
) -> Written:
    """Append the events of ``orders`` to one table and the rejected to another.

    The batch counterpart of ``stream_orders``: ``check_orders`` runs once (with
    ``options``), and both tables are written from its kept result. Each gets the run
    whole or not at all; a call that is repeated with the same ``run`` adds what is
    missing and nothing twice, and computes nothing if nothing is missing.
    ``read_events`` and ``read_runs`` read them.
    """
    spark = orders.sparkSession
    if all(has_run(spark, table, run) for table in (path, rejected_path)):
        return Written(False, False)
    checked = check_orders(
        orders,
        lines,
        catalog.items,
        catalog.addresses,
        items_small=catalog.items_small,
        addresses_small=catalog.addresses_small,
        **options,
    )
    with kept(checked, "orders") as result:
        found = split_checked(result, without_id(lines, orders))
        # A run has one date, unless each order has its moment.
        events = append_events(
            to_events(found.accepted, run=run), path, by_date=by_date, run=run,
            few_dates=not isinstance(options.get("as_of"), Column),
        )
        return Written(events, append_run(found.rejected, rejected_path, run))
