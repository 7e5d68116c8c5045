"""Order lines to order documents.

One order makes one document. Every order that comes in leaves as accepted or
as rejected with a reason, whatever the policy for empty products.
"""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.documents import (
    as_of_column,
    date_text,
    destination_address,
    payment_details,
    timestamp_text,
)
from ordermill.functions.exact import exact_sum
from ordermill.functions.totals import item_total, package_measure_total
from ordermill.operators.groups import RUN, check_limit, collect_entries, number_parts, one_per_key
from ordermill.operators.joins import lookup_join
from ordermill.schemas import ADDRESS_COLUMNS, ORDER_STATUS

ON_EMPTY = ("drop_order", "drop_item", "keep")
TOTALS = ["total_amount", "total_volume", "total_weight"]
FLAGS = ["unknown", "empty", "incomplete"]
HEADER = ["as_of", "known_client", "customer_id", "destination_address"]

# Reasons for which an order is rejected, in the order in which they are checked.
NO_ORDER = "no_order_id"
NO_LINES = "no_lines"
UNKNOWN_PRODUCT = "unknown_product"
EMPTY_PRODUCT = "empty_product"
NULL_VALUE = "null_value"
UNKNOWN_CLIENT = "unknown_client"
# Lines of a stream that came after their order was closed.
LATE_LINE = "late_line"


class Orders(NamedTuple):
    """Finished orders, and ``order_id``, ``reason``, ``n_lines`` of those rejected.

    Lines and orders without an id are one rejected row with their number of lines.
    """

    accepted: DataFrame
    rejected: DataFrame


def attach_products(
    lines: DataFrame, products: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """Give each line its product; a line of an unknown product stays, with nulls.

    ``products`` is made by ``build_items`` or ``product_measures``.
    """
    return lookup_join(lines, products, ["product_id"], "left", small=small)


def client_addresses(clients: DataFrame) -> DataFrame:
    """One client and address per ``address_id``."""
    others = [c for c in ADDRESS_COLUMNS if c != "address_id"]
    return one_per_key(
        clients.select("address_id", "client_id", *others), "address_id"
    ).select(
        "address_id",
        F.col("client_id").alias("customer_id"),
        destination_address().alias("destination_address"),
        F.lit(True).alias("known_client"),
    )


def attach_client(
    orders: DataFrame, addresses: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """Give each order (``order_id``, ``address_id``) its client and address.

    ``addresses`` is made by ``client_addresses``.
    """
    return lookup_join(orders, addresses, ["address_id"], "left", small=small)


def _check_policy(on_empty: str) -> None:
    if on_empty not in ON_EMPTY:
        raise ValueError(f"on_empty must be one of {ON_EMPTY}, got {on_empty!r}")


def _line_flags(lines: DataFrame, on_empty: str) -> DataFrame:
    """Flag each line; ``kept`` is false where the policy drops it."""
    empty = F.coalesce("is_empty", F.lit(False))
    kept = ~empty if on_empty == "drop_item" else F.lit(True)
    missing = F.coalesce("has_null", F.lit(False)) | F.col("quantity").isNull()
    return lines.withColumns(
        {
            "unknown": F.col("is_empty").isNull(),
            "empty": empty,
            "kept": kept,
            "incomplete": missing & kept,
        }
    )


def _reason(on_empty: str) -> Column:
    reason = F.when(F.col("n_lines") == 0, NO_LINES).when(F.col("unknown"), UNKNOWN_PRODUCT)
    if on_empty == "drop_order":
        reason = reason.when(F.col("empty"), EMPTY_PRODUCT)
    elif on_empty == "drop_item":
        reason = reason.when(F.col("n_kept") == 0, EMPTY_PRODUCT)
    return reason.when(F.col("incomplete"), NULL_VALUE)


def without_id(lines: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """One rejected row for all lines and orders without an order id, if any."""
    stray = lines.where(F.col("order_id").isNull()).select(F.lit(1).alias("line"))
    if orders is not None:
        nameless = orders.where(F.col("order_id").isNull())
        stray = stray.unionByName(nameless.select(F.lit(0).alias("line")))
    counted = stray.agg(F.count("line").alias("n"), F.sum("line").alias("n_lines"))
    return counted.where("n > 0").select(
        F.lit(None).cast("string").alias("order_id"),
        F.lit(NO_ORDER).alias("reason"),
        "n_lines",
    )


def split_checked(checked: DataFrame, stray: DataFrame) -> Orders:
    """Part documents with a ``reason`` from those without."""
    rejected = checked.where(F.col("reason").isNotNull())
    if "part" in checked.columns:
        rejected = rejected.where("part = 0")
    kind = checked.schema["order_id"].dataType
    stray = stray.withColumn("order_id", F.col("order_id").cast(kind))
    rejected = rejected.select("order_id", "reason", "n_lines").unionByName(stray)
    accepted = checked.where(F.col("reason").isNull())
    return Orders(accepted.drop("reason", "n_lines", "n_kept", *FLAGS), rejected)


def order_totals(
    lines: DataFrame,
    measures: DataFrame,
    *,
    on_empty: str = "drop_order",
    small: bool | None = None,
    exact: bool = False,
) -> Orders:
    """Totals per order from flat rows (``measures`` from ``product_measures``).

    Nothing is collected: lines are summed before they are shuffled by order, so
    an order of any size will do. Sums of doubles depend on the order of rows in
    their last bits; with ``exact``, here and for the measures, they do not, and
    equal those of ``order_documents`` with ``exact``.
    """
    _check_policy(on_empty)
    narrow = lines.select("order_id", "product_id", "quantity")
    measured = _line_flags(attach_products(narrow, measures, small=small), on_empty)
    quantity = F.when(F.col("kept"), F.col("quantity").cast("double"))
    add = exact_sum if exact else F.sum
    totals = (
        measured.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if("kept").alias("n_kept"),
            add(quantity * F.col("price")).alias("total_amount"),
            add(quantity * F.coalesce("unit_volume", F.lit(0.0))).alias("total_volume"),
            add(quantity * F.coalesce("unit_weight", F.lit(0.0))).alias("total_weight"),
            *[F.max(flag).alias(flag) for flag in FLAGS],
        )
        .withColumn("n_items", F.col("n_kept"))
    )
    return split_checked(totals.withColumn("reason", _reason(on_empty)), without_id(lines))


def _documents(
    lines: DataFrame,
    items: DataFrame,
    on_empty: str,
    max_packages: int | None,
    items_small: bool | None,
    headers: DataFrame | None = None,
    exact: bool = False,
) -> DataFrame:
    """One row per order, or per part: items, totals, flags, counts and header.

    Headers are rows of the same fold as the lines, so documents are never joined
    or sorted, and an order that has only the one or the other is there too. Rows
    with their items are shuffled once, before they are folded.
    """
    rows = lines.where(F.col("order_id").isNotNull()).select(
        "order_id", "pos", "product_id", "quantity"
    )
    if max_packages is None:
        documents = _whole_orders(_by_order(rows, items, headers, items_small), on_empty)
    elif items_small:
        documents = _long_orders(rows, items, headers, on_empty, max_packages, items_small)
    else:
        # Orders of one run of positions are put in parts where they are folded, by the
        # same shuffle as whole ones; only longer ones are numbered by many tasks.
        long = rows.where(F.expr(f"pos div {RUN}") != 0).select("order_id").distinct()
        known = long.hint("shuffle_hash")
        short = _by_order(rows, items, headers, items_small).join(
            known.withColumn("long", F.lit(True)), "order_id", "left"
        )
        documents = _short_orders(short.where(F.col("long").isNull()), on_empty, max_packages)
        rows = rows.join(known, "order_id", "left_semi")
        if headers is not None:
            headers = headers.join(known, "order_id", "left_semi")
        documents = documents.unionByName(
            _long_orders(rows, items, headers, on_empty, max_packages, items_small)
        )
    measured = documents.withColumns(
        {
            "n_items": F.size("items").cast("bigint"),
            "total_amount": item_total(F.col("items"), exact=exact),
            "total_volume": package_measure_total(F.col("items"), "volume", exact=exact),
            "total_weight": package_measure_total(F.col("items"), "weight", exact=exact),
        }
    )
    numbers = ["part", "n_parts", "n_lines", "n_kept", "n_items"]
    return measured.select("order_id", *numbers, *TOTALS, "items", *FLAGS, "header")


def _item() -> Column:
    return F.struct("product_id", "product_name", "price", "quantity", "packages")


def _by_order(
    rows: DataFrame, items: DataFrame, headers: DataFrame | None, items_small: bool | None
) -> DataFrame:
    """Lines with their items, and the fields of headers as rows ``beside`` them, by order."""

    def with_headers(rows: DataFrame) -> DataFrame:
        if headers is None:
            nothing = F.lit(None).cast("boolean")
            return rows.withColumns({"beside": nothing, "header": nothing})
        # Field by field, so that those nobody asks for are not shuffled.
        fields = headers.select("order_id", F.lit(True).alias("beside"), "header.*")
        return rows.unionByName(fields, allowMissingColumns=True)

    if items_small:
        # The narrow rows are shuffled; the wide items are added behind that.
        return attach_products(with_headers(rows).repartition("order_id"), items, small=True)
    # Collected before the shuffle, rows would be written with their keys twice.
    return with_headers(attach_products(rows, items, small=items_small)).repartition("order_id")


def _header_fields(rows: DataFrame) -> list[str]:
    return [c for c in HEADER if c in rows.columns]


def _header(fields: list[str]) -> Column:
    return (F.struct(*fields) if fields else F.lit(None).cast("boolean")).alias("header")


def _whole_orders(rows: DataFrame, on_empty: str) -> DataFrame:
    """Rows of ``_by_order`` to one document per order."""
    rows, fields = _line_flags(rows, on_empty), _header_fields(rows)
    is_line = F.col("beside").isNull()
    folded = rows.groupBy("order_id").agg(
        collect_entries(
            ["pos", "product_id", "quantity"], F.when(is_line & F.col("kept"), _item())
        ).alias("items"),
        F.count_if(is_line).alias("n_lines"),
        F.count_if(is_line & F.col("kept")).alias("n_kept"),
        *[F.max(c).alias(c) for c in fields],
        *[F.coalesce(F.max(F.when(is_line, F.col(f))), F.lit(False)).alias(f) for f in FLAGS],
    )
    return folded.select(
        "order_id",
        "items",
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("n_parts"),
        "n_lines", "n_kept", _header(fields), *FLAGS,
    )


def _short_orders(rows: DataFrame, on_empty: str, max_packages: int) -> DataFrame:
    """Rows of ``_by_order`` to documents of parts, numbered as by ``number_parts``."""
    check_limit(max_packages)
    rows, fields = _line_flags(rows, on_empty), _header_fields(rows)
    is_line = F.col("beside").isNull()
    order = Window.partitionBy("order_id")
    placed = order.orderBy(is_line, F.coalesce("pos", F.lit(0)), "product_id", "quantity")
    weight = F.when(is_line, F.greatest(F.lit(1), F.size("packages")))
    before = F.sum(weight).over(placed.rowsBetween(Window.unboundedPreceding, -1))
    run = F.floor(F.coalesce(before, F.lit(0)) / F.lit(max_packages))
    begins = F.when(F.col("_run") != F.lag("_run").over(placed), 1).otherwise(0)
    # Numbers without gaps, though a row may be heavier than a part.
    number = F.sum("_begins").over(placed.rowsBetween(Window.unboundedPreceding, 0))
    whole = {
        "n_parts": F.max("part").over(order) + 1,
        "n_lines": F.count_if(is_line).over(order),
        "n_kept": F.count_if(is_line & F.col("kept")).over(order),
        **{c: F.max(c).over(order) for c in fields},
        **{f"any_{f}": F.coalesce(F.max(F.when(is_line, F.col(f))).over(order), F.lit(False)) for f in FLAGS},
    }
    numbered = rows.withColumn("_run", run).withColumn("_begins", begins).withColumn("part", number)
    folded = numbered.withColumns(whole).groupBy("order_id", "part").agg(
        collect_entries(
            [F.coalesce("pos", F.lit(0)).alias("pos"), "product_id", "quantity"],
            F.when(is_line & F.col("kept"), _item()),
        ).alias("items"),
        *[F.first(c).alias(c) for c in ("n_parts", "n_lines", "n_kept", *fields)],
        *[F.first(f"any_{f}").alias(f) for f in FLAGS],
    )
    return folded.select(
        "order_id", "items", "part", "n_parts", "n_lines", "n_kept", _header(fields), *FLAGS
    )


def _long_orders(
    rows: DataFrame,
    items: DataFrame,
    headers: DataFrame | None,
    on_empty: str,
    max_packages: int,
    items_small: bool | None,
) -> DataFrame:
    """Documents of parts that are numbered on narrow rows and shuffled by part."""
    keys = ["order_id", "part"]
    rows, beside = _parts(rows, items, headers, on_empty, max_packages, items_small)
    if items_small:
        rows = rows.unionByName(beside, allowMissingColumns=True).repartition(*keys)
        rows = attach_products(rows, items, small=True)
        rows = _line_flags(rows, on_empty).withColumn("item", _item())
    else:
        rows = _line_flags(attach_products(rows, items, small=items_small), on_empty)
        rows = rows.select(*keys, "pos", "kept", _item().alias("item"))
        rows = rows.unionByName(beside, allowMissingColumns=True).repartition(*keys)
    is_line = F.col("whole").isNull()
    folded = rows.groupBy(*keys).agg(
        collect_entries(
            ["pos", F.col("item.product_id"), F.col("item.quantity")],
            F.when(is_line & F.col("kept"), F.col("item")),
        ).alias("items"),
        F.max("whole").alias("whole"),
    )
    return folded.select("order_id", "items", "whole.*")


def _parts(
    rows: DataFrame,
    items: DataFrame,
    headers: DataFrame | None,
    on_empty: str,
    max_packages: int,
    items_small: bool | None,
) -> tuple[DataFrame, DataFrame]:
    """Narrow lines with the part that each belongs to, and one row for each part.

    The latter has in ``whole`` the flags, counts and header of the whole order and
    the numbers of the part, without gaps. No task holds an order.
    """
    sizes = items.select("product_id", "is_empty", "has_null", F.size("packages").alias("n_packages"))
    sized = attach_products(rows, sizes, small=items_small)
    sized = _line_flags(sized, on_empty).withColumn("pos", F.coalesce("pos", F.lit(0)))
    # In one column, so that the lines and the orders need the same columns and the
    # numbered rows are shuffled once for both.
    flags = ["kept", *FLAGS]
    bits = sum((F.col(f).cast("int") * (1 << k) for k, f in enumerate(flags)), F.lit(0))
    numbered = number_parts(
        sized.select("order_id", "pos", "product_id", "quantity", "n_packages", bits.alias("flags")),
        "order_id", "pos", ["product_id", "quantity"],
        F.greatest(F.lit(1), F.col("n_packages")), max_packages,
    ).drop("n_packages")

    def has(flag: str) -> Column:
        return F.col("flags").bitwiseAND(1 << flags.index(flag)) != 0

    told = numbered.select("order_id", "part", "flags")
    if headers is None:
        told = told.withColumn("header", F.lit(None).cast("boolean"))
    else:
        told = told.unionByName(
            headers.withColumn("part", F.lit(0).cast("bigint")), allowMissingColumns=True
        )
    whole = told.groupBy("order_id").agg(
        F.count("flags").alias("n_lines"),
        F.count_if(has("kept")).alias("n_kept"),
        F.max("header").alias("header"),
        *[F.coalesce(F.max(has(f)), F.lit(False)).alias(f) for f in FLAGS],
        F.array_sort(F.collect_set("part")).alias("parts"),
    )
    each = whole.select(
        "order_id",
        F.posexplode("parts").alias("number", "part"),
        "n_lines", "n_kept", "header", *FLAGS,
        F.size("parts").cast("bigint").alias("n_parts"),
    )
    numbers = [F.col("number").cast("bigint").alias("part"), "n_parts", "n_lines", "n_kept"]
    each = each.select("order_id", "part", F.struct(*numbers, "header", *FLAGS).alias("whole"))
    return numbered.drop("flags"), each


def order_documents(
    lines: DataFrame,
    items: DataFrame,
    *,
    on_empty: str = "drop_order",
    max_packages: int | None = None,
    items_small: bool | None = None,
    exact: bool = False,
) -> Orders:
    """Fold lines (``order_id, pos, product_id, quantity``) to nested orders.

    ``items`` come from ``build_items``. One order is one row. A caller whose
    orders do not fit a row may ask for parts of about ``max_packages`` packages:
    consecutive runs of ``pos``, each with the totals of its own items, so sums
    over parts are those of the order. All results have ``part`` and ``n_parts``.
    ``exact`` totals do not depend on the order of rows.
    """
    _check_policy(on_empty)
    documents = _documents(lines, items, on_empty, max_packages, items_small, exact=exact)
    checked = documents.drop("header").withColumn("reason", _reason(on_empty))
    return split_checked(checked, without_id(lines))


def check_orders(
    orders: DataFrame,
    lines: DataFrame,
    items: DataFrame,
    addresses: DataFrame,
    *,
    as_of: str | datetime | Column | None = None,
    on_empty: str = "drop_order",
    max_packages: int | None = None,
    items_small: bool | None = None,
    addresses_small: bool | None = None,
    exact: bool = False,
) -> DataFrame:
    """Complete orders, accepted and rejected together; null ``reason``: accepted."""
    _check_policy(on_empty)
    if as_of is None:
        # One moment for the run, however often and however late it is computed.
        as_of = datetime.now(timezone.utc)
    headers = one_per_key(
        orders.select("order_id", "address_id", as_of_column(as_of).alias("as_of")),
        "order_id",
    )
    headers = attach_client(headers, addresses, small=addresses_small)
    header = F.struct(*HEADER)
    documents = _documents(
        lines,
        items,
        on_empty,
        max_packages,
        items_small,
        headers.select("order_id", header.alias("header")),
        exact,
    )
    no_client = F.col("header.known_client").isNull()
    return documents.select(
        "order_id",
        "part",
        "n_parts",
        "n_lines",
        "header.as_of",
        F.struct(
            "header.customer_id",
            timestamp_text(F.col("header.as_of")).alias("order_timestamp"),
            date_text(F.col("header.as_of")).alias("order_date"),
            "items",
            *TOTALS,
            F.lit(ORDER_STATUS).alias("status"),
            "header.destination_address",
            payment_details().alias("payment_details"),
        ).alias("order_details"),
        _reason(on_empty).when(no_client, UNKNOWN_CLIENT).alias("reason"),
    )


def compose_orders(
    orders: DataFrame, lines: DataFrame, items: DataFrame, addresses: DataFrame, **options
) -> Orders:
    """Complete orders: ``order_id``, ``part``, ``n_parts``, ``as_of``, ``order_details``.

    ``orders`` has ``order_id`` and ``address_id``; ``as_of`` may be a column of
    it, a moment, or None for the time of this call. Of several rows with one
    ``order_id`` the least counts. Takes the options of ``check_orders``.
    """
    checked = check_orders(orders, lines, items, addresses, **options)
    return split_checked(checked, without_id(lines, orders))
