from ordermill.operators.events import (
    conform,
    event_ids,
    split_valid,
    to_envelope,
    to_events,
)
from ordermill.operators.groups import number_parts, one_per_key
from ordermill.operators.items import (
    build_items,
    component_measures,
    explode_components,
    product_measures,
)
from ordermill.operators.joins import (
    fits_broadcast,
    lookup_by_key,
    lookup_join,
)
from ordermill.operators.orders import (
    Orders,
    attach_client,
    attach_products,
    check_orders,
    client_addresses,
    compose_orders,
    order_documents,
    order_totals,
    split_checked,
)
from ordermill.operators.sampling import RowIndex, dense_index, draw_rows
from ordermill.operators.skew import hot_join, hot_keys
from ordermill.operators.validate import document_faults, validate_documents

__all__ = [
    "Orders",
    "RowIndex",
    "attach_client",
    "attach_products",
    "build_items",
    "check_orders",
    "client_addresses",
    "component_measures",
    "compose_orders",
    "conform",
    "dense_index",
    "document_faults",
    "draw_rows",
    "event_ids",
    "explode_components",
    "fits_broadcast",
    "hot_join",
    "hot_keys",
    "lookup_by_key",
    "lookup_join",
    "number_parts",
    "one_per_key",
    "order_documents",
    "order_totals",
    "product_measures",
    "split_checked",
    "split_valid",
    "to_envelope",
    "to_events",
    "validate_documents",
]
