from ordermill.functions.documents import (
    as_of_column,
    date_text,
    destination_address,
    has_text_field,
    json_bytes,
    json_text,
    payment_details,
    timestamp_text,
)
from ordermill.functions.draws import (
    draw,
    keyed_id,
    random_id,
    reciprocal_choice,
    reciprocal_weights,
)
from ordermill.functions.exact import exact_sum, exact_total
from ordermill.functions.totals import (
    item_total,
    measure_or_one,
    package_measure_total,
)

__all__ = [
    "as_of_column",
    "date_text",
    "destination_address",
    "draw",
    "exact_sum",
    "exact_total",
    "has_text_field",
    "item_total",
    "json_bytes",
    "json_text",
    "keyed_id",
    "measure_or_one",
    "package_measure_total",
    "payment_details",
    "random_id",
    "reciprocal_choice",
    "reciprocal_weights",
    "timestamp_text",
]
