"""Order totals over a nested ``items`` array.

Sums run in array order, so a total does not depend on how rows were shuffled. With
``exact`` they do not depend on any order, and equal those of flat rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions.exact import exact_total


def _product(*factors: Column) -> Column:
    result = F.lit(1.0)
    for factor in factors:
        result = result * factor.cast("double")
    return result


def measure_or_one(measure: Column) -> Column:
    """A missing measure counts as one."""
    return F.coalesce(measure.cast("double"), F.lit(1.0))


def item_total(items: Column, property_name: str = "price", *, exact: bool = False) -> Column:
    """Sum of quantity x property over the items."""
    if exact:
        return exact_total(F.transform(items, lambda i: _product(i["quantity"], i[property_name])))
    return F.aggregate(
        items,
        F.lit(0.0),
        lambda total, item: total + _product(item["quantity"], item[property_name]),
    )


def package_measure_total(
    items: Column,
    property_name: str = "volume",
    quantity: str = "quantity",
    *,
    exact: bool = False,
) -> Column:
    """Sum of item quantity x package quantity x measure over all packages."""
    if exact:
        # First the sum over one piece of the item, as flat rows have it.
        def piece(item: Column) -> Column:
            return exact_total(
                F.transform(
                    item["packages"],
                    lambda p: _product(p[quantity], measure_or_one(p[property_name])),
                )
            )

        return exact_total(F.transform(items, lambda i: _product(i[quantity], piece(i))))
    return F.aggregate(
        items,
        F.lit(0.0),
        lambda total, item: F.aggregate(
            item["packages"],
            total,
            lambda inner, package: inner
            + _product(
                item[quantity],
                package[quantity],
                measure_or_one(package[property_name]),
            ),
        ),
    )
