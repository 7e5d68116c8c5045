"""Product components, package measures and order items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.exact import exact_sum
from ordermill.functions.totals import measure_or_one
from ordermill.operators.groups import collect_entries
from ordermill.operators.joins import lookup_join

PACKAGE_KEYS = ["package_id", "subpackage_id"]
MEASURES = ["width", "height", "length", "weight", "volume"]


def explode_components(products: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """One row per product component.

    ``keep_empty`` keeps a product without components as a row whose
    ``component_pos`` is null.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return products.select(
        "product_id",
        F.col("name").alias("product_name"),
        "price",
        explode("product_components").alias("component_pos", "component"),
    ).select("product_id", "product_name", "price", "component_pos", "component.*")


def component_measures(
    products: DataFrame,
    packages: DataFrame,
    *,
    keep_empty: bool = False,
    packages_small: bool | None = None,
) -> DataFrame:
    """Components with the measures of their package, null where none matches."""
    return lookup_join(
        explode_components(products, keep_empty=keep_empty),
        packages.select(*PACKAGE_KEYS, *MEASURES),
        PACKAGE_KEYS,
        "left",
        small=packages_small,
    )


def _head() -> Column:
    """The row that names an item: one with components first, then the least."""
    missing = F.col("component_pos").isNull().alias("missing")
    return F.min(F.struct(missing, "product_name", "price"))


def _unit(measure: str, exact: bool) -> Column:
    add = exact_sum if exact else F.sum
    return add(
        F.when(
            F.col("component_pos").isNotNull(),
            F.col("package_quantity").cast("double") * measure_or_one(F.col(measure)),
        )
    )


def _quantity_missing() -> Column:
    return F.col("component_pos").isNotNull() & F.col("package_quantity").isNull()


def _named(df: DataFrame) -> DataFrame:
    """Replace ``head`` by the columns that the order operators use."""
    kept = [c for c in df.columns if c not in ("head", "has_null")]
    return df.select(
        *kept,
        F.col("head.product_name").alias("product_name"),
        F.col("head.price").cast("double").alias("price"),
        F.col("head.missing").alias("is_empty"),
        (F.col("has_null") | F.col("head.price").isNull()).alias("has_null"),
    )


def product_measures(
    products: DataFrame,
    packages: DataFrame,
    *,
    packages_small: bool | None = None,
    exact: bool = False,
) -> DataFrame:
    """One flat row per product: price, and volume and weight of one piece.

    ``exact`` sums do not depend on the order of rows.
    """
    components = component_measures(
        products, packages, keep_empty=True, packages_small=packages_small
    )
    return _named(
        components.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            _head().alias("head"),
            F.max(_quantity_missing()).alias("has_null"),
            _unit("volume", exact).alias("unit_volume"),
            _unit("weight", exact).alias("unit_weight"),
        )
    )


def build_items(
    products: DataFrame, packages: DataFrame, *, packages_small: bool | None = None
) -> DataFrame:
    """One document per product: name, price and ``packages`` in component order.

    Rows that share a ``product_id`` make one item.
    """
    position = ["product_name", "price", "component_pos"]
    entry = F.when(
        F.col("component_pos").isNotNull(),
        F.struct(
            "package_id",
            "subpackage_id",
            F.col("package_quantity").alias("quantity"),
            F.col("weight").cast("double").alias("weight"),
            F.col("volume").cast("double").alias("volume"),
        ),
    )
    components = component_measures(
        products, packages, keep_empty=True, packages_small=packages_small
    )
    return _named(
        components.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            _head().alias("head"),
            F.max(_quantity_missing()).alias("has_null"),
            collect_entries(position, entry).alias("packages"),
        )
    )
