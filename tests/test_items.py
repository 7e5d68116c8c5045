from ordermill.operators import (
    build_items,
    component_measures,
    explode_components,
    product_measures,
)
from ordermill.operators.items import MEASURES
from tests.conftest import rows


def test_explode_drops_products_without_components(shop):
    exploded = explode_components(shop.products)
    assert exploded.columns == [
        "product_id", "product_name", "price", "component_pos",
        "package_id", "subpackage_id", "package_quantity",
    ]
    found = rows(exploded, "product_id", "component_pos", "package_id", "subpackage_id")
    assert ("lamp", 0, "box", 1) in found and ("lamp", 1, "box", 2) in found
    assert "void" not in {r[0] for r in found}
    kept = explode_components(shop.products, keep_empty=True)
    assert rows(kept.where("product_id = 'void'"), "component_pos", "package_id") == [(None, None)]


def test_unmatched_and_null_keys_keep_null_measures(shop):
    measured = component_measures(shop.products, shop.packages)
    lost = measured.where("product_id = 'lost'")
    assert rows(lost, "package_id", *MEASURES) == [
        ("bag", None, None, None, None, None),
        ("gone", None, None, None, None, None),
    ]
    lamp = rows(measured.where("product_id = 'lamp'"), "subpackage_id", *MEASURES)
    assert lamp == [(1, 1, 2, 3, 2.5, 10), (2, 2, 4, 6, None, None)]


def items_by_id(df):
    return {r.product_id: r for r in df.collect()}


def test_items(shop):
    items = items_by_id(build_items(shop.products, shop.packages))
    assert None not in items and len(items) == 7
    lamp = items["lamp"]
    assert lamp.price == 19.989999771118164
    assert [tuple(p) for p in lamp.packages] == [
        ("box", 1, 3, 2.5, 10.0),
        ("box", 2, 2, None, None),
    ]
    assert not lamp.is_empty and not lamp.has_null
    assert items["void"].is_empty and items["void"].packages == []
    assert items["void"].product_name == "Void"
    assert items["free"].has_null and items["odd"].has_null


def test_rows_of_one_product_merge_under_the_least_header(shop):
    twin = items_by_id(build_items(shop.products, shop.packages))["twin"]
    assert (twin.product_name, twin.price) == ("Twin A", 5.0)
    assert [(p.subpackage_id, p.quantity) for p in twin.packages] == [(2, 6), (1, 5)]


def test_an_empty_row_does_not_name_the_item(spark, shop):
    empty = spark.createDataFrame(
        [("twin", "A first", "home", None, 0.5, "EUR", [])], shop.products.schema
    )
    twin = items_by_id(build_items(shop.products.unionAll(empty), shop.packages))["twin"]
    assert twin.product_name == "Twin A" and not twin.is_empty


def test_unit_measures(shop):
    units = items_by_id(product_measures(shop.products, shop.packages))
    # Null measures count as one: 3 * 10 + 2 * 1 and 3 * 2.5 + 2 * 1.
    assert (units["lamp"].unit_volume, units["lamp"].unit_weight) == (32.0, 9.5)
    assert (units["lost"].unit_volume, units["lost"].unit_weight) == (5.0, 5.0)
    assert units["void"].is_empty and units["void"].unit_volume is None
    assert units["twin"].price == 5.0
