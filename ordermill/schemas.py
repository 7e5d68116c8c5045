"""Table and event schemas.

The column names, their order, their types and the constants are fixed values:
they have to match the tables and events that users already have.
"""

from pyspark.sql import types as T

STRING, DATE, INT = T.StringType(), T.DateType(), T.IntegerType()
FLOAT, DOUBLE = T.FloatType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- fixed values -----------------------------------------------------------
clients_address_schema = _struct(
    client_id=STRING,
    first_name=STRING,
    last_name=STRING,
    email=STRING,
    phone_number=STRING,
    date_of_birth=DATE,
    gender=STRING,
    occupation=STRING,
    created_at=DATE,
    updated_at=DATE,
    status=STRING,
    address_id=STRING,
    neighborhood=STRING,
    coordinates=T.ArrayType(DOUBLE),
    road=STRING,
    house_number=STRING,
    suburb=STRING,
    city_district=STRING,
    state=STRING,
    postcode=STRING,
    country=STRING,
    lat=FLOAT,
    lon=FLOAT,
)

component_schema = _struct(package_id=STRING, subpackage_id=INT, package_quantity=INT)

products_schema = _struct(
    product_id=STRING,
    name=STRING,
    category=STRING,
    url=STRING,
    price=FLOAT,
    currency=STRING,
).add("product_components", T.ArrayType(component_schema, False), nullable=False)

packages_schema = _struct(
    package_id=STRING,
    subpackage_id=INT,
    name=STRING,
    width=INT,
    height=INT,
    length=INT,
    weight=FLOAT,
    volume=INT,
).add("stock_quantity", INT, nullable=False)

package_entry_schema = _struct(
    package_id=STRING,
    subpackage_id=INT,
    quantity=INT,
    weight=DOUBLE,
    volume=DOUBLE,
)

item_schema = _struct(
    product_id=STRING,
    product_name=STRING,
    price=DOUBLE,
    quantity=INT,
    packages=T.ArrayType(package_entry_schema),
)

destination_address_schema = _struct(
    address_id=STRING,
    neighborhood=STRING,
    coordinates=T.ArrayType(DOUBLE),
    road=STRING,
    house_number=STRING,
    suburb=STRING,
    city_district=STRING,
    state=STRING,
    postcode=STRING,
    country=STRING,
    lat=DOUBLE,
    lon=DOUBLE,
)

payment_details_schema = _struct(
    payment_method=STRING, payment_status=STRING, transaction_id=STRING
)

order_details_schema = _struct(
    customer_id=STRING,
    order_timestamp=STRING,
    order_date=STRING,
    items=T.ArrayType(item_schema),
    total_amount=DOUBLE,
    total_volume=DOUBLE,
    total_weight=DOUBLE,
    status=STRING,
    destination_address=destination_address_schema,
    payment_details=payment_details_schema,
)

order_event_schema = _struct(
    event_id=STRING,
    event_type=STRING,
    event_timestamp=STRING,
    order_id=STRING,
    order_details=order_details_schema,
)

COMPONENT_COLUMNS = [
    "product_id",
    "product_quantity",
    "package_id",
    "subpackage_id",
    "product_name",
    "price",
    "package_quantity",
    "width",
    "height",
    "length",
    "weight",
    "volume",
]

EVENT_TYPE = "ORDER_CREATED"
ORDER_STATUS = "RECEIVED"
EVENT_ID_PREFIX = "ev-"
ORDER_ID_PREFIX = "ord-"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
# --- end of fixed values ----------------------------------------------------

ADDRESS_COLUMNS = destination_address_schema.names
