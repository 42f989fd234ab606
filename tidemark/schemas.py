"""StructType constants for the record models and the stored tables.

Every stored column is nullable, even the ones a model requires: storage does
not enforce NOT NULL.
"""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "tinyint": T.ByteType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
}


def _schema(fields: str) -> T.StructType:
    """``"name type, name type"`` with the plain type names above; all nullable."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in pairs])


def with_ntz(schema: T.StructType) -> T.StructType:
    """The same schema with ``timestamp`` fields as ``timestamp_ntz``."""
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType)
                                       else f.dataType, f.nullable) for f in schema.fields])


BOOKING = _schema(
    "booking_id string, agency_id string, customer_name string, flight_number string, "
    "departure_date timestamp, arrival_date timestamp, price double, currency string, status string"
)

CLICKSTREAM = _schema(
    "event_id string, user_id string, session_id string, event_type string, "
    "event_timestamp timestamp, page_url string, referrer_url string, user_agent string, "
    "ip_address string"
)

PRODUCT_VIEW = _schema(
    "event_id string, user_id string, view_product_id string, view_product_name string, "
    "view_category string, timestamp timestamp"
)

ADD_TO_CART = _schema(
    "event_id string, user_id string, cart_product_id string, cart_product_name string, "
    "cart_quantity bigint, price double, timestamp timestamp"
)

PURCHASE = _schema(
    "event_id string, user_id string, order_id string, purchase_product_id string, "
    "purchase_product_name string, purchase_quantity bigint, price double, timestamp timestamp, "
    "total_amount double, payment_method string"
)

# One generated bundle: a view, then optionally a cart and a purchase.
EVENT_BUNDLE = T.StructType([
    T.StructField("product_view", PRODUCT_VIEW, True),
    T.StructField("add_to_cart", ADD_TO_CART, True),
    T.StructField("purchase", PURCHASE, True),
])

# The message envelope of the Spark Kafka source.
KAFKA_ENVELOPE = _schema(
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

DIM_TIME = _schema("time_key timestamp, hour tinyint, day tinyint, month tinyint, year int")
DIM_PRODUCT = _schema("product_key string, price double, currency string")
DIM_CUSTOMER = _schema("customer_key string, agency_id string")
FACT_ORDERS = _schema(
    "order_id string, time_key timestamp, product_key string, customer_key string, price double"
)

CUSTOMER_JOURNEY = _schema(
    "event_id string, user_id string, view_product_id string, view_product_name string, "
    "view_category string, timestamp timestamp, cart_product_id string, cart_product_name string, "
    "cart_quantity bigint, price double, order_id string, purchase_product_id string, "
    "purchase_product_name string, purchase_quantity bigint, total_amount double, "
    "payment_method string"
)

KPI = _schema("kpi string, value double")

# The two KPI names.
KPI_NAMES = ("total_revenue", "active_sessions")
