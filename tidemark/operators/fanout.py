"""Event bundles to per-topic messages, and the Kafka envelope codec.

A bundle ``{product_view, add_to_cart?, purchase?}`` becomes up to three
messages: the view always, the cart and purchase only when present. Key = the
member's user_id, value = the member as JSON, topic = the member's topic. The
Kafka sink routes rows by the ``topic`` column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import parse_utc, utc_instant

# Topic names of the three event kinds and of the journey output.
VIEW_TOPIC = "ecomm_product_view"
CART_TOPIC = "ecomm_cart"
BUY_TOPIC = "ecomm_buy"
JOURNEY_TOPIC = "ecomm_customer_journey"

_JSON_OPTS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_value(*cols: str | Column) -> Column:
    """The row (or the given columns) as a JSON object; NULL fields are written."""
    return F.to_json(F.struct(*cols), _JSON_OPTS)


def encode(df: DataFrame, topic: str | None = None, key: str | None = None,
           quote_key: bool = False) -> DataFrame:
    """Rows to ``key, value[, topic]`` for the Kafka sink.

    value = the whole row as JSON, key column included. key = the column as a
    string (``quote_key`` JSON-encodes it, as a JSON key serializer would), or
    NULL.
    """
    if key is None:
        k = F.lit(None).cast("string")
    elif quote_key:
        k = F.regexp_extract(F.to_json(F.struct(F.col(key).alias("k"))), r'^\{"k":(.*)\}$', 1)
    else:
        k = F.col(key).cast("string")
    out = [k.alias("key"), json_value("*").alias("value")]
    if topic is not None:
        out.append(F.lit(topic).alias("topic"))
    return df.select(*out)


_TIMES = (T.TimestampType, T.TimestampNTZType)


def _times_as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, _TIMES):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _times_as_text(f.dataType), True) for f in kind.fields])
    return kind


def _parsed(value: Column, kind: T.DataType, strict: bool = True) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return parse_utc(value, strict)
    if isinstance(kind, T.TimestampType):
        return utc_instant(parse_utc(value, strict))
    if isinstance(kind, T.StructType) and _times_as_text(kind) != kind:
        return F.when(value.isNotNull(), F.struct(*[_parsed(value[f.name], f.dataType, strict).alias(f.name) for f in kind.fields]))
    return value


def _no_time(value: Column, kind: T.DataType) -> Column:
    """Whether a text that should be a time is none."""
    if isinstance(kind, _TIMES):
        return value.isNotNull() & parse_utc(value, False).isNull()
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a | b, [_no_time(value[f.name], f.dataType) for f in kind.fields], F.lit(False))
    return F.lit(False)


def decode(envelope: DataFrame, schema: T.StructType | str, keep: tuple[str, ...] = (), on_malformed: str = "fail") -> DataFrame:
    """Kafka envelope rows to typed columns: ``from_json(value, schema)``.

    Times are read as text and parsed by ``parse_utc``, so every ISO-8601 style
    (``Z``, an offset, none, with or without a fraction) keeps its instant. JSON
    that does not parse, or a time that is none, fails the query; with
    ``on_malformed="keep"`` the message's text is in an extra column ``malformed``
    (NULL elsewhere), for the caller to route. ``keep`` carries envelope columns such as ``key`` or ``timestamp``.
    """
    if on_malformed not in ("fail", "keep"):
        raise ValueError(f"on_malformed must be fail or keep, not {on_malformed!r}")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text, read = F.col("value").cast("string"), _times_as_text(schema)
    if on_malformed == "keep":
        read = T.StructType([*read.fields, T.StructField("malformed", T.StringType())])
    mode = {"mode": "FAILFAST"} if on_malformed == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    rows = envelope.select(*keep, F.from_json(text, read, {**_JSON_OPTS, **mode}).alias("__v"), text.alias("__text"))
    out = [_parsed(F.col(f"__v.`{f.name}`"), f.dataType, on_malformed == "fail").alias(f.name) for f in schema.fields]
    if on_malformed == "keep":
        out.append(F.when(F.col("__v.malformed").isNotNull() | _no_time(F.col("__v"), schema), F.col("__text")).alias("malformed"))
    return rows.select(*keep, *out)


def fan_out(bundles: DataFrame) -> DataFrame:
    """One message per present bundle member: ``topic, key, value``."""
    members = F.array(
        F.struct(F.lit(VIEW_TOPIC).alias("topic"), F.col("product_view.user_id").alias("key"),
                 F.when(F.col("product_view").isNotNull(), F.to_json("product_view", _JSON_OPTS)).alias("value")),
        F.struct(F.lit(CART_TOPIC).alias("topic"), F.col("add_to_cart.user_id").alias("key"),
                 F.when(F.col("add_to_cart").isNotNull(), F.to_json("add_to_cart", _JSON_OPTS)).alias("value")),
        F.struct(F.lit(BUY_TOPIC).alias("topic"), F.col("purchase.user_id").alias("key"),
                 F.when(F.col("purchase").isNotNull(), F.to_json("purchase", _JSON_OPTS)).alias("value")),
    )
    return (bundles.select(F.explode(members).alias("m"))
            .where(F.col("m.value").isNotNull())
            .select("m.topic", "m.key", "m.value"))
