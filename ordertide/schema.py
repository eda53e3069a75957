"""Declared schemas of raw orders and of the change feed."""

from pyspark.sql import types as T

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("country", T.StringType()),
])

FEED_COLUMNS = [
    T.StructField("_action", T.StringType()),
    T.StructField("_is_update", T.BooleanType()),
    T.StructField("_seq", T.LongType()),
]


def feed_schema(table: T.StructType) -> T.StructType:
    """Schema of the change feed of a table."""
    return T.StructType(list(table.fields) + FEED_COLUMNS)
