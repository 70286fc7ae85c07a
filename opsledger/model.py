"""Table schemas and the values every other module agrees on."""

from pyspark.sql import types as T

# Order statuses, in report order.
PENDING = "pending"
CONFIRMED = "confirmed"
CANCELLED = "cancelled"
STATUSES = (PENDING, CONFIRMED, CANCELLED)

# Finite upper bounds of the latency histogram, in seconds.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

# Defaults of the envelope and of a channel entry.
UNKNOWN_EVENT = "unknown"
DEFAULT_CHANNEL = "log"
DEFAULT_TEMPLATE = ""
DEAD_LETTER_BYTES = 200

ORDERS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

# Partition column of stored orders.
CREATED_DATE = "created_date"

ORDER_REQUESTS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

CHANNEL = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("template", T.StringType()),
        T.StructField("retry", T.IntegerType()),
        T.StructField("level", T.StringType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("event_type", T.StringType(), False),
        T.StructField("channels", T.ArrayType(CHANNEL), False),
    ]
)

SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
