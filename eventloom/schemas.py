"""Record shapes shared by sources, operators and payloads."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

FRAME = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("function", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("in_app", T.BooleanType()),
])

CRUMB = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("data", STRING_MAP),
    T.StructField("timestamp", T.TimestampType()),
])

CONTEXT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("http_method", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("session_hash", T.StringType()),
    T.StructField("runtime", T.StringType()),
    T.StructField("server", STRING_MAP),
    T.StructField("user", STRING_MAP),
    T.StructField("extra", STRING_MAP),
])

EVENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("level", T.StringType()),
    T.StructField("environment", T.StringType()),
    T.StructField("release", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("tags", STRING_MAP),
    T.StructField("context", CONTEXT),
    T.StructField("stack_trace", T.ArrayType(FRAME)),
    T.StructField("breadcrumbs", T.ArrayType(CRUMB)),
    T.StructField("partial", T.BooleanType()),
])

# Columns that place an event in a sender's stream; seq is unique within a sender and a flush.
ROUTING = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("sender_id", T.StringType()),
    T.StructField("flush_id", T.StringType()),
    T.StructField("scope_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

# One JSON line of an event file. The three map-like members stay text because an empty map
# is written as [] there.
EVENT_LINE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("level", T.StringType()),
    T.StructField("environment", T.StringType()),
    T.StructField("release", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partial", T.BooleanType()),
    T.StructField("tags", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("stack_trace", T.ArrayType(FRAME)),
    T.StructField("breadcrumbs", T.ArrayType(T.StructType([
        T.StructField("category", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]))),
    T.StructField("_corrupt_record", T.StringType()),
])
