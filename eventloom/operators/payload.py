"""The wire form of events: placeholders, caps and promoted context members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.net import is_ip
from ..functions.text import (
    merge_maps, non_blank, text_map, timestamp_text, truncate_chars)

MAX_PAYLOAD_FRAMES = 250
MAX_PAYLOAD_CRUMBS = 50

# The request methods that are passed on.
HTTP_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")


def context_text(context: Column, dtype: T.DataType, *path: str) -> Column:
    """A text member of a context given as struct, map or JSON; null when absent or not text."""
    if isinstance(dtype, T.StringType):
        node = F.try_parse_json(context)
        place = "$" + "".join(f".{p}" for p in path)
        kind = F.schema_of_variant(F.try_variant_get(node, place, "variant"))
        return F.when(kind == "STRING", F.try_variant_get(node, place, "string"))
    value, kind = context, dtype
    for name in path:
        if isinstance(kind, T.StructType):
            if name not in kind.names:
                return F.lit(None).cast("string")
            value, kind = value.getField(name), kind[name].dataType
        elif isinstance(kind, T.MapType):
            value, kind = F.try_element_at(value, F.lit(name)), kind.valueType
        else:
            return F.lit(None).cast("string")
    return value if isinstance(kind, T.StringType) else F.lit(None).cast("string")


def promoted(context: Column, dtype: T.DataType) -> dict[str, Column]:
    """Members lifted out of the context; each is null unless it is valid."""
    get = lambda *path: context_text(context, dtype, *path)
    method, ip, session = get("http_method"), get("ip_address"), get("session_hash")
    return {
        "url": truncate_chars(get("url"), 2000),
        "http_method": F.when(method.isin(*HTTP_METHODS), method),
        "ip_address": F.when(is_ip(ip), ip),
        "session_hash": F.when(session.rlike(r"\A[a-f0-9]{64}\n?\z"), session),
        "server_name": truncate_chars(get("server", "SERVER_NAME"), 100),
        "runtime": truncate_chars(get("runtime"), 100),
    }


def promote_context(df: DataFrame, context: str = "context") -> DataFrame:
    return df.withColumns(promoted(F.col(context), df.schema[context].dataType))


def stringify_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Tags as text: true/false, '' for null, whole doubles without a fraction."""
    return df.withColumn(tags, text_map(F.col(tags), df.schema[tags].dataType))


def crumbs_to_wire(col: Column) -> Column:
    return F.transform(col, lambda c: F.struct(
        c["category"].alias("category"), c["message"].alias("message"),
        c["level"].alias("level"), c["data"].alias("data"),
        timestamp_text(c["timestamp"]).alias("timestamp")))


def to_error_payload(df: DataFrame, name: str = "payload") -> DataFrame:
    """Add the payload struct of each event. Texts are cut before the blank test; only the first
    50 breadcrumbs and 250 frames travel; optional members are null, which JSON leaves out."""
    context_type = df.schema["context"].dataType
    members = {
        "type": non_blank(truncate_chars(F.col("type"), 255), "<unknown>"),
        "message": non_blank(truncate_chars(F.col("message"), 1000), "<no message>"),
        "file": non_blank(truncate_chars(F.col("file"), 500), "<unknown>"),
        "line": F.greatest(F.lit(1), F.col("line")),
        "level": F.col("level"),
        "source": F.lit("backend"),
        "environment": truncate_chars(F.col("environment"), 100),
        "timestamp": timestamp_text(F.col("timestamp")),
        "tags": text_map(F.col("tags"), df.schema["tags"].dataType),
        "context": F.col("context"),
        "stack_trace": F.slice("stack_trace", 1, MAX_PAYLOAD_FRAMES),
        "breadcrumbs": crumbs_to_wire(F.slice("breadcrumbs", 1, MAX_PAYLOAD_CRUMBS)),
        "release": truncate_chars(F.col("release"), 255),
        **promoted(F.col("context"), context_type),
    }
    return df.withColumn(name, F.struct(*[c.alias(n) for n, c in members.items()]))


def event_to_row(df: DataFrame) -> DataFrame:
    """The thirteen members of an event line, maps as JSON text with [] for an empty one."""

    def as_json(col: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StringType):
            return F.coalesce(col, F.lit("[]"))
        text = F.coalesce(F.to_json(col), F.lit("[]"))
        return F.when(text == "{}", "[]").otherwise(text)

    return df.select(
        "type", "message", "file", "line", "level", "environment", "release",
        timestamp_text(F.col("timestamp")).alias("timestamp"), "partial",
        as_json(F.col("tags"), df.schema["tags"].dataType).alias("tags"),
        as_json(F.col("context"), df.schema["context"].dataType).alias("context"),
        "stack_trace", crumbs_to_wire(F.col("breadcrumbs")).alias("breadcrumbs"))


def merge_context(df: DataFrame, collected: str, own: str = "context") -> DataFrame:
    """Collected context under the event's own, whose members win."""
    dtype = df.schema[own].dataType
    if isinstance(dtype, T.MapType):
        merged = merge_maps(F.col(collected), F.col(own))
    else:
        merged = F.struct(*[
            F.coalesce(F.col(own)[f.name], F.col(collected)[f.name]).alias(f.name)
            for f in dtype.fields])
    return df.withColumn(own, merged).drop(collected)
