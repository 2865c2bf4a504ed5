"""Log records: interpolation, scrubbing, wire form and batches."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.levels import log_level
from ..functions.redact import scrub_text
from ..functions.text import (
    cap_bytes, empty_map, interpolate, is_scalar, placeholder_values, scalar_text, timestamp_text)
from .scrub import scrub_fields
from .slices import ROWS_PER_SLICE, numbered

# Byte caps of a log entry.
MESSAGE_BYTES = 65536
APP_NAME_BYTES = 48
ENVIRONMENT_BYTES = 64
CONTEXT_KEY_BYTES = 256
CONTEXT_VALUE_BYTES = 65536

BATCH_SIZE = 1000
FALLBACK_MESSAGE = "<unserializable log entry>"


def interpolate_messages(df: DataFrame, safe_fragments: Sequence[str] | None = None) -> DataFrame:
    """Fill ``{key}`` placeholders from the context. As the raw context is used, a secret named
    in a template ends up in the text; ``safe_fragments`` fills in scrubbed values instead."""
    source = df if safe_fragments is None else scrub_fields(
        df.withColumn("__values", F.col("context")), ["__values"], safe_fragments)
    column = "context" if safe_fragments is None else "__values"
    values = placeholder_values(F.col(column), source.schema[column].dataType)
    return source.withColumn("message", interpolate(F.col("message"), values)).drop("__values")


@F.pandas_udf(T.StringType())
def _escaped_json(texts: pd.Series) -> pd.Series:
    """JSON text with every non-ASCII character and slash escaped."""
    return texts.map(lambda t: None if t is None else json.dumps(
        json.loads(t), separators=(",", ":")).replace("/", "\\/"))


def stringify_context(col: Column, dtype: T.DataType, escape_unicode: bool = False) -> Column:
    """Context values as text: words for booleans, '' for null, ``Class: message`` for errors,
    JSON for other nested values. Slashes in that JSON are escaped; non-ASCII characters only
    with ``escape_unicode``, which needs a Python step."""

    def one(value: Column, kind: T.DataType) -> Column:
        if is_scalar(kind):
            return scalar_text(value, kind)
        if isinstance(kind, T.StructType) and set(kind.names) == {"class", "message"}:
            return F.coalesce(F.concat(value["class"], F.lit(": "), value["message"]), F.lit(""))
        text = F.to_json(value)
        text = _escaped_json(text) if escape_unicode else F.replace(text, F.lit("/"), F.lit("\\/"))
        return F.coalesce(text, F.lit(""))

    if isinstance(dtype, T.StructType):
        parts = [x for f in dtype.fields
                 for x in (F.lit(f.name), one(col.getField(f.name), f.dataType))]
        return F.when(col.isNotNull(), F.create_map(*parts) if parts else empty_map())
    if escape_unicode and not is_scalar(dtype.valueType):
        raise ValueError("escape_unicode needs a struct context")
    return F.transform_values(col, lambda _, v: one(v, dtype.valueType))


def _capped(context: Column) -> Column:
    """Cap keys and values; of keys equal after the cap the last one stays."""
    entries = F.transform(F.map_entries(context), lambda e: F.struct(
        cap_bytes(e["key"], CONTEXT_KEY_BYTES).alias("key"),
        cap_bytes(e["value"], CONTEXT_VALUE_BYTES).alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(
        F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), e["key"]))
    over = F.exists(F.map_entries(context), lambda e: (
        F.octet_length(e["key"]) > CONTEXT_KEY_BYTES)
        | (F.octet_length(e["value"]) > CONTEXT_VALUE_BYTES))
    return F.when(F.size(context) > 0, F.when(over, F.map_from_entries(last)).otherwise(context))


def to_log_wire(df: DataFrame, name: str = "wire", escape_unicode: bool = False) -> DataFrame:
    """Add the wire struct of each record. A record that is not valid UTF-8 becomes a fixed
    fallback entry, so it cannot spoil its batch."""
    text = stringify_context(F.col("context"), df.schema["context"].dataType, escape_unicode)

    def filled(column: str, limit: int) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("string")
        return F.when(F.col(column) != "", cap_bytes(F.col(column), limit))

    wire = F.struct(
        log_level(F.col("level")).alias("severity"),
        cap_bytes(F.col("message"), MESSAGE_BYTES).alias("message"),
        timestamp_text(F.col("timestamp")).alias("timestamp"),
        filled("app_name", APP_NAME_BYTES).alias("app_name"),
        filled("environment", ENVIRONMENT_BYTES).alias("environment"),
        _capped(F.col("__context")).alias("context"))
    none = F.lit(None).cast("string")
    fallback = F.struct(
        F.lit("info").alias("severity"), F.lit(FALLBACK_MESSAGE).alias("message"),
        none.alias("timestamp"), none.alias("app_name"), none.alias("environment"),
        F.lit(None).cast("map<string,string>").alias("context"))
    valid = lambda c: F.coalesce(F.is_valid_utf8(c), F.lit(True))
    readable = F.coalesce(F.is_valid_utf8("message"), F.lit(True)) & F.coalesce(F.forall(
        F.map_entries("__context"), lambda e: valid(e["key"]) & valid(e["value"])), F.lit(True))
    for column in ("app_name", "environment"):
        readable = readable & valid(F.col(column)) if column in df.columns else readable
    return df.withColumn("__context", text).withColumn(
        name, F.when(readable, wire).otherwise(fallback)).drop("__context")


def build_log_records(
    df: DataFrame, fragments: Sequence[str], literals: Sequence[str] = (),
    app_name: str | None = None, environment: str | None = None,
    max_scan_bytes: int | None = None,
) -> DataFrame:
    """Scrub context and message, normalise the level and stamp application and environment."""
    return scrub_fields(df, ["context"], fragments).withColumns({
        "level": log_level(F.col("level")),
        "message": scrub_text(F.col("message"), literals, max_scan_bytes),
        "app_name": F.lit(app_name).cast("string"),
        "environment": F.lit(environment).cast("string"),
    })


def build_log_batches(
    df: DataFrame, size: int = BATCH_SIZE, wire: str = "wire", group: str = "flush_id",
    order: str = "seq", rows_per_slice: int = ROWS_PER_SLICE, place: str | None = None,
) -> DataFrame:
    """One JSON body per batch of at most ``size`` records of a flush, in buffer order.

    ``place`` names a column with the record's position in its flush, from 0, where that is known.
    Otherwise records are numbered in slices, so a flush of any size is cut into batches by many
    tasks. No task gathers more than one batch of a group at a time.
    """
    entry = F.to_json(wire).alias("__entry")
    if place is None:
        placed = numbered(df.select(group, order, entry), [group], order, "__place", rows_per_slice)
    else:
        placed = df.select(group, order, entry, F.col(place).alias("__place"))
    batches = placed.groupBy(group, F.floor(F.col("__place") / size).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sort_array(F.collect_list(F.struct("__place", "__entry"))).alias("__entries"))
    body = F.concat(F.lit('{"logs":['), F.array_join(F.col("__entries.__entry"), ","), F.lit("]}"))
    return batches.select(group, "batch_no", "records", body.alias("body"))
