"""Rows of exceptions, messages and runtime errors as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.levels import errno_name, errno_severity, severity
from ..functions.text import empty_map, non_blank
from ..schemas import CONTEXT, CRUMB, EVENT, FRAME
from .gates import drop_suppressed, fatal_only

MAX_PARSED_FRAMES = 100
MAX_HANDLER_FRAMES = 50


def normalize_frames(col: Column, dtype: T.DataType, mode: str = "parser") -> Column:
    """Stack frames in the event shape; call arguments are not part of it.

    ``parser`` keeps 100 frames, fills gaps with ''/0 and tells own code from vendor code.
    ``handler`` keeps 50 and leaves gaps null except the function name.
    """
    names = {f.name for f in dtype.elementType.fields}

    def get(frame: Column, name: str, kind: str) -> Column:
        return frame[name].cast(kind) if name in names else F.lit(None).cast(kind)

    def parsed(frame: Column) -> Column:
        file = F.coalesce(get(frame, "file", "string"), F.lit(""))
        own = (file != "") & ~F.contains(file, F.lit("/vendor/"))
        return F.struct(
            file.alias("file"),
            F.coalesce(get(frame, "line", "int"), F.lit(0)).alias("line"),
            *[F.coalesce(get(frame, n, "string"), F.lit("")).alias(n)
              for n in ("function", "class", "type")],
            own.alias("in_app"))

    def handled(frame: Column) -> Column:
        return F.struct(
            get(frame, "file", "string").alias("file"),
            get(frame, "line", "int").alias("line"),
            F.coalesce(get(frame, "function", "string"), F.lit("<unknown>")).alias("function"),
            get(frame, "class", "string").alias("class"),
            F.lit(None).cast("string").alias("type"),
            F.lit(None).cast("boolean").alias("in_app"))

    shape, limit = ((parsed, MAX_PARSED_FRAMES) if mode == "parser"
                    else (handled, MAX_HANDLER_FRAMES))
    frames = F.transform(F.slice(col, 1, limit), shape)
    return F.coalesce(frames, F.array().cast(T.ArrayType(FRAME)))


def _events(df: DataFrame, used: set[str], **columns: Column) -> DataFrame:
    """Event columns in schema order, then every input column that was not used up."""
    defaults = {
        "tags": empty_map(),
        "context": F.lit(None).cast(CONTEXT),
        "stack_trace": F.array().cast(T.ArrayType(FRAME)),
        "breadcrumbs": F.array().cast(T.ArrayType(CRUMB)),
        "partial": F.lit(False),
    }
    members = []
    for f in EVENT.fields:
        if f.name in columns:
            members.append(columns[f.name].alias(f.name))
        elif f.name in df.columns and f.name not in used:
            members.append(F.col(f.name))
        else:
            members.append(defaults[f.name].alias(f.name))
    names = {f.name for f in EVENT.fields}
    rest = [c for c in df.columns if c not in names and c not in used]
    return df.select(*members, *rest)


def from_exceptions(
    df: DataFrame, environment: str = "production", release: str | None = None, caught: bool = True
) -> DataFrame:
    """Rows (class, message, file, line, timestamp, trace) as ``error`` events."""
    mode = "parser" if caught else "handler"
    frames = normalize_frames(F.col("trace"), df.schema["trace"].dataType, mode)
    return _events(
        df, {"class", "trace"},
        type=F.col("class"), message=F.col("message"), file=F.col("file"),
        line=F.col("line").cast("int"), level=F.lit("error"), environment=F.lit(environment),
        release=F.lit(release).cast("string"), timestamp=F.col("timestamp").cast("timestamp"),
        stack_trace=frames)


def from_messages(
    df: DataFrame, level: Column | str = "info", environment: str = "production",
    release: str | None = None,
) -> DataFrame:
    """Rows (message, timestamp) as events without a place in the code."""
    level = F.lit(level) if isinstance(level, str) else level
    return _events(
        df, set(),
        type=F.lit("message"), message=F.col("message"), file=F.lit(""), line=F.lit(0),
        level=severity(level), environment=F.lit(environment),
        release=F.lit(release).cast("string"), timestamp=F.col("timestamp").cast("timestamp"))


def from_raw_errors(
    df: DataFrame, reporting_mask: Column | int = -1, environment: str = "production",
    release: str | None = None,
) -> DataFrame:
    """Runtime errors (errno, message, file, line) that are not suppressed."""
    kept = drop_suppressed(df, reporting_mask)
    frames = {}
    if "trace" in df.columns:
        frames["stack_trace"] = normalize_frames(
            F.col("trace"), df.schema["trace"].dataType, "handler")
    return _events(
        kept, {"errno", "trace"},
        type=errno_name(F.col("errno")), message=F.col("message"), file=F.col("file"),
        line=F.col("line").cast("int"), level=errno_severity(F.col("errno")),
        environment=F.lit(environment), release=F.lit(release).cast("string"),
        timestamp=F.col("timestamp").cast("timestamp"), **frames)


def from_fatals(
    df: DataFrame, environment: str = "production", release: str | None = None
) -> DataFrame:
    """Last errors that ended a process. Running out of memory marks the event partial and
    replaces its tags."""
    fatal = fatal_only(df)
    oom = F.contains(F.col("message"), F.lit("Allowed memory size"))
    marks = F.create_map(F.lit("oom"), F.lit("true"), F.lit("partial"), F.lit("true"))
    tags = F.col("tags") if "tags" in df.columns else empty_map()
    return _events(
        fatal, {"errno", "tags"},
        type=non_blank(errno_name(F.col("errno")), "FatalError"),
        message=non_blank(F.col("message"), "<no message>"),
        file=non_blank(F.col("file"), "<unknown>"),
        line=F.greatest(F.lit(1), F.col("line").cast("int")), level=F.lit("fatal"),
        environment=F.lit(environment), release=F.lit(release).cast("string"),
        timestamp=F.col("timestamp").cast("timestamp"),
        tags=F.when(oom, marks).otherwise(tags), partial=F.coalesce(oom, F.lit(False)))
