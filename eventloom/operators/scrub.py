"""Redaction of whole event rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.redact import MAX_DEPTH, json_is_readable, scrub_json, scrub_text, scrub_value


def scrub_fields(
    df: DataFrame, columns: Sequence[str], fragments: Sequence[str], depth: int = MAX_DEPTH,
    unreadable: str | None = None,
) -> DataFrame:
    """Mask fields by name inside the given columns: typed ones natively, STRING ones as JSON.

    JSON that cannot be read comes out as an empty list. ``unreadable`` names an array column that
    then lists the columns in question, for a quarantine or a count.
    """
    changed, broken = {}, []
    for name in columns:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.StringType):
            changed[name] = scrub_json(F.col(name), fragments, depth)
            broken.append(F.when(~json_is_readable(F.col(name)), F.lit(name)))
        else:
            changed[name] = scrub_value(F.col(name), dtype, fragments, depth)
    if unreadable is not None:
        none = F.array().cast("array<string>")
        changed[unreadable] = F.array_compact(F.array(*broken)) if broken else none
    return df.withColumns(changed)


def scrub_event(
    df: DataFrame, fragments: Sequence[str], literals: Sequence[str] | Column = (),
    max_scan_bytes: int | None = None,
) -> DataFrame:
    """Message by token shape, context and tags by name, breadcrumbs both ways. Type, file,
    release, frames and breadcrumb categories stay as they are."""
    fields = [c for c in ("context", "tags") if c in df.columns]
    out = scrub_fields(df, fields, fragments)
    changed = {"message": scrub_text(F.col("message"), literals, max_scan_bytes)}
    if "breadcrumbs" in df.columns:
        crumb_type = df.schema["breadcrumbs"].dataType.elementType

        def one(crumb):
            members = []
            for f in crumb_type.fields:
                value = crumb[f.name]
                if f.name == "message":
                    value = scrub_text(value, literals, max_scan_bytes)
                elif f.name == "data":
                    value = scrub_value(value, f.dataType, fragments)
                members.append(value.alias(f.name))
            return F.struct(*members)

        changed["breadcrumbs"] = F.transform("breadcrumbs", one)
    return out.withColumns(changed)


def scrub_fatal(
    df: DataFrame, literals: Sequence[str] | Column = (), max_scan_bytes: int | None = None
) -> DataFrame:
    """The lean variant for out-of-memory rows: message and file only."""
    return df.withColumns({
        name: scrub_text(F.col(name), literals, max_scan_bytes) for name in ("message", "file")})


def with_project_literals(
    df: DataFrame, secrets: DataFrame, project: str = "project_id", secret: str = "secret", name: str = "literals"
) -> DataFrame:
    """Add the secrets of each row's project as an array for ``scrub_text`` and ``scrub_event``.

    ``secrets`` has one row per secret, as many projects as there are; longer secrets come first, so one
    inside another doesn't break it up. Rows without a project, or of one without secrets, get none.
    """
    listed = secrets.where(F.col(secret).isNotNull() & (F.col(secret) != "")).groupBy(project).agg(
        F.transform(F.sort_array(F.collect_set(F.struct(F.length(secret).alias("n"), F.col(secret).alias("v"))), False),
                    lambda s: s["v"]).alias(name))
    return df.drop(name).join(listed, project, "left").select(*[c for c in df.columns if c != name], name)
