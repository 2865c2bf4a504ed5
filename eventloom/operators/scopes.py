"""Scopes: tags, user, extra values and breadcrumbs that enrich events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import empty_map, merge_maps
from ..session import cut_lineage


def _non_empty(col: Column) -> Column:
    return F.coalesce(F.size(col) > 0, F.lit(False))


def _no_variants() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))


def _json_context(context: Column, user: Column, extra: Column) -> Column:
    """JSON text with ``user`` replaced and ``extra`` merged in."""
    node = F.try_parse_json(F.coalesce(context, F.lit("{}")))
    members = F.coalesce(F.try_variant_get(node, "$", "map<string,variant>"), _no_variants())
    old = F.coalesce(F.try_variant_get(node, "$.extra", "map<string,variant>"), _no_variants())
    added = F.transform_values(extra, lambda _, v: v.cast("variant"))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(extra, k)), added)

    def member(name: str, value: Column, present: Column) -> Column:
        return F.when(present, F.create_map(F.lit(name), F.to_variant_object(value))).otherwise(
            _no_variants())

    new = F.map_concat(member("user", user, _non_empty(user)),
                       member("extra", merged, _non_empty(extra)))
    return F.to_json(F.map_concat(
        F.map_filter(members, lambda k, _: ~F.map_contains_key(new, k)), new))


def apply_scope(events: DataFrame, scopes: DataFrame) -> DataFrame:
    """Merge each event's scope into it: scope tags and extra values win, a non-empty user
    replaces the event's, and scope breadcrumbs follow the event's own.

    ``scopes`` has one row per scope_id with the maps tags, user, extra and optionally the array
    breadcrumbs. ``context`` may be a struct with user and extra maps or JSON text.
    """
    has_crumbs = "breadcrumbs" in scopes.columns and "breadcrumbs" in events.columns
    names = ["tags", "user", "extra"] + (["breadcrumbs"] if has_crumbs else [])
    side = scopes.select("scope_id", *[F.col(n).alias(f"__scope_{n}") for n in names])
    joined = events.join(side, "scope_id", "left")

    user, extra = F.col("__scope_user"), F.col("__scope_extra")
    changed = {"tags": merge_maps(F.col("tags"), F.col("__scope_tags"))}
    dtype = events.schema["context"].dataType
    if isinstance(dtype, T.StructType):
        context = F.coalesce(F.col("context"), F.struct(*[
            F.lit(None).cast(f.dataType).alias(f.name) for f in dtype.fields]))
        context = context.withField(
            "user", F.when(_non_empty(user), user).otherwise(F.col("context.user")))
        context = context.withField(
            "extra", F.when(_non_empty(extra), merge_maps(F.col("context.extra"), extra))
            .otherwise(F.col("context.extra")))
        touched = _non_empty(user) | _non_empty(extra)
        changed["context"] = F.when(
            F.col("context").isNotNull() | touched, context)
    else:
        filled = _json_context(F.col("context"), user, extra)
        touched = _non_empty(user) | _non_empty(extra)
        changed["context"] = F.when(touched, filled).otherwise(F.col("context"))
    if has_crumbs:
        none = F.lit(None).cast(events.schema["breadcrumbs"].dataType)
        own = F.coalesce("breadcrumbs", F.slice(F.coalesce("__scope_breadcrumbs", none), 1, 0))
        changed["breadcrumbs"] = F.when(
            F.col("__scope_breadcrumbs").isNotNull(), F.concat(own, F.col("__scope_breadcrumbs"))
        ).otherwise(F.col("breadcrumbs"))
    return joined.withColumns(changed).select(*events.columns)


def layer_scopes(scopes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Resolve nested scopes: each starts as a copy of its parent and adds its own changes.

    Own tags and extra values win and an own non-empty user replaces the parent's. A row with
    ``reset`` true starts empty. In every round a scope takes in all that the scope it points to has taken
    in so far and points to where that one points, so a chain of n ancestors takes log2(n) + 1 rounds. A
    scope that is its own ancestor, or has more than ``max_depth`` ancestors where that is given, is an error;
    rows that are merged halfway are never returned. A parent without a row is empty, scope ids are unique.
    """
    reset = F.coalesce(F.col("reset"), F.lit(False)) if "reset" in scopes.columns else F.lit(False)
    maps = ("tags", "user", "extra")
    names = ("scope_id", *maps)
    rows = cut_lineage(scopes.select(
        "scope_id", F.when(~reset, F.col("parent_scope_id")).alias("__up"),
        F.when(~reset & F.col("parent_scope_id").isNotNull(), 1).otherwise(0).cast("long").alias("__depth"),
        *[F.coalesce(n, empty_map()).alias(n) for n in maps]), "scopes")
    done, open_rows = [rows.where("__up is null")], rows.where("__up is not null")
    reach, total = 1, None  # ancestors each open scope has taken in, itself included
    while left := open_rows.agg(F.count(F.lit(1)), F.max("__depth")).first():
        if not left[0]:
            break
        total = total or rows.count()
        if max_depth is not None and left[1] > max_depth:
            raise ValueError(f"a scope has more than {max_depth} ancestors")
        if reach > total:
            raise ValueError("a scope is its own ancestor")
        above = reduce(DataFrame.unionByName, done, open_rows).select(
            F.col("scope_id").alias("__up"), F.col("__up").alias("__next"), F.col("__depth").alias("__up_depth"),
            *[F.col(n).alias(f"__up_{n}") for n in maps])
        layered = cut_lineage(open_rows.join(above, "__up", "left").select(
            "scope_id", F.col("__next").alias("__up"),
            (F.col("__depth") + F.coalesce("__up_depth", F.lit(0))).alias("__depth"),
            merge_maps(F.col("__up_tags"), F.col("tags")).alias("tags"),
            F.when(_non_empty(F.col("user")), F.col("user"))
            .otherwise(F.coalesce("__up_user", empty_map())).alias("user"),
            merge_maps(F.col("__up_extra"), F.col("extra")).alias("extra")), "scopes")
        done.append(layered.where("__up is null"))
        open_rows = layered.where("__up is not null")
        reach *= 2
    out = reduce(DataFrame.unionByName, done)
    if max_depth is not None and out.where(F.col("__depth") > max_depth).limit(1).count():
        raise ValueError(f"a scope has more than {max_depth} ancestors")
    return out.select(*names)
