"""Text helpers: blanks, truncation by characters or bytes, scalar rendering, interpolation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a blank test strips.
BLANKS = " \t\n\r\0\x0b"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_blanks(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def non_blank(col: Column, fallback: str) -> Column:
    return F.when(F.coalesce(strip_blanks(col), F.lit("")) == "", F.lit(fallback)).otherwise(col)


def truncate_chars(col: Column, limit: int) -> Column:
    return F.substring(col, 1, limit)


def cap_bytes(col: Column, limit: int) -> Column:
    """Longest prefix of at most ``limit`` bytes that does not split a character."""
    raw = F.encode(col, "UTF-8")

    def prefix(size: int) -> Column:
        return F.try_validate_utf8(F.substring(raw, 1, size).cast("string"))

    # A UTF-8 character has at most four bytes, so at most three bytes are a torn tail.
    cut = F.coalesce(*[prefix(max(limit - back, 0)) for back in range(4)], F.lit(""))
    return F.when(F.octet_length(col) <= limit, col).otherwise(F.when(col.isNotNull(), cut))


def timestamp_text(col: Column) -> Column:
    """ISO-8601 text with whole seconds and an offset."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ssxxx")


def _double_text(col: Column) -> Column:
    """A double with up to 14 significant digits: plain between 1e-4 and 1e14, else d.dE+x."""
    sci = F.format_string("%.13e", col)
    exponent = F.regexp_extract(sci, r"e([+-]\d+)$", 1).try_cast("int")
    sign = F.when(F.startswith(sci, F.lit("-")), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_extract(sci, r"^-?([\d.]+)e", 1), r"\.", "")
    short = F.regexp_replace(digits, "0+$", "")
    whole = F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, "0")
    fraction = F.regexp_replace(F.substring(digits, exponent + 2, F.lit(14)), "0+$", "")
    plain = F.when(
        exponent >= 0,
        F.concat(sign, whole, F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction))),
    ).otherwise(F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), short))
    mantissa = F.concat(
        F.substring(short, 1, 1), F.lit("."),
        F.when(F.length(short) == 1, "0").otherwise(F.substring(short, 2, 14)))
    power = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent).cast("string"))
    return (
        F.when(F.isnan(col), "NAN")
        .when(col == float("inf"), "INF")
        .when(col == float("-inf"), "-INF")
        .when(col == 0, F.when(F.startswith(col.cast("string"), F.lit("-")), "-0").otherwise("0"))
        .when((exponent < -4) | (exponent > 13), F.concat(sign, mantissa, F.lit("E"), power))
        .otherwise(plain)
    )


def scalar_text(col: Column, dtype: T.DataType, true: str = "true", false: str = "false") -> Column:
    """A scalar as text: booleans by the given words, null as '', whole doubles without '.0'."""
    if isinstance(dtype, T.BooleanType):
        text = F.when(col, F.lit(true)).otherwise(F.lit(false))
        return F.when(col.isNull(), F.lit("")).otherwise(text)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.coalesce(_double_text(col.cast("double")), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def is_scalar(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType, T.NullType))


def text_map(col: Column, dtype: T.DataType, true: str = "true", false: str = "false") -> Column:
    """A struct or map of scalars as MAP<STRING,STRING>; a null map becomes an empty one."""
    if isinstance(dtype, T.StructType):
        parts = [x for f in dtype.fields for x in (
            F.lit(f.name), scalar_text(col.getField(f.name), f.dataType, true, false))]
        filled = F.create_map(*parts) if parts else empty_map()
    else:
        filled = F.transform_values(
            col, lambda _, v: scalar_text(v, dtype.valueType, true, false))
    return F.when(col.isNull(), empty_map()).otherwise(filled)


def empty_map() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def merge_maps(base: Column, over: Column) -> Column:
    """Union of two maps where ``over`` wins; needs no session-wide duplicate-key policy."""
    base, over = F.coalesce(base, empty_map()), F.coalesce(over, empty_map())
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def interpolate(message: Column, values: Column) -> Column:
    """Replace ``{key}`` by ``values[key]`` in one pass; unknown keys and null values stay."""
    tokens = F.regexp_extract_all(message, F.lit(r"\{[^{}]*\}|[^{]+|\{"), F.lit(0))

    def swap(token: Column) -> Column:
        key = F.substring(token, F.lit(2), F.length(token) - 2)
        return F.when(
            F.startswith(token, F.lit("{")) & F.endswith(token, F.lit("}")),
            F.coalesce(F.try_element_at(values, key), token),
        ).otherwise(token)

    filled = F.array_join(F.transform(tokens, swap), "")
    usable = F.contains(message, F.lit("{")) & values.isNotNull()
    return F.when(usable, filled).otherwise(message)


def placeholder_values(col: Column, dtype: T.DataType) -> Column:
    """The replacement map of a log context: scalars by plain cast (true is 1, false is '')."""
    if isinstance(dtype, T.StructType):
        parts = []
        for f in dtype.fields:
            if is_scalar(f.dataType):
                value = col.getField(f.name)
                text = scalar_text(value, f.dataType, "1", "")
                parts += [F.lit(f.name), F.when(value.isNotNull(), text)]
        return F.create_map(*parts) if parts else empty_map()
    if is_scalar(dtype.valueType):
        return F.transform_values(
            col, lambda _, v: F.when(v.isNotNull(), scalar_text(v, dtype.valueType, "1", "")))
    return empty_map()


def in_order(items: Column, dtype: T.DataType, key: str, value: str) -> Column:
    """An array of (key, value) structs sorted by its unique key, reduced to the values."""
    if _is_sortable(dtype):
        return F.transform(F.sort_array(items), lambda x: x[value])
    by_key = F.array_sort(items, lambda a, b: F.signum(a[key] - b[key]).cast("int"))
    return F.transform(by_key, lambda x: x[value])


def _is_sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_is_sortable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _is_sortable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))
