"""Redaction of tokens in text, of named fields, and of query strings and URLs."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .net import url_is_malformed
from .text import bind

MASK = "[REDACTED]"
# The bound on scanned texts that a caller may ask for, and how deep names are followed.
SCAN_BOUND = 8192
MAX_DEPTH = 16

# Token patterns in the order they are applied. A look-behind after the literal
# start asks for a word boundary that knows ASCII letters only, which Java's own \b does not;
# with the literal first, Java searches for it instead of trying every position.
TOKEN_PATTERNS = (
    r"sk_log_(?<![A-Za-z0-9_]sk_log_)[A-Za-z0-9]+",
    r"pk_(?<![A-Za-z0-9_]pk_)[A-Za-z0-9]+",
    r"(?i)bearer(?<![A-Za-z0-9_]bearer)\s+[A-Za-z0-9._\-]+",
    r"AKIA(?<![A-Za-z0-9_]AKIA)[0-9A-Z]{16}(?![A-Za-z0-9_])",
    r"ghp_(?<![A-Za-z0-9_]ghp_)[A-Za-z0-9]+",
    r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----",
)
_MARKERS = ("sk_log_", "pk_", "AKIA", "ghp_", "PRIVATE KEY-----")


def scrub_text(
    col: Column, literals: Sequence[str] | Column = (), max_scan_bytes: int | None = None
) -> Column:
    """Mask literals, then known token shapes, in texts of any length. With ``max_scan_bytes``
    longer texts stay as they are, unmasked. ``literals`` may be an array column, masked in its order."""
    own = literals if isinstance(literals, Column) else None
    kept = [] if own is not None else [v for v in literals if v]
    masked = col
    for literal in kept:
        masked = F.replace(masked, F.lit(literal), F.lit(MASK))
    if own is not None:
        own = F.filter(F.coalesce(own, F.array().cast("array<string>")), lambda v: v.isNotNull() & (v != ""))
        masked = F.aggregate(own, masked, lambda text, v: F.replace(text, v, F.lit(MASK)))
    for pattern in TOKEN_PATTERNS:
        masked = F.regexp_replace(masked, pattern, F.lit("\\[REDACTED\\]"))
    # A byte search rules out most texts before six regular expressions run on them.
    suspicious = col.rlike("(?i)bearer")
    for marker in [*_MARKERS, *kept]:
        suspicious = F.contains(col, F.lit(marker)) | suspicious
    if own is not None:
        suspicious = F.exists(own, lambda v: F.contains(col, v)) | suspicious
    if max_scan_bytes is not None:
        suspicious = (F.octet_length(col) <= max_scan_bytes) & suspicious
    return F.when(suspicious, masked).otherwise(col)


def _fragment_pattern(fragments: Sequence[str]) -> str | None:
    kept = sorted({f.lower() for f in fragments if f})
    # Java's (?i) folds ASCII letters only, which is the folding wanted for names.
    return "(?i)(?:" + "|".join(re.escape(f) for f in kept) + ")" if kept else None


def is_sensitive(name: Column, fragments: Sequence[str]) -> Column:
    pattern = _fragment_pattern(fragments)
    return F.lit(False) if pattern is None else name.rlike(pattern)


def _name_is_sensitive(name: str, fragments: Sequence[str]) -> bool:
    lowered = name.lower()
    return any(f.lower() in lowered for f in fragments if f)


def scrub_value(
    col: Column, dtype: T.DataType, fragments: Sequence[str], depth: int = MAX_DEPTH
) -> Column:
    """Mask fields by name, walking the schema once while the plan is built.

    A masked field becomes STRING. In a map whose values are not text all values become text,
    nested ones as JSON. Containers below ``depth`` levels come out empty.
    """
    if isinstance(dtype, T.StructType):
        if depth <= 0:
            return F.lit(None).cast(dtype)
        fields = []
        for f in dtype.fields:
            inner = (F.lit(MASK) if _name_is_sensitive(f.name, fragments)
                     else scrub_value(col.getField(f.name), f.dataType, fragments, depth - 1))
            fields.append(inner.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.MapType):
        value_type = dtype.valueType
        if depth <= 0:
            return F.when(col.isNotNull(), F.map_filter(col, lambda k, v: F.lit(False)))

        def keep(v: Column) -> Column:
            if isinstance(value_type, T.StringType):
                return v
            inner = scrub_value(v, value_type, fragments, depth - 1)
            if isinstance(value_type, (T.StructType, T.MapType, T.ArrayType)):
                return F.to_json(inner)
            return inner.cast("string")

        return F.transform_values(
            col, lambda k, v: F.when(is_sensitive(k, fragments), F.lit(MASK)).otherwise(keep(v)))
    if isinstance(dtype, T.ArrayType):
        if depth <= 0:
            return F.when(col.isNotNull(), F.slice(col, 1, 0))
        if not isinstance(dtype.elementType, (T.StructType, T.MapType, T.ArrayType)):
            return col
        return F.transform(
            col, lambda v: scrub_value(v, dtype.elementType, fragments, depth - 1))
    return col


class _Raw(str):
    """A number or constant as it was written."""


class _Pairs(list):
    """The members of a JSON object in their order, repeated names included."""


def json_is_readable(col: Column) -> Column:
    """Whether a text is a JSON object or list; null for null."""
    return F.when(col.isNotNull(), col.rlike(r"(?s)^\s*[\[{].*[\]}]\s*$") & F.get_json_object(col, "$").isNotNull())


def scrub_json(col: Column, fragments: Sequence[str], depth: int = MAX_DEPTH, unreadable: str | None = "[]") -> Column:
    """Mask fields by name in JSON text of unknown shape.

    Texts that hold no fragment stay byte for byte as they are and never leave the JVM. In the others
    numbers, empty objects and repeated names are kept as written. Containers below ``depth`` levels
    become empty lists. A text that is no JSON object or list becomes ``unreadable``, so nothing can
    slip through; ``json_is_readable`` tells which ones.
    """
    kept = [f.lower() for f in fragments if f]
    quoted = json.encoder.encode_basestring_ascii

    class Names(dict):
        """A name as it is written, with the mask where it is sensitive; remembers a bounded number."""

        def __missing__(self, name):
            if len(self) >= 10_000:
                self.clear()
            lowered = name.lower()
            masked = any(f in lowered for f in kept)
            entry = self[name] = (quoted(name) + ":" + (f'"{MASK}"' if masked else ""), masked)
            return entry

    names = Names()

    def write(node, left):
        if isinstance(node, _Raw):
            return node
        if isinstance(node, str):
            return quoted(node)
        if not isinstance(node, list):
            return json.dumps(node)
        if left <= 0:
            return "[]"
        if not isinstance(node, _Pairs):
            return "[" + ",".join([write(v, left - 1) for v in node]) + "]"
        members = []
        for name, value in node:
            head, masked = names[name]
            members.append(head if masked else head + write(value, left - 1))
        return "{" + ",".join(members) + "}"

    def one(text):
        if text is None:
            return None
        try:
            node = json.loads(text, parse_float=_Raw, parse_int=_Raw, object_pairs_hook=_Pairs)
            return write(node, depth) if isinstance(node, list) else unreadable
        except (ValueError, RecursionError):
            return unreadable

    @F.pandas_udf(T.StringType())
    def rewrite(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    named = is_sensitive(col, fragments) | F.contains(col, F.lit("\\"))
    # Names outside ASCII fold in Python only.
    folded = F.lit(not all(f.isascii() for f in kept))
    deep = F.length(F.regexp_replace(col, r"[^\[{]", "")) > depth
    touched = folded | named | deep | ~json_is_readable(col)
    # Rows that stay are sent as null, which costs Python nothing.
    rewritten = rewrite(F.when(touched, col))
    return F.coalesce(rewritten, col) if unreadable is not None else F.when(touched, rewritten).otherwise(col)


def _decoded_name(pair: Column) -> Column:
    """The percent-decoded name of a query pair; '+' and broken escapes stay as written."""
    name = F.regexp_replace(F.substring_index(pair, "=", 1), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(
        F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    ).otherwise(name)


def scrub_query_string(col: Column, fragments: Sequence[str]) -> Column:
    """Mask the values of sensitively named pairs; a bare sensitive name gains a masked value."""

    def one(pair: Column) -> Column:
        masked = F.concat(F.substring_index(pair, "=", 1), F.lit("=" + MASK))
        return F.when(is_sensitive(_decoded_name(pair), fragments), masked).otherwise(pair)

    return F.array_join(F.transform(F.split(col, "&", -1), one), "&")


def scrub_userinfo(col: Column) -> Column:
    """Mask everything before the last '@' of the authority."""
    return (
        F.when(F.contains(col, F.lit("://")),
               F.regexp_replace(col, r"(?s)\A((?>.*?://))[^/?#]*@", r"$1\[REDACTED\]@"))
        .when(F.startswith(col, F.lit("//")),
              F.regexp_replace(col, r"\A(//)[^/?#]*@", r"$1\[REDACTED\]@"))
        .otherwise(col)
    )


def scrub_url(col: Column, fragments: Sequence[str]) -> Column:
    """Mask credentials and sensitive query values; a URL that cannot be read is masked whole."""

    def with_query(url: Column) -> Column:
        before = F.substring_index(url, "#", 1)
        path = F.substring_index(before, "?", 1)
        query = F.regexp_replace(
            F.substring(before, F.length(path) + 2, F.length(before)), r"[\x00-\x1f\x7f]", "_")
        masked = scrub_query_string(query, fragments)
        rebuilt = F.concat(
            path, F.lit("?"), masked, F.substring(url, F.length(before) + 1, F.length(url)))
        return (
            F.when(url_is_malformed(url), F.lit(MASK))
            .when(F.contains(before, F.lit("?")) & (masked != query), rebuilt)
            .otherwise(url)
        )

    return F.when(F.coalesce(col, F.lit("")) == "", col).otherwise(
        bind(scrub_userinfo(col), with_query))
