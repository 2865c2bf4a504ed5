"""Severity, log level and runtime-error code mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_blanks

# The five event severities and the eight log levels.
SEVERITIES = ("debug", "info", "warning", "error", "fatal")
LOG_LEVELS = ("emergency", "alert", "critical", "error", "warning", "notice", "info", "debug")

# Error code -> name.
ERRNO_NAMES = {
    1: "E_ERROR",
    2: "E_WARNING",
    4: "E_PARSE",
    8: "E_NOTICE",
    16: "E_CORE_ERROR",
    64: "E_COMPILE_ERROR",
    256: "E_USER_ERROR",
    512: "E_USER_WARNING",
    1024: "E_USER_NOTICE",
    4096: "E_RECOVERABLE_ERROR",
    8192: "E_DEPRECATED",
    16384: "E_USER_DEPRECATED",
}
# Error codes by severity; every other code is a warning.
ERRNO_INFO = (8, 1024, 2048, 8192, 16384)
ERRNO_ERROR = (256, 4096)

# Fixed value: 1 | 4 | 16 | 64 | 256, the codes that end a process.
FATAL_MASK = 341


def severity(col: Column) -> Column:
    name = F.lower(strip_blanks(col))
    return (
        F.when(name == "debug", "debug")
        .when(name.isin("info", "notice"), "info")
        .when(name.isin("warning", "warn"), "warning")
        .when(name.isin("fatal", "emergency", "alert"), "fatal")
        .otherwise("error")
    )


def log_level(col: Column) -> Column:
    name = F.lower(col)
    return F.when(name.isin(*LOG_LEVELS), name).otherwise("info")


def errno_name(col: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ERRNO_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, col.try_cast("int")), F.lit("E_UNKNOWN"))


def errno_severity(col: Column) -> Column:
    return (
        F.when(col.isin(*ERRNO_INFO), "info")
        .when(col.isin(*ERRNO_ERROR), "error")
        .otherwise("warning")
    )
