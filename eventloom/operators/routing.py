"""Routing rows by DSN or log endpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.net import dsn_label, dsn_parts, ingest_url, log_endpoint
from ..sources.sinks import BATCH_PATH, ERROR_PATH


def route_by_dsn(df: DataFrame, dsn: str = "dsn") -> DataFrame:
    """Add scheme, host, port, project_id, ingest_url and a label without secrets; all null for
    a DSN that is not acceptable."""
    parts = F.col("__dsn")
    return df.withColumn("__dsn", dsn_parts(F.col(dsn))).withColumns({
        **{n: parts[n] for n in ("scheme", "host", "port", "project_id")},
        "ingest_url": ingest_url(parts, ERROR_PATH),
        "dsn_label": dsn_label(parts),
    }).drop("__dsn")


def route_by_log_endpoint(df: DataFrame, endpoint: str = "endpoint", token: str = "token") -> DataFrame:
    """Add ``log_base`` and, where a token is set too, ``batch_url``."""
    base: Column = log_endpoint(F.col(endpoint))
    url = F.when(F.col(token) != "", F.concat(F.col("log_base"), F.lit(BATCH_PATH)))
    return df.withColumn("log_base", base).withColumn("batch_url", url)
