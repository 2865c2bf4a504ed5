"""Request context: allow-listed, scrubbed and pseudonymised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hmac_sha256
from ..functions.net import anonymize_ip, client_ip
from ..functions.redact import scrub_url
from ..schemas import STRING_MAP
from .payload import HTTP_METHODS

# The only request members that are ever read into the server map.
SERVER_KEYS = ("REQUEST_URI", "REQUEST_METHOD", "SERVER_NAME", "HTTP_HOST", "HTTP_USER_AGENT")


def with_client_ip(df: DataFrame, output: str = "client_ip") -> DataFrame:
    return df.withColumn(output, client_ip(
        F.col("HTTP_X_FORWARDED_FOR"), F.col("HTTP_X_REAL_IP"), F.col("REMOTE_ADDR")))


def pseudonymize_session(df: DataFrame, salt: str, session: str = "session_id") -> DataFrame:
    """Replace the session id by its keyed hash."""
    return df.withColumn("session_hash", hmac_sha256(F.col(session), salt)).drop(session)


def collect_request_context(
    df: DataFrame, fragments: Sequence[str], salt: str, runtime: str, output: str = "context"
) -> DataFrame:
    """Turn request columns into a context struct and drop them; cookies, credentials and
    every column outside the allow-list are never read."""
    def present(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name))

    df = with_client_ip(df, "__ip").withColumn(
        "__uri", scrub_url(present("REQUEST_URI"), fragments))
    method = F.upper(F.col("REQUEST_METHOD"))
    pairs = []
    for name in SERVER_KEYS:
        pairs += [F.lit(name), F.col("__uri") if name == "REQUEST_URI" else present(name)]
    server = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    context = F.struct(
        F.col("__uri").alias("url"),
        F.when(method.isin(*HTTP_METHODS), method).alias("http_method"),
        anonymize_ip(F.col("__ip")).alias("ip_address"),
        hmac_sha256(F.col("session_id"), salt).alias("session_hash"),
        F.lit(runtime).alias("runtime"),
        F.when(F.size(server) > 0, server).alias("server"),
        F.lit(None).cast(STRING_MAP).alias("user"),
        F.lit(None).cast(STRING_MAP).alias("extra"),
    )
    used = {*SERVER_KEYS, "HTTP_X_FORWARDED_FOR", "HTTP_X_REAL_IP", "REMOTE_ADDR", "session_id"}
    return df.withColumn(output, context).drop("__ip", "__uri", *used)
