"""Views that read the driver's tables as telemetry records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import empty_map
from ..schemas import CONTEXT, CRUMB, FRAME


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape_events(events: DataFrame) -> DataFrame:
    """Rows of the events table, static or streaming, as captured events."""
    kind = F.col("event_type")
    level = F.when(kind == "error", "error").when(kind == "view", "warn").otherwise("info")
    sender = (F.col("user_id") % 8).cast("string")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
    return events.select(
        "event_id", F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"), "user_id",
        sender.alias("sender_id"),
        F.concat(sender, F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("flush_id"),
        F.col("user_id").alias("scope_id"),
        kind.alias("type"),
        F.concat(F.lit("evt "), F.col("event_id").cast("string")).alias("message"),
        F.concat(F.lit("src/mod"), (F.col("user_id") % 4).cast("string"), F.lit(".php")).alias("file"),
        k.alias("k"), (k % 5).alias("line"), level.alias("level"), "value", "props",
    )


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def full_events(events: DataFrame) -> DataFrame:
    """``ev`` with every member of an event; the secret in each message depends on the row."""
    secret = F.when(F.col("k") % 4 == 0, F.concat(F.lit(" key ghp_"), F.col("seq").cast("string"))).otherwise("")
    text = lambda col: col.cast("string")
    context = F.struct(
        F.concat(F.lit("/evt?page="), text(F.col("k")), F.lit("&token=t"), text(F.col("seq"))).alias("url"),
        F.lit("GET").alias("http_method"), F.lit("203.0.113.0").alias("ip_address"),
        F.lit(None).cast("string").alias("session_hash"), F.lit("spark").alias("runtime"),
        F.create_map(F.lit("SERVER_NAME"), F.concat(F.lit("host"), F.col("sender_id"))).alias("server"),
        F.lit(None).cast("map<string,string>").alias("user"),
        F.create_map(F.lit("auth_code"), text(F.col("k")), F.lit("k"), text(F.col("k"))).alias("extra"))
    return events.select(
        "event_id", "seq", "sender_id", "flush_id", "scope_id", "ts", "type",
        F.concat(F.col("message"), secret).alias("message"),
        "file", "line", "level", F.lit("production").alias("environment"),
        F.lit(None).cast("string").alias("release"), F.col("ts").alias("timestamp"),
        F.create_map(F.lit("kind"), F.col("type"), F.lit("api_token"), text(F.col("seq"))).alias("tags"),
        context.cast(CONTEXT).alias("context"),
        F.array().cast(T.ArrayType(FRAME)).alias("stack_trace"),
        F.array().cast(T.ArrayType(CRUMB)).alias("breadcrumbs"),
        F.lit(False).alias("partial"))


def msg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plain messages."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("event_id"), F.col("doc_id").alias("seq"),
        F.floor(F.col("doc_id") / 100).cast("string").alias("flush_id"),
        F.col("lang"), F.col("text").alias("message"), F.col("source"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("timestamp"))


def _token(key: Column) -> Column:
    pick = key % 7
    text = key.cast("string")
    pem = F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\nMII"), text,
                   F.lit("\n-----END RSA PRIVATE KEY-----"))
    return (
        F.when(pick == 0, F.concat(F.lit("sk_log_a"), text))
        .when(pick == 1, F.concat(F.lit("pk_live"), text))
        .when(pick == 2, F.concat(F.lit("bearer abc.def-"), text))
        .when(pick == 3, F.concat(F.lit("AKIA"), F.lpad(text, 16, "0")))
        .when(pick == 4, F.concat(F.lit("éghp_x"), text))
        .when(pick == 5, pem)
        .otherwise(F.concat(F.lit("opk_clean"), text)))


def tok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a token, chosen by id, in front of and behind the text."""
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(_token(key), F.lit(" "), F.col("text"), F.lit(" "), _token(key + 1)).alias("text"))


def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scope per customer; every fifth has no user."""
    none = F.col("c_custkey") % 5 == 0
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("scope_id"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"),
                     F.col("c_nationkey").cast("string"), F.lit("kind"), F.lit("scoped")).alias("tags"),
        F.when(none, empty_map()).otherwise(
            F.create_map(F.lit("name"), F.col("c_name"))).alias("user"),
        F.create_map(F.lit("acctbal_cents"),
                     F.round(F.col("c_acctbal") * 100).cast("long").cast("string")).alias("extra"))


def crumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).where(F.col("type") != "error").select(
        "scope_id", "seq", F.col("type").alias("category"), F.col("props").alias("message"), "ts")


def shape_logs(conversations: DataFrame) -> DataFrame:
    """Conversation turns, static or streaming, as log records."""
    level = (F.when(F.col("role") == "user", "Notice").when(F.col("role") == "assistant", "ERROR")
             .otherwise("verbose"))
    template = F.concat(F.lit("turn {turn} by {role}: {missing} "), F.col("text"))
    return conversations.select(
        F.floor(F.col("conv_id") / 50).cast("string").alias("flush_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), "conv_id", "turn",
        level.alias("level"), template.alias("message"),
        F.create_map(F.lit("role"), F.col("role"), F.lit("turn"), F.col("turn").cast("string"),
                     F.lit("auth_code"), F.col("conv_id").cast("string")).alias("context"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn")).alias("timestamp"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_logs(table(spark, sf_dir, "conversations"))


def req(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as requests: some with credentials, some unreadable."""
    key = F.col("page_id")
    text = key.cast("string")
    host = F.regexp_extract("url", r"://([^/]*)", 1)
    uri = (
        F.when(key % 10 == 0, F.regexp_replace("url", "://", "://user:p@ss@"))
        .when(key % 10 == 1, F.concat(F.lit("http://host:-1?token="), text))
        .when(key % 10 == 2, F.regexp_replace("url", r"https?:", ""))
        .when(key % 10 == 3, F.concat(F.lit("/path/"), text, F.lit("?%72ef=1&page=2&&utm#top")))
        .when(key % 10 == 4, F.lit(""))
        .otherwise(F.col("url")))
    forwarded = (
        F.when(key % 4 == 0, F.concat(F.lit(" 198.51.100."), (key % 256).cast("string"), F.lit(", 10.0.0.1")))
        .when(key % 4 == 1, F.lit(", 10.0.0.1"))
        .when(key % 4 == 2, F.lit("garbage")))
    return table(spark, sf_dir, "pages").select(
        "page_id", uri.alias("REQUEST_URI"),
        F.when(key % 3 == 0, "post").when(key % 3 == 1, "GET").otherwise("TRACE").alias("REQUEST_METHOD"),
        F.when(key % 6 == 0, "").otherwise(host).alias("SERVER_NAME"),
        host.alias("HTTP_HOST"), F.lit(None).cast("string").alias("HTTP_USER_AGENT"),
        forwarded.alias("HTTP_X_FORWARDED_FOR"), F.lit("").alias("HTTP_X_REAL_IP"),
        F.concat(F.lit("2001:DB8:"), F.lower(F.hex(key % 16)), F.lit("::"), F.lower(F.hex(key))).alias("REMOTE_ADDR"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("sess-"), text)).alias("session_id"))


def shape_attempts(events: DataFrame) -> DataFrame:
    """Events as delivery attempts of eight endpoints."""
    kind = F.col("type")
    status = (F.when(kind == "purchase", 202).when(kind == "signup", 409)
              .when(kind == "view", 429).when(kind == "click", 400).otherwise(503))
    return events.select(
        F.col("sender_id").alias("endpoint"), "event_id", "seq", "ts", status.alias("status"),
        (F.col("k") * 60).alias("retry_after"), (F.col("k") + 1).cast("long").alias("rows"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_attempts(ev(spark, sf_dir))


def raw_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runtime errors; the code depends on ``k``, some ran out of memory."""
    code = F.pow(F.lit(2), F.col("k") % 15).cast("int")
    note = F.when(F.col("k") % 9 == 0, "Allowed memory size of 1 bytes exhausted ghp_abc").when(
        F.col("k") % 9 == 1, " \t").otherwise(F.col("message"))
    return ev(spark, sf_dir).select(
        "event_id", "seq", "sender_id", "flush_id", "scope_id", "ts", F.col("ts").alias("timestamp"),
        code.alias("errno"), note.alias("message"), "file", F.col("line"))
