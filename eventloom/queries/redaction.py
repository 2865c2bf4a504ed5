"""Token, field, URL and address redaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_FRAGMENTS
from ..functions.net import anonymize_ip
from ..functions.redact import SCAN_BOUND, scrub_query_string, scrub_text, scrub_url
from ..functions.text import cap_bytes
from ..operators.requests import collect_request_context, pseudonymize_session, with_client_ip
from ..operators.routing import route_by_dsn, route_by_log_endpoint
from ..operators.scrub import scrub_event, scrub_fatal, scrub_fields, with_project_literals
from ..plans import views
from .events import PADS
from .registry import EV, query

TOKEN_SQL = """CASE {k} % 7
    WHEN 0 THEN 'sk_log_a' || {k} WHEN 1 THEN 'pk_live' || {k} WHEN 2 THEN 'bearer abc.def-' || {k}
    WHEN 3 THEN 'AKIA' || lpad(CAST({k} AS VARCHAR), 16, '0') WHEN 4 THEN 'éghp_x' || {k}
    WHEN 5 THEN '-----BEGIN RSA PRIVATE KEY-----' || chr(10) || 'MII' || {k} || chr(10) || '-----END RSA PRIVATE KEY-----'
    ELSE 'opk_clean' || {k} END"""
TOK = f"""
tok AS (
  SELECT doc_id, {TOKEN_SQL.format(k='doc_id')} || ' ' || text || ' ' || {TOKEN_SQL.format(k='(doc_id + 1)')} AS text
  FROM documents)"""


def masked_sql(text: str) -> str:
    for pattern in (
        r"\bsk_log_[A-Za-z0-9]+", r"\bpk_[A-Za-z0-9]+", r"(?i)\bBearer\s+[A-Za-z0-9._\-]+",
        r"\bAKIA[0-9A-Z]{16}\b", r"\bghp_[A-Za-z0-9]+",
        r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----",
    ):
        text = f"regexp_replace({text}, '{pattern}', '[REDACTED]', 'g')"
    return text


@query("scrub_text", f"""
WITH {TOK}
SELECT doc_id, {masked_sql("replace(text, 'doc-secret', '[REDACTED]')")} AS text FROM tok""")
def scrub(spark, sf):
    return views.tok(spark, sf).select(
        "doc_id", scrub_text(F.col("text"), ["doc-secret"]).alias("text"))


@query("scrub_text_full", f"WITH {TOK} SELECT doc_id, {masked_sql('text')} AS text FROM tok")
def scrub_full(spark, sf):
    """Token shapes only, no literals."""
    return views.tok(spark, sf).select("doc_id", scrub_text(F.col("text")).alias("text"))


@query("scrub_text_bounded", f"""
WITH {TOK}
SELECT doc_id, CASE WHEN strlen(text) <= 8192 THEN {masked_sql('text')} ELSE text END AS text FROM tok""")
def scrub_bounded(spark, sf):
    """The bound on scanned texts, asked for by the caller: longer texts stay as they are."""
    return views.tok(spark, sf).select(
        "doc_id", scrub_text(F.col("text"), max_scan_bytes=SCAN_BOUND).alias("text"))


@query("scrub_map", f"""
WITH {EV}
SELECT event_id, '[REDACTED]' AS password, 'u' || user_id AS name, '[REDACTED]' AS api_token, k,
       'ghp_inside' AS note, '[REDACTED]' AS auth_level, CAST(k AS VARCHAR) AS plain, '[REDACTED]' AS item_secret,
       CAST(line AS VARCHAR) AS item_line FROM ev""")
def scrub_map(spark, sf):
    """Structs, maps and arrays of known shape; a token under an innocent name stays."""
    ev = views.ev(spark, sf)
    text = lambda c: F.col(c).cast("string")
    data = F.struct(
        F.struct(F.col("k").alias("Password"), F.concat(F.lit("u"), text("user_id")).alias("name"),
                 F.lit("ghp_inside").alias("note")).alias("user"),
        F.col("value").alias("api_token"), "k",
        F.create_map(F.lit("AUTH_level"), F.col("k"), F.lit("plain"), F.col("k")).alias("levels"),
        F.array(F.struct(text("k").alias("secret"), text("line").alias("line"))).alias("items"))
    out = scrub_fields(ev.select("event_id", data.alias("data")), ["data"], ("password", "token", "auth", "secret"))
    d = F.col("data")
    return out.select(
        "event_id", d["user"]["Password"].alias("password"), d["user"]["name"].alias("name"),
        d["api_token"].alias("api_token"), d["k"].alias("k"), d["user"]["note"].alias("note"),
        F.try_element_at(d["levels"], F.lit("AUTH_level")).alias("auth_level"),
        F.try_element_at(d["levels"], F.lit("plain")).alias("plain"),
        d["items"][0]["secret"].alias("item_secret"), d["items"][0]["line"].alias("item_line"))


@query("scrub_json", f"""
WITH {EV}
SELECT event_id, '{{"user":{{"password":"[REDACTED]","name":"u' || user_id || '"}},"api_token":"[REDACTED]","list":['
       || k || ',{{"secret_id":"[REDACTED]"}}],"k":' || k || '}}' AS context FROM ev""")
def scrub_json(spark, sf):
    """JSON text of unknown shape."""
    k = F.col("k").cast("string")
    text = F.concat(
        F.lit('{"user": {"password": "p'), k, F.lit('", "name": "u'), F.col("user_id").cast("string"),
        F.lit('"}, "api_token": ['), k, F.lit('], "list": ['), k, F.lit(', {"secret_id": 1}], "k": '), k, F.lit("}"))
    events = views.ev(spark, sf).select("event_id", text.alias("context"))
    return scrub_fields(events, ["context"], ("password", "token", "secret"))


REQ = """
req AS (
  SELECT page_id, regexp_extract(url, '://([^/]*)', 1) AS host,
         CASE page_id % 10 WHEN 0 THEN replace(url, '://', '://user:p@ss@')
           WHEN 1 THEN 'http://host:-1?token=' || page_id
           WHEN 2 THEN regexp_replace(url, 'https?:', '')
           WHEN 3 THEN '/path/' || page_id || '?%72ef=1&page=2&&utm#top'
           WHEN 4 THEN '' ELSE url END AS uri
  FROM pages)"""

MASKED_QUERY_SQL = """array_to_string(list_transform(string_split({q}, '&'), lambda p:
    CASE WHEN regexp_matches(lower(replace(split_part(p, '=', 1), '%72', 'r')), 'ref|utm')
         THEN split_part(p, '=', 1) || '=[REDACTED]' ELSE p END), '&')"""

CLEAN_SQL = f"""
{REQ},
c AS (SELECT *, regexp_replace(uri, '^((?:https?:)?//)[^/?#]*@', '\\1[REDACTED]@') AS clean FROM req),
p AS (SELECT *, split_part(clean, '#', 1) AS before, CASE WHEN contains(clean, '#')
             THEN '#' || split_part(clean, '#', 2) ELSE '' END AS fragment FROM c),
q AS (SELECT *, split_part(before, '?', 1) AS path, contains(before, '?') AS has_query,
             split_part(before, '?', 2) AS query FROM p),
scrubbed AS (
  SELECT *, CASE WHEN uri LIKE 'http://host:-1%' THEN '[REDACTED]'
                 WHEN has_query THEN path || '?' || {MASKED_QUERY_SQL.format(q='query')} || fragment
                 ELSE clean END AS url FROM q)"""


@query("scrub_url", f"WITH {CLEAN_SQL} SELECT page_id, url FROM scrubbed")
def url(spark, sf):
    return views.req(spark, sf).select(
        "page_id", scrub_url(F.col("REQUEST_URI"), ("ref", "utm")).alias("url"))


@query("scrub_query", f"""
WITH {CLEAN_SQL}
SELECT page_id, {MASKED_QUERY_SQL.format(q='query')} AS query FROM q""")
def query_string(spark, sf):
    before = F.substring_index("REQUEST_URI", "#", 1)
    text = F.when(F.contains(before, F.lit("?")), F.substring_index(before, "?", -1)).otherwise("")
    return views.req(spark, sf).select("page_id", scrub_query_string(text, ("ref", "utm")).alias("query"))


IPV4_SQL = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}"


@query("anonymize_ip", f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') AS ips,
         CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id % 65536 END AS g2,
         CASE WHEN doc_id % 2 = 0 THEN 0 ELSE doc_id % 977 END AS g3 FROM documents),
a AS (SELECT *, unnest(range(1, greatest(1, coalesce(len(ips), 0)) + 1)) AS place FROM d),
e AS (SELECT *, ips[place] AS ip FROM a)
SELECT doc_id, CAST(place AS INTEGER) AS place,
       CASE WHEN regexp_full_match(ip, '{IPV4_SQL}') THEN regexp_replace(ip, '[0-9]+$', '0') END AS v4,
       CASE WHEN doc_id % 6 = 4 THEN NULL
            ELSE '2001' || CASE WHEN g2 = 0 AND g3 = 0 THEN '' WHEN g3 = 0 THEN ':' || printf('%x', g2)
                 ELSE ':' || printf('%x', g2) || ':' || printf('%x', g3) END || '::' END AS v6
FROM e""")
def ip(spark, sf):
    """Every IPv4-like text of a document, or one row without, and an IPv6 address in one of six spellings."""
    key = F.col("doc_id")
    two = F.when(key % 3 == 0, 0).otherwise(key % 65536).cast("long")
    three = F.when(key % 2 == 0, 0).otherwise(key % 977).cast("long")
    a, b = F.lower(F.hex(two)), F.lower(F.hex(three))
    head = F.concat(F.lit("2001:"), a, F.lit(":"), b)
    wide = F.concat(F.lit("2001:"), F.lpad(a, 4, "0"), F.lit(":"), F.lpad(b, 4, "0"))
    kind = key % 6
    v6 = (
        F.when(kind == 0, F.concat(head, F.lit("::1")))
        .when(kind == 1, F.concat(F.upper(head), F.lit(":A:B:C:D:E")))
        .when(kind == 2, F.concat(wide, F.lit("::")))
        .when(kind == 3, F.concat(head, F.lit("::1.2.3.4")))
        .when(kind == 4, F.concat(head, F.lit("::1%eth0")))
        .otherwise(F.concat(wide, F.lit(":1:2:3:10.0.0.1"))))
    found = F.regexp_extract_all("text", F.lit(r"[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+"), F.lit(0))
    each = views.table(spark, sf, "documents").select("doc_id", F.posexplode_outer(found).alias("i", "ip"))
    return each.select("doc_id", (F.coalesce("i", F.lit(0)) + 1).alias("place"), anonymize_ip(F.col("ip")).alias("v4"),
                       anonymize_ip(v6).alias("v6"))


@query("scrub_project_secrets", f"""
WITH {TOK}, p AS (
  SELECT doc_id, text || ' ' || own.c_name || ' ' || 'key' || own.c_custkey * 7919 || 'z ' || other.c_name AS text, own.c_name,
         'key' || own.c_custkey * 7919 || 'z' AS c_key,
         own.c_custkey % 10 = 0 AS bare
  FROM tok JOIN customer own ON own.c_custkey = doc_id % 100 + 1 JOIN customer other ON other.c_custkey = doc_id % 100 + 2)
SELECT doc_id, {masked_sql("CASE WHEN bare THEN text ELSE replace(replace(text, c_name, '[REDACTED]'), c_key, '[REDACTED]') END")} AS text
FROM p""")
def project_secrets(spark, sf):
    """Each project's own secrets are masked, those of another project stay."""
    customers = views.table(spark, sf, "customer")
    key = F.concat(F.lit("key"), (F.col("c_custkey") * 7919).cast("string"), F.lit("z"))
    names = customers.select(F.col("c_custkey").alias("project_id"), "c_name", key.alias("c_key"))
    other = names.select((F.col("project_id") - 1).alias("project_id"), F.col("c_name").alias("other"))
    rows = views.tok(spark, sf).withColumn("project_id", F.col("doc_id") % 100 + 1)
    rows = rows.join(names, "project_id").join(other, "project_id").withColumn(
        "text", F.concat_ws(" ", "text", "c_name", "c_key", "other"))
    secrets = names.where(F.col("project_id") % 10 != 0).select(
        "project_id", F.explode(F.array("c_name", "c_key")).alias("secret"))
    return with_project_literals(rows, secrets).select("doc_id", scrub_text(F.col("text"), F.col("literals")).alias("text"))


CONTEXT_SQL = """
SELECT page_id, nullif(url, '') AS url,
       CASE page_id % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'GET' END AS http_method,
       CASE page_id % 4 WHEN 0 THEN '198.51.100.0' WHEN 2 THEN NULL
         ELSE '2001:db8' || CASE WHEN page_id % 16 = 0 THEN '' ELSE ':' || printf('%x', page_id % 16) END || '::' END AS ip_address,
       CASE WHEN page_id % 5 = 0 THEN 0 ELSE 64 END AS hash_length,
       CASE WHEN page_id % 6 = 0 THEN NULL ELSE host END AS server_name,
       CASE WHEN page_id % 10 = 4 THEN NULL ELSE url END AS server_uri,
       CAST(4 - CASE WHEN page_id % 6 = 0 THEN 1 ELSE 0 END - CASE WHEN page_id % 10 = 4 THEN 1 ELSE 0 END AS BIGINT) AS members
FROM scrubbed"""


@query("collect_request_context", f"WITH {CLEAN_SQL} {CONTEXT_SQL}")
def request_context(spark, sf):
    out = collect_request_context(views.req(spark, sf), ("ref", "utm"), "salt", "spark")
    c = F.col("context")
    return out.select(
        "page_id", c["url"].alias("url"), c["http_method"].alias("http_method"),
        c["ip_address"].alias("ip_address"),
        F.coalesce(F.length(c["session_hash"]), F.lit(0)).alias("hash_length"),
        F.try_element_at(c["server"], F.lit("SERVER_NAME")).alias("server_name"),
        F.try_element_at(c["server"], F.lit("REQUEST_URI")).alias("server_uri"),
        F.size(c["server"]).cast("long").alias("members"))


@query("client_ip", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '198.51.100.' || (page_id % 256) WHEN 2 THEN 'garbage'
  ELSE '2001:DB8:' || printf('%x', page_id % 16) || '::' || printf('%x', page_id) END AS client_ip FROM pages""")
def first_hop(spark, sf):
    return with_client_ip(views.req(spark, sf)).select("page_id", "client_ip")


@query("pseudonymize_session", f"""
SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN sha256(unhex('{PADS["outer"]}') || unhex(sha256(
         unhex('{PADS["inner"]}') || encode('sess-' || CAST(page_id AS VARCHAR))))) END AS session_hash
FROM pages""")
def sessions(spark, sf):
    return pseudonymize_session(views.req(spark, sf), "my-test-salt").select("page_id", "session_hash")


@query("scrub_event", f"""
WITH {EV}
SELECT event_id, message || CASE WHEN k % 4 = 0 THEN ' key [REDACTED]' ELSE '' END AS message,
       type AS kind, '[REDACTED]' AS api_token, '/evt?page=' || k || '&token=t' || seq AS url,
       '[REDACTED]' AS auth_code, CAST(k AS VARCHAR) AS extra_k, '[REDACTED] seen' AS crumb,
       '[REDACTED]' AS crumb_password FROM ev""")
def whole_event(spark, sf):
    """Message and breadcrumbs by token, context, tags and breadcrumb data by name."""
    crumb = F.struct(
        F.lit("c").alias("category"),
        F.concat(F.lit("pk_"), F.col("seq").cast("string"), F.lit(" seen")).alias("message"),
        F.lit("info").alias("level"),
        F.create_map(F.lit("password"), F.col("seq").cast("string")).alias("data"),
        F.col("ts").alias("timestamp"))
    events = views.full_events(views.ev(spark, sf)).withColumn("breadcrumbs", F.array(crumb))
    out = scrub_event(events, DEFAULT_FRAGMENTS)
    at = lambda col, key: F.try_element_at(F.col(col), F.lit(key))
    return out.select(
        "event_id", "message", at("tags", "kind").alias("kind"), at("tags", "api_token").alias("api_token"),
        "context.url", at("context.extra", "auth_code").alias("auth_code"),
        at("context.extra", "k").alias("extra_k"), F.col("breadcrumbs")[0]["message"].alias("crumb"),
        F.try_element_at(F.col("breadcrumbs")[0]["data"], F.lit("password")).alias("crumb_password"))


@query("scrub_fatal", f"""
WITH {EV}
SELECT event_id, message || ' [REDACTED]' AS message, file || '?[REDACTED]' AS file, CAST(seq AS VARCHAR) AS api_token FROM ev""")
def lean_event(spark, sf):
    """Message and file only; the tags keep their secrets."""
    ev = views.ev(spark, sf)
    rows = ev.select(
        "event_id", F.concat("message", F.lit(" Bearer x.y")).alias("message"),
        F.concat("file", F.lit("?ghp_abc")).alias("file"),
        F.create_map(F.lit("api_token"), F.col("seq").cast("string")).alias("tags"))
    return scrub_fatal(rows).select(
        "event_id", "message", "file", F.try_element_at("tags", F.lit("api_token")).alias("api_token"))


DSN_SQL = """
d AS (
  SELECT page_id, regexp_extract(url, '://([^/]*)', 1) AS host FROM pages),
e AS (
  SELECT *, 'p' || page_id AS project,
         CASE page_id % 9 WHEN 0 THEN ' https://' || host || '/p' || page_id || ' '
           WHEN 1 THEN 'HTTP://' || host || ':8443/p' || page_id
           WHEN 2 THEN 'https://user@' || host || '/p' || page_id
           WHEN 3 THEN 'https://' || host || '/a/b'
           WHEN 4 THEN 'ftp://' || host || '/p' || page_id
           WHEN 5 THEN 'https://' || host
           WHEN 6 THEN 'https://' || host || '//p' || page_id || '?x=1'
           WHEN 7 THEN 'https://' || host || ':99999/p' || page_id
           ELSE 'not a url' END AS dsn FROM d)"""


def _dsns(spark, sf):
    key = F.col("page_id")
    text = key.cast("string")
    host = F.regexp_extract("url", r"://([^/]*)", 1)
    https = F.concat(F.lit("https://"), host)
    dsn = (
        F.when(key % 9 == 0, F.concat(F.lit(" "), https, F.lit("/p"), text, F.lit(" ")))
        .when(key % 9 == 1, F.concat(F.lit("HTTP://"), host, F.lit(":8443/p"), text))
        .when(key % 9 == 2, F.concat(F.lit("https://user@"), host, F.lit("/p"), text))
        .when(key % 9 == 3, F.concat(https, F.lit("/a/b")))
        .when(key % 9 == 4, F.concat(F.lit("ftp://"), host, F.lit("/p"), text))
        .when(key % 9 == 5, https)
        .when(key % 9 == 6, F.concat(https, F.lit("//p"), text, F.lit("?x=1")))
        .when(key % 9 == 7, F.concat(https, F.lit(":99999/p"), text))
        .otherwise("not a url"))
    return views.table(spark, sf, "pages").select("page_id", dsn.alias("dsn"))


@query("dsn_route", f"""
WITH {DSN_SQL}, ok AS (SELECT *, page_id % 9 IN (0, 1, 6) AS ok, page_id % 9 = 1 AS odd FROM e)
SELECT page_id, CASE WHEN ok THEN CASE WHEN odd THEN 'HTTP' ELSE 'https' END END AS scheme,
       CASE WHEN ok THEN host END AS host, CASE WHEN ok AND odd THEN 8443 END AS port,
       CASE WHEN ok THEN project END AS project_id,
       CASE WHEN ok THEN CASE WHEN odd THEN 'HTTP://' || host || ':8443' ELSE 'https://' || host END || '/api/v1/errors' END AS ingest_url,
       CASE WHEN ok THEN '[dsn ' || host || '/' || project || ']' END AS dsn_label FROM ok""")
def dsn(spark, sf):
    return route_by_dsn(_dsns(spark, sf)).drop("dsn")


@query("log_route", f"""
WITH {DSN_SQL}, b AS (
  SELECT page_id, CASE WHEN page_id % 9 IN (2, 3, 5, 6) THEN 'https://' || host END AS log_base FROM e)
SELECT page_id, log_base, CASE WHEN page_id % 2 = 0 THEN log_base || '/v1/logs/batch' END AS batch_url FROM b""")
def endpoint(spark, sf):
    """Unlike a DSN an endpoint may hold credentials, which are cut off, and is not trimmed."""
    rows = _dsns(spark, sf).withColumnRenamed("dsn", "endpoint").withColumn(
        "token", F.when(F.col("page_id") % 2 == 0, "sk_log_x").otherwise(""))
    return route_by_log_endpoint(rows).select("page_id", "log_base", "batch_url")


@query("cap_bytes", """
SELECT doc_id, substr(text, 1, list_max(list_filter(range(0, 301), lambda n: strlen(substr(text, 1, n)) <= 300))) AS text
FROM documents""")
def cap(spark, sf):
    return views.table(spark, sf, "documents").select(
        "doc_id", cap_bytes(F.col("text"), 300).alias("text"))
