"""Scopes and breadcrumb trails."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import empty_map
from ..operators.scopes import apply_scope, layer_scopes
from ..operators.trail import attach_trail
from ..plans import views
from .registry import EV, query


@query("apply_scope", f"""
WITH {EV}
SELECT event_id, CASE WHEN c.c_custkey IS NULL THEN type ELSE 'scoped' END AS kind,
       CAST(seq AS VARCHAR) AS api_token, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
       CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS user_name, CAST(k AS VARCHAR) AS extra_k,
       CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS acctbal_cents
FROM ev LEFT JOIN customer c ON c.c_custkey = ev.scope_id""")
def scope(spark, sf):
    events = views.full_events(views.ev(spark, sf))
    out = apply_scope(events, views.scopes(spark, sf))
    at = lambda col, key: F.try_element_at(F.col(col), F.lit(key))
    return out.select(
        "event_id", at("tags", "kind").alias("kind"), at("tags", "api_token").alias("api_token"),
        at("tags", "segment").alias("segment"), at("tags", "nation").alias("nation"),
        at("context.user", "name").alias("user_name"), at("context.extra", "k").alias("extra_k"),
        at("context.extra", "acctbal_cents").alias("acctbal_cents"))


@query("apply_scope_json", f"""
WITH {EV}
SELECT event_id, CAST(k AS VARCHAR) AS k, CASE WHEN c_custkey IS NULL OR c_custkey % 5 = 0 THEN 'own' ELSE c_name END AS user_name,
       CAST(line AS VARCHAR) AS old_extra, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS acctbal_cents
FROM ev LEFT JOIN customer c ON c.c_custkey = ev.scope_id""")
def scope_json(spark, sf):
    """The event context is JSON text."""
    k, line = F.col("k").cast("string"), F.col("line").cast("string")
    text = F.concat(F.lit('{"k":'), k, F.lit(',"user":{"name":"own"},"extra":{"old":'), line, F.lit("}}"))
    events = views.ev(spark, sf).select("event_id", "seq", "scope_id", text.alias("context"), empty_map().alias("tags"))
    out = apply_scope(events, views.scopes(spark, sf))
    get = lambda path: F.get_json_object("context", path)
    return out.select(
        "event_id", get("$.k").alias("k"), get("$.user.name").alias("user_name"),
        get("$.extra.old").alias("old_extra"), get("$.extra.acctbal_cents").alias("acctbal_cents"))


@query("layer_scopes", """
SELECT 'c' || c_custkey AS scope_id, 'customer' AS level, n_name AS nation, r_name AS region,
       CASE WHEN c_custkey % 3 = 0 THEN 'nation user' ELSE c_name END AS user_name,
       CAST(c_nationkey % 7 AS VARCHAR) AS shared, CAST(c_custkey AS VARCHAR) AS own
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE c_custkey % 11 <> 0
UNION ALL
SELECT 'c' || c_custkey, 'customer', NULL, NULL, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, NULL,
       CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 11 = 0
UNION ALL
SELECT 'n' || n_nationkey, 'nation', n_name, r_name, 'nation user', CAST(n_nationkey % 7 AS VARCHAR), NULL
FROM nation JOIN region ON r_regionkey = n_regionkey
UNION ALL
SELECT 'r' || r_regionkey, 'region', NULL, r_name, 'region user', 'region', NULL FROM region""")
def layers(spark, sf):
    """Customers inside nations inside regions; every eleventh customer was reset."""
    t = lambda name: views.table(spark, sf, name)
    text = lambda c: F.col(c).cast("string")
    customers = t("customer").select(
        F.concat(F.lit("c"), text("c_custkey")).alias("scope_id"),
        F.concat(F.lit("n"), text("c_nationkey")).alias("parent_scope_id"),
        F.create_map(F.lit("level"), F.lit("customer")).alias("tags"),
        F.when(F.col("c_custkey") % 3 == 0, empty_map()).otherwise(
            F.create_map(F.lit("name"), F.col("c_name"))).alias("user"),
        F.create_map(F.lit("own"), text("c_custkey")).alias("extra"),
        (F.col("c_custkey") % 11 == 0).alias("reset"))
    nations = t("nation").select(
        F.concat(F.lit("n"), text("n_nationkey")).alias("scope_id"),
        F.concat(F.lit("r"), text("n_regionkey")).alias("parent_scope_id"),
        F.create_map(F.lit("level"), F.lit("nation"), F.lit("nation"), F.col("n_name")).alias("tags"),
        F.create_map(F.lit("name"), F.lit("nation user")).alias("user"),
        F.create_map(F.lit("shared"), (F.col("n_nationkey") % 7).cast("string")).alias("extra"),
        F.lit(False).alias("reset"))
    regions = t("region").select(
        F.concat(F.lit("r"), text("r_regionkey")).alias("scope_id"),
        F.lit(None).cast("string").alias("parent_scope_id"),
        F.create_map(F.lit("level"), F.lit("region"), F.lit("region"), F.col("r_name")).alias("tags"),
        F.create_map(F.lit("name"), F.lit("region user")).alias("user"),
        F.create_map(F.lit("shared"), F.lit("region")).alias("extra"), F.lit(False).alias("reset"))
    out = layer_scopes(customers.unionByName(nations).unionByName(regions), max_depth=2)
    at = lambda col, key: F.try_element_at(F.col(col), F.lit(key))
    return out.select(
        "scope_id", *[at("tags", n).alias(n) for n in ("level", "nation", "region")],
        at("user", "name").alias("user_name"), at("extra", "shared").alias("shared"),
        at("extra", "own").alias("own"))


@query("attach_trail", f"""
WITH {EV},
c AS (SELECT scope_id, seq, type, row_number() OVER (PARTITION BY scope_id ORDER BY seq) AS i FROM ev WHERE type <> 'error'),
e AS (SELECT event_id, scope_id, (SELECT count(*) FROM ev x WHERE x.scope_id = ev.scope_id AND x.type <> 'error' AND x.seq < ev.seq) AS n
      FROM ev WHERE type = 'error')
SELECT event_id, coalesce(string_agg(CAST(c.seq AS VARCHAR) || ':' || c.type, ',' ORDER BY c.seq), '') AS trail
FROM e LEFT JOIN c ON c.scope_id = e.scope_id AND c.i > e.n - 10 AND c.i <= e.n GROUP BY event_id""")
def trail(spark, sf):
    events = views.ev(spark, sf).where(F.col("type") == "error").select("event_id", "scope_id", "seq")
    label = F.concat(F.col("seq").cast("string"), F.lit(":"), F.col("category"))
    out = attach_trail(events, views.crumbs(spark, sf), 10, crumb=label)
    return out.select("event_id", F.array_join("trail", ",").alias("trail"))


@query("attach_trail_resets", f"""
WITH {EV},
marked AS (
  SELECT *, count(*) FILTER (WHERE type = 'signup') OVER (PARTITION BY scope_id ORDER BY seq) AS era,
         count(*) FILTER (WHERE type NOT IN ('error', 'signup')) OVER (PARTITION BY scope_id ORDER BY seq) AS i FROM ev),
c AS (SELECT * FROM marked WHERE type NOT IN ('error', 'signup'))
SELECT e.event_id, coalesce(string_agg(CAST(c.seq AS VARCHAR), ',' ORDER BY c.seq), '') AS trail
FROM marked e LEFT JOIN c ON c.scope_id = e.scope_id AND c.era = e.era AND c.i > e.i - 3 AND c.i <= e.i
WHERE e.type = 'error' GROUP BY e.event_id""")
def trail_resets(spark, sf):
    """Signups empty the scope."""
    ev = views.ev(spark, sf)
    events = ev.where(F.col("type") == "error").select("event_id", "scope_id", "seq")
    crumbs = views.crumbs(spark, sf).where(F.col("category") != "signup")
    resets = ev.where(F.col("type") == "signup").select("scope_id", "seq")
    out = attach_trail(events, crumbs, 3, crumb=F.col("seq").cast("string"), resets=resets)
    return out.select("event_id", F.array_join("trail", ",").alias("trail"))
