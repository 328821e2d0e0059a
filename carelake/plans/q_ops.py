"""Operations queries over the event feed and the three alert tables
(L4-L6, L13-L15, L18-L31). The streaming forms live in ``carelake.streaming``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.q_scoring import FRAUD_SQL, GAP_SQL, TRAJ_SQL, feeds, fraud, gap_alerts, traj
from carelake.plans.registry import query
from carelake.plans.star import Star
from carelake.sources import bindings as B
from carelake.sources.io import reference_rows

AS_OF_TS = "2025-11-28 00:00:00"
ALL = {**FRAUD_SQL, **GAP_SQL, **TRAJ_SQL}
PRIORITY_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
# FIXED VALUES: alert type -> (action, destination) for CRITICAL items.
ROUTES = [("fraud", "SIU_REFERRAL", "Special Investigations Unit Queue"),
          ("care_gap", "PROVIDER_ALERT", "Provider Care Team / EHR Alert"),
          ("high_cost", "CM_REFERRAL", "Care Management Program Referral")]
OTHER_ROUTE = ("GENERAL_ALERT", "Operations Review Queue")


def _rank(col) -> F.Column:
    out = F.lit(4)
    for k, v in reversed(list(PRIORITY_RANK.items())):
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


RANK_SQL = "CASE {c} WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"
ALL["alert_union"] = """
SELECT patient_id, 'fraud' AS alert_type, risk_tier AS priority, claim_id AS alert_id,
  'Fraud score: ' || CAST(fraud_score AS VARCHAR) || ' | Flags: ' || fraud_flags AS detail,
  event_timestamp AS alert_time, latitude, longitude
FROM fraud_tiered
UNION ALL SELECT patient_id, 'care_gap', alert_priority, CAST(event_id AS VARCHAR) || ':' || measure_id,
  'Gap: ' || measure_name || ' | Overdue: ' || CAST(gap_days_overdue AS VARCHAR) || 'd', event_timestamp, latitude, longitude
FROM gap_alerts
UNION ALL SELECT patient_id, 'high_cost', risk_tier, patient_id,
  '30d spend: $' || CAST(CAST(r30 AS DECIMAL(28,2)) AS VARCHAR) || ' | ED visits: ' || CAST(ed_visits_30d AS VARCHAR)
    || ' | Trend: ' || cost_trend, event_timestamp, latitude, longitude
FROM trajectory"""
ALL["raised_alerts"] = "SELECT * FROM alert_union WHERE priority <> 'LOW'"
ALL["recent_alerts"] = f"""SELECT * FROM alert_union
WHERE alert_time > TIMESTAMP '{AS_OF_TS}' - INTERVAL 24 HOUR AND alert_time <= TIMESTAMP '{AS_OF_TS}'"""
ALL["worklist"] = f"""
SELECT patient_id, list_sort(list_distinct(list(alert_type))) AS alert_types,
  min({RANK_SQL.format(c='priority')}) AS top_priority_rank, count(*) AS alerts,
  count(*) FILTER (WHERE alert_type = 'fraud') AS fraud_alerts,
  count(*) FILTER (WHERE alert_type = 'care_gap') AS care_gap_alerts,
  count(*) FILTER (WHERE alert_type = 'high_cost') AS high_cost_alerts, max(alert_time) AS last_alert_time,
  {rnd('arg_max(latitude, alert_time::VARCHAR || alert_type || alert_id)')} AS latitude,
  {rnd('arg_max(longitude, alert_time::VARCHAR || alert_type || alert_id)')} AS longitude
FROM recent_alerts GROUP BY 1 ORDER BY top_priority_rank, alerts DESC, patient_id LIMIT 100"""


def alert_union(s: Star):
    """All three alert tables in one shape, every tier: patient, type,
    priority, id, detail, time and position."""
    def shape(df, kind, tier, alert_id, *detail):
        return df.select("patient_id", F.lit(kind).alias("alert_type"), F.col(tier).alias("priority"),
                         alert_id.alias("alert_id"), F.concat(*detail).alias("detail"),
                         F.col("event_timestamp").alias("alert_time"), "latitude", "longitude")

    text = lambda c: F.col(c).cast("string")
    f = shape(fraud(s), "fraud", "risk_tier", F.col("claim_id"),
              F.lit("Fraud score: "), text("fraud_score"), F.lit(" | Flags: "), "fraud_flags")
    g = shape(gap_alerts(s), "care_gap", "alert_priority", F.concat_ws(":", text("event_id"), "measure_id"),
              F.lit("Gap: "), "measure_name", F.lit(" | Overdue: "), text("gap_days_overdue"), F.lit("d"))
    h = shape(traj(s), "high_cost", "risk_tier", F.col("patient_id"),
              F.lit("30d spend: $"), F.col("rolling_spend_30d").cast("decimal(28,2)").cast("string"),
              F.lit(" | ED visits: "), text("ed_visits_30d"), F.lit(" | Trend: "), "cost_trend")
    return f.unionByName(g).unionByName(h)


def recent(u, as_of: str = AS_OF_TS, hours: int = 24):
    """Alerts of the ``hours`` up to ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return u.where((F.col("alert_time") > end - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("alert_time") <= end))


def worklist(u, size: int = 100):
    """Per patient the set of alert types (at most three), best priority,
    counts, and time and position of the last alert; the ``size`` patients with the
    best priority."""
    newest = F.struct("alert_time", "alert_type", "alert_id")
    t = F.col("alert_type")
    g = u.groupBy("patient_id").agg(
        F.array_sort(F.collect_set("alert_type")).alias("alert_types"),
        F.min(_rank(F.col("priority"))).alias("top_priority_rank"), F.count(F.lit(1)).alias("alerts"),
        F.count_if(t == "fraud").alias("fraud_alerts"), F.count_if(t == "care_gap").alias("care_gap_alerts"),
        F.count_if(t == "high_cost").alias("high_cost_alerts"), F.max("alert_time").alias("last_alert_time"),
        M.rnd(F.max_by("latitude", newest)).alias("latitude"), M.rnd(F.max_by("longitude", newest)).alias("longitude"))
    return g.orderBy("top_priority_rank", F.col("alerts").desc(), "patient_id").limit(size)


@query("l04_tumbling_5min_counts", sql("""
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, _table, count(*) AS events
FROM landing_events GROUP BY 1, 2"""))
def l04(spark, d):
    """L4: tumbling 5-minute counts per event type (union of the feeds)."""
    land = B.landing_events(Star(spark, d).t)
    return (land.groupBy(F.window(F.col("event_timestamp").cast("timestamp"), "5 minutes").alias("w"), "_table")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "_table", "events"))


@query("l05_hourly_trend_aligned", sql("""
SELECT date_trunc('hour', event_timestamp) AS hour,
  count(*) FILTER (WHERE _table = 'claims_events') AS claims,
  count(*) FILTER (WHERE _table = 'adt_events') AS adt,
  count(*) FILTER (WHERE _table = 'rx_events') AS rx
FROM landing_events GROUP BY 1"""))
def l05(spark, d):
    """Three hourly series aligned in one pass (count_if per bin)."""
    land = B.landing_events(Star(spark, d).t)
    t = F.col("_table")
    return land.groupBy(F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz").alias("hour")).agg(
        F.count_if(t == "claims_events").alias("claims"), F.count_if(t == "adt_events").alias("adt"),
        F.count_if(t == "rx_events").alias("rx"))


@query("l06_freshness", sql(f"""
SELECT _table, max(event_timestamp) AS last_event,
  CAST(floor(epoch(TIMESTAMP '{AS_OF_TS}' - max(event_timestamp)) / 60) AS BIGINT) AS minutes_since,
  CASE WHEN epoch(TIMESTAMP '{AS_OF_TS}' - max(event_timestamp)) / 60 > 60 THEN 'CRITICAL'
       WHEN epoch(TIMESTAMP '{AS_OF_TS}' - max(event_timestamp)) / 60 > 15 THEN 'WARNING' ELSE 'OK' END AS status
FROM landing_events GROUP BY 1"""))
def l06(spark, d, as_of: str = AS_OF_TS):
    """Minutes since the last event per feed against an as-of time."""
    land = B.landing_events(Star(spark, d).t)
    g = land.groupBy("_table").agg(F.max("event_timestamp").alias("last_event"))
    secs = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("last_event").cast("timestamp"))) / 1e6
    mins = secs / 60
    return g.select("_table", "last_event", F.floor(mins).cast("long").alias("minutes_since"),
                    F.when(mins > 60, "CRITICAL").when(mins > 15, "WARNING").otherwise("OK").alias("status"))


@query("l13_unified_worklist", sql("SELECT * FROM worklist", ALL))
def l13(spark, d):
    """Unified worklist over the last 24 hours' alerts of every tier; the top
    100 patients."""
    return worklist(recent(alert_union(Star(spark, d))))


@query("l13b_worklist_alerts", sql("""
SELECT u.patient_id, w.top_priority_rank, u.alert_type, u.alert_id, u.detail, u.priority AS tier, u.alert_time
FROM recent_alerts u JOIN worklist w ON u.patient_id = w.patient_id""", ALL))
def l13b(spark, d):
    """The alerts behind the worklist, one row each rather than a list
    per patient, so a patient with a third of all alerts stays spread out."""
    u = recent(alert_union(Star(spark, d)))
    top = F.broadcast(worklist(u).select("patient_id", "top_priority_rank"))  # at most 100 rows
    return u.join(top, "patient_id").select("patient_id", "top_priority_rank", "alert_type", "alert_id", "detail",
                                            F.col("priority").alias("tier"), "alert_time")


def routes_sql() -> str:
    return ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in ROUTES)


@query("l14_action_routing", sql(f"""
SELECT DISTINCT u.patient_id, u.alert_type, coalesce(r.action, '{OTHER_ROUTE[0]}') AS action,
  coalesce(r.destination, '{OTHER_ROUTE[1]}') AS destination
FROM alert_union u LEFT JOIN (SELECT * FROM (VALUES {routes_sql()}) t(alert_type, action, destination)) r
  ON u.alert_type = r.alert_type
WHERE u.priority = 'CRITICAL'""", ALL))
def l14(spark, d):
    """CRITICAL items routed to an action and destination (broadcast
    lookup of three rows)."""
    s = Star(spark, d)
    routes = reference_rows(spark, ROUTES, "alert_type string, action string, destination string")
    return (alert_union(s).where(F.col("priority") == "CRITICAL").join(routes, "alert_type", "left")
            .select("patient_id", "alert_type", F.coalesce("action", F.lit(OTHER_ROUTE[0])).alias("action"),
                    F.coalesce("destination", F.lit(OTHER_ROUTE[1])).alias("destination")).distinct())


@query("l15_co_occurring_alerts", sql("""
SELECT patient_id, 'fraud+high_cost' AS pattern FROM (
  SELECT patient_id FROM raised_alerts WHERE alert_type = 'fraud'
  INTERSECT SELECT patient_id FROM raised_alerts WHERE alert_type = 'high_cost')
UNION ALL
SELECT patient_id, 'high_cost+care_gap' FROM (
  SELECT patient_id FROM raised_alerts WHERE alert_type = 'high_cost'
  INTERSECT SELECT patient_id FROM raised_alerts WHERE alert_type = 'care_gap')""", ALL))
def l15(spark, d):
    """Patients with co-occurring alert types, from one aggregate of
    flags per patient (each alert table is scored once)."""
    t = F.col("alert_type")
    has = alert_union(Star(spark, d)).where(F.col("priority") != "LOW").groupBy("patient_id").agg(
        *[F.max(t == k).alias(k) for k in ("fraud", "care_gap", "high_cost")])
    patterns = F.array_compact(F.array(
        F.when(F.col("fraud") & F.col("high_cost"), F.lit("fraud+high_cost")),
        F.when(F.col("high_cost") & F.col("care_gap"), F.lit("high_cost+care_gap"))))
    return has.select("patient_id", F.explode(patterns).alias("pattern"))


@query("l18_live_counts", sql("""
SELECT _table, coalesce(adt_event_type, procedure_code, medication_code) AS subtype, count(*) AS events
FROM (SELECT _table,
        CASE WHEN _table = 'adt_events' THEN adt_event_type END AS adt_event_type,
        CASE WHEN _table = 'claims_events' THEN procedure_code END AS procedure_code,
        CASE WHEN _table = 'rx_events' THEN 'all' END AS medication_code
      FROM landing_events) GROUP BY 1, 2"""))
def l18(spark, d):
    """Live counts per feed, by procedure code (claims) and ADT type."""
    land = B.landing_events(Star(spark, d).t)
    t = F.col("_table")
    sub = (F.when(t == "adt_events", F.col("adt_event_type")).when(t == "claims_events", F.col("procedure_code"))
           .otherwise(F.lit("all")))
    return land.groupBy("_table", sub.alias("subtype")).agg(F.count(F.lit(1)).alias("events"))


@query("l19_patients_by_last_facility", sql("""
SELECT f.facility_name, count(*) AS patients
FROM last_facility l JOIN dim_facility f ON l.facility_id = f.facility_id GROUP BY 1""", ALL))
def l19(spark, d):
    """Last known facility per patient (latest ADT event), mapped."""
    from carelake.operators.windows import latest_by
    s = Star(spark, d)
    _, adt = feeds(s)
    last = latest_by(adt, "patient_id", ["event_timestamp", "event_id"], ["facility_id"])
    fac = s.dim_facility().select("facility_id", "facility_name")
    return last.join(fac, "facility_id").groupBy("facility_name").agg(F.count(F.lit(1)).alias("patients"))


@query("l20_score_distribution", sql("""
SELECT CASE WHEN fraud_score < 0.3 THEN 'Low' WHEN fraud_score < 0.7 THEN 'Medium' ELSE 'High' END AS score_bucket,
  count(*) AS claims FROM fraud_tiered GROUP BY 1""", ALL))
def l20(spark, d):
    """Fraud score distribution buckets (.3 / .7)."""
    f = fraud(Star(spark, d))
    b = F.when(F.col("fraud_score") < 0.3, "Low").when(F.col("fraud_score") < 0.7, "Medium").otherwise("High")
    return f.groupBy(b.alias("score_bucket")).agg(F.count(F.lit(1)).alias("claims"))


@query("l21_top_fraud_claims", sql("""
SELECT claim_id, provider_id, fraud_score, fraud_flags FROM fraud_tiered
ORDER BY fraud_score DESC, claim_id LIMIT 10""", ALL))
def l21(spark, d):
    """Top-10 table by fraud score."""
    return (fraud(Star(spark, d)).orderBy(F.col("fraud_score").desc(), "claim_id").limit(10)
            .select("claim_id", "provider_id", "fraud_score", "fraud_flags"))


@query("l22_flag_counts", sql("""
SELECT flag, count(*) AS claims FROM (SELECT unnest(string_split(fraud_flags, '|')) AS flag FROM fraud_tiered
  WHERE fraud_flags <> '') GROUP BY 1""", ALL))
def l22(spark, d):
    """Explode the pipe-delimited flag list and count per flag."""
    f = fraud(Star(spark, d)).where(F.col("fraud_flags") != "")
    return (f.select(F.explode(F.split("fraud_flags", r"\|")).alias("flag")).groupBy("flag")
            .agg(F.count(F.lit(1)).alias("claims")))


@query("l23_alert_trend_hourly", sql("""
SELECT date_trunc('hour', e.event_timestamp) AS hour, 'fraud' AS alert_type, count(*) AS alerts
FROM fraud_tiered f JOIN claims_events e ON f.claim_id = e.claim_id WHERE f.risk_tier <> 'LOW' GROUP BY 1
UNION ALL
SELECT date_trunc('hour', event_timestamp), 'care_gap', count(*) FROM gap_alerts GROUP BY 1
UNION ALL
SELECT date_trunc('hour', event_timestamp), 'high_cost', count(*) FROM trajectory GROUP BY 1""", ALL))
def l23(spark, d):
    """Alerts per hour of the three alert tables (fraud above tier LOW)."""
    u = alert_union(Star(spark, d)).where((F.col("alert_type") != "fraud") | (F.col("priority") != "LOW"))
    return u.groupBy(F.date_trunc("hour", "alert_time").cast("timestamp_ntz").alias("hour"), "alert_type").agg(
        F.count(F.lit(1)).alias("alerts"))


@query("l24_counts_by_category", sql("""
SELECT 'care_gap_measure' AS dimension, measure_id AS value, count(*) AS alerts FROM gap_alerts GROUP BY 2
UNION ALL SELECT 'care_gap_priority', alert_priority, count(*) FROM gap_alerts GROUP BY 2
UNION ALL SELECT 'fraud_tier', risk_tier, count(*) FROM fraud_tiered GROUP BY 2
UNION ALL SELECT 'high_cost_tier', risk_tier, count(*) FROM trajectory GROUP BY 2""", ALL))
def l24(spark, d):
    """Alert counts by measure, priority and tier in one table."""
    s = Star(spark, d)
    g = gap_alerts(s)

    def cnt(df, dim, col):
        return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("alerts")) \
            .select(F.lit(dim).alias("dimension"), "value", "alerts")
    return (cnt(g, "care_gap_measure", "measure_id").unionByName(cnt(g, "care_gap_priority", "alert_priority"))
            .unionByName(cnt(fraud(s), "fraud_tier", "risk_tier"))
            .unionByName(cnt(traj(s), "high_cost_tier", "risk_tier")))


@query("l25_gap_map", sql("""
SELECT facility_id, count(*) AS alerts, list_sort(list_distinct(list(measure_id))) AS measures
FROM gap_alerts GROUP BY 1""", ALL))
def l25(spark, d):
    """Per facility, open-gap alerts and the sorted set of measures
    (bounded by the eight measures)."""
    return gap_alerts(Star(spark, d)).groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("alerts"), F.array_sort(F.collect_set("measure_id")).alias("measures"))


@query("l25b_high_cost_map", sql(f"""
SELECT {rnd('t.latitude')} AS latitude, {rnd('t.longitude')} AS longitude, f.facility_name, count(*) AS patients,
  {rnd('avg(CAST(t.r30 AS DOUBLE))', 2)} AS avg_spend, min(t.risk_tier) AS risk_tier
FROM trajectory t JOIN dim_facility f ON t.facility_id = f.facility_id
WHERE t.latitude IS NOT NULL AND t.longitude IS NOT NULL GROUP BY 1, 2, 3""", ALL))
def l25b(spark, d):
    """High-cost patient map: members, average 30-day spend and a tier (the
    first by name) per place and last facility."""
    s = Star(spark, d)
    fac = s.dim_facility().select("facility_id", "facility_name")
    t = traj(s).where("latitude IS NOT NULL AND longitude IS NOT NULL").join(fac, "facility_id")
    return t.groupBy(M.rnd(F.col("latitude")).alias("latitude"), M.rnd(F.col("longitude")).alias("longitude"), "facility_name").agg(
        F.count(F.lit(1)).alias("patients"), M.rnd(F.avg(F.col("rolling_spend_30d").cast("double")), 2).alias("avg_spend"),
        F.min("risk_tier").alias("risk_tier"))


@query("l26_dashboard_filtered", sql("""
SELECT f.claim_id, f.fraud_score, f.risk_tier, e.facility_id
FROM fraud_tiered f JOIN claims_events e ON f.claim_id = e.claim_id
WHERE e.event_timestamp BETWEEN TIMESTAMP '2024-02-01 00:00:00' AND TIMESTAMP '2024-09-30 23:59:59'
  AND lower(f.risk_tier) IN ('high', 'medium') AND e.facility_id IN ('FAC001', 'FAC002', 'FAC003')""", ALL))
def l26(spark, d, start="2024-02-01 00:00:00", end="2024-09-30 23:59:59",
        tiers=("HIGH", "MEDIUM"), facilities=("FAC001", "FAC002", "FAC003")):
    """Dashboard parameters: time range, tier and facility filters
    (empty selection keeps everything)."""
    from carelake.functions.cleaning import optional_filter
    f = fraud(Star(spark, d))
    f = f.where(F.col("event_timestamp").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    f = optional_filter(f, "risk_tier", list(tiers))
    f = optional_filter(f, "facility_id", list(facilities))
    return f.select("claim_id", "fraud_score", "risk_tier", "facility_id")


@query("l27_alert_hotspots", sql("""
SELECT facility_name, measure_id, count(*) AS open_gap_alerts,
  count(*) FILTER (WHERE alert_priority = 'CRITICAL') AS critical_alerts
FROM gap_alerts GROUP BY 1, 2""", ALL))
def l27(spark, d):
    """Open gaps and CRITICAL alerts by facility x measure."""
    return gap_alerts(Star(spark, d)).groupBy("facility_name", "measure_id").agg(
        F.count(F.lit(1)).alias("open_gap_alerts"),
        F.count_if(F.col("alert_priority") == "CRITICAL").alias("critical_alerts"))


@query("l28_critical_gap_summary", sql(f"""
SELECT measure_id, count(DISTINCT patient_id) AS critical_patients, {rnd('avg(gap_days_overdue)', 2)} AS avg_overdue,
  max(gap_days_overdue) AS max_overdue
FROM gap_alerts WHERE alert_priority = 'CRITICAL' GROUP BY 1""", ALL))
def l28(spark, d):
    """Patients with a CRITICAL gap and overdue days per measure."""
    g = gap_alerts(Star(spark, d)).where(F.col("alert_priority") == "CRITICAL")
    return g.groupBy("measure_id").agg(F.countDistinct("patient_id").alias("critical_patients"),
                                       M.rnd(F.avg("gap_days_overdue"), 2).alias("avg_overdue"),
                                       F.max("gap_days_overdue").alias("max_overdue"))


@query("l29_accelerating_members", sql("""
SELECT patient_id, CAST(r30 AS DOUBLE) AS rolling_spend_30d, ed_visits_30d, readmission_count_30d
FROM trajectory WHERE cost_trend = 'ACCELERATING'""", ALL))
def l29(spark, d):
    """Members whose spend is accelerating."""
    t = traj(Star(spark, d)).where(F.col("cost_trend") == "ACCELERATING")
    return t.select("patient_id", F.col("rolling_spend_30d").cast("double"), "ed_visits_30d",
                    "readmission_count_30d")


@query("l30_pattern_exposure", sql("""
SELECT f.risk_tier, count(*) AS claims,
  CAST(round(coalesce(sum(CASE WHEN list_contains(f.fraud_flag_list, 'geo_anomaly') THEN f.claim_amount END), 0), 2) AS DOUBLE)
    AS geo_anomaly_amount
FROM fraud_tiered f GROUP BY 1""", ALL))
def l30(spark, d, pattern: str = "geo_anomaly"):
    """Flagged amount for one fraud pattern, and claims per tier."""
    f = fraud(Star(spark, d))
    hit = F.array_contains("fraud_flag_list", pattern)
    return f.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("claims"),
        F.coalesce(M.money(F.sum(F.when(hit, F.col("claim_amount")))), F.lit(0.0)).alias(f"{pattern}_amount"))


@query("l31_threshold_routing", sql("""
SELECT claim_id AS item_id, 'fraud' AS alert_type, 'SIU review queue' AS queue FROM fraud_tiered WHERE fraud_score >= 0.80
UNION ALL
SELECT DISTINCT patient_id || ':' || measure_id, 'care_gap', 'Care management queue' FROM gap_alerts WHERE gap_days_overdue > 180
UNION ALL
SELECT patient_id, 'high_cost', 'Case management queue' FROM trajectory WHERE r30 > 10000000 OR ed_visits_30d >= 5""", ALL))
def l31(spark, d):
    """Threshold routing rules (scores as fractions; spend on the
    feed's dollar scale) -> queues."""
    s = Star(spark, d)
    a = (fraud(s).where(F.col("fraud_score") >= 0.80)
         .select(F.col("claim_id").alias("item_id"), F.lit("fraud").alias("alert_type"),
                 F.lit("SIU review queue").alias("queue")))
    b = (gap_alerts(s).where(F.col("gap_days_overdue") > 180)
         .select(F.concat_ws(":", "patient_id", "measure_id").alias("item_id"), F.lit("care_gap").alias("alert_type"),
                 F.lit("Care management queue").alias("queue")).distinct())
    c = (traj(s).where((F.col("rolling_spend_30d") > 10_000_000) | (F.col("ed_visits_30d") >= 5))
         .select(F.col("patient_id").alias("item_id"), F.lit("high_cost").alias("alert_type"),
                 F.lit("Case management queue").alias("queue")))
    return a.unionByName(b).unionByName(c)
