"""Event scoring queries (K1-K19) over the driver event feed.

Threshold parameters: velocity counts are per provider-hour (the driver
feed peaks at 3-4 events per hour, so the registered query fires above 1
instead of 5); spend thresholds are on the feed's dollar scale (claim amount =
value x 1000), FEED_DOLLARS times the defaults.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.functions.exprs import hash_bucket
from carelake.operators import scoring as K
from carelake.plans import metrics as M
from carelake.plans.oracle import AS_OF, hb, lst, rnd, sql
from carelake.plans.registry import query
from carelake.plans.star import Star
from carelake.sources import bindings as B

VELOCITY_MIN = 1
FEED_DOLLARS = 5
SPEND_30D, SPEND_90D, ED_MIN = K.SPEND_30D * FEED_DOLLARS, K.SPEND_90D * FEED_DOLLARS, K.ED_VISITS_30D


def feeds(s: Star):
    land = B.landing_events(s.t)
    return B.claims_events(land), B.adt_events(land)


def fraud(s: Star):
    """The scored claim events, written once a session."""
    def build():
        ev, _ = feeds(s)
        return K.fraud_scores(ev, s.dim_provider(), s.dim_facility(), K.provider_history(s.fact_claim()),
                              velocity_min=VELOCITY_MIN)
    return s.snapshot("fraud_scores", build)


FRAUD_SQL = {"fraud_scored": f"""
SELECT *, {rnd('(velocity_score + amount_score + geo_score + upcoding_score) / 100.0::DOUBLE', 2)} AS fraud_score,
  concat_ws('|', CASE WHEN velocity_score > 0 THEN 'velocity_burst' END,
                 CASE WHEN amount_score > 0 THEN 'amount_outlier' END,
                 CASE WHEN geo_score > 0 THEN 'geo_anomaly' END,
                 CASE WHEN upcoding_score > 0 THEN 'upcoding' END) AS fraud_flags,
  list_filter([CASE WHEN velocity_score > 0 THEN 'velocity_burst' END,
               CASE WHEN amount_score > 0 THEN 'amount_outlier' END,
               CASE WHEN geo_score > 0 THEN 'geo_anomaly' END,
               CASE WHEN upcoding_score > 0 THEN 'upcoding' END], lambda x: x IS NOT NULL) AS fraud_flag_list
FROM (
  SELECT *,
    CASE WHEN claims_in_window > {VELOCITY_MIN} THEN least(30, (claims_in_window - {VELOCITY_MIN}) * 6) ELSE 0 END
      AS velocity_score,
    CASE WHEN amount_zscore > 2 THEN least(25.0::DOUBLE, (amount_zscore - 2) * 10) ELSE 0.0::DOUBLE END AS amount_score,
    CASE WHEN geo_distance_deg > 1 THEN least(25.0::DOUBLE, geo_distance_deg * 5) ELSE 0.0::DOUBLE END AS geo_score,
    CASE WHEN procedure_code = '99215' THEN 20 ELSE 0 END AS upcoding_score
  FROM (
    SELECT e.*, count(*) OVER (PARTITION BY e.provider_id ORDER BY e.event_timestamp
                               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS claims_in_window,
      CASE WHEN h.s IS NOT NULL AND h.s > 0 THEN (CAST(e.claim_amount AS DOUBLE) - h.a) / h.s ELSE 0.0::DOUBLE END
        AS amount_zscore,
      sqrt(pow(e.latitude - f.latitude, 2) + pow(e.longitude - f.longitude, 2)) AS geo_distance_deg
    FROM claims_events e LEFT JOIN dim_facility f ON e.facility_id = f.facility_id
    LEFT JOIN (SELECT provider_id, avg(CAST(billed_amount AS DOUBLE)) AS a, stddev_samp(CAST(billed_amount AS DOUBLE)) AS s
               FROM fact_claim GROUP BY 1) h ON e.provider_id = h.provider_id))""",
    "fraud_tiered": """SELECT *, CASE WHEN fraud_score >= 0.50 THEN 'CRITICAL' WHEN fraud_score >= 0.30 THEN 'HIGH'
        WHEN fraud_score >= 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM fraud_scored"""}


@query("k01_fraud_scores", sql(f"""
SELECT claim_id, provider_id, event_timestamp, claims_in_window, velocity_score, {rnd('amount_zscore')} AS amount_zscore,
  {rnd('amount_score')} AS amount_score, {rnd('geo_distance_deg')} AS geo_distance_deg, {rnd('geo_score')} AS geo_score,
  upcoding_score, fraud_score, fraud_flags, fraud_flag_list, risk_tier
FROM fraud_tiered""", FRAUD_SQL))
def k01(spark, d):
    """K1-K5: velocity, amount z-score, geography and upcoding rules,
    composite score, tier and flags for every claim event."""
    f = fraud(Star(spark, d))
    return f.select("claim_id", "provider_id", "event_timestamp", "claims_in_window", "velocity_score",
                    M.rnd(F.col("amount_zscore")).alias("amount_zscore"),
                    M.rnd(F.col("amount_score")).alias("amount_score"),
                    M.rnd(F.col("geo_distance_deg")).alias("geo_distance_deg"),
                    M.rnd(F.col("geo_score")).alias("geo_score"), "upcoding_score", "fraud_score",
                    "fraud_flags", "fraud_flag_list", "risk_tier")


@query("k06_fraud_summary_by_tier", sql(f"""
SELECT risk_tier, count(*) AS claims, {rnd('avg(fraud_score)')} AS avg_fraud_score,
  CAST(round(sum(claim_amount), 2) AS DOUBLE) AS flagged_amount,
  CASE risk_tier WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS tier_order
FROM fraud_tiered GROUP BY risk_tier""", FRAUD_SQL))
def k06(spark, d):
    """K6: fraud summary per tier in the custom tier order."""
    f = fraud(Star(spark, d))
    order = (F.when(F.col("risk_tier") == "CRITICAL", 1).when(F.col("risk_tier") == "HIGH", 2)
             .when(F.col("risk_tier") == "MEDIUM", 3).otherwise(4))
    return (f.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("claims"),
                                       M.rnd(F.avg("fraud_score")).alias("avg_fraud_score"),
                                       M.money(F.sum("claim_amount")).alias("flagged_amount"))
            .withColumn("tier_order", order).orderBy("tier_order"))


@query("k06b_top_flagged_providers", sql(f"""
SELECT provider_id, count(*) AS flagged_claims, {rnd('avg(fraud_score)')} AS avg_fraud_score
FROM fraud_tiered WHERE fraud_score >= 0.15 GROUP BY 1 ORDER BY flagged_claims DESC, provider_id LIMIT 10""",
          FRAUD_SQL))
def k06b(spark, d):
    """K6: the ten providers with the most flagged claims."""
    f = fraud(Star(spark, d)).where(F.col("fraud_score") >= 0.15)
    return (f.groupBy("provider_id").agg(F.count(F.lit(1)).alias("flagged_claims"),
                                         M.rnd(F.avg("fraud_score")).alias("avg_fraud_score"))
            .orderBy(F.col("flagged_claims").desc(), "provider_id").limit(10))


@query("k04b_upcoding_habit", sql(f"""
SELECT provider_id, count(*) AS claims, count(*) FILTER (WHERE procedure_code = '99215') AS top_code_claims,
  {rnd("CAST(count(*) FILTER (WHERE procedure_code = '99215') AS DOUBLE) / count(*)")} AS top_code_share,
  CAST(count(*) FILTER (WHERE procedure_code = '99215') AS DOUBLE) / count(*) >= 0.3 AS habitual
FROM claims_events GROUP BY 1"""))
def k04b(spark, d):
    """Share of the top E&M code per provider (habitual upcoding)."""
    ev, _ = feeds(Star(spark, d))
    return K.upcoding_habit(ev)


def _gaps(s: Star):
    pats = s.dim_patient().where("is_current = 1").select("patient_id", "age", "gender")
    codes = s.dim_diagnosis().select("icd_code", F.col("standard_code").alias("code"))
    conditions = s.fact_diagnosis().select("patient_id", "icd_code").join(codes, "icd_code").select("patient_id", "code")
    # an outpatient visit renders the service of one measure, by its id
    ids = F.array(*[F.lit(m[0]) for m in K.HEDIS_MEASURES])
    served = F.element_at(ids, hash_bucket("encounter_id", len(K.HEDIS_MEASURES)) + 1)
    last = (s.fact_encounter().where(F.col("encounter_type") == "Outpatient")
            .groupBy("patient_id", served.alias("measure_id")).agg(F.max("encounter_date").alias("last_service_date")))
    return K.hedis_gaps(pats, conditions, last, K.hedis_measures(s.spark), AS_OF)


def _hedis_values() -> str:
    def lit(v):
        if isinstance(v, list):
            return f"CAST({lst(v)} AS VARCHAR[])"
        if isinstance(v, bool):
            return "true" if v else "false"
        return str(v) if isinstance(v, int) else "'" + v + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in K.HEDIS_MEASURES)


GAP_SQL = {
    "hedis": f"""SELECT * FROM (VALUES {_hedis_values()}) t(measure_id, measure_name, description,
        frequency_months, age_min, age_max, female_only, target_icd)""",
    "hedis_qualified": """
SELECT DISTINCT d.patient_id, t.measure_id FROM fact_diagnosis d JOIN dim_diagnosis x ON d.icd_code = x.icd_code
JOIN (SELECT measure_id, unnest(target_icd) AS code FROM hedis) t ON t.code = x.standard_code""",
    "hedis_services": f"""
SELECT patient_id, {lst([m[0] for m in K.HEDIS_MEASURES])}[{hb('encounter_id', len(K.HEDIS_MEASURES))} + 1] AS measure_id,
  max(encounter_date) AS last_service_date
FROM fact_encounter WHERE encounter_type = 'Outpatient' GROUP BY 1, 2""",
    "hedis_gaps": f"""
SELECT patient_id, measure_id, measure_name, (due IS NULL OR due < DATE '{AS_OF}') AS is_gap_open,
  last_service_date, due AS due_date,
  CASE WHEN due IS NULL THEN NULL ELSE CAST(greatest(datediff('day', due, DATE '{AS_OF}'), 0) AS INTEGER) END
    AS gap_days_overdue
FROM (
  SELECT p.patient_id, m.measure_id, m.measure_name, l.last_service_date,
    CAST(l.last_service_date + to_months(m.frequency_months) AS DATE) AS due
  FROM dim_patient p JOIN hedis m ON p.age >= m.age_min AND p.age <= m.age_max
    AND (NOT m.female_only OR p.gender = 'Female')
  LEFT JOIN hedis_services l ON p.patient_id = l.patient_id AND m.measure_id = l.measure_id
  LEFT JOIN hedis_qualified q ON p.patient_id = q.patient_id AND m.measure_id = q.measure_id
  WHERE p.is_current = 1 AND (len(m.target_icd) = 0 OR q.patient_id IS NOT NULL))""",
}
GAP_SQL["gap_alerts"] = """
SELECT event_id, event_timestamp, patient_id, facility_id, facility_name, latitude, longitude, measure_id, measure_name,
  gap_days_overdue, CASE WHEN measure_id IN ('CDC', 'BCS', 'COL') AND gap_days_overdue > 180 THEN 'CRITICAL'
       WHEN gap_days_overdue > 365 THEN 'CRITICAL'
       WHEN measure_id IN ('CDC', 'BCS', 'COL') OR gap_days_overdue > 90 THEN 'HIGH'
       WHEN gap_days_overdue > 30 THEN 'MEDIUM' ELSE 'LOW' END AS alert_priority,
  'CARE GAP ALERT: Patient ' || coalesce(first_name, '') || ' ' || coalesce(last_name, '') || ' has an open '
    || measure_id || ' gap (' || coalesce(measure_name, measure_id) || '), overdue by '
    || CAST(gap_days_overdue AS VARCHAR) || ' days. Consider ordering during this visit.' AS alert_text
FROM (
  SELECT a.event_id, a.event_timestamp, a.patient_id, a.facility_id, f.facility_name, a.latitude, a.longitude, g.measure_id,
    coalesce(g.measure_name, g.measure_id) AS measure_name, coalesce(g.gap_days_overdue, 0) AS gap_days_overdue,
    p.first_name, p.last_name
  FROM adt_events a JOIN hedis_gaps g ON a.patient_id = g.patient_id AND g.is_gap_open
  LEFT JOIN dim_patient p ON a.patient_id = p.patient_id AND p.is_current = 1
  LEFT JOIN dim_facility f ON a.facility_id = f.facility_id
  WHERE a.event_type IN ('ADMIT', 'OBSERVATION'))"""


def gap_alerts(s: Star):
    """The care-gap alerts, written once a session."""
    def build():
        _, adt = feeds(s)
        pats = s.dim_patient().where("is_current = 1").select("patient_id", "first_name", "last_name")
        return K.care_gap_alerts(adt, _gaps(s), pats, s.dim_facility())
    return s.snapshot("care_gap_alerts", build)


@query("k11_hedis_gaps", sql("""
SELECT patient_id, measure_id, is_gap_open, last_service_date, due_date, gap_days_overdue FROM hedis_gaps""", GAP_SQL))
def k11(spark, d):
    """HEDIS eligibility by age, gender and condition; open gaps."""
    return _gaps(Star(spark, d)).select("patient_id", "measure_id", "is_gap_open", "last_service_date",
                                        "due_date", "gap_days_overdue")


@query("k07_care_gap_alerts", sql("""
SELECT event_id, event_timestamp, patient_id, facility_name, measure_id, measure_name, gap_days_overdue,
  alert_priority, alert_text FROM gap_alerts""", GAP_SQL))
def k07(spark, d):
    """K7-K9: admission/observation events meeting open care gaps."""
    return gap_alerts(Star(spark, d)).select("event_id", "event_timestamp", "patient_id", "facility_name",
                                             "measure_id", "measure_name", "gap_days_overdue", "alert_priority",
                                             "alert_text")


@query("k10_care_gap_summary", sql("""
SELECT alert_priority, measure_id, count(*) AS alerts, count(DISTINCT patient_id) AS patients,
  count(DISTINCT facility_id) AS facilities FROM gap_alerts GROUP BY 1, 2""", GAP_SQL))
def k10(spark, d):
    """Care-gap alerts by priority x measure with distinct counts."""
    return gap_alerts(Star(spark, d)).groupBy("alert_priority", "measure_id").agg(
        F.count(F.lit(1)).alias("alerts"), F.countDistinct("patient_id").alias("patients"),
        F.countDistinct("facility_id").alias("facilities"))


def traj(s: Star):
    """The members' trajectories, written once a session."""
    def build():
        ev, adt = feeds(s)
        return K.trajectory(ev, adt, SPEND_30D, SPEND_90D, ED_MIN)
    return s.snapshot("trajectory", build)


TRAJ_SQL = {
    "spend_latest": """
SELECT patient_id, rolling_spend_30d, rolling_spend_90d, claims_count_30d, event_timestamp, latitude, longitude FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM (
    SELECT *, sum(claim_amount) OVER w30 AS rolling_spend_30d, count(*) OVER w30 AS claims_count_30d,
      sum(claim_amount) OVER w90 AS rolling_spend_90d
    FROM claims_events
    WINDOW w30 AS (PARTITION BY patient_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW),
           w90 AS (PARTITION BY patient_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)))
WHERE rn = 1""",
    "ed_latest": """
SELECT patient_id, ed_visits_30d FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM (
    SELECT *, count(*) OVER (PARTITION BY patient_id ORDER BY event_timestamp
                             RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS ed_visits_30d
    FROM adt_events WHERE admission_type = 'EMERGENCY'))
WHERE rn = 1""",
    "readmit_counts": """
SELECT patient_id, count(*) FILTER (WHERE date_diff('day', prev, day) <= 30) AS readmission_count_30d FROM (
  SELECT patient_id, CAST(event_timestamp AS DATE) AS day,
    lag(CAST(event_timestamp AS DATE)) OVER (PARTITION BY patient_id ORDER BY event_timestamp, event_id) AS prev
  FROM adt_events WHERE event_type = 'ADMIT') GROUP BY 1""",
    "last_facility": """
SELECT patient_id, facility_id FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM adt_events) WHERE rn = 1""",
}
TRAJ_SQL["trajectory"] = f"""
SELECT *, CASE WHEN r30 >= {SPEND_30D} AND ed_visits_30d >= {ED_MIN} THEN 'CRITICAL'
               WHEN r30 >= {SPEND_30D} OR r90 >= {SPEND_90D} THEN 'HIGH'
               WHEN ed_visits_30d >= {ED_MIN} OR readmission_count_30d > 0 OR cost_trend = 'ACCELERATING' THEN 'MEDIUM'
               ELSE 'LOW' END AS risk_tier
FROM (
  SELECT *, CASE WHEN CAST(r30 AS DOUBLE) > CAST(r90 AS DOUBLE) / 3 * 1.5 THEN 'ACCELERATING'
                 WHEN CAST(r30 AS DOUBLE) > CAST(r90 AS DOUBLE) / 3 * 1.1 THEN 'RISING'
                 WHEN CAST(r30 AS DOUBLE) < CAST(r90 AS DOUBLE) / 3 * 0.8 THEN 'DECLINING' ELSE 'STABLE' END AS cost_trend
  FROM (
    SELECT s.patient_id, s.event_timestamp, s.latitude, s.longitude, coalesce(s.rolling_spend_30d, 0) AS r30, coalesce(s.rolling_spend_90d, 0) AS r90,
      s.claims_count_30d, coalesce(e.ed_visits_30d, 0) AS ed_visits_30d,
      coalesce(r.readmission_count_30d, 0) AS readmission_count_30d, f.facility_id
    FROM spend_latest s LEFT JOIN ed_latest e ON s.patient_id = e.patient_id
    LEFT JOIN readmit_counts r ON s.patient_id = r.patient_id
    LEFT JOIN last_facility f ON s.patient_id = f.patient_id))"""


@query("k12_highcost_trajectory", sql("""
SELECT patient_id, CAST(r30 AS DOUBLE) AS rolling_spend_30d, CAST(r90 AS DOUBLE) AS rolling_spend_90d,
  claims_count_30d, ed_visits_30d, readmission_count_30d, cost_trend, risk_tier, facility_id
FROM trajectory""", TRAJ_SQL))
def k12(spark, d):
    """Rolling spend, ED visits, admit-to-admit readmissions, last
    facility, cost trend and trajectory tier per patient."""
    t = traj(Star(spark, d))
    return t.select("patient_id", F.col("rolling_spend_30d").cast("double"),
                    F.col("rolling_spend_90d").cast("double"), "claims_count_30d", "ed_visits_30d",
                    "readmission_count_30d", "cost_trend", "risk_tier", "facility_id")


@query("k19_trajectory_summary", sql(f"""
SELECT risk_tier, cost_trend, count(*) AS patients, {rnd('avg(CAST(r30 AS DOUBLE))', 2)} AS avg_spend_30d
FROM trajectory GROUP BY 1, 2""", TRAJ_SQL))
def k19(spark, d):
    """Trajectory summary by tier x trend."""
    t = traj(Star(spark, d))
    return t.groupBy("risk_tier", "cost_trend").agg(
        F.count(F.lit(1)).alias("patients"),
        M.rnd(F.avg(F.col("rolling_spend_30d").cast("double")), 2).alias("avg_spend_30d"))


@query("k19c_trajectory_by_tier", sql(f"""
SELECT risk_tier, count(*) AS patients, {rnd('avg(CAST(r30 AS DOUBLE))', 0)} AS avg_spend_30d,
  {rnd('avg(CAST(r90 AS DOUBLE))', 0)} AS avg_spend_90d, {rnd('avg(CAST(ed_visits_30d AS DOUBLE))', 1)} AS avg_ed_visits,
  count(*) FILTER (WHERE readmission_count_30d > 0) AS readmissions
FROM trajectory GROUP BY 1""", TRAJ_SQL))
def k19c(spark, d):
    """Per tier members, average spends and ED visits, readmitted members."""
    return traj(Star(spark, d)).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("patients"), M.rnd(F.avg(F.col("rolling_spend_30d").cast("double")), 0).alias("avg_spend_30d"),
        M.rnd(F.avg(F.col("rolling_spend_90d").cast("double")), 0).alias("avg_spend_90d"),
        M.rnd(F.avg(F.col("ed_visits_30d").cast("double")), 1).alias("avg_ed_visits"),
        F.count_if("readmission_flag").alias("readmissions"))


@query("k19d_trajectory_by_trend", sql(f"""
SELECT cost_trend, count(*) AS members, {rnd('avg(CAST(r30 AS DOUBLE))', 0)} AS avg_spend_30d,
  {rnd('avg(CAST(ed_visits_30d AS DOUBLE))', 1)} AS avg_ed_visits FROM trajectory GROUP BY 1""", TRAJ_SQL))
def k19d(spark, d):
    """Per cost trend members, average spend and ED visits."""
    return traj(Star(spark, d)).groupBy("cost_trend").agg(
        F.count(F.lit(1)).alias("members"), M.rnd(F.avg(F.col("rolling_spend_30d").cast("double")), 0).alias("avg_spend_30d"),
        M.rnd(F.avg(F.col("ed_visits_30d").cast("double")), 1).alias("avg_ed_visits"))


@query("k19b_top_spenders", sql("""
SELECT patient_id, CAST(r30 AS DOUBLE) AS rolling_spend_30d, risk_tier FROM trajectory
WHERE risk_tier IN ('CRITICAL', 'HIGH') ORDER BY r30 DESC, patient_id LIMIT 15""", TRAJ_SQL))
def k19b(spark, d):
    """The 15 CRITICAL or HIGH members with the largest 30-day spend."""
    t = traj(Star(spark, d)).where(F.col("risk_tier").isin("CRITICAL", "HIGH"))
    return (t.orderBy(F.col("rolling_spend_30d").desc(), "patient_id").limit(15)
            .select("patient_id", F.col("rolling_spend_30d").cast("double"), "risk_tier"))


@query("k18_patient_location", sql(f"""
SELECT p.patient_id, {rnd('coalesce(a.latitude, c.latitude, f.latitude)')} AS latitude,
  {rnd('coalesce(a.longitude, c.longitude, f.longitude)')} AS longitude,
  CASE WHEN a.latitude IS NOT NULL THEN 'adt' WHEN c.latitude IS NOT NULL THEN 'claim' ELSE 'facility' END AS source
FROM dim_patient p
LEFT JOIN (SELECT patient_id, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
           ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM adt_events) WHERE rn = 1) a ON p.patient_id = a.patient_id
LEFT JOIN (SELECT patient_id, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
           ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM claims_events) WHERE rn = 1) c ON p.patient_id = c.patient_id
LEFT JOIN dim_facility f ON f.zip_code = p.zip_code
WHERE p.is_current = 1"""))
def k18(spark, d):
    """Member location from three sources in order: latest ADT event,
    latest claim event, home facility (same zip)."""
    from carelake.operators.windows import latest_by
    s = Star(spark, d)
    ev, adt = feeds(s)
    a = latest_by(adt, "patient_id", ["event_timestamp", "event_id"], ["latitude", "longitude"]) \
        .withColumnsRenamed({"latitude": "a_lat", "longitude": "a_lon"})
    c = latest_by(ev, "patient_id", ["event_timestamp", "event_id"], ["latitude", "longitude"]) \
        .withColumnsRenamed({"latitude": "c_lat", "longitude": "c_lon"})
    fac = s.dim_facility().select("zip_code", F.col("latitude").alias("f_lat"), F.col("longitude").alias("f_lon"))
    p = s.dim_patient().where("is_current = 1").select("patient_id", "zip_code")
    j = p.join(a, "patient_id", "left").join(c, "patient_id", "left").join(fac, "zip_code", "left")
    src = F.when(F.col("a_lat").isNotNull(), "adt").when(F.col("c_lat").isNotNull(), "claim").otherwise("facility")
    return j.select("patient_id", M.rnd(F.coalesce("a_lat", "c_lat", "f_lat")).alias("latitude"),
                    M.rnd(F.coalesce("a_lon", "c_lon", "f_lon")).alias("longitude"), src.alias("source"))
