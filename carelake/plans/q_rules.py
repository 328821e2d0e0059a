"""Rule operators surfaced on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.functions.exprs import euclid_degrees, haversine_km
from carelake.operators import facts as E
from carelake.plans import metrics as M
from carelake.plans.oracle import _PCT, hb, rnd, sql
from carelake.plans.q_scoring import feeds
from carelake.plans.registry import query
from carelake.plans.star import Star

DATA_END = "2001-06-30"


@query("e04_clinical_risk_by_type", sql(f"""
SELECT encounter_type, count(*) AS encounters, {rnd('avg(score)')} AS avg_clinical_risk,
  count(*) FILTER (WHERE score >= 0.7) AS high_risk
FROM (
  SELECT e.encounter_type, {rnd('''least(greatest(0.15::DOUBLE
      + CASE WHEN e.encounter_type IN ('Inpatient', 'Emergency') THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN e.length_of_stay > 7 THEN 0.15::DOUBLE WHEN e.length_of_stay > 3 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN e.total_charges > 50000 THEN 0.10::DOUBLE WHEN e.total_charges > 20000 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN x.is_chronic = 1 THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN x.standard_code IN ('I50.9', 'J44.9', 'N18.3') THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN e.discharge_disposition IN ('SNF', 'Rehab', 'Home Health') THEN 0.08::DOUBLE
             WHEN e.discharge_disposition = 'AMA' THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END,
      0.01::DOUBLE), 0.99::DOUBLE)''')} AS score
  FROM fact_encounter e LEFT JOIN dim_diagnosis x ON e.primary_diagnosis_code = x.icd_code)
GROUP BY 1"""))
def e04(spark, d):
    """Additive clinical risk score (type, stay, charges, primary
    diagnosis, disposition), clamped to [.01, .99]."""
    s = Star(spark, d)
    dx = s.dim_diagnosis().select(F.col("icd_code").alias("primary_diagnosis_code"), "is_chronic", "standard_code")
    e = s.fact_encounter().join(dx, "primary_diagnosis_code", "left")
    score = E.clinical_risk_score(F.col("encounter_type"), F.col("length_of_stay"), F.col("total_charges"),
                                  F.col("is_chronic"), F.col("standard_code"), F.col("discharge_disposition"))
    return e.withColumn("score", score).groupBy("encounter_type").agg(
        F.count(F.lit(1)).alias("encounters"), M.rnd(F.avg("score")).alias("avg_clinical_risk"),
        F.count_if(F.col("score") >= 0.7).alias("high_risk"))


@query("e09_denials_without_status", sql(f"""
SELECT payer_type, count(*) AS claims, CAST(sum(denied) AS BIGINT) AS denied, CAST(sum(paid) AS DOUBLE) AS paid FROM (
  SELECT payer_type, CASE WHEN is_denied THEN 1 ELSE 0 END AS denied,
    CASE WHEN is_denied THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(coalesce(paid_amount,
      round(coalesce(billed_amount, CAST(0 AS DECIMAL(18,2))) * CAST(0.80 AS DECIMAL(3,2)), 2)) AS DECIMAL(18,2)) END AS paid
  FROM (SELECT c.*, p.payer_type, {hb('c.claim_id', 100)} < {_PCT} AS is_denied
        FROM silver_claims c LEFT JOIN dim_payer p ON c.payer_id = p.payer_id))
GROUP BY 1"""))
def e09(spark, d):
    """E9's other branch: a claims feed without adjudication status has no
    denials of its own (below the 2 % share), so E8's rates decide."""
    s = Star(spark, d)
    py = s.dim_payer().select("payer_id", "payer_name", "payer_type")
    c = s.silver_claims().withColumn("claim_status", F.lit(None).cast("string")).join(py, "payer_id", "left")
    return E.score_claims(c).groupBy("payer_type").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("denial_flag").cast("long").alias("denied"),
        F.sum("paid_amount").cast("double").alias("paid"))


@query("e14_denial_actions", sql("""
SELECT primary_denial_reason, recommended_action, count(*) AS claims, CAST(sum(denial_flag) AS BIGINT) AS denied
FROM fact_claim GROUP BY 1, 2"""))
def e14(spark, d):
    """Canonical denial reasons with their next step."""
    return Star(spark, d).fact_claim().groupBy("primary_denial_reason", "recommended_action").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("denial_flag").cast("long").alias("denied"))


@query("e16_claim_lifecycle", sql(f"""
SELECT claim_status, count(*) AS claims, count(payment_date) AS with_payment_date, count(paid_amount) AS with_payment
FROM (SELECT claim_status,
        CASE WHEN lower(claim_status) IN ('pending', 'submitted') THEN NULL ELSE payment_date END AS payment_date,
        CASE WHEN lower(claim_status) IN ('pending', 'submitted') THEN NULL ELSE paid_amount END AS paid_amount
      FROM silver_claims WHERE claim_date IS NULL OR claim_date <= DATE '{DATA_END}')
GROUP BY 1"""))
def e16(spark, d):
    """Claims after the data end are dropped; unadjudicated claims carry
    no decision date and no payment."""
    c = E.lifecycle_consistency(Star(spark, d).silver_claims(), DATA_END)
    return c.groupBy("claim_status").agg(F.count(F.lit(1)).alias("claims"),
                                         F.count("payment_date").alias("with_payment_date"),
                                         F.count("paid_amount").alias("with_payment"))


@query("e18_encounter_payer_bridge", sql("""
SELECT y.payer_name, count(*) AS encounters FROM (
  SELECT encounter_id, payer_id, row_number() OVER (PARTITION BY encounter_id ORDER BY claim_date DESC NULLS LAST,
    payer_id DESC NULLS LAST) AS rn FROM silver_claims) b
JOIN dim_payer y ON b.payer_id = y.payer_id WHERE b.rn = 1 GROUP BY 1"""))
def e18(spark, d):
    """One payer per encounter (latest claim wins), then its key."""
    s = Star(spark, d)
    bridge = E.one_per_group(s.silver_claims(), "encounter_id", ["claim_date", "payer_id"], "payer_id")
    py = s.dim_payer().select("payer_id", "payer_name")
    return bridge.join(py, "payer_id").groupBy("payer_name").agg(F.count(F.lit(1)).alias("encounters"))


@query("k03_geo_distances", sql(f"""
SELECT e.claim_id,
  {rnd('sqrt(pow(e.latitude - f.latitude, 2) + pow(e.longitude - f.longitude, 2))')} AS distance_deg,
  {rnd('2 * 6371.0 * asin(sqrt(pow(sin((radians(f.latitude) - radians(e.latitude)) / 2), 2) + cos(radians(e.latitude)) * cos(radians(f.latitude)) * pow(sin((radians(f.longitude) - radians(e.longitude)) / 2), 2)))', 1)} AS distance_km
FROM claims_events e LEFT JOIN dim_facility f ON e.facility_id = f.facility_id"""))
def k03(spark, d):
    """Event-to-facility distance in degrees (what the rule uses)
    and as great-circle kilometres."""
    s = Star(spark, d)
    ev, _ = feeds(s)
    fac = s.dim_facility().select("facility_id", F.col("latitude").alias("flat"), F.col("longitude").alias("flon"))
    j = ev.join(fac, "facility_id", "left")
    return j.select("claim_id", M.rnd(euclid_degrees("latitude", "longitude", "flat", "flon")).alias("distance_deg"),
                    M.rnd(haversine_km("latitude", "longitude", "flat", "flon"), 1).alias("distance_km"))
