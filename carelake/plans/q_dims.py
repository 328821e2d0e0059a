"""Cleaning, enrichment and dimensional-modelling recipes (B, C, D1-D17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.functions.exprs import days_open, rnd, safe_ratio
from carelake.operators import dims as D
from carelake.operators.enrich import lookup_join
from carelake.operators.keys import assign_stable_keys, dense_keys, duplicate_keys, high_water
from carelake.plans import metrics as M
from carelake.plans.oracle import AS_OF, rnd as rnd_sql, sql
from carelake.plans.registry import query
from carelake.plans.star import Star
from carelake.sources import bindings as B

SNAP1 = "1997-01-01"     # as-of date of the earlier dimension snapshot
UPSERT_CUT, UPSERT_FROM = "2000-01-01", "1999-07-01"


@query("d01_date_dimension", sql("SELECT * FROM dim_date"))
def d01(spark, d):
    """Date dimension with a July fiscal year (range from the data)."""
    return Star(spark, d).dim_date()


@query("d03_dense_encounter_keys", sql("SELECT encounter_id, encounter_key FROM fact_encounter"))
def d03(spark, d):
    """D3: dense 1..n keys in business-key order without a one-task window."""
    return Star(spark, d).fact_encounter().select("encounter_id", "encounter_key")


@query("d03b_dense_diagnosis_keys", sql("SELECT diagnosis_id, diagnosis_fact_key FROM fact_diagnosis"))
def d03b(spark, d):
    """D3 on the largest fact (one row per lineitem key)."""
    return Star(spark, d).fact_diagnosis().select("diagnosis_id", "diagnosis_fact_key")


def _snap1_patients(s: Star):
    early = s.silver_encounters().where(F.col("encounter_date") < F.lit(SNAP1).cast("date")).select("patient_id")
    return s.silver_patients().join(early, "patient_id", "left_semi")


STABLE_SQL = {
    "snap1_patients": f"""SELECT * FROM silver_patients WHERE patient_id IN
        (SELECT patient_id FROM silver_encounters WHERE encounter_date < DATE '{SNAP1}')""",
}


@query("d04_stable_patient_keys", sql("""
SELECT patient_id, row_number() OVER (ORDER BY patient_id) AS patient_key FROM snap1_patients
UNION ALL
SELECT patient_id, (SELECT count(*) FROM snap1_patients) + row_number() OVER (ORDER BY patient_id) AS patient_key
FROM silver_patients WHERE patient_id NOT IN (SELECT patient_id FROM snap1_patients)""", STABLE_SQL))
def d04(spark, d):
    """Keys assigned in an earlier snapshot stay; new members get
    max + position."""
    s = Star(spark, d)
    old = dense_keys(_snap1_patients(s).select("patient_id"), "patient_id", "patient_key")
    return assign_stable_keys(s.silver_patients().select("patient_id"), old, "patient_key", "patient_id")


@query("d05_high_water", sql("""
SELECT max(TRY_CAST(regexp_extract(encounter_id, 'ENC0*(\\d+)', 1) AS BIGINT)) AS max_encounter_number,
  max(encounter_key) AS max_encounter_key FROM fact_encounter"""))
def d05(spark, d):
    """High-water marks: max number inside string ids and max key."""
    fe = Star(spark, d).fact_encounter()
    a = high_water(fe, "encounter_id", r"ENC0*(\d+)").withColumnRenamed("high_water", "max_encounter_number")
    b = high_water(fe, "encounter_key").withColumnRenamed("high_water", "max_encounter_key")
    return a.crossJoin(b)  # two one-row aggregates


SCD_SQL = dict(STABLE_SQL)
SCD_SQL.update({
    "scd_v1": f"""SELECT *, row_number() OVER (ORDER BY patient_id) AS patient_key, 1 AS is_current,
        DATE '{SNAP1}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date FROM snap1_patients""",
    "scd_src": """SELECT * REPLACE (CASE WHEN account_balance < 0 THEN insurance_type || '-PLUS'
        ELSE insurance_type END AS insurance_type) FROM silver_patients""",
    "scd_changed": """SELECT s.* FROM scd_src s JOIN scd_v1 v ON s.patient_id = v.patient_id AND v.is_current = 1
        WHERE s.insurance_type IS DISTINCT FROM v.insurance_type OR s.city IS DISTINCT FROM v.city""",
    "scd_inserts": """SELECT * FROM scd_changed UNION ALL
        SELECT * FROM scd_src WHERE patient_id NOT IN (SELECT patient_id FROM scd_v1)""",
    "scd_v2": f"""
        SELECT patient_id, patient_key, insurance_type, city,
          CASE WHEN patient_id IN (SELECT patient_id FROM scd_changed) AND is_current = 1 THEN 0 ELSE is_current END
            AS is_current, effective_start_date,
          CASE WHEN patient_id IN (SELECT patient_id FROM scd_changed) AND is_current = 1 THEN DATE '{AS_OF}'
            ELSE effective_end_date END AS effective_end_date
        FROM scd_v1
        UNION ALL
        SELECT patient_id, (SELECT max(patient_key) FROM scd_v1) + row_number() OVER (ORDER BY patient_id),
          insurance_type, city, 1, DATE '{AS_OF}', CAST(NULL AS DATE) FROM scd_inserts""",
})


def scd_snapshots(s: Star):
    """Earlier dimension (members first seen before SNAP1) and the next
    source snapshot, in which members with a negative balance changed plan."""
    v1 = D.scd2_initial(_snap1_patients(s), "patient_id", "patient_key", SNAP1)
    src = s.silver_patients().withColumn(
        "insurance_type", F.when(F.col("account_balance") < 0, F.concat("insurance_type", F.lit("-PLUS")))
        .otherwise(F.col("insurance_type")))
    return v1, src


@query("d10_scd2_apply", sql("""
SELECT patient_id, patient_key, insurance_type, city, is_current, effective_start_date, effective_end_date
FROM scd_v2""", SCD_SQL))
def d10(spark, d):
    """SCD2 next snapshot = expired + kept + new versions (no MERGE)."""
    v1, src = scd_snapshots(Star(spark, d))
    v2 = D.scd2_apply(v1, src, "patient_id", "patient_key", ["insurance_type", "city"], AS_OF)
    return v2.select("patient_id", "patient_key", "insurance_type", "city", "is_current",
                     "effective_start_date", "effective_end_date")


@query("d11_scd2_version_counts", sql("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current = 1) AS current_rows,
  count(*) FILTER (WHERE is_current = 0) AS historical_rows, count(DISTINCT patient_id) AS distinct_keys
FROM scd_v2""", SCD_SQL))
def d11(spark, d):
    """Current and historical version counts of the SCD2 snapshot."""
    v1, src = scd_snapshots(Star(spark, d))
    v2 = D.scd2_apply(v1, src, "patient_id", "patient_key", ["insurance_type", "city"], AS_OF)
    return D.version_counts(v2, "patient_id")


UPS_SQL = {
    "ups_t": f"""SELECT claim_id, claim_date, billed_amount, claim_status,
        row_number() OVER (ORDER BY claim_id) AS claim_key FROM silver_claims WHERE claim_date < DATE '{UPSERT_CUT}'""",
    "ups_s": f"""SELECT claim_id, claim_date, billed_amount,
        CASE WHEN claim_status = 'Pending' THEN 'Paid' ELSE claim_status END AS claim_status
        FROM silver_claims WHERE claim_date >= DATE '{UPSERT_FROM}'""",
    "ups_m": """SELECT coalesce(s.claim_id, t.claim_id) AS claim_id,
        CASE WHEN s.claim_id IS NOT NULL THEN s.claim_date ELSE t.claim_date END AS claim_date,
        CASE WHEN s.claim_id IS NOT NULL THEN s.billed_amount ELSE t.billed_amount END AS billed_amount,
        CASE WHEN s.claim_id IS NOT NULL THEN s.claim_status ELSE t.claim_status END AS claim_status,
        t.claim_key FROM ups_t t FULL OUTER JOIN ups_s s ON t.claim_id = s.claim_id""",
}


def upsert_inputs(s: Star):
    c = s.silver_claims().select("claim_id", "claim_date", "billed_amount", "claim_status")
    target = dense_keys(c.where(F.col("claim_date") < F.lit(UPSERT_CUT).cast("date")), "claim_id", "claim_key")
    src = (c.where(F.col("claim_date") >= F.lit(UPSERT_FROM).cast("date"))
           .withColumn("claim_status", F.when(F.col("claim_status") == "Pending", F.lit("Paid"))
                       .otherwise(F.col("claim_status"))))
    return target, src


@query("d16_upsert_claims", sql("""
SELECT claim_id, claim_date, CAST(billed_amount AS DOUBLE) AS billed_amount, claim_status, claim_key
FROM ups_m WHERE claim_key IS NOT NULL
UNION ALL
SELECT claim_id, claim_date, CAST(billed_amount AS DOUBLE), claim_status,
  (SELECT max(claim_key) FROM ups_t) + row_number() OVER (ORDER BY claim_id)
FROM ups_m WHERE claim_key IS NULL""", UPS_SQL))
def d16(spark, d):
    """Upsert an overlapping increment (updates matched, inserts new,
    surrogate keys kept) as a full-outer-join snapshot."""
    target, src = upsert_inputs(Star(spark, d))
    out = D.upsert(target, src, "claim_id", "claim_key")
    return out.select("claim_id", "claim_date", F.col("billed_amount").cast("double").alias("billed_amount"),
                      "claim_status", "claim_key")


@query("d17_duplicate_claim_ids", sql("""
SELECT claim_id, count(*) AS n_rows FROM raw_claims GROUP BY 1 HAVING count(*) > 1"""))
def d17(spark, d):
    """Business keys that occur more than once in the raw feed."""
    return duplicate_keys(B.raw_claims(Star(spark, d).t).select("claim_id"), "claim_id")


@query("d12_payer_dimension", sql("SELECT payer_key, payer_id, payer_name, payer_type FROM dim_payer"))
def d12(spark, d):
    """Payer dimension derived from the payers seen on claims."""
    return Star(spark, d).dim_payer().select("payer_key", "payer_id", "payer_name", "payer_type")


@query("d12b_payers_without_table", sql("""
SELECT DISTINCT payer_id, payer_id AS payer_name, CASE WHEN contains(lower(payer_id), 'medicare') THEN 'Medicare'
  WHEN contains(lower(payer_id), 'medicaid') THEN 'Medicaid' WHEN contains(lower(payer_id), 'self') THEN 'Self-Pay'
  WHEN contains(lower(payer_id), 'cash') THEN 'Self-Pay' ELSE 'Commercial' END AS payer_type
FROM silver_claims WHERE payer_id IS NOT NULL"""))
def d12b(spark, d):
    """D12 where no payer table was delivered: ids serve as names."""
    return D.derive_payers(Star(spark, d).silver_claims(), None).select("payer_id", "payer_name", "payer_type")


@query("d14_sdoh_dimension", sql("""
SELECT zip_code, poverty_rate, food_desert_flag, transportation_score, uninsured_rate, unemployment_rate,
  median_household_income, social_vulnerability_index, risk_tier FROM dim_sdoh"""))
def d14(spark, d):
    """SDOH zip dimension with the weighted vulnerability index."""
    return Star(spark, d).dim_sdoh()


@query("d13b_monitor_dimension", sql("""
SELECT monitor_key, device_id, device_type, device_model, facility_key, location_key, unit_name, is_active FROM dim_monitor"""))
def d13b(spark, d):
    """Monitors with facility and location keys, null where nobody knows the place."""
    return Star(spark, d).dim_monitor().select("monitor_key", "device_id", "device_type", "device_model", "facility_key",
                                               "location_key", "unit_name", "is_active")


def _survey_rate(base: int, mult: int, mod: int) -> str:
    return f"CAST(({base} + (n_nationkey * {mult}) % {mod}) / 100.0 AS DECIMAL(4,2))::DOUBLE"


@query("d15_sdoh_layouts", sql(f"""
SELECT 'generated' AS layout, zip_code, 'MI' AS state, poverty_rate, food_desert_flag, {rnd_sql('transportation_score')} AS transportation_score,
  NULL::DOUBLE AS housing_instability_rate, uninsured_rate, NULL::DOUBLE AS broadband_access_pct, unemployment_rate,
  median_household_income, NULL::INTEGER AS population, social_vulnerability_index, risk_tier FROM dim_sdoh
UNION ALL
SELECT 'survey', zip_code, state, poverty, desert, {rnd_sql('transport')}, housing, uninsured, broadband, NULL, income, population, svi,
  CASE WHEN svi >= 0.30 THEN 'High' WHEN svi >= 0.15 THEN 'Medium' ELSE 'Low' END
FROM (SELECT *, {rnd_sql('poverty * 0.25 + desert * 0.15 + (1 - transport) * 0.20 + housing * 0.15 + uninsured * 0.15 + (1 - broadband) * 0.10')} AS svi
  FROM (SELECT '48' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS zip_code,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'OH' ELSE 'MI' END AS state, {_survey_rate(5, 7, 26)} AS poverty,
    CAST(n_nationkey % 4 = 0 AS INTEGER) AS desert, {_survey_rate(30, 11, 61)} AS transport, {_survey_rate(3, 5, 23)} AS housing,
    {_survey_rate(4, 3, 17)} AS uninsured, {_survey_rate(50, 13, 49)} AS broadband,
    CAST(28000 + n_nationkey * 2500 AS INTEGER) AS income, CAST(1000 + n_nationkey * 3000 AS INTEGER) AS population FROM nation))"""))
def d15(spark, d):
    """Both SDOH layouts, each with its own index and cut points, in the gold schema."""
    t = Star(spark, d).t
    a = B.raw_sdoh(t).withColumn("social_vulnerability_index", D.weighted_index(D.SVI_WEIGHTS, income_col="median_household_income"))
    a = a.withColumn("risk_tier", D.svi_tier(F.col("social_vulnerability_index")))
    both = (D.harmonise_sdoh(a).withColumn("layout", F.lit("generated"))
            .unionByName(D.harmonise_sdoh(D.survey_index(B.survey_sdoh(t))).withColumn("layout", F.lit("survey"))))
    return both.withColumns({c: M.rnd(F.col(c)) for c in ("transportation_score", "social_vulnerability_index")})


@query("b01_clean_patients", sql("""
SELECT patient_id, first_name, last_name, gender, state, zip_code, phone, email, date_of_birth, city
FROM silver_patients"""))
def b01(spark, d):
    """Names, gender, codes, digits, email and dates cleaned."""
    return Star(spark, d).silver_patients().select(
        "patient_id", "first_name", "last_name", "gender", "state", "zip_code", "phone", "email",
        "date_of_birth", "city")


@query("b09_dedupe_summary", sql("""
SELECT (SELECT count(*) FROM raw_claims) AS raw_rows, (SELECT count(DISTINCT claim_id) FROM raw_claims) AS distinct_keys,
  (SELECT count(*) FROM silver_claims) AS kept_rows"""))
def b09(spark, d):
    """Newest-per-key dedupe keeps exactly one row per business key."""
    s = Star(spark, d)
    raw = B.raw_claims(s.t).select("claim_id")
    a = raw.agg(F.count(F.lit(1)).alias("raw_rows"), F.countDistinct("claim_id").alias("distinct_keys"))
    return a.crossJoin(s.silver_claims().agg(F.count(F.lit(1)).alias("kept_rows")))


@query("c04_encounter_enrichment", sql("""
SELECT e.encounter_id, e.encounter_type, p.full_name AS patient_name, p.age AS patient_age,
  pr.provider_name, pr.specialty AS provider_specialty, f.facility_name
FROM silver_encounters e LEFT JOIN dim_patient p ON e.patient_id = p.patient_id
LEFT JOIN dim_provider pr ON e.provider_id = pr.provider_id
LEFT JOIN dim_facility f ON e.facility_id = f.facility_id"""))
def c04(spark, d):
    """Encounters with role-prefixed patient, provider and facility
    attributes."""
    s = Star(spark, d)
    e = s.silver_encounters().select("encounter_id", "encounter_type", "patient_id", "provider_id", "facility_id")
    e = lookup_join(e, s.dim_patient(), "patient_id", ["full_name", "age"], prefix="patient_")
    e = lookup_join(e, s.dim_provider(), "provider_id", ["provider_name", "specialty"], prefix="provider_")
    e = lookup_join(e, s.dim_facility(), "facility_id", ["facility_name"], small=True)  # one row per nation
    return e.select("encounter_id", "encounter_type", F.col("patient_full_name").alias("patient_name"),
                    "patient_age", F.col("provider_provider_name").alias("provider_name"),
                    "provider_specialty", "facility_name")


@query("c05_claim_enrichment", sql(f"""
SELECT c.claim_id, p.payer_name,
  CASE WHEN CAST(c.billed_amount AS DOUBLE) > 0
       THEN CAST(round(CAST(CAST(c.paid_amount AS DOUBLE) / CAST(c.billed_amount AS DOUBLE) AS DECIMAL(38,10)), 4) AS DOUBLE)
       ELSE 0.0 END AS paid_ratio,
  CAST(datediff('day', c.claim_date, DATE '{AS_OF}') AS INTEGER) AS days_open
FROM silver_claims c LEFT JOIN payers_ref p ON c.payer_id = p.payer_id"""))
def c05(spark, d):
    """Claims with payer, paid/billed ratio and days open."""
    s = Star(spark, d)
    c = s.silver_claims().select("claim_id", "payer_id", "billed_amount", "paid_amount", "claim_date")
    c = lookup_join(c, B.raw_payers(s.t), "payer_id", ["payer_name"], small=True)  # payer vocabulary
    return c.select("claim_id", "payer_name", safe_ratio("paid_amount", "billed_amount", 4).alias("paid_ratio"),
                    days_open("claim_date", AS_OF).alias("days_open"))


@query("c09_rx_enrichment", sql("""
SELECT r.prescription_id, m.medication_name, m.drug_class,
  CASE WHEN r.days_supply > 0 THEN CAST(round(CAST(CAST(r.total_cost AS DOUBLE) / r.days_supply AS DECIMAL(38,10)), 2) AS DOUBLE)
       ELSE 0.0 END AS cost_per_day,
  CASE WHEN r.total_cost > 0 THEN CAST(round(CAST(CAST(r.payer_paid AS DOUBLE) / CAST(r.total_cost AS DOUBLE) AS DECIMAL(38,10)), 4) AS DOUBLE)
       ELSE 0.0 END AS payer_coverage_pct
FROM fact_prescription r LEFT JOIN dim_medication m ON r.medication_code = m.medication_code"""))
def c09(spark, d):
    """Prescriptions with medication reference, cost per day and
    payer coverage."""
    s = Star(spark, d)
    r = s.fact_prescription().select("prescription_id", "medication_code", "days_supply", "total_cost", "payer_paid")
    r = lookup_join(r, s.dim_medication(), "medication_code", ["medication_name", "drug_class"])
    return r.select("prescription_id", "medication_name", "drug_class",
                    safe_ratio("total_cost", "days_supply", 2).alias("cost_per_day"),
                    safe_ratio("payer_paid", "total_cost", 4).alias("payer_coverage_pct"))


@query("c10_diagnosis_enrichment", sql("""
SELECT f.diagnosis_id, x.icd_description, x.icd_category, e.encounter_type, e.facility_id
FROM fact_diagnosis f LEFT JOIN dim_diagnosis x ON f.icd_code = x.icd_code
LEFT JOIN fact_encounter e ON f.encounter_id = e.encounter_id"""))
def c10(spark, d):
    """Diagnoses with ICD reference and encounter context."""
    s = Star(spark, d)
    f = s.fact_diagnosis().select("diagnosis_id", "icd_code", "encounter_id")
    f = lookup_join(f, s.dim_diagnosis(), "icd_code", ["icd_description", "icd_category"])
    f = lookup_join(f, s.fact_encounter(), "encounter_id", ["encounter_type", "facility_id"])
    return f.select("diagnosis_id", "icd_description", "icd_category", "encounter_type", "facility_id")


@query("d13_provider_dim_with_facility_key", sql("""
SELECT p.provider_id, p.provider_key, f.facility_key, f.facility_name, p.is_active
FROM dim_provider p LEFT JOIN dim_facility f ON p.facility_id = f.facility_id WHERE p.is_current = 1"""))
def d13(spark, d):
    """Type-1 dimension enriched with foreign keys of other dimensions
    (provider -> facility key), a keyed lookup per row."""
    s = Star(spark, d)
    p = s.dim_provider().where("is_current = 1").select("provider_id", "provider_key", "facility_id", "is_active")
    p = lookup_join(p, s.dim_facility(), "facility_id", ["facility_key", "facility_name"], small=True)
    return p.select("provider_id", "provider_key", "facility_key", "facility_name", "is_active")
