"""Member, diagnosis and social-risk questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.q_rx import adherence
from carelake.plans.registry import query
from carelake.plans.star import Star


def _cur(s: Star):
    return s.dim_patient().where("is_current = 1")


def _tiers(s: Star):
    """patient_key -> zip social-risk attributes. dim_sdoh is one row per zip."""
    sd = s.dim_sdoh().select("zip_code", "risk_tier", "poverty_rate", "social_vulnerability_index")
    return _cur(s).select("patient_key", "patient_id", "zip_code").join(sd, "zip_code", "left")


@query("h19_patient_measures", sql(f"""
SELECT count(*) AS total_patients, count(*) FILTER (WHERE gender = 'Female') AS female_patients,
  count(*) FILTER (WHERE gender = 'Male') AS male_patients, {rnd('avg(age)', 2)} AS avg_patient_age,
  max(c.n) AS chronic_patients, {rnd('CAST(max(c.n) AS DOUBLE) / count(*)')} AS chronic_rate
FROM dim_patient CROSS JOIN (SELECT count(DISTINCT patient_key) AS n FROM fact_diagnosis WHERE is_chronic = 1) c
WHERE is_current = 1"""))
def h19(spark, d):
    """Patients, by gender, average age, chronic patients and rate."""
    s = Star(spark, d)
    chronic = s.fact_diagnosis().where("is_chronic = 1").agg(F.countDistinct("patient_key").alias("_n"))
    p = _cur(s).crossJoin(chronic)  # one-row aggregate
    return p.agg(F.count(F.lit(1)).alias("total_patients"),
                 F.count_if(F.col("gender") == "Female").alias("female_patients"),
                 F.count_if(F.col("gender") == "Male").alias("male_patients"),
                 M.rnd(F.avg("age"), 2).alias("avg_patient_age"),
                 F.max("_n").alias("chronic_patients"),
                 M.rate(F.max("_n"), F.count(F.lit(1))).alias("chronic_rate"))


@query("h25_diagnosis_measures", sql("""
SELECT count(DISTINCT icd_code) AS unique_diagnoses,
  count(DISTINCT CASE WHEN is_chronic = 1 THEN icd_code END) AS chronic_diagnoses,
  count(DISTINCT CASE WHEN is_chronic = 1 THEN patient_key END) AS patients_with_chronic
FROM fact_diagnosis"""))
def h25(spark, d):
    """Unique and chronic diagnoses; patients with chronic conditions."""
    fd = Star(spark, d).fact_diagnosis()
    ch = F.col("is_chronic") == 1
    return fd.agg(F.countDistinct("icd_code").alias("unique_diagnoses"),
                  F.countDistinct(F.when(ch, F.col("icd_code"))).alias("chronic_diagnoses"),
                  F.countDistinct(F.when(ch, F.col("patient_key"))).alias("patients_with_chronic"))


@query("i15_high_vulnerability_members", sql("""
SELECT p.patient_id, p.zip_code, s.social_vulnerability_index, s.risk_tier
FROM dim_patient p JOIN dim_sdoh s ON p.zip_code = s.zip_code
WHERE p.is_current = 1 AND s.risk_tier = 'High' AND s.social_vulnerability_index >= 0.20"""))
def i15(spark, d, min_svi: float = 0.20):
    """Members living in high-vulnerability zips."""
    t = _tiers(Star(spark, d))
    return (t.where((F.col("risk_tier") == "High") & (F.col("social_vulnerability_index") >= min_svi))
            .select("patient_id", "zip_code", "social_vulnerability_index", "risk_tier"))


@query("i16_adherence_readmission_by_tier", sql(f"""
SELECT coalesce(e.risk_tier, a.risk_tier) AS risk_tier, e.encounters, e.readmission_rate, a.members, a.adherent_rate
FROM (SELECT s.risk_tier, count(*) AS encounters,
        {rnd('CAST(sum(f.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate
      FROM fact_encounter f JOIN dim_patient p ON f.patient_key = p.patient_key
      JOIN dim_sdoh s ON p.zip_code = s.zip_code GROUP BY 1) e
FULL OUTER JOIN (
      SELECT s.risk_tier, count(*) AS members,
        {rnd("CAST(count(*) FILTER (WHERE x.adherence_category = 'Adherent') AS DOUBLE) / count(*)")} AS adherent_rate
      FROM agg_adherence x JOIN dim_patient p ON x.patient_key = p.patient_key
      JOIN dim_sdoh s ON p.zip_code = s.zip_code GROUP BY 1) a ON e.risk_tier = a.risk_tier"""))
def i16(spark, d):
    """I16: adherence and readmission rate per SDOH tier (two aggregates
    joined on the tier, never a fact-to-fact join)."""
    s = Star(spark, d)
    t = _tiers(s).select("patient_key", "risk_tier")
    e = (s.fact_encounter().join(t, "patient_key").groupBy("risk_tier")
         .agg(F.count(F.lit(1)).alias("encounters"), M.readmission_rate().alias("readmission_rate")))
    a = (adherence(s).join(t, "patient_key").groupBy("risk_tier")
         .agg(F.count(F.lit(1)).alias("members"),
              M.rate(F.count_if(F.col("adherence_category") == "Adherent"), F.count(F.lit(1))).alias("adherent_rate")))
    return e.join(a, "risk_tier", "full_outer").select("risk_tier", "encounters", "readmission_rate",
                                                       "members", "adherent_rate")


@query("i18_readmitted_social_risk", sql(f"""
SELECT r.patient_id, s.risk_tier, r.readmissions, {rnd('a.avg_pdc')} AS avg_pdc
FROM (SELECT patient_id, patient_key, CAST(sum(readmission_flag) AS BIGINT) AS readmissions FROM fact_encounter
      GROUP BY 1, 2 HAVING sum(readmission_flag) > 0) r
JOIN dim_patient p ON r.patient_key = p.patient_key
JOIN dim_sdoh s ON p.zip_code = s.zip_code
LEFT JOIN (SELECT patient_key, avg(pdc_score) AS avg_pdc FROM agg_adherence GROUP BY 1) a ON r.patient_key = a.patient_key
WHERE s.risk_tier = 'High'"""))
def i18(spark, d):
    """Readmitted patients living in higher social-risk zips, with their
    average PDC (semi-join chain, one aggregate per branch)."""
    s = Star(spark, d)
    r = (s.fact_encounter().groupBy("patient_id", "patient_key")
         .agg(F.sum("readmission_flag").cast("long").alias("readmissions")).where("readmissions > 0"))
    t = _tiers(s).where((F.col("risk_tier") == "High")).select("patient_key", "risk_tier")
    a = adherence(s).groupBy("patient_key").agg(F.avg("pdc_score").alias("_pdc"))
    return (r.join(t, "patient_key").join(a, "patient_key", "left")
            .select("patient_id", "risk_tier", "readmissions", M.rnd(F.col("_pdc")).alias("avg_pdc")))


@query("i19_top_diagnoses", sql("""
SELECT icd_code, count(*) AS diagnoses FROM fact_diagnosis GROUP BY 1 ORDER BY diagnoses DESC, icd_code LIMIT 10"""))
def i19(spark, d):
    """The ten most frequent diagnosis codes."""
    return (Star(spark, d).fact_diagnosis().groupBy("icd_code").agg(F.count(F.lit(1)).alias("diagnoses"))
            .orderBy(F.col("diagnoses").desc(), "icd_code").limit(10))


@query("i19b_chronic_prevalence", sql("""
SELECT x.icd_category, count(DISTINCT f.patient_key) AS patients
FROM fact_diagnosis f JOIN dim_diagnosis x ON f.diagnosis_key = x.diagnosis_key
WHERE x.is_chronic = 1 GROUP BY 1"""))
def i19b(spark, d):
    """Most prevalent chronic condition groups by distinct patients."""
    s = Star(spark, d)
    dx = s.dim_diagnosis().where("is_chronic = 1").select("diagnosis_key", "icd_category")
    return (s.fact_diagnosis().join(dx, "diagnosis_key").groupBy("icd_category")
            .agg(F.countDistinct("patient_key").alias("patients")))


@query("i27_readmitted_and_non_adherent", sql("""
SELECT r.patient_id, r.readmissions, n.non_adherent_classes
FROM (SELECT patient_id, patient_key, CAST(sum(readmission_flag) AS BIGINT) AS readmissions FROM fact_encounter
      GROUP BY 1, 2 HAVING sum(readmission_flag) > 0) r
JOIN (SELECT patient_key, count(DISTINCT drug_class) AS non_adherent_classes FROM agg_adherence
      WHERE adherence_category = 'Non-Adherent' GROUP BY 1) n ON r.patient_key = n.patient_key"""))
def i27(spark, d):
    """Patients both readmitted and non-adherent (intersection of two
    per-patient aggregates), with detail."""
    s = Star(spark, d)
    r = (s.fact_encounter().groupBy("patient_id", "patient_key")
         .agg(F.sum("readmission_flag").cast("long").alias("readmissions")).where("readmissions > 0"))
    n = (adherence(s).where(F.col("adherence_category") == "Non-Adherent").groupBy("patient_key")
         .agg(F.countDistinct("drug_class").alias("non_adherent_classes")))
    return r.join(n, "patient_key").select("patient_id", "readmissions", "non_adherent_classes")


@query("i30_high_risk_non_adherent_payers", sql(f"""
SELECT py.payer_name, count(DISTINCT r.patient_key) AS patients, {'CAST(round(sum(r.total_cost), 2) AS DOUBLE)'} AS rx_cost
FROM fact_prescription r JOIN dim_payer py ON r.payer_key = py.payer_key
WHERE r.patient_key IN (SELECT patient_key FROM fact_encounter WHERE readmission_risk_category = 'High')
  AND r.patient_key IN (SELECT patient_key FROM agg_adherence WHERE adherence_category = 'Non-Adherent')
GROUP BY 1"""))
def i30(spark, d):
    """High-risk, non-adherent patients: their payers and Rx cost."""
    s = Star(spark, d)
    hi = s.fact_encounter().where(F.col("readmission_risk_category") == "High").select("patient_key")
    na = adherence(s).where(F.col("adherence_category") == "Non-Adherent").select("patient_key")
    py = s.dim_payer().select("payer_key", "payer_name")
    return (s.fact_prescription().join(hi, "patient_key", "left_semi").join(na, "patient_key", "left_semi")
            .join(py, "payer_key").groupBy("payer_name")
            .agg(F.countDistinct("patient_key").alias("patients"), M.money(F.sum("total_cost")).alias("rx_cost")))


@query("i31_patients_by_age_group", sql("""
SELECT age_group, count(*) AS patients FROM dim_patient WHERE is_current = 1 GROUP BY 1"""))
def i31(spark, d):
    """Patients per age group."""
    return _cur(Star(spark, d)).groupBy("age_group").agg(F.count(F.lit(1)).alias("patients"))


@query("i32_name_lookup", sql("""
SELECT p.patient_id, p.full_name, p.date_of_birth, p.city, c.name_matches
FROM dim_patient p JOIN (SELECT full_name, count(*) AS name_matches FROM dim_patient
                         WHERE is_current = 1 AND lower(full_name) = 'james smith' GROUP BY 1) c
  ON p.full_name = c.full_name WHERE p.is_current = 1"""))
def i32(spark, d, name: str = "James Smith"):
    """I32: name lookup with disambiguation (how many members share it)."""
    p = _cur(Star(spark, d)).where(F.lower("full_name") == name.lower())
    c = p.groupBy("full_name").agg(F.count(F.lit(1)).alias("name_matches"))
    return p.join(c, "full_name").select("patient_id", "full_name", "date_of_birth", "city", "name_matches")


@query("i39_adherence_readmission_correlation", sql(f"""
SELECT {rnd('corr(a.avg_pdc, e.readmit_rate)')} AS corr_pdc_readmission,
  {rnd('corr(CAST(s.poverty_rate AS DOUBLE), e.readmit_rate)')} AS corr_poverty_readmission,
  {rnd('corr(CAST(s.poverty_rate AS DOUBLE), a.avg_pdc)')} AS corr_poverty_pdc,
  count(*) AS patients
FROM (SELECT patient_key, CAST(sum(readmission_flag) AS DOUBLE) / count(*) AS readmit_rate FROM fact_encounter
      WHERE patient_key IS NOT NULL GROUP BY 1) e
JOIN (SELECT patient_key, avg(pdc_score) AS avg_pdc FROM agg_adherence GROUP BY 1) a ON e.patient_key = a.patient_key
JOIN dim_patient p ON e.patient_key = p.patient_key JOIN dim_sdoh s ON p.zip_code = s.zip_code"""))
def i39(spark, d):
    """Correlation of adherence and social factors with readmission
    (per-patient aggregates first, then ``corr``)."""
    s = Star(spark, d)
    e = (s.fact_encounter().where(F.col("patient_key").isNotNull()).groupBy("patient_key")
         .agg((F.sum("readmission_flag") / F.count(F.lit(1))).alias("readmit_rate")))
    a = adherence(s).groupBy("patient_key").agg(F.avg("pdc_score").alias("avg_pdc"))
    t = _tiers(s).select("patient_key", F.col("poverty_rate").cast("double").alias("pov"))
    j = e.join(a, "patient_key").join(t, "patient_key")
    return j.agg(M.rnd(F.corr("avg_pdc", "readmit_rate")).alias("corr_pdc_readmission"),
                 M.rnd(F.corr("pov", "readmit_rate")).alias("corr_poverty_readmission"),
                 M.rnd(F.corr("pov", "avg_pdc")).alias("corr_poverty_pdc"),
                 F.count(F.lit(1)).alias("patients"))


SOCIAL_FACTORS = ["poverty_rate", "uninsured_rate", "unemployment_rate", "transportation_score", "median_household_income",
                  "social_vulnerability_index"]


@query("i39b_social_factor_correlations", sql("\nUNION ALL\n".join(f"""
SELECT '{f}' AS factor, {rnd(f'corr(CAST(s.{f} AS DOUBLE), e.readmit_rate)')} AS corr_readmission,
  {rnd(f'corr(CAST(s.{f} AS DOUBLE), a.avg_pdc)')} AS corr_pdc
FROM (SELECT patient_key, CAST(sum(readmission_flag) AS DOUBLE) / count(*) AS readmit_rate FROM fact_encounter
      WHERE patient_key IS NOT NULL GROUP BY 1) e
JOIN (SELECT patient_key, avg(pdc_score) AS avg_pdc FROM agg_adherence GROUP BY 1) a ON e.patient_key = a.patient_key
JOIN dim_patient p ON e.patient_key = p.patient_key JOIN dim_sdoh s ON p.zip_code = s.zip_code""" for f in SOCIAL_FACTORS)))
def i39b(spark, d):
    """Every social factor against readmission and adherence, one pass."""
    s = Star(spark, d)
    e = (s.fact_encounter().where(F.col("patient_key").isNotNull()).groupBy("patient_key")
         .agg((F.sum("readmission_flag") / F.count(F.lit(1))).alias("readmit_rate")))
    a = adherence(s).groupBy("patient_key").agg(F.avg("pdc_score").alias("avg_pdc"))
    z = s.dim_sdoh().select("zip_code", *[F.col(c).cast("double").alias(c) for c in SOCIAL_FACTORS])
    j = e.join(a, "patient_key").join(_cur(s).select("patient_key", "zip_code"), "patient_key").join(z, "zip_code")
    long = j.unpivot(["readmit_rate", "avg_pdc"], SOCIAL_FACTORS, "factor", "level")
    return long.groupBy("factor").agg(M.rnd(F.corr("level", "readmit_rate")).alias("corr_readmission"),
                                      M.rnd(F.corr("level", "avg_pdc")).alias("corr_pdc"))
