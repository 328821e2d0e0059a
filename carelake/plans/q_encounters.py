"""Encounter and readmission questions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators.aggs import exists_within, readmission_by_date
from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.registry import query
from carelake.plans.star import Star

RRATE = rnd("CAST(sum(readmission_flag) AS DOUBLE) / count(*)")
MONTHLY = {"monthly_charges": """
SELECT CAST(year(encounter_date) AS INTEGER) AS year, CAST(month(encounter_date) AS INTEGER) AS month, sum(total_charges) AS charges
FROM fact_encounter GROUP BY 1, 2"""}


def _fe(spark, d):
    return Star(spark, d).fact_encounter()


@query("f01_readmission_by_date_type", sql(f"""
SELECT encounter_date_key, encounter_type, count(*) AS total_encounters,
  count(*) FILTER (WHERE readmission_risk_category = 'High') AS high_risk_count,
  count(*) FILTER (WHERE readmission_risk_category = 'Medium') AS medium_risk_count,
  count(*) FILTER (WHERE readmission_risk_category = 'Low') AS low_risk_count,
  {rnd('avg(readmission_risk_score)')} AS avg_risk_score,
  count(*) FILTER (WHERE readmission_flag = 1) AS actual_readmissions,
  CAST(round(sum(total_charges), 2) AS DOUBLE) AS total_charges,
  {rnd('avg(length_of_stay)')} AS avg_length_of_stay
FROM fact_encounter GROUP BY encounter_date_key, encounter_type"""))
def f01(spark, d):
    """agg_readmission_by_date."""
    a = readmission_by_date(_fe(spark, d))
    return a.withColumns({"avg_risk_score": M.rnd(F.col("avg_risk_score")),
                          "total_charges": M.money(F.col("total_charges")),
                          "avg_length_of_stay": M.rnd(F.col("avg_length_of_stay"))})


@query("h01_encounter_measures_by_type", sql(f"""
SELECT encounter_type, count(*) AS total_encounters, CAST(sum(readmission_flag) AS BIGINT) AS readmissions,
  {RRATE} AS readmission_rate,
  count(*) FILTER (WHERE readmission_risk_category = 'High') AS high_risk_readmissions,
  count(*) FILTER (WHERE readmission_risk_category = 'Medium') AS medium_risk_readmissions,
  count(*) FILTER (WHERE readmission_risk_category = 'Low') AS low_risk_readmissions,
  {rnd('avg(length_of_stay)')} AS avg_length_of_stay, {rnd('avg(readmission_risk_score)')} AS avg_readmission_risk,
  CAST(round(sum(total_charges), 2) AS DOUBLE) AS total_charges, CAST(round(sum(total_cost), 2) AS DOUBLE) AS total_cost,
  {rnd('CAST(sum(total_cost) AS DOUBLE) / count(*)', 2)} AS avg_cost_per_encounter
FROM fact_encounter GROUP BY encounter_type"""))
def h01(spark, d):
    """H1-H5: encounter measures per encounter type."""
    return M.measure_table(_fe(spark, d), ["encounter_type"], [
        "total_encounters", "readmissions", "readmission_rate", "high_risk_readmissions",
        "medium_risk_readmissions", "low_risk_readmissions", "avg_length_of_stay", "avg_readmission_risk",
        "total_charges", "total_cost", "avg_cost_per_encounter"])


@query("e02_readmission_flags_compared", sql("""
SELECT encounter_type, CAST(sum(readmission_flag) AS BIGINT) AS previous_acute_flag,
  CAST(sum(readmit_any_acute) AS BIGINT) AS any_acute_flag, count(*) AS encounters
FROM fact_encounter GROUP BY encounter_type"""))
def e02(spark, d):
    """E2 vs E2b: immediately-previous-acute rule against any-acute-in-30-days."""
    return _fe(spark, d).groupBy("encounter_type").agg(
        F.sum("readmission_flag").cast("long").alias("previous_acute_flag"),
        F.sum("readmit_any_acute").cast("long").alias("any_acute_flag"),
        F.count(F.lit(1)).alias("encounters"))


@query("i07_readmission_rate_by_month", sql(f"""
SELECT strftime(encounter_date, '%Y-%m') AS month, count(*) AS encounters,
  CAST(sum(readmission_flag) AS BIGINT) AS readmissions, {RRATE} AS readmission_rate
FROM fact_encounter GROUP BY 1"""))
def i07(spark, d):
    """Readmission rate by month."""
    return (_fe(spark, d).groupBy(F.date_format("encounter_date", "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("encounters"), M.readmissions().alias("readmissions"),
                 M.readmission_rate().alias("readmission_rate")))


@query("i07b_readmission_by_department", sql(f"""
SELECT p.department, count(*) AS encounters, CAST(sum(e.readmission_flag) AS BIGINT) AS readmissions,
  {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate
FROM fact_encounter e JOIN dim_provider p ON e.provider_key = p.provider_key GROUP BY p.department"""))
def i07b(spark, d):
    """Readmission rate by provider department."""
    s = Star(spark, d)
    prv = s.dim_provider().select("provider_key", "department")
    return (s.fact_encounter().join(prv, "provider_key").groupBy("department")
            .agg(F.count(F.lit(1)).alias("encounters"), M.readmissions().alias("readmissions"),
                 M.readmission_rate().alias("readmission_rate")))


@query("i08_top_risk_patients", sql("""
SELECT e.patient_id, e.max_risk, p.age, p.insurance_type FROM (
  SELECT patient_id, patient_key, max(readmission_risk_score) AS max_risk FROM fact_encounter
  GROUP BY patient_id, patient_key) e LEFT JOIN dim_patient p ON e.patient_key = p.patient_key
ORDER BY e.max_risk DESC, e.patient_id LIMIT 10"""))
def i08(spark, d):
    """I8: top 10 patients by readmission risk with age and insurance."""
    s = Star(spark, d)
    pat = s.dim_patient().select("patient_key", "age", "insurance_type")
    top = (s.fact_encounter().groupBy("patient_id", "patient_key")
           .agg(F.max("readmission_risk_score").alias("max_risk")))
    return (top.join(pat, "patient_key", "left").orderBy(F.col("max_risk").desc(), "patient_id").limit(10)
            .select("patient_id", "max_risk", "age", "insurance_type"))


@query("i09_avg_stay_by_risk_type", sql(f"""
SELECT readmission_risk_category, encounter_type, count(*) AS encounters,
  {rnd('avg(length_of_stay)')} AS avg_length_of_stay
FROM fact_encounter GROUP BY 1, 2"""))
def i09(spark, d):
    """Average length of stay for each risk category x encounter type."""
    return (_fe(spark, d).groupBy("readmission_risk_category", "encounter_type")
            .agg(F.count(F.lit(1)).alias("encounters"), M.avg_of("length_of_stay").alias("avg_length_of_stay")))


@query("i10_encounters_per_risk_category", sql("""
SELECT readmission_risk_category, count(*) AS encounters FROM fact_encounter GROUP BY 1"""))
def i10(spark, d):
    """Encounters per readmission-risk category."""
    return _fe(spark, d).groupBy("readmission_risk_category").agg(F.count(F.lit(1)).alias("encounters"))


@query("i17_readmission_by_payer_type", sql(f"""
SELECT c.payer_type, count(*) AS encounters, CAST(sum(e.readmission_flag) AS BIGINT) AS readmissions,
  {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate
FROM (SELECT DISTINCT payer_type, encounter_id FROM fact_claim) c
JOIN fact_encounter e ON c.encounter_id = e.encounter_id GROUP BY c.payer_type"""))
def i17(spark, d):
    """Readmission rate by payer type over distinct encounters
    (claims are made distinct per encounter before the join: no fan-out)."""
    s = Star(spark, d)
    pairs = s.fact_claim().select("payer_type", "encounter_id").distinct()
    return (pairs.join(s.fact_encounter().select("encounter_id", "readmission_flag"), "encounter_id")
            .groupBy("payer_type").agg(F.count(F.lit(1)).alias("encounters"),
                                       M.readmissions().alias("readmissions"),
                                       M.readmission_rate().alias("readmission_rate")))


@query("i21_avoidable_readmission_cost", sql("""
SELECT (SELECT count(*) FROM fact_encounter WHERE readmission_risk_category = 'High' AND readmission_flag = 1)
         AS encounters,
       (SELECT CAST(round(coalesce(sum(paid_amount), 0), 2) AS DOUBLE) FROM fact_claim WHERE encounter_id IN
         (SELECT encounter_id FROM fact_encounter WHERE readmission_risk_category = 'High' AND readmission_flag = 1))
         AS avoidable_paid"""))
def i21(spark, d):
    """Payments on encounters that were high risk AND readmitted."""
    s = Star(spark, d)
    idx = s.fact_encounter().where((F.col("readmission_risk_category") == "High") & (F.col("readmission_flag") == 1))
    n = idx.agg(F.count(F.lit(1)).alias("encounters"))
    paid = (s.fact_claim().join(idx.select("encounter_id"), "encounter_id", "left_semi")
            .agg(F.coalesce(M.money(F.sum("paid_amount")), F.lit(0.0)).alias("avoidable_paid")))
    return n.crossJoin(paid)  # two one-row aggregates


@query("i38_readmission_condition_facility", sql(f"""
SELECT x.icd_category, f.facility_name, count(*) AS encounters,
  {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate, 0.15::DOUBLE AS target_rate,
  CAST(sum(e.readmission_flag) AS DOUBLE) / count(*) > 0.15 AS above_target
FROM fact_encounter e JOIN dim_diagnosis x ON e.primary_diagnosis_code = x.icd_code
JOIN dim_facility f ON e.facility_key = f.facility_key GROUP BY 1, 2"""))
def i38(spark, d, target: float = 0.15):
    """Readmission rate by condition x facility against a target."""
    s = Star(spark, d)
    dx = s.dim_diagnosis().select(F.col("icd_code").alias("primary_diagnosis_code"), "icd_category")
    fac = s.dim_facility().select("facility_key", "facility_name")
    g = (s.fact_encounter().join(dx, "primary_diagnosis_code").join(fac, "facility_key")
         .groupBy("icd_category", "facility_name")
         .agg(F.count(F.lit(1)).alias("encounters"), M.readmission_rate().alias("readmission_rate"),
              (F.sum("readmission_flag") / F.count(F.lit(1))).alias("_r")))
    return (g.withColumn("target_rate", F.lit(target)).withColumn("above_target", F.col("_r") > target)
            .drop("_r"))


@query("i38b_readmission_12_month_trend", sql(f"""
SELECT x.icd_category, strftime(e.encounter_date, '%Y-%m') AS month, count(*) AS encounters,
  {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate
FROM fact_encounter e JOIN dim_diagnosis x ON e.primary_diagnosis_code = x.icd_code
WHERE strftime(e.encounter_date, '%Y-%m') > (
  SELECT strftime(max(encounter_date) - INTERVAL 12 MONTH, '%Y-%m') FROM fact_encounter)
GROUP BY 1, 2"""))
def i38b(spark, d):
    """Monthly readmission rate by condition over the last 12 calendar
    months of the data."""
    s = Star(spark, d)
    fe = s.fact_encounter().select("encounter_date", "primary_diagnosis_code", "readmission_flag")
    last = fe.agg(F.date_format(F.add_months(F.max("encounter_date"), -12), "yyyy-MM").alias("_before"))
    dx = s.dim_diagnosis().select(F.col("icd_code").alias("primary_diagnosis_code"), "icd_category")
    return (fe.withColumn("month", F.date_format("encounter_date", "yyyy-MM"))
            .crossJoin(F.broadcast(last))  # one row
            .where(F.col("month") > F.col("_before")).join(dx, "primary_diagnosis_code")
            .groupBy("icd_category", "month")
            .agg(F.count(F.lit(1)).alias("encounters"), M.readmission_rate().alias("readmission_rate")))


@query("i40_followup_within_7_days", sql(f"""
SELECT count(*) AS readmitted_encounters, count(*) FILTER (WHERE hit) AS with_followup,
  {rnd('CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / count(*)')} AS followup_share
FROM (SELECT e.encounter_id, EXISTS (SELECT 1 FROM fact_encounter f WHERE f.patient_id = e.patient_id
        AND f.encounter_date BETWEEN e.discharge_date + 1 AND e.discharge_date + 7) AS hit
      FROM fact_encounter e WHERE e.readmission_flag = 1)"""))
def i40(spark, d):
    """Share of readmissions followed by a visit within 7 days of
    discharge (interval semi-join, see ``exists_within``)."""
    fe = _fe(spark, d)
    idx = fe.where(F.col("readmission_flag") == 1).select("encounter_id", "patient_id", "discharge_date")
    hit = exists_within(idx, fe, "patient_id", "discharge_date", "encounter_date", 1, 7)
    j = idx.join(hit.select("encounter_id", F.lit(1).alias("_hit")), "encounter_id", "left")
    return j.agg(F.count(F.lit(1)).alias("readmitted_encounters"),
                 F.count("_hit").alias("with_followup"),
                 M.rate(F.count("_hit"), F.count(F.lit(1))).alias("followup_share"))


@query("h06_charges_py_yoy_by_month", sql(f"""
SELECT a.year, a.month, CAST(round(a.charges, 2) AS DOUBLE) AS charges,
  CAST(round(b.charges, 2) AS DOUBLE) AS py_charges,
  {rnd('(CAST(a.charges AS DOUBLE) - CAST(b.charges AS DOUBLE)) / CAST(b.charges AS DOUBLE)')} AS yoy_growth
FROM monthly_charges a LEFT JOIN monthly_charges b ON b.year = a.year - 1 AND b.month = a.month""", MONTHLY))
def h06(spark, d):
    """H6-H7 (+J8): charges, prior-year charges and YoY growth by month."""
    m = (_fe(spark, d).groupBy(F.year("encounter_date").alias("year"), F.month("encounter_date").alias("month"))
         .agg(F.sum("total_charges").alias("charges")))
    py = m.select((F.col("year") + 1).alias("year"), "month", F.col("charges").alias("py"))
    j = m.join(py, ["year", "month"], "left")
    return j.select("year", "month", M.money(F.col("charges")).alias("charges"),
                    M.money(F.col("py")).alias("py_charges"),
                    M.rnd((F.col("charges").cast("double") - F.col("py").cast("double"))
                          / F.col("py").cast("double")).alias("yoy_growth"))


@query("h06b_charges_same_day_prior_year", sql("""
SELECT a.encounter_date, CAST(round(a.charges, 2) AS DOUBLE) AS charges, CAST(round(b.charges, 2) AS DOUBLE) AS py_charges
FROM (SELECT encounter_date, sum(total_charges) AS charges FROM fact_encounter GROUP BY 1) a
LEFT JOIN (SELECT encounter_date, sum(total_charges) AS charges FROM fact_encounter GROUP BY 1) b
  ON b.encounter_date = CAST(a.encounter_date - INTERVAL 1 YEAR AS DATE)"""))
def h06b(spark, d):
    """H6 at day grain: same date a year earlier (Feb 29 maps to Feb 28)."""
    daily = _fe(spark, d).groupBy("encounter_date").agg(F.sum("total_charges").alias("charges"))
    prior = daily.select(F.col("encounter_date").alias("py_date"), F.col("charges").alias("py"))
    j = daily.join(prior, F.add_months("encounter_date", -12) == F.col("py_date"), "left")
    return j.select("encounter_date", M.money(F.col("charges")).alias("charges"), M.money(F.col("py")).alias("py_charges"))


@query("h08_ytd_charges", sql("""
SELECT year, month, CAST(round(sum(charges) OVER (PARTITION BY year ORDER BY month), 2) AS DOUBLE) AS ytd_charges
FROM monthly_charges""", MONTHLY))
def h08(spark, d):
    """H8: year-to-date charges (window over one row per month)."""
    m = (_fe(spark, d).groupBy(F.year("encounter_date").alias("year"), F.month("encounter_date").alias("month"))
         .agg(F.sum("total_charges").alias("charges")))
    w = Window.partitionBy("year").orderBy("month").rangeBetween(Window.unboundedPreceding, 0)
    return m.select("year", "month", M.money(F.sum("charges").over(w)).alias("ytd_charges"))


@query("h09_pmpm_by_year", sql(f"""
SELECT e.year, CAST(round(e.cost, 2) AS DOUBLE) AS encounter_cost, CAST(round(coalesce(r.cost, 0), 2) AS DOUBLE) AS rx_cost,
  m.members, {rnd('(CAST(e.cost AS DOUBLE) + CAST(coalesce(r.cost, 0) AS DOUBLE)) / (m.members * 12)', 2)} AS pmpm
FROM (SELECT CAST(year(encounter_date) AS INTEGER) AS year, sum(total_cost) AS cost FROM fact_encounter GROUP BY 1) e
LEFT JOIN (SELECT year(fill_date) AS year, sum(total_cost) AS cost FROM fact_prescription GROUP BY 1) r ON e.year = r.year
CROSS JOIN (SELECT count(*) AS members FROM dim_patient WHERE is_current = 1) m"""))
def h09(spark, d):
    """H9: per-member-per-month cost; each fact aggregated separately first."""
    s = Star(spark, d)
    e = s.fact_encounter().groupBy(F.year("encounter_date").alias("year")).agg(F.sum("total_cost").alias("ec"))
    r = s.fact_prescription().groupBy(F.year("fill_date").alias("year")).agg(F.sum("total_cost").alias("rc"))
    m = s.dim_patient().where("is_current = 1").agg(F.count(F.lit(1)).alias("members"))
    j = e.join(r, "year", "left").crossJoin(m)  # m is one row
    rc = F.coalesce(F.col("rc"), F.lit(0).cast("decimal(18,2)"))
    return j.select("year", M.money(F.col("ec")).alias("encounter_cost"), M.money(rc).alias("rx_cost"), "members",
                    M.rnd((F.col("ec").cast("double") + rc.cast("double")) / (F.col("members") * 12), 2).alias("pmpm"))


@query("h10_quality_score", sql(f"""
SELECT r.readmission_rate, a.adherent_rate, c.denial_rate,
  {rnd('((1 - r.rr) + a.ar + (1 - c.dr)) / 3')} AS quality_score
FROM (SELECT CAST(sum(readmission_flag) AS DOUBLE) / count(*) AS rr,
        {rnd('CAST(sum(readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate FROM fact_encounter) r
CROSS JOIN (SELECT CAST(count(*) FILTER (WHERE adherence_category = 'Adherent') AS DOUBLE) / count(*) AS ar,
        {rnd("CAST(count(*) FILTER (WHERE adherence_category = 'Adherent') AS DOUBLE) / count(*)")} AS adherent_rate
      FROM agg_adherence) a
CROSS JOIN (SELECT CAST(sum(denial_flag) AS DOUBLE) / count(*) AS dr,
        {rnd('CAST(sum(denial_flag) AS DOUBLE) / count(*)')} AS denial_rate FROM fact_claim) c"""))
def h10(spark, d):
    """Quality score = mean of (1 - readmission rate), adherent rate and
    (1 - denial rate); three one-row aggregates joined."""
    from carelake.plans.q_rx import adherence
    s = Star(spark, d)
    r = s.fact_encounter().agg((F.sum("readmission_flag") / F.count(F.lit(1))).alias("rr"))
    a = adherence(s).agg((F.count_if(F.col("adherence_category") == "Adherent") / F.count(F.lit(1))).alias("ar"))
    c = s.fact_claim().agg((F.sum("denial_flag") / F.count(F.lit(1))).alias("dr"))
    j = r.crossJoin(a).crossJoin(c)
    return j.select(M.rnd(F.col("rr")).alias("readmission_rate"), M.rnd(F.col("ar")).alias("adherent_rate"),
                    M.rnd(F.col("dr")).alias("denial_rate"),
                    M.rnd(((1 - F.col("rr")) + F.col("ar") + (1 - F.col("dr"))) / 3).alias("quality_score"))


@query("h26_extension_measures", sql(f"""
SELECT (SELECT {rnd("CAST(count(*) FILTER (WHERE readmission_flag = 1) AS DOUBLE) / count(*)")}
          FROM fact_encounter WHERE encounter_type = 'Inpatient') AS inpatient_readmission_rate,
       (SELECT CAST(round(coalesce(sum(billed_amount) - sum(paid_amount), 0), 2) AS DOUBLE)
          FROM fact_claim WHERE claim_status = 'Paid') AS revenue_leakage,
       (SELECT {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} FROM fact_encounter e
          JOIN dim_patient p ON e.patient_key = p.patient_key JOIN dim_sdoh s ON p.zip_code = s.zip_code
          WHERE s.risk_tier = 'High') AS sdoh_high_readmission_rate"""))
def h26(spark, d):
    """Inpatient readmission rate, revenue leakage on paid claims and
    the readmission rate in high social-risk zips."""
    s = Star(spark, d)
    fe = s.fact_encounter()
    a = fe.where(F.col("encounter_type") == "Inpatient").agg(
        M.rate(F.count_if(F.col("readmission_flag") == 1), F.count(F.lit(1))).alias("inpatient_readmission_rate"))
    b = s.fact_claim().where(F.col("claim_status") == "Paid").agg(
        F.coalesce(M.money(F.sum("billed_amount") - F.sum("paid_amount")), F.lit(0.0)).alias("revenue_leakage"))
    pat = s.dim_patient().select("patient_key", "zip_code")
    sd = s.dim_sdoh().where(F.col("risk_tier") == "High").select("zip_code")
    c = fe.join(pat, "patient_key").join(sd, "zip_code").agg(M.readmission_rate().alias("sdoh_high_readmission_rate"))
    return a.crossJoin(b).crossJoin(c)  # one-row aggregates


@query("i34b_facility_readmission_rank", sql(f"""
SELECT facility_name, encounters, readmission_rate,
  CAST(dense_rank() OVER (ORDER BY readmission_rate DESC) AS INTEGER) AS readmission_rank
FROM (SELECT f.facility_name, count(*) AS encounters,
        {rnd('CAST(sum(e.readmission_flag) AS DOUBLE) / count(*)')} AS readmission_rate
      FROM fact_encounter e JOIN dim_facility f ON e.facility_key = f.facility_key GROUP BY 1)"""))
def i34b(spark, d):
    """Facilities ranked by readmission rate (rank over one row per
    facility)."""
    s = Star(spark, d)
    fac = s.dim_facility().select("facility_key", "facility_name")
    g = (s.fact_encounter().join(fac, "facility_key").groupBy("facility_name")
         .agg(F.count(F.lit(1)).alias("encounters"), M.readmission_rate().alias("readmission_rate")))
    return g.withColumn("readmission_rank", F.dense_rank().over(Window.orderBy(F.col("readmission_rate").desc())))
