"""Claim and denial questions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.registry import query
from carelake.plans.star import Star

RATE = rnd("CAST(sum(denial_flag) AS DOUBLE) / count(*)")
MONEY_SUM = "CAST(round(sum({c}), 2) AS DOUBLE)"


def _fc(spark, d):
    return Star(spark, d).fact_claim()


@query("i01_denial_rate_by_payer", sql(f"""
SELECT payer_name, count(*) AS total_claims, CAST(sum(denial_flag) AS BIGINT) AS denied_claims,
       {RATE} AS denial_rate
FROM fact_claim GROUP BY ROLLUP (payer_name)"""))
def i01(spark, d):
    """Denial rate overall (payer_name null) and per payer."""
    return _fc(spark, d).rollup("payer_name").agg(
        F.count(F.lit(1)).alias("total_claims"), M.denied_claims().alias("denied_claims"),
        M.denial_rate().alias("denial_rate"))


@query("i02_top_denial_reasons", sql(f"""
SELECT primary_denial_reason, count(*) AS denied_claims, {MONEY_SUM.format(c='billed_amount')} AS denied_billed
FROM fact_claim WHERE denial_flag = 1
GROUP BY primary_denial_reason ORDER BY denied_claims DESC, primary_denial_reason LIMIT 5"""))
def i02(spark, d):
    """Top 5 denial reasons by count, with billed amount."""
    return (_fc(spark, d).where(F.col("denial_flag") == 1).groupBy("primary_denial_reason")
            .agg(F.count(F.lit(1)).alias("denied_claims"), M.total_of("billed_amount").alias("denied_billed"))
            .orderBy(F.col("denied_claims").desc(), F.col("primary_denial_reason")).limit(5))


@query("h11_claim_measures_by_type", sql(f"""
SELECT claim_type, count(*) AS total_claims, {MONEY_SUM.format(c='billed_amount')} AS total_billed,
  {MONEY_SUM.format(c='paid_amount')} AS total_paid, {RATE} AS denial_rate,
  {rnd("CAST(sum(paid_amount) AS DOUBLE) / CAST(sum(billed_amount) AS DOUBLE)")} AS collection_rate,
  coalesce(CAST(round(sum(CASE WHEN denial_risk_category IN ('High', 'Medium') THEN billed_amount END), 2) AS DOUBLE), 0.0)
    AS at_risk_revenue,
  {rnd("avg(denial_risk_score)")} AS avg_denial_risk,
  count(*) FILTER (WHERE denial_risk_category = 'High') AS high_risk_denials
FROM fact_claim GROUP BY claim_type"""))
def h11(spark, d):
    """Claim measures per claim type."""
    return M.measure_table(_fc(spark, d), ["claim_type"],
                           ["total_claims", "total_billed", "total_paid", "denial_rate", "collection_rate",
                            "at_risk_revenue", "avg_denial_risk", "high_risk_denials"])


@query("f02_denial_by_date_type", sql(f"""
SELECT claim_date_key, claim_type, count(*) AS total_claims,
  count(*) FILTER (WHERE denial_risk_category = 'High') AS high_risk_count,
  count(*) FILTER (WHERE denial_risk_category = 'Medium') AS medium_risk_count,
  count(*) FILTER (WHERE denial_risk_category = 'Low') AS low_risk_count,
  {rnd("avg(denial_risk_score)")} AS avg_risk_score,
  count(*) FILTER (WHERE denial_flag = 1) AS actual_denials,
  {MONEY_SUM.format(c='billed_amount')} AS total_billed, {MONEY_SUM.format(c='paid_amount')} AS total_paid,
  CAST(round(sum(CASE WHEN denial_risk_category = 'High' THEN billed_amount ELSE 0 END), 2) AS DOUBLE) AS at_risk_amount
FROM fact_claim GROUP BY claim_date_key, claim_type"""))
def f02(spark, d):
    """agg_denial_by_date."""
    fc = _fc(spark, d)
    return fc.groupBy("claim_date_key", "claim_type").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(F.col("denial_risk_category") == "High").alias("high_risk_count"),
        F.count_if(F.col("denial_risk_category") == "Medium").alias("medium_risk_count"),
        F.count_if(F.col("denial_risk_category") == "Low").alias("low_risk_count"),
        M.avg_of("denial_risk_score").alias("avg_risk_score"),
        F.count_if(F.col("denial_flag") == 1).alias("actual_denials"),
        M.total_of("billed_amount").alias("total_billed"), M.total_of("paid_amount").alias("total_paid"),
        M.money(F.sum(F.when(F.col("denial_risk_category") == "High", F.col("billed_amount"))
                      .otherwise(F.lit(0).cast("decimal(18,2)")))).alias("at_risk_amount"))


@query("f03_denial_by_payer_reason", sql(f"""
SELECT claim_date_key, payer_name, payer_type, primary_denial_reason, count(*) AS total_claims,
  count(*) FILTER (WHERE denial_flag = 1) AS denied_claims, {MONEY_SUM.format(c='billed_amount')} AS total_billed,
  CAST(round(sum(CASE WHEN denial_flag = 1 THEN billed_amount ELSE 0 END), 2) AS DOUBLE) AS denied_amount,
  {MONEY_SUM.format(c='paid_amount')} AS total_paid, {rnd("avg(denial_risk_score)")} AS avg_denial_risk_score,
  {RATE} AS denial_rate
FROM fact_claim GROUP BY claim_date_key, payer_name, payer_type, primary_denial_reason"""))
def f03(spark, d):
    """agg_denial_by_payer (date x payer x reason)."""
    fc = _fc(spark, d)
    return fc.groupBy("claim_date_key", "payer_name", "payer_type", "primary_denial_reason").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(F.col("denial_flag") == 1).alias("denied_claims"),
        M.total_of("billed_amount").alias("total_billed"),
        M.money(F.sum(F.when(F.col("denial_flag") == 1, F.col("billed_amount"))
                      .otherwise(F.lit(0).cast("decimal(18,2)")))).alias("denied_amount"),
        M.total_of("paid_amount").alias("total_paid"),
        M.avg_of("denial_risk_score").alias("avg_denial_risk_score"),
        M.denial_rate().alias("denial_rate"))


@query("i03_denial_rate_by_specialty", sql(f"""
SELECT p.specialty, count(*) AS total_claims, CAST(sum(c.denial_flag) AS BIGINT) AS denied_claims,
  {rnd("CAST(sum(c.denial_flag) AS DOUBLE) / count(*)")} AS denial_rate
FROM fact_claim c JOIN dim_provider p ON c.provider_key = p.provider_key
GROUP BY p.specialty ORDER BY denial_rate DESC, p.specialty LIMIT 10"""))
def i03(spark, d):
    """Denial rate by provider specialty, top 10."""
    s = Star(spark, d)
    prv = s.dim_provider().select("provider_key", "specialty")
    return (s.fact_claim().join(prv, "provider_key").groupBy("specialty")
            .agg(F.count(F.lit(1)).alias("total_claims"), M.denied_claims().alias("denied_claims"),
                 M.denial_rate().alias("denial_rate"))
            .orderBy(F.col("denial_rate").desc(), "specialty").limit(10))


@query("i04_denied_over_50k", sql(f"""
SELECT c.claim_id, p.full_name AS patient_name, c.payer_name, c.primary_denial_reason,
  CAST(c.billed_amount AS DOUBLE) AS billed_amount
FROM fact_claim c LEFT JOIN dim_patient p ON c.patient_key = p.patient_key
WHERE c.denial_flag = 1 AND c.billed_amount > 50000"""))
def i04(spark, d):
    """I4: denied claims over $50,000 with patient, payer and reason."""
    s = Star(spark, d)
    pat = s.dim_patient().select("patient_key", F.col("full_name").alias("patient_name"))
    return (s.fact_claim().where((F.col("denial_flag") == 1) & (F.col("billed_amount") > 50000))
            .join(pat, "patient_key", "left")
            .select("claim_id", "patient_name", "payer_name", "primary_denial_reason",
                    F.col("billed_amount").cast("double").alias("billed_amount")))


@query("i05_claims_by_risk_category", sql(f"""
SELECT denial_risk_category, count(*) AS total_claims, {MONEY_SUM.format(c='billed_amount')} AS total_billed,
  {RATE} AS denial_rate
FROM fact_claim GROUP BY denial_risk_category"""))
def i05(spark, d):
    """Claims, billed and realised denial rate per denial-risk category."""
    return _fc(spark, d).groupBy("denial_risk_category").agg(
        F.count(F.lit(1)).alias("total_claims"), M.total_of("billed_amount").alias("total_billed"),
        M.denial_rate().alias("denial_rate"))


@query("i06_high_risk_pending", sql(f"""
SELECT claim_id, payer_name, CAST(billed_amount AS DOUBLE) AS billed_amount, denial_risk_score
FROM fact_claim WHERE denial_risk_category = 'High' AND claim_status = 'Pending'"""))
def i06(spark, d):
    """High-risk claims still pending."""
    return (_fc(spark, d).where((F.col("denial_risk_category") == "High") & (F.col("claim_status") == "Pending"))
            .select("claim_id", "payer_name", F.col("billed_amount").cast("double").alias("billed_amount"),
                    "denial_risk_score"))


@query("i26_collection_rate_by_payer", sql(f"""
SELECT payer_name, {MONEY_SUM.format(c='billed_amount')} AS total_billed, {MONEY_SUM.format(c='paid_amount')} AS total_paid,
  {rnd("CAST(sum(paid_amount) AS DOUBLE) / CAST(sum(billed_amount) AS DOUBLE)")} AS collection_rate,
  CAST(round(sum(billed_amount) - sum(paid_amount), 2) AS DOUBLE) AS reimbursement_gap
FROM fact_claim GROUP BY payer_name ORDER BY collection_rate ASC, payer_name"""))
def i26(spark, d):
    """Payers by lowest collection rate, with the reimbursement gap."""
    return (_fc(spark, d).groupBy("payer_name").agg(
        M.total_of("billed_amount").alias("total_billed"), M.total_of("paid_amount").alias("total_paid"),
        M.collection_rate().alias("collection_rate"),
        M.money(F.sum("billed_amount") - F.sum("paid_amount")).alias("reimbursement_gap"))
        .orderBy("collection_rate", "payer_name"))


@query("i29_denial_high_poverty_vs_overall", sql(f"""
SELECT {rnd("CAST(sum(CASE WHEN s.poverty_rate >= 0.20 THEN c.denial_flag END) AS DOUBLE) / count(CASE WHEN s.poverty_rate >= 0.20 THEN 1 END)")} AS high_poverty_denial_rate,
       {rnd("CAST(sum(c.denial_flag) AS DOUBLE) / count(*)")} AS overall_denial_rate,
       count(CASE WHEN s.poverty_rate >= 0.20 THEN 1 END) AS high_poverty_claims, count(*) AS total_claims
FROM fact_claim c LEFT JOIN dim_patient p ON c.patient_key = p.patient_key
LEFT JOIN dim_sdoh s ON p.zip_code = s.zip_code"""))
def i29(spark, d):
    """Denial rate in high-poverty zips vs overall, in one pass."""
    s = Star(spark, d)
    pat = s.dim_patient().select("patient_key", "zip_code")
    sd = s.dim_sdoh().select("zip_code", "poverty_rate")
    j = s.fact_claim().join(pat, "patient_key", "left").join(sd, "zip_code", "left")
    hp = F.col("poverty_rate") >= 0.20
    return j.agg(
        M.rate(F.sum(F.when(hp, F.col("denial_flag"))), F.count(F.when(hp, 1))).alias("high_poverty_denial_rate"),
        M.denial_rate().alias("overall_denial_rate"),
        F.count(F.when(hp, 1)).alias("high_poverty_claims"), F.count(F.lit(1)).alias("total_claims"))


@query("i33_top_reason_per_payer", sql(f"""
SELECT payer_name, primary_denial_reason, denied_claims FROM (
  SELECT payer_name, primary_denial_reason, count(*) AS denied_claims,
    row_number() OVER (PARTITION BY payer_name ORDER BY count(*) DESC, primary_denial_reason) AS rn
  FROM fact_claim WHERE denial_flag = 1 GROUP BY payer_name, primary_denial_reason) WHERE rn = 1"""))
def i33(spark, d):
    """The leading denial reason of each payer."""
    agg = (_fc(spark, d).where(F.col("denial_flag") == 1)
           .groupBy("payer_name", "primary_denial_reason").agg(F.count(F.lit(1)).alias("denied_claims")))
    w = Window.partitionBy("payer_name").orderBy(F.col("denied_claims").desc(), "primary_denial_reason")
    return agg.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@query("i33b_top_payer_per_reason", sql("""
SELECT primary_denial_reason, payer_name, denied_claims FROM (
  SELECT primary_denial_reason, payer_name, count(*) AS denied_claims,
    row_number() OVER (PARTITION BY primary_denial_reason ORDER BY count(*) DESC, payer_name) AS rn
  FROM fact_claim WHERE denial_flag = 1 GROUP BY 1, 2) WHERE rn = 1"""))
def i33b(spark, d):
    """The payer that leads in each denial reason (the window runs over
    one row per reason and payer)."""
    agg = (_fc(spark, d).where(F.col("denial_flag") == 1)
           .groupBy("primary_denial_reason", "payer_name").agg(F.count(F.lit(1)).alias("denied_claims")))
    w = Window.partitionBy("primary_denial_reason").orderBy(F.col("denied_claims").desc(), "payer_name")
    return agg.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@query("i34_facility_denial_leader", sql(f"""
SELECT f.facility_name, r.total_claims, r.denial_rate, t.primary_denial_reason AS top_reason
FROM (SELECT facility_key, count(*) AS total_claims,
        {RATE} AS denial_rate
      FROM fact_claim GROUP BY facility_key) r
LEFT JOIN (SELECT facility_key, primary_denial_reason FROM (
             SELECT facility_key, primary_denial_reason, row_number() OVER (
               PARTITION BY facility_key ORDER BY count(*) DESC, primary_denial_reason DESC) AS rn
             FROM fact_claim WHERE denial_flag = 1 GROUP BY facility_key, primary_denial_reason) WHERE rn = 1) t
  ON r.facility_key IS NOT DISTINCT FROM t.facility_key
JOIN dim_facility f ON r.facility_key = f.facility_key"""))
def i34(spark, d):
    """Denial rate per facility and its most frequent denial reason."""
    s = Star(spark, d)
    fc = s.fact_claim()
    fac = s.dim_facility().select("facility_key", "facility_name")
    rates = fc.groupBy("facility_key").agg(F.count(F.lit(1)).alias("total_claims"),
                                           M.denial_rate().alias("denial_rate"))
    reasons = (fc.where(F.col("denial_flag") == 1).groupBy("facility_key", "primary_denial_reason")
               .agg(F.count(F.lit(1)).alias("n"))
               .groupBy("facility_key")
               .agg(F.max(F.struct(F.col("n"), F.col("primary_denial_reason"))).alias("top")))
    return (rates.join(reasons, "facility_key", "left").join(fac, "facility_key")
            .select("facility_name", "total_claims", "denial_rate",
                    F.col("top.primary_denial_reason").alias("top_reason")))


@query("i35_reason_month_trend", sql(f"""
SELECT month, denied_claims, denied_claims - lag(denied_claims) OVER (ORDER BY month) AS change_vs_prior
FROM (SELECT CAST(strftime(claim_date, '%Y-%m') AS VARCHAR) AS month, count(*) AS denied_claims
      FROM fact_claim WHERE primary_denial_reason = 'Prior Authorization Required' GROUP BY 1)"""))
def i35(spark, d):
    """Month-over-month trend of one denial reason.

    The window runs over one row per month (bounded by the calendar)."""
    m = (_fc(spark, d).where(F.col("primary_denial_reason") == "Prior Authorization Required")
         .groupBy(F.date_format("claim_date", "yyyy-MM").alias("month"))
         .agg(F.count(F.lit(1)).alias("denied_claims")))
    return m.withColumn("change_vs_prior",
                        F.col("denied_claims") - F.lag("denied_claims").over(Window.orderBy("month")))


@query("i36_denial_by_diagnosis_category", sql(f"""
SELECT x.icd_category, c.payer_name, count(*) AS total_claims,
  {rnd("CAST(sum(c.denial_flag) AS DOUBLE) / count(*)")} AS denial_rate
FROM fact_claim c JOIN dim_diagnosis x ON c.primary_diagnosis_code = x.icd_code
GROUP BY x.icd_category, c.payer_name"""))
def i36(spark, d):
    """Denial rate by diagnosis category x payer."""
    s = Star(spark, d)
    dx = s.dim_diagnosis().select(F.col("icd_code").alias("primary_diagnosis_code"), "icd_category")
    return (s.fact_claim().join(dx, "primary_diagnosis_code").groupBy("icd_category", "payer_name")
            .agg(F.count(F.lit(1)).alias("total_claims"), M.denial_rate().alias("denial_rate")))


@query("i36b_denial_by_diagnosis_code", sql(f"""
SELECT primary_diagnosis_code, count(*) AS total_claims, {RATE} AS denial_rate FROM fact_claim GROUP BY 1"""))
def i36b(spark, d):
    """Denial rate by diagnosis code."""
    return (_fc(spark, d).groupBy("primary_diagnosis_code")
            .agg(F.count(F.lit(1)).alias("total_claims"), M.denial_rate().alias("denial_rate")))


@query("i36c_denial_by_encounter_type", sql(f"""
SELECT e.encounter_type, count(*) AS total_claims, {rnd("CAST(sum(c.denial_flag) AS DOUBLE) / count(*)")} AS denial_rate
FROM fact_claim c JOIN fact_encounter e ON c.encounter_key = e.encounter_key GROUP BY 1"""))
def i36c(spark, d):
    """Denial rate by encounter type; claims are summed per encounter
    before the join."""
    s = Star(spark, d)
    per = (s.fact_claim().groupBy("encounter_key")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("denial_flag").alias("denied")))
    return (per.join(s.fact_encounter().select("encounter_key", "encounter_type"), "encounter_key")
            .groupBy("encounter_type").agg(F.sum("n").alias("total_claims"),
                                           M.rate(F.sum("denied"), F.sum("n")).alias("denial_rate")))


@query("i37_providers_denial_over_10pct", sql(f"""
SELECT provider_id, count(*) AS total_claims, {RATE} AS denial_rate
FROM fact_claim GROUP BY provider_id HAVING CAST(sum(denial_flag) AS DOUBLE) / count(*) > 0.10"""))
def i37(spark, d):
    """Providers whose denial rate exceeds 10%."""
    return (_fc(spark, d).groupBy("provider_id")
            .agg(F.count(F.lit(1)).alias("total_claims"), M.denial_rate().alias("denial_rate"),
                 (F.sum("denial_flag") / F.count(F.lit(1))).alias("_r"))
            .where(F.col("_r") > 0.10).drop("_r"))


@query("h16_mtd_claims", sql(f"""
SELECT claim_date, n_claims, CAST(sum(n_claims) OVER (PARTITION BY year(claim_date), month(claim_date)
  ORDER BY claim_date) AS BIGINT) AS mtd_claims
FROM (SELECT claim_date, count(*) AS n_claims FROM fact_claim GROUP BY claim_date)"""))
def h16(spark, d):
    """Month-to-date claim count per day (window over one row per day)."""
    daily = _fc(spark, d).groupBy("claim_date").agg(F.count(F.lit(1)).alias("n_claims"))
    w = (Window.partitionBy(F.year("claim_date"), F.month("claim_date")).orderBy("claim_date")
         .rangeBetween(Window.unboundedPreceding, 0))
    return daily.withColumn("mtd_claims", F.sum("n_claims").over(w).cast("long"))


@query("h17_paid_by_payment_month", sql(f"""
SELECT d.year, d.month_number, CAST(round(sum(c.paid_amount), 2) AS DOUBLE) AS paid_by_payment_date
FROM fact_claim c JOIN dim_date d
  ON c.payment_date_key = d.date_key
GROUP BY d.year, d.month_number"""))
def h17(spark, d):
    """Paid amount by payment date (the inactive role-playing date)."""
    s = Star(spark, d)
    dd = s.dim_date().select("date_key", "year", "month_number")
    return (s.fact_claim().join(dd, F.col("payment_date_key") == F.col("date_key"))
            .groupBy("year", "month_number").agg(M.total_of("paid_amount").alias("paid_by_payment_date")))


@query("i28_denied_claims_primary_diagnosis", sql("""
SELECT c.claim_id, x.icd_code, d.icd_category
FROM fact_claim c JOIN fact_diagnosis x ON c.encounter_key = x.encounter_key AND x.sequence_number = 1
LEFT JOIN dim_diagnosis d ON x.diagnosis_key = d.diagnosis_key
WHERE c.denial_flag = 1"""))
def i28(spark, d):
    """Denied claims with the primary diagnosis of their encounter."""
    s = Star(spark, d)
    primary = (s.fact_diagnosis().where(F.col("sequence_number") == 1)
               .select("encounter_key", "icd_code", "diagnosis_key"))
    dx = s.dim_diagnosis().select("diagnosis_key", "icd_category")
    return (s.fact_claim().where(F.col("denial_flag") == 1).select("claim_id", "encounter_key")
            .join(primary, "encounter_key").join(dx, "diagnosis_key", "left")
            .select("claim_id", "icd_code", "icd_category"))


@query("i28b_encounters_behind_denials", sql("""
SELECT encounter_type, count(*) AS encounters FROM fact_encounter
WHERE encounter_key IN (SELECT encounter_key FROM fact_claim WHERE denial_flag = 1) GROUP BY 1"""))
def i28b(spark, d):
    """Encounters that have at least one denied claim (semi-join)."""
    s = Star(spark, d)
    denied = s.fact_claim().where(F.col("denial_flag") == 1).select("encounter_key")
    return (s.fact_encounter().join(denied, "encounter_key", "left_semi").groupBy("encounter_type")
            .agg(F.count(F.lit(1)).alias("encounters")))
