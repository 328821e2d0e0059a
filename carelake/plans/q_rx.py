"""Prescription and adherence questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators import aggs as A
from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.registry import query
from carelake.plans.star import Star


def adherence(s: Star):
    """F4/F5 over the star, kept once a session."""
    return s.numbered("agg_adherence", lambda: A.adherence_keys(
        A.pdc_simple(s.fact_prescription(), s.dim_medication())))


def chronic_fills(s: Star):
    meds = s.dim_medication().where("is_chronic = 1").select("medication_key", "drug_class")
    return s.fact_prescription().select("patient_key", "medication_key", "fill_date", "days_supply") \
        .join(meds, "medication_key")


def inpatient_stays(s: Star):
    return (s.fact_encounter().where((F.col("encounter_type") == "Inpatient") & F.col("patient_key").isNotNull())
            .select("patient_key", F.col("encounter_date").alias("stay_start"),
                    F.col("discharge_date").alias("stay_end")))


MONEY = "CAST(round({}, 2) AS DOUBLE)"


@query("f04_medication_adherence", sql(f"""
SELECT adherence_key, patient_key, medication_key, drug_class, therapeutic_area, measurement_period_start,
  measurement_period_end, total_fills, total_days_supply, days_in_period, covered_days,
  {rnd('pdc_score')} AS pdc_score, adherence_category,
  {MONEY.format('total_medication_cost')} AS total_medication_cost, {MONEY.format('total_payer_cost')} AS total_payer_cost,
  {MONEY.format('total_patient_cost')} AS total_patient_cost, gap_days, is_chronic
FROM agg_adherence"""))
def f04(spark, d):
    """agg_medication_adherence, keyed by patient and medication."""
    a = adherence(Star(spark, d))
    return a.select("adherence_key", "patient_key", "medication_key", "drug_class", "therapeutic_area",
                    "measurement_period_start", "measurement_period_end", "total_fills", "total_days_supply",
                    "days_in_period", "covered_days", M.rnd(F.col("pdc_score")).alias("pdc_score"),
                    "adherence_category", M.money(F.col("total_medication_cost")).alias("total_medication_cost"),
                    M.money(F.col("total_payer_cost")).alias("total_payer_cost"),
                    M.money(F.col("total_patient_cost")).alias("total_patient_cost"), "gap_days",
                    F.col("is_chronic").cast("int"))


@query("f04b_pdc_exact", sql("""
SELECT patient_key, drug_class, year, period_start, fills, covered_days, period_days, pdc FROM pdc_exact"""))
def f04b(spark, d):
    """Exact PDC per patient x drug class x year (gaps and islands)."""
    out = A.pdc_exact(chronic_fills(Star(spark, d)))
    return out.select("patient_key", "drug_class", "year", "period_start", "fills",
                      F.col("covered_days").cast("long"), "period_days", "pdc")


@query("f04c_pdc_excluding_inpatient", sql("""
SELECT patient_key, drug_class, year, period_days, period_days_excl, covered_days, covered_days_excl, pdc_excl
FROM pdc_excl_stays"""))
def f04c(spark, d):
    """Exact PDC with inpatient days excluded from both sides."""
    s = Star(spark, d)
    return A.pdc_excluding_stays(chronic_fills(s), inpatient_stays(s)).select(
        "patient_key", "drug_class", "year", "period_days", "period_days_excl", "covered_days",
        "covered_days_excl", "pdc_excl")


@query("f04d_star_measures", sql(f"""
SELECT g.measure, g.year, g.members, g.adherent, g.rate, c.cut_4, c.cut_5,
  {rnd('greatest(c.cut_4 - g.rate, 0.0)')} AS gap_to_4_star, {rnd('greatest(c.cut_5 - g.rate, 0.0)')} AS gap_to_5_star
FROM (
  SELECT measure, year, count(*) AS members, count(*) FILTER (WHERE pdc >= 0.80) AS adherent,
    {rnd('CAST(count(*) FILTER (WHERE pdc >= 0.80) AS DOUBLE) / count(*)')} AS rate
  FROM (
    SELECT x.*, CASE TRY_CAST(regexp_extract(x.drug_class, '(\\d+)$', 1) AS INTEGER) % 3
                  WHEN 0 THEN 'Diabetes' WHEN 1 THEN 'RAS Antagonists' WHEN 2 THEN 'Statins' END AS measure
    FROM pdc_exact x JOIN dim_patient p ON x.patient_key = p.patient_key
    WHERE x.fills >= 2 AND p.age >= 18)
  GROUP BY 1, 2) g
JOIN (SELECT * FROM (VALUES ('Diabetes', 0.80::DOUBLE, 0.83::DOUBLE), ('RAS Antagonists', 0.81::DOUBLE, 0.84::DOUBLE),
                            ('Statins', 0.81::DOUBLE, 0.84::DOUBLE)) t(measure, cut_4, cut_5)) c
  ON g.measure = c.measure"""))
def f04d(spark, d):
    """F4d: adherence measure rates vs 4- and 5-star cut points."""
    s = Star(spark, d)
    pdc = A.pdc_exact(chronic_fills(s))
    return A.star_measures(pdc, s.dim_patient()).select(
        "measure", "year", "members", "adherent", "rate", "cut_4", "cut_5", "gap_to_4_star", "gap_to_5_star")


@query("h18_adherence_by_area", sql(f"""
SELECT therapeutic_area, count(*) AS members,
  {rnd("CAST(count(*) FILTER (WHERE adherence_category = 'Adherent') AS DOUBLE) / count(*)")} AS adherent_rate,
  {rnd('avg(pdc_score)')} AS avg_pdc_score
FROM agg_adherence GROUP BY therapeutic_area"""))
def h18(spark, d):
    """Adherent rate and average PDC per therapeutic area."""
    return adherence(Star(spark, d)).groupBy("therapeutic_area").agg(
        F.count(F.lit(1)).alias("members"),
        M.rate(F.count_if(F.col("adherence_category") == "Adherent"), F.count(F.lit(1))).alias("adherent_rate"),
        M.avg_of("pdc_score").alias("avg_pdc_score"))


@query("h22_rx_measures_by_area", sql(f"""
SELECT m.therapeutic_area, count(*) AS total_fills, {MONEY.format('sum(r.total_cost)')} AS total_rx_cost,
  {rnd('CAST(sum(r.total_cost) AS DOUBLE) / count(*)', 2)} AS avg_rx_cost_per_fill,
  {rnd('CAST(sum(r.is_generic) AS DOUBLE) / count(*)')} AS generic_fill_rate,
  {MONEY.format('sum(r.payer_paid)')} AS payer_rx_cost, {MONEY.format('sum(r.patient_copay)')} AS patient_copay_total
FROM fact_prescription r JOIN dim_medication m ON r.medication_key = m.medication_key GROUP BY 1"""))
def h22(spark, d):
    """Prescription measures per therapeutic area."""
    s = Star(spark, d)
    meds = s.dim_medication().select("medication_key", "therapeutic_area")
    return M.measure_table(s.fact_prescription().join(meds, "medication_key"), ["therapeutic_area"], [
        "total_fills", "total_rx_cost", "avg_rx_cost_per_fill", "generic_fill_rate", "payer_rx_cost",
        "patient_copay_total"])


@query("i11_non_adherent_members", sql(f"""
SELECT p.patient_id, a.drug_class, a.gap_days, {rnd('a.pdc_score')} AS pdc_score
FROM agg_adherence a JOIN dim_patient p ON a.patient_key = p.patient_key
WHERE a.adherence_category = 'Non-Adherent'"""))
def i11(spark, d):
    """Non-adherent members (chronic medications) with class and gap days."""
    s = Star(spark, d)
    pat = s.dim_patient().select("patient_key", "patient_id")
    return (adherence(s).where(F.col("adherence_category") == "Non-Adherent").join(pat, "patient_key")
            .select("patient_id", "drug_class", "gap_days", M.rnd(F.col("pdc_score")).alias("pdc_score")))


@query("i12_adherence_by_class_area", sql(f"""
SELECT drug_class, therapeutic_area, count(*) AS members,
  count(*) FILTER (WHERE adherence_category = 'Adherent') AS adherent,
  {rnd("CAST(count(*) FILTER (WHERE adherence_category = 'Adherent') AS DOUBLE) / count(*)")} AS adherence_rate
FROM agg_adherence GROUP BY 1, 2"""))
def i12(spark, d):
    """Adherence rate by drug class x therapeutic area."""
    ok = F.count_if(F.col("adherence_category") == "Adherent")
    return adherence(Star(spark, d)).groupBy("drug_class", "therapeutic_area").agg(
        F.count(F.lit(1)).alias("members"), ok.alias("adherent"),
        M.rate(ok, F.count(F.lit(1))).alias("adherence_rate"))


@query("i13_patients_by_adherence", sql("""
SELECT adherence_category, count(DISTINCT patient_key) AS patients FROM agg_adherence GROUP BY 1"""))
def i13(spark, d):
    """Distinct patients per adherence category."""
    return adherence(Star(spark, d)).groupBy("adherence_category").agg(
        F.countDistinct("patient_key").alias("patients"))


@query("i14_avg_rx_cost_by_class_area", sql(f"""
SELECT m.drug_class, m.therapeutic_area, count(*) AS fills,
  {rnd('CAST(sum(r.total_cost) AS DOUBLE) / count(*)', 2)} AS avg_cost
FROM fact_prescription r JOIN dim_medication m ON r.medication_key = m.medication_key GROUP BY 1, 2"""))
def i14(spark, d):
    """Average prescription cost by drug class x therapeutic area."""
    s = Star(spark, d)
    meds = s.dim_medication().select("medication_key", "drug_class", "therapeutic_area")
    return (s.fact_prescription().join(meds, "medication_key").groupBy("drug_class", "therapeutic_area")
            .agg(F.count(F.lit(1)).alias("fills"),
                 M.rnd(F.sum("total_cost").cast("double") / F.count(F.lit(1)), 2).alias("avg_cost")))


@query("i20_oop_burden_by_class", sql(f"""
SELECT c.drug_class, c.total_cost, c.copay, c.copay_share, a.non_adherent_share FROM (
  SELECT m.drug_class, {MONEY.format('sum(r.total_cost)')} AS total_cost, {MONEY.format('sum(r.patient_copay)')} AS copay,
    {rnd('CAST(sum(r.patient_copay) AS DOUBLE) / CAST(sum(r.total_cost) AS DOUBLE)')} AS copay_share
  FROM fact_prescription r JOIN dim_medication m ON r.medication_key = m.medication_key GROUP BY 1) c
LEFT JOIN (
  SELECT drug_class, {rnd("CAST(count(*) FILTER (WHERE adherence_category = 'Non-Adherent') AS DOUBLE) / count(*)")}
    AS non_adherent_share FROM agg_adherence GROUP BY 1) a ON c.drug_class = a.drug_class"""))
def i20(spark, d):
    """Out-of-pocket burden per drug class next to its non-adherent share
    (two aggregates joined on the class)."""
    s = Star(spark, d)
    meds = s.dim_medication().select("medication_key", "drug_class")
    cost = (s.fact_prescription().join(meds, "medication_key").groupBy("drug_class").agg(
        M.money(F.sum("total_cost")).alias("total_cost"), M.money(F.sum("patient_copay")).alias("copay"),
        M.rate(F.sum("patient_copay"), F.sum("total_cost")).alias("copay_share")))
    adh = adherence(s).groupBy("drug_class").agg(
        M.rate(F.count_if(F.col("adherence_category") == "Non-Adherent"), F.count(F.lit(1)))
        .alias("non_adherent_share"))
    return cost.join(adh, "drug_class", "left")


@query("i22_rx_cost_by_payer", sql(f"""
SELECT py.payer_name, {MONEY.format('sum(r.total_cost)')} AS total_cost, {MONEY.format('sum(r.payer_paid)')} AS payer_paid,
  {MONEY.format('sum(r.patient_copay)')} AS patient_paid,
  {rnd('CAST(sum(r.patient_copay) AS DOUBLE) / CAST(sum(r.total_cost) AS DOUBLE)')} AS patient_share
FROM fact_prescription r JOIN dim_payer py ON r.payer_key = py.payer_key GROUP BY 1"""))
def i22(spark, d):
    """Prescription cost by payer and the share shifted to patients."""
    s = Star(spark, d)
    py = s.dim_payer().select("payer_key", "payer_name")
    return (s.fact_prescription().join(py, "payer_key").groupBy("payer_name").agg(
        M.money(F.sum("total_cost")).alias("total_cost"), M.money(F.sum("payer_paid")).alias("payer_paid"),
        M.money(F.sum("patient_copay")).alias("patient_paid"),
        M.rate(F.sum("patient_copay"), F.sum("total_cost")).alias("patient_share")))


@query("i23_avg_copay_payer_class", sql(f"""
SELECT py.payer_name, m.drug_class, count(*) AS fills,
  {rnd('CAST(sum(r.patient_copay) AS DOUBLE) / count(*)', 2)} AS avg_copay
FROM fact_prescription r JOIN dim_payer py ON r.payer_key = py.payer_key
JOIN dim_medication m ON r.medication_key = m.medication_key GROUP BY 1, 2"""))
def i23(spark, d):
    """Average copay by payer x drug class."""
    s = Star(spark, d)
    py = s.dim_payer().select("payer_key", "payer_name")
    meds = s.dim_medication().select("medication_key", "drug_class")
    return (s.fact_prescription().join(py, "payer_key").join(meds, "medication_key")
            .groupBy("payer_name", "drug_class")
            .agg(F.count(F.lit(1)).alias("fills"),
                 M.rnd(F.sum("patient_copay").cast("double") / F.count(F.lit(1)), 2).alias("avg_copay")))


@query("i24_chronic_cost_by_payer", sql(f"""
SELECT py.payer_name, count(*) AS fills, {MONEY.format('sum(r.total_cost)')} AS chronic_cost
FROM fact_prescription r JOIN dim_payer py ON r.payer_key = py.payer_key
JOIN dim_medication m ON r.medication_key = m.medication_key WHERE m.is_chronic = 1 GROUP BY 1"""))
def i24(spark, d):
    """Chronic medication cost burden by payer."""
    s = Star(spark, d)
    py = s.dim_payer().select("payer_key", "payer_name")
    meds = s.dim_medication().where("is_chronic = 1").select("medication_key")
    return (s.fact_prescription().join(meds, "medication_key").join(py, "payer_key").groupBy("payer_name")
            .agg(F.count(F.lit(1)).alias("fills"), M.money(F.sum("total_cost")).alias("chronic_cost")))


@query("i25_provider_payer_network", sql(f"""
SELECT r.provider_id, py.payer_name, count(*) AS prescriptions, {MONEY.format('sum(r.total_cost)')} AS total_cost
FROM fact_prescription r JOIN dim_payer py ON r.payer_key = py.payer_key GROUP BY 1, 2"""))
def i25(spark, d):
    """Provider-payer prescription network (weighted edges)."""
    s = Star(spark, d)
    py = s.dim_payer().select("payer_key", "payer_name")
    return (s.fact_prescription().join(py, "payer_key").groupBy("provider_id", "payer_name")
            .agg(F.count(F.lit(1)).alias("prescriptions"), M.money(F.sum("total_cost")).alias("total_cost")))


@query("i41_adherence_by_payer", sql(f"""
SELECT p.payer_id, count(*) AS members,
  {rnd("CAST(count(*) FILTER (WHERE a.adherence_category = 'Adherent') AS DOUBLE) / count(*)")} AS adherent_rate,
  {rnd('avg(a.pdc_score)')} AS avg_pdc
FROM agg_adherence a JOIN dim_patient p ON a.patient_key = p.patient_key GROUP BY 1"""))
def i41(spark, d):
    """Adherence by payer."""
    s = Star(spark, d)
    pat = s.dim_patient().select("patient_key", "payer_id")
    return (adherence(s).join(pat, "patient_key").groupBy("payer_id").agg(
        F.count(F.lit(1)).alias("members"),
        M.rate(F.count_if(F.col("adherence_category") == "Adherent"), F.count(F.lit(1))).alias("adherent_rate"),
        M.avg_of("pdc_score").alias("avg_pdc")))


@query("i41b_lowest_pdc_medications", sql(f"""
SELECT m.medication_name, count(*) AS members, {rnd('avg(a.pdc_score)')} AS avg_pdc
FROM agg_adherence a JOIN dim_medication m ON a.medication_key = m.medication_key
GROUP BY m.medication_key, m.medication_name
ORDER BY avg(a.pdc_score), m.medication_key LIMIT 10"""))
def i41b(spark, d):
    """The ten medications with the lowest average PDC."""
    s = Star(spark, d)
    meds = s.dim_medication().select("medication_key", "medication_name")
    g = adherence(s).groupBy("medication_key").agg(F.count(F.lit(1)).alias("members"),
                                                   F.avg("pdc_score").alias("_avg"))
    return (g.join(meds, "medication_key").orderBy("_avg", "medication_key").limit(10)
            .select("medication_name", "members", M.rnd(F.col("_avg")).alias("avg_pdc")))


@query("i41d_below_target_by_class", sql(f"""
SELECT drug_class, count(*) AS members, count(*) FILTER (WHERE pdc_score < 0.80) AS below_target,
  {rnd("CAST(count(*) FILTER (WHERE pdc_score < 0.80) AS DOUBLE) / count(*)")} AS below_target_rate
FROM agg_adherence GROUP BY 1"""))
def i41d(spark, d):
    """Members under a PDC of 0.80 in each drug class."""
    low = F.count_if(F.col("pdc_score") < 0.80)
    return adherence(Star(spark, d)).groupBy("drug_class").agg(
        F.count(F.lit(1)).alias("members"), low.alias("below_target"),
        M.rate(low, F.count(F.lit(1))).alias("below_target_rate"))


@query("i41c_adherence_6_month_trend", sql(f"""
SELECT year, half, count(*) AS members,
  {rnd("CAST(count(*) FILTER (WHERE pdc >= 0.80) AS DOUBLE) / count(*)")} AS adherent_rate
FROM (SELECT *, CASE WHEN month(period_start) <= 6 THEN 1 ELSE 2 END AS half FROM pdc_exact) GROUP BY 1, 2"""))
def i41c(spark, d):
    """Adherence trend by half-year of the measurement start."""
    pdc = A.pdc_exact(chronic_fills(Star(spark, d)))
    half = F.when(F.month("period_start") <= 6, 1).otherwise(2)
    return pdc.groupBy("year", half.alias("half")).agg(
        F.count(F.lit(1)).alias("members"),
        M.rate(F.count_if(F.col("pdc") >= 0.80), F.count(F.lit(1))).alias("adherent_rate"))
