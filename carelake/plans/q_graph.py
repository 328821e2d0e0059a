"""Property-graph patterns (M1-M16) as join chains over node/edge frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators.graph import EDGE_TYPES, NODE_TYPES, Graph
from carelake.plans import metrics as M
from carelake.plans.oracle import rnd, sql
from carelake.plans.q_rx import adherence
from carelake.plans.registry import query
from carelake.plans.star import Star

CURRENT = {"dim_patient", "dim_provider"}


def graph(s: Star) -> Graph:
    return Graph({
        "fact_claim": s.fact_claim, "dim_sdoh": s.dim_sdoh, "dim_diagnosis": s.dim_diagnosis,
        "fact_encounter": s.fact_encounter, "dim_medication": s.dim_medication,
        "agg_adherence": lambda: adherence(s), "dim_patient": s.dim_patient,
        "fact_diagnosis": s.fact_diagnosis, "dim_payer": s.dim_payer,
        "fact_prescription": s.fact_prescription, "dim_provider": s.dim_provider,
    })


def _where_current(table: str, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f" AND {p}is_current = 1" if table in CURRENT else ""


def _validation_sql() -> str:
    parts = []
    for etype, (src, dst, table, fk) in EDGE_TYPES.items():
        dtable, dpk = NODE_TYPES[dst]
        parts.append(
            f"SELECT '{etype}' AS edge, '{table}' AS table_name, true AS pk_exists, true AS fk_exists, "
            f"(SELECT count(*) FROM {table} t WHERE t.{fk} IS NOT NULL{_where_current(table, 't')} AND t.{fk} NOT IN "
            f"(SELECT {dpk} FROM {dtable} WHERE {dpk} IS NOT NULL{_where_current(dtable)})) AS orphan_edges")
    return "\nUNION ALL\n".join(parts)


def _counts_sql() -> str:
    parts = [f"SELECT 'node' AS kind, '{l}' AS name, count(*) AS n FROM {t} WHERE {pk} IS NOT NULL{_where_current(t)}"
             for l, (t, pk) in NODE_TYPES.items()]
    parts += [f"SELECT 'edge', '{e}', count(*) FROM {t} WHERE {fk} IS NOT NULL{_where_current(t)}"
              for e, (_, _, t, fk) in EDGE_TYPES.items()]
    return "\nUNION ALL\n".join(parts)


@query("m02_binding_validation", sql(_validation_sql()))
def m02(spark, d):
    """M2: bound columns exist; edges pointing at missing target nodes."""
    return graph(Star(spark, d)).validate()


@query("m03_graph_counts", sql(_counts_sql()))
def m03(spark, d):
    """M1/M3: nodes per label and edges per type."""
    return graph(Star(spark, d)).counts()


@query("m04_one_hop_claims_of_specialty", sql("""
SELECT DISTINCT c.claim_id FROM fact_claim c JOIN dim_provider p ON c.provider_key = p.provider_key
WHERE p.is_current = 1 AND p.specialty = 'Cardiology' ORDER BY c.claim_id LIMIT 25"""))
def m04(spark, d, specialty: str = "Cardiology"):
    """M4: one hop Claim -submittedBy-> Provider with a filter on the far end."""
    g = graph(Star(spark, d))
    prov = g.nodes("Provider").where(F.col("specialty") == specialty).select(F.col("provider_key").alias("dst"))
    return (g.edges("submittedBy").join(prov, "dst").select(F.col("src").alias("claim_id")).distinct()
            .orderBy("claim_id").limit(25))


@query("m05_claim_provider_payer", sql("""
SELECT c.claim_id, p.provider_name, y.payer_name FROM fact_claim c
JOIN dim_provider p ON c.provider_key = p.provider_key AND p.is_current = 1
JOIN dim_payer y ON c.payer_key = y.payer_key"""))
def m05(spark, d):
    """M5: two outbound paths from each claim (provider and payer)."""
    g = graph(Star(spark, d))
    prov = g.nodes("Provider").select(F.col("provider_key").alias("pk"), "provider_name")
    pay = g.nodes("Payer").select(F.col("payer_key").alias("yk"), "payer_name")
    a = g.edges("submittedBy").join(prov, F.col("dst") == F.col("pk")).select(F.col("src").alias("claim_id"),
                                                                               "provider_name")
    b = g.edges("ClaimHasPayer").join(pay, F.col("dst") == F.col("yk")).select(
        F.col("src").alias("claim_id"), "payer_name")
    return a.join(b, "claim_id")


@query("m06_claim_encounter_patient_path", sql("""
SELECT c.claim_id, e.encounter_id, p.patient_id, p.zip_code, s.risk_tier
FROM fact_claim c JOIN fact_encounter e ON c.encounter_key = e.encounter_key
JOIN dim_patient p ON e.patient_key = p.patient_key AND p.is_current = 1
JOIN dim_sdoh s ON p.zip_code = s.zip_code"""))
def m06(spark, d):
    """M6: Claim -billsFor-> Encounter -involves-> Patient -livesIn-> CommunityHealth."""
    g = graph(Star(spark, d))
    bills = g.edges("billsFor").select(F.col("src").alias("claim_id"), F.col("dst").alias("encounter_key"))
    inv = g.edges("involves").select(F.col("src").alias("encounter_key"), F.col("dst").alias("patient_key"))
    enc = g.nodes("Encounter").select("encounter_key", "encounter_id")
    pat = g.nodes("Patient").select("patient_key", "patient_id", "zip_code")
    com = g.nodes("CommunityHealth").select("zip_code", "risk_tier")
    return (bills.join(inv, "encounter_key").join(enc, "encounter_key").join(pat, "patient_key")
            .join(com, "zip_code").select("claim_id", "encounter_id", "patient_id", "zip_code", "risk_tier"))


@query("m06b_provider_patient_community_path", sql("""
SELECT r.provider_id, s.zip_code, s.risk_tier, count(*) AS encounters, count(DISTINCT p.patient_key) AS patients
FROM fact_encounter e JOIN dim_provider r ON e.provider_key = r.provider_key
JOIN dim_patient p ON e.patient_key = p.patient_key AND p.is_current = 1
JOIN dim_sdoh s ON p.zip_code = s.zip_code GROUP BY 1, 2, 3"""))
def m06b(spark, d):
    """M6: Provider <-treatedBy- Encounter -involves-> Patient -livesIn-> CommunityHealth,
    counted per provider and community."""
    g = graph(Star(spark, d))
    by = g.edges("treatedBy").select(F.col("src").alias("encounter_key"), F.col("dst").alias("provider_key"))
    inv = g.edges("involves").select(F.col("src").alias("encounter_key"), F.col("dst").alias("patient_key"))
    doc = g.nodes("Provider").select("provider_key", "provider_id")
    pat = g.nodes("Patient").select("patient_key", "zip_code")
    com = g.nodes("CommunityHealth").select("zip_code", "risk_tier")
    return (by.join(inv, "encounter_key").join(doc, "provider_key").join(pat, "patient_key").join(com, "zip_code")
            .groupBy("provider_id", "zip_code", "risk_tier")
            .agg(F.count(F.lit(1)).alias("encounters"), F.countDistinct("patient_key").alias("patients")))


@query("m07_patient_profile", sql("""
SELECT p.patient_id, coalesce(c.n, 0) AS claims, coalesce(e.n, 0) AS encounters, coalesce(r.n, 0) AS prescriptions,
  coalesce(x.n, 0) AS diagnoses
FROM dim_patient p
LEFT JOIN (SELECT patient_key, count(*) AS n FROM fact_claim GROUP BY 1) c ON p.patient_key = c.patient_key
LEFT JOIN (SELECT patient_key, count(*) AS n FROM fact_encounter GROUP BY 1) e ON p.patient_key = e.patient_key
LEFT JOIN (SELECT patient_key, count(*) AS n FROM fact_prescription GROUP BY 1) r ON p.patient_key = r.patient_key
LEFT JOIN (SELECT patient_key, count(*) AS n FROM fact_diagnosis GROUP BY 1) x ON p.patient_key = x.patient_key
WHERE p.is_current = 1"""))
def m07(spark, d):
    """M7: fan-out-safe profile: each relation aggregated on its own, then
    joined on the patient (no cross product of relations)."""
    g = graph(Star(spark, d))
    out = g.nodes("Patient").select("patient_key", "patient_id")
    for etype, name in [("covers", "claims"), ("involves", "encounters"), ("serves", "prescriptions"),
                        ("affects", "diagnoses")]:
        agg = g.edges(etype).groupBy(F.col("dst").alias("patient_key")).agg(F.count(F.lit(1)).alias(name))
        out = out.join(agg, "patient_key", "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    return out.drop("patient_key")


@query("m08_payer_specialty_claims", sql("""
SELECT y.payer_name, p.specialty, count(*) AS claims
FROM fact_claim c JOIN dim_payer y ON c.payer_key = y.payer_key
JOIN dim_provider p ON c.provider_key = p.provider_key AND p.is_current = 1 GROUP BY 1, 2"""))
def m08(spark, d):
    """M8: aggregation over a path, grouped by both ends."""
    g = graph(Star(spark, d))
    pay = g.nodes("Payer").select(F.col("payer_key").alias("y"), "payer_name")
    prov = g.nodes("Provider").select(F.col("provider_key").alias("p"), "specialty")
    a = g.edges("ClaimHasPayer").join(pay, F.col("dst") == F.col("y")).select(F.col("src").alias("c"), "payer_name")
    b = g.edges("submittedBy").join(prov, F.col("dst") == F.col("p")).select(F.col("src").alias("c"), "specialty")
    return a.join(b, "c").groupBy("payer_name", "specialty").agg(F.count(F.lit(1)).alias("claims"))


@query("m09_high_readmission_share_by_payer", sql(f"""
SELECT payer_name, count(*) AS encounters, count(*) FILTER (WHERE readmission_flag = 1) AS readmitted,
  {rnd('CAST(count(*) FILTER (WHERE readmission_flag = 1) AS DOUBLE) / count(*)')} AS readmitted_share
FROM (SELECT DISTINCT y.payer_name, e.encounter_key, e.readmission_flag
      FROM fact_claim c JOIN dim_payer y ON c.payer_key = y.payer_key
      JOIN fact_encounter e ON c.encounter_key = e.encounter_key) GROUP BY 1"""))
def m09(spark, d):
    """M9: two counts over Payer <- Claim -> Encounter on distinct encounters."""
    g = graph(Star(spark, d))
    pay = g.nodes("Payer").select(F.col("payer_key").alias("y"), "payer_name")
    a = g.edges("ClaimHasPayer").join(pay, F.col("dst") == F.col("y")).select(F.col("src").alias("c"), "payer_name")
    b = g.edges("billsFor").select(F.col("src").alias("c"), F.col("dst").alias("encounter_key"))
    enc = g.nodes("Encounter").select("encounter_key", "readmission_flag")
    pairs = a.join(b, "c").select("payer_name", "encounter_key").distinct().join(enc, "encounter_key")
    hit = F.count_if(F.col("readmission_flag") == 1)
    return pairs.groupBy("payer_name").agg(F.count(F.lit(1)).alias("encounters"), hit.alias("readmitted"),
                                          M.rate(hit, F.count(F.lit(1))).alias("readmitted_share"))


@query("m10_orphans_and_connected", sql("""
SELECT (SELECT count(*) FROM dim_patient p WHERE p.is_current = 1 AND p.patient_key NOT IN
          (SELECT patient_key FROM fact_claim WHERE patient_key IS NOT NULL)) AS patients_without_claims,
       (SELECT count(*) FROM dim_provider p WHERE p.is_current = 1 AND p.provider_key IN
          (SELECT provider_key FROM fact_claim WHERE provider_key IS NOT NULL)) AS providers_with_claims"""))
def m10(spark, d):
    """Nodes with no edge (left anti) and nodes with one (left semi)."""
    g = graph(Star(spark, d))
    covers = g.edges("covers").select(F.col("dst").alias("patient_key"))
    sub = g.edges("submittedBy").select(F.col("dst").alias("provider_key"))
    a = g.nodes("Patient").join(covers, "patient_key", "left_anti").agg(
        F.count(F.lit(1)).alias("patients_without_claims"))
    b = g.nodes("Provider").join(sub, "provider_key", "left_semi").agg(
        F.count(F.lit(1)).alias("providers_with_claims"))
    return a.crossJoin(b)  # two one-row aggregates


@query("m11_claim_trace", sql("""
SELECT c.claim_id, pr.provider_name, y.payer_name, p.full_name AS patient_name, e.encounter_type,
  (SELECT count(*) FROM fact_diagnosis x WHERE x.encounter_key = c.encounter_key) AS encounter_diagnoses
FROM (SELECT * FROM fact_claim ORDER BY billed_amount DESC, claim_id LIMIT 1) c
LEFT JOIN dim_provider pr ON c.provider_key = pr.provider_key
LEFT JOIN dim_payer y ON c.payer_key = y.payer_key
LEFT JOIN dim_patient p ON c.patient_key = p.patient_key
LEFT JOIN fact_encounter e ON c.encounter_key = e.encounter_key"""))
def m11(spark, d):
    """End-to-end trace of one claim (the largest) with its neighbours."""
    s = Star(spark, d)
    c = s.fact_claim().orderBy(F.col("billed_amount").desc(), "claim_id").limit(1)
    dx = (s.fact_diagnosis().groupBy("encounter_key").agg(F.count(F.lit(1)).alias("encounter_diagnoses")))
    j = (c.join(s.dim_provider().select("provider_key", "provider_name"), "provider_key", "left")
         .join(s.dim_payer().select("payer_key", F.col("payer_name").alias("_pn")), "payer_key", "left")
         .join(s.dim_patient().select("patient_key", F.col("full_name").alias("patient_name")), "patient_key", "left")
         .join(s.fact_encounter().select("encounter_key", "encounter_type"), "encounter_key", "left")
         .join(dx, "encounter_key", "left"))
    return j.select("claim_id", "provider_name", F.col("_pn").alias("payer_name"), "patient_name", "encounter_type",
                    F.coalesce("encounter_diagnoses", F.lit(0)).alias("encounter_diagnoses"))


@query("m12_denied_claims_by_diagnosis", sql("""
SELECT x.icd_category, CAST(sum(c.denied) AS BIGINT) AS denied_claims
FROM (SELECT encounter_key, count(*) AS denied FROM fact_claim WHERE denial_flag = 1 GROUP BY 1) c
JOIN (SELECT DISTINCT f.encounter_key, d.icd_category FROM fact_diagnosis f
      JOIN dim_diagnosis d ON f.diagnosis_key = d.diagnosis_key) x ON c.encounter_key = x.encounter_key
GROUP BY 1"""))
def m12(spark, d):
    """Denied claims per diagnosis category over
    Claim -> Encounter <- PatientDiagnosis; both sides are reduced to one
    row per encounter (and category) before the join, so no pairs form."""
    s = Star(spark, d)
    denied = (s.fact_claim().where(F.col("denial_flag") == 1).groupBy("encounter_key")
              .agg(F.count(F.lit(1)).alias("denied")))
    cats = (s.fact_diagnosis().join(s.dim_diagnosis().select("diagnosis_key", "icd_category"), "diagnosis_key")
            .select("encounter_key", "icd_category").distinct())
    return (denied.join(cats, "encounter_key").groupBy("icd_category")
            .agg(F.sum("denied").cast("long").alias("denied_claims")))


@query("m13_vulnerable_cohort", sql("""
SELECT patient_key FROM agg_adherence WHERE adherence_category = 'Non-Adherent'
INTERSECT SELECT p.patient_key FROM dim_patient p JOIN dim_sdoh s ON p.zip_code = s.zip_code
  WHERE p.is_current = 1 AND s.risk_tier = 'High'
INTERSECT SELECT patient_key FROM fact_encounter WHERE readmission_risk_category = 'High'"""))
def m13(spark, d):
    """Non-adherent AND high social risk AND high readmission risk."""
    s = Star(spark, d)
    a = adherence(s).where(F.col("adherence_category") == "Non-Adherent").select("patient_key")
    sd = s.dim_sdoh().where((F.col("risk_tier") == "High")).select("zip_code")
    b = s.dim_patient().where("is_current = 1").join(sd, "zip_code").select("patient_key")
    c = s.fact_encounter().where(F.col("readmission_risk_category") == "High").select("patient_key")
    return a.intersect(b).intersect(c)


@query("m14_payer_drug_class_cost", sql("""
SELECT y.payer_name, m.drug_class, count(*) AS prescriptions, CAST(round(sum(r.total_cost), 2) AS DOUBLE) AS total_cost
FROM fact_prescription r JOIN dim_payer y ON r.payer_key = y.payer_key
JOIN dim_medication m ON r.medication_key = m.medication_key GROUP BY 1, 2"""))
def m14(spark, d):
    """Prescription -> Medication and -> Payer, cost per pair."""
    g = graph(Star(spark, d))
    rx = g.nodes("Prescription").select("prescription_id", "payer_key", "medication_key", "total_cost")
    pay = g.nodes("Payer").select("payer_key", "payer_name")
    med = g.nodes("Medication").select("medication_key", "drug_class")
    return (rx.join(pay, "payer_key").join(med, "medication_key").groupBy("payer_name", "drug_class")
            .agg(F.count(F.lit(1)).alias("prescriptions"), M.money(F.sum("total_cost")).alias("total_cost")))


@query("m14b_top_non_generic_prescribers", sql("""
SELECT provider_id, count(*) AS prescriptions, CAST(round(sum(total_cost), 2) AS DOUBLE) AS total_cost
FROM fact_prescription WHERE is_generic = 0 GROUP BY 1 ORDER BY sum(total_cost) DESC, provider_id LIMIT 20"""))
def m14b(spark, d):
    """The 20 prescribers with the highest non-generic cost."""
    r = Star(spark, d).fact_prescription().where(F.col("is_generic") == 0)
    g = r.groupBy("provider_id").agg(F.count(F.lit(1)).alias("prescriptions"), F.sum("total_cost").alias("_c"))
    return (g.orderBy(F.col("_c").desc(), "provider_id").limit(20)
            .select("provider_id", "prescriptions", M.money(F.col("_c")).alias("total_cost")))


@query("m15_provider_payer_degree", sql("""
SELECT c.provider_id, y.payer_name, count(*) AS claims, max(dg.degree) AS provider_degree
FROM fact_claim c JOIN dim_payer y ON c.payer_key = y.payer_key
JOIN (SELECT provider_id, count(DISTINCT payer_key) AS degree FROM fact_claim GROUP BY 1) dg
  ON c.provider_id = dg.provider_id
GROUP BY 1, 2"""))
def m15(spark, d):
    """Weighted provider-payer edges with the provider's degree."""
    fc = Star(spark, d).fact_claim()
    deg = fc.groupBy("provider_id").agg(F.countDistinct("payer_key").alias("provider_degree"))
    w = fc.groupBy("provider_id", "payer_name").agg(F.count(F.lit(1)).alias("claims"))
    return w.join(deg, "provider_id")


@query("m16_non_adherent_class_count", sql("""
SELECT patient_key, count(DISTINCT drug_class) AS non_adherent_classes FROM agg_adherence
WHERE adherence_category = 'Non-Adherent' GROUP BY 1 ORDER BY non_adherent_classes DESC, patient_key LIMIT 20"""))
def m16(spark, d):
    """Patients by number of non-adherent drug classes (top 20)."""
    a = adherence(Star(spark, d)).where(F.col("adherence_category") == "Non-Adherent")
    return (a.groupBy("patient_key").agg(F.countDistinct("drug_class").alias("non_adherent_classes"))
            .orderBy(F.col("non_adherent_classes").desc(), "patient_key").limit(20))
