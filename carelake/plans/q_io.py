"""Source and sink recipes (A1-A13) run end to end: data derived from the
driver tables is written to a fresh folder under the shared checkpoint
directory, read back through the operator under test, and summarised."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelake.plans.oracle import sql
from carelake.plans.q_scoring import FRAUD_SQL, fraud
from carelake.plans.registry import query
from carelake.plans.star import Star
from carelake.session import ensure_checkpoint_dir
from carelake.sources import bindings as B
from carelake.sources import io as IO
from carelake.sources import versions as V

PATIENT_SCHEMA = ("patient_id string, first_name string, last_name string, date_of_birth string, gender string, "
                  "city string, state string, zip_code string, phone string, email string, insurance_type string, "
                  "payer_id string, account_balance double")


def _dir(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/carelake-io/{uuid.uuid4().hex}"


@query("a01_csv_roundtrip_lineage", sql("""
SELECT insurance_type, count(*) AS patients, count(DISTINCT zip_code) AS zips FROM raw_patients GROUP BY 1"""))
def a01(spark, d):
    """A1/A3/A5: raw patients written as a headered CSV snapshot, read back
    with an explicit schema (zip codes keep their leading zeros) and
    lineage columns, then summarised."""
    root = _dir(spark)
    B.raw_patients(Star(spark, d).t).write.option("header", True).csv(f"{root}/patients_csv")
    df = IO.with_lineage(IO.read_csv_full(spark, f"{root}/patients_csv", PATIENT_SCHEMA), "patients_csv")
    return df.where(F.col("_source_file").isNotNull()).groupBy("insurance_type").agg(
        F.count(F.lit(1)).alias("patients"), F.countDistinct("zip_code").alias("zips"))


@query("a02_increment_files", sql("""
SELECT CASE WHEN admit_date < '1998-01-01' THEN 'flat' ELSE 'dated' END AS layout, count(*) AS encounters,
  count(*) FILTER (WHERE provider_id IS NULL) AS missing_provider
FROM raw_encounters GROUP BY 1"""))
def a02(spark, d):
    """A2/A4: increments in both layouts (flat ``t_*.csv`` and dated
    ``*/t_*.csv``) read in one scan and unioned by name."""
    root = _dir(spark)
    enc = B.raw_encounters(Star(spark, d).t)
    flat = enc.where(F.col("admit_date") < "1998-01-01")
    dated = enc.where(F.col("admit_date") >= "1998-01-01")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in enc.schema.fields)
    flat.write.option("header", True).csv(f"{root}/encounters_001.csv")
    dated.write.option("header", True).csv(f"{root}/2024-06-01/encounters_001.csv")
    both = IO.read_csv_increment(spark, root, "encounters", schema)
    base = both.where(F.col("admit_date") < "1998-01-01")
    incr = both.where(F.col("admit_date") >= "1998-01-01").drop("readmission_risk")
    u = IO.union_evolving(base, incr)
    layout = F.when(F.col("admit_date") < "1998-01-01", "flat").otherwise("dated")
    return u.groupBy(layout.alias("layout")).agg(F.count(F.lit(1)).alias("encounters"),
                                                 F.count_if(F.col("provider_id").isNull()).alias("missing_provider"))


@query("a05_versioned_table", sql("""
SELECT v AS version, count(*) AS patients, count(account_balance) AS with_balance, CAST(count(DISTINCT zip_code) AS BIGINT) AS zips
FROM (SELECT unnest([1, 2, 3]) AS v) x JOIN (
  SELECT 1 AS first, 2 AS last, patient_id, zip_code, NULL AS account_balance FROM raw_patients WHERE insurance_type = 'BUILDING'
  UNION ALL SELECT 2, 2, patient_id, zip_code, account_balance FROM raw_patients WHERE insurance_type <> 'BUILDING'
  UNION ALL SELECT 3, 3, patient_id, zip_code, account_balance FROM raw_patients) p ON v BETWEEN first AND last GROUP BY 1"""))
def a05(spark, d):
    """A table in three versions: a replacement, an append with a column the
    first did not have, a replacement; a fourth is written but not committed and is
    never read. Each version is read as it was."""
    root = _dir(spark)
    p = B.raw_patients(Star(spark, d).t)
    first = F.col("insurance_type") == "BUILDING"
    V.write_version(p.where(first).drop("account_balance"), root)
    V.write_version(p.where(~first), root, "append")
    V.write_version(p, root)
    V.stage(p.limit(1), root)
    newest = V.read_version(spark, root)
    parts = [(1, V.read_version(spark, root, 1)), (2, V.read_version(spark, root, 2)), (3, newest)]
    out = None
    for n, df in parts:
        df = IO.union_evolving(df.select(F.lit(n).alias("version"), "patient_id", "zip_code",
                                         *[c for c in df.columns if c == "account_balance"]),
                               spark.createDataFrame([], "account_balance double"))
        part = df.groupBy("version").agg(F.count(F.lit(1)).alias("patients"), F.count("account_balance").alias("with_balance"),
                                         F.countDistinct("zip_code").alias("zips"))
        out = part if out is None else out.unionByName(part)
    return out


@query("a07_file_ingestion", sql("""
SELECT CASE WHEN admit_date < '1998-01-01' THEN 1 ELSE 2 END AS run, count(*) AS encounters,
  count(DISTINCT encounter_id) AS distinct_encounters FROM raw_encounters GROUP BY 1"""))
def a07(spark, d):
    """Two deliveries of encounter files, taken in by two runs of one job; the
    second adds only the new files, the first's are archived."""
    root = _dir(spark)
    enc = B.raw_encounters(Star(spark, d).t)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in enc.schema.fields)
    early = F.col("admit_date") < "1998-01-01"
    for part in (enc.where(early), enc.where(~early)):
        part.write.mode("append").option("header", True).csv(f"{root}/landing")
        IO.ingest_new_files(spark, f"{root}/landing", schema, f"{root}/encounters", f"{root}/_ck", archive_dir=f"{root}/archive")
    run = F.when(early, 1).otherwise(2)
    return spark.read.parquet(f"{root}/encounters").groupBy(run.alias("run")).agg(
        F.count(F.lit(1)).alias("encounters"), F.countDistinct("encounter_id").alias("distinct_encounters"))


@query("a09_load_audit", sql("""
SELECT 'claims' AS table_name, 'OK' AS status, count(*) AS row_count, NULL AS error FROM raw_claims
UNION ALL SELECT 'patients', 'OK', count(*), NULL FROM raw_patients
UNION ALL SELECT 'referrals', 'FAILED', NULL, 'PATH_NOT_FOUND'
UNION ALL SELECT 'missing_table', 'MISSING', NULL, NULL"""))
def a09(spark, d):
    """Row counts observed during the write (no second pass), a load that
    fails, a manifest check for a required table that is absent; one audit row each."""
    root = _dir(spark)
    t = Star(spark, d).t

    def load(name, source):
        def run() -> int:
            observed, obs = IO.load_audit(source(), name)
            observed.write.mode("append").parquet(f"{root}/{name}")
            return obs.get["row_count"]
        return IO.audited(spark, name, run)
    rows = [load("claims", lambda: B.raw_claims(t)), load("patients", lambda: B.raw_patients(t)),
            load("referrals", lambda: spark.read.parquet(f"{root}/no_delivery"))]
    expected = IO.reference_rows(spark, [("claims",), ("patients",), ("missing_table",)], "table string")
    found = IO.list_files(spark, f"{root}/*/*.parquet").select(
        F.element_at(F.split("path", "/"), -2).alias("table"))
    missing = IO.manifest_check(expected, found).select(
        F.col("table").alias("table_name"), F.lit("MISSING").alias("status"),
        F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("string").alias("error"))
    for r in rows:
        missing = missing.unionByName(r.select("table_name", "status", "row_count", "error"))
    return missing


@query("a10_first_available", sql("""
SELECT 'file' AS source, count(*) AS row_count FROM raw_sdoh_zips UNION ALL SELECT 'none', 0""",
       {"raw_sdoh_zips": "SELECT zip_code FROM sdoh_raw"}))
def a10(spark, d):
    """A10: a table that does not exist, then a file that does; and where neither
    does, a typed empty frame."""
    root = _dir(spark)
    B.raw_sdoh(Star(spark, d).t).select("zip_code").write.option("header", True).csv(f"{root}/zips")
    held = IO.first_available(spark, ["no_such_table", lambda: IO.read_csv_full(spark, f"{root}/gone", "zip_code string"),
                                      lambda: IO.read_csv_full(spark, f"{root}/zips", "zip_code string")], "zip_code string")
    empty = IO.first_available(spark, ["no_such_table"], "zip_code string")

    def counted(df, name):
        return df.agg(F.count("zip_code").alias("row_count")).select(F.lit(name).alias("source"), "row_count")
    return counted(held, "file").unionByName(counted(empty, "none"))


@query("a11_parse_event_payloads", sql("""
SELECT event_type, count(*) AS events, count(*) FILTER (WHERE k IS NULL) AS corrupt, CAST(sum(k) AS BIGINT) AS sum_k
FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1"""))
def a11(spark, d):
    """JSON payloads parsed with an explicit schema; undecodable rows
    are kept aside in a corrupt-record column."""
    e = Star(spark, d).t.events.select("event_type", "props")
    p = IO.parse_events(e, "props", "k int")
    return p.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                       F.count_if(F.col("_corrupt").isNotNull() | F.col("k").isNull()).alias("corrupt"),
                                       F.sum("k").cast("long").alias("sum_k"))


@query("a13_alert_sinks", sql("""
SELECT risk_tier, count(*) AS alerts FROM fraud_tiered WHERE risk_tier <> 'LOW' GROUP BY 1""", FRAUD_SQL))
def a13(spark, d):
    """Fraud alerts written as a parquet snapshot plus a JSON-lines
    feed of a projected subset, by executors; the feed is read back."""
    root = _dir(spark)
    alerts = fraud(Star(spark, d)).where(F.col("risk_tier") != "LOW")
    V.write_alerts(alerts.drop("fraud_flag_list"), f"{root}/fraud_scores", f"{root}/fraud_feed",
                    ["claim_id", "provider_id", "fraud_score", "risk_tier"])
    return spark.read.json(f"{root}/fraud_feed").groupBy("risk_tier").agg(F.count(F.lit(1)).alias("alerts"))
