"""Benchmark: build the gold star once, then run the headline queries.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query time is the median of 3 warm runs (result fully computed with a
no-op write so every row and column is produced). ``star_build`` is the
one-off cost of materialising silver/gold snapshots from the raw tables.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carelake.plans.registry import load_all  # noqa: E402
from carelake.plans.star import Star  # noqa: E402
from carelake.session import get_session  # noqa: E402

HEADLINE = [
    "i01_denial_rate_by_payer", "f02_denial_by_date_type", "f03_denial_by_payer_reason",
    "f01_readmission_by_date_type", "i40_followup_within_7_days", "f04_medication_adherence",
    "f04b_pdc_exact", "f04c_pdc_excluding_inpatient", "d10_scd2_apply", "d16_upsert_claims",
    "k01_fraud_scores", "k12_highcost_trajectory", "k07_care_gap_alerts", "l13_unified_worklist",
    "m06_claim_encounter_patient_path", "j12_provider_scorecard", "g02_fk_coverage",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus, extra={"spark.driver.memory": "16g"})
    reg = load_all()
    out = {}
    t = time.time()
    s = Star(spark, sf_dir)
    for name in ["dim_date", "dim_patient", "dim_provider", "dim_payer", "dim_facility", "dim_sdoh",
                 "dim_medication", "dim_diagnosis", "fact_encounter", "fact_claim", "fact_prescription",
                 "fact_diagnosis"]:
        getattr(s, name)()
    out["star_build"] = round(time.time() - t, 3)
    for name in HEADLINE:
        if name not in reg:
            continue
        fn, _ = reg[name]
        runs = []
        for _ in range(3):
            t = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        out[name] = round(statistics.median(runs), 3)
    queries_total = round(sum(v for k, v in out.items() if k != "star_build"), 3)
    total = round(queries_total + out["star_build"], 3)
    print(json.dumps({"metric": "star_build_plus_headline_queries_sec", "value": total, "unit": "sec",
                      "headline_queries_sec": queries_total,
                      "queries": out, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "star_build_sec": out["star_build"]}))


if __name__ == "__main__":
    main()
