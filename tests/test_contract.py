import pytest

from carelake.plans.compare import compare, duckdb_conn

SF = "/root/testdata/sf0.001"
SAMPLE = ["i01_denial_rate_by_payer", "f01_readmission_by_date_type", "f04_medication_adherence",
          "f04c_pdc_excluding_inpatient", "d10_scd2_apply", "d16_upsert_claims", "k01_fraud_scores",
          "k12_highcost_trajectory", "m06_claim_encounter_patient_path", "l13_unified_worklist",
          "i40_followup_within_7_days", "j12_provider_scorecard", "g02_fk_coverage"]


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 1 and "denial_rate" in df.columns
    q, o = e.queries(), e.oracle_sql()
    assert len(q) >= 100 and set(o) <= set(q)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as e
    con = duckdb_conn(SF)
    r = compare(e.queries()[name](spark, SF), e.oracle_sql()[name], con)
    assert r["ok"], r


def test_metric_table_filters_each_fact(spark):
    from carelake.plans.q_reports import metric_table
    from carelake.plans.star import Star
    s = Star(spark, SF)
    df = metric_table(s, "specialty", s.dim_provider(), "provider_key",
                      {"fact_claim": ["total_claims"], "fact_encounter": ["total_encounters"]},
                      {"claim_type": ["institutional"]})  # case-insensitive; encounters have no such column
    got = df.collect()
    assert sum(r.total_claims or 0 for r in got) == s.fact_claim().where("claim_type = 'Institutional'").count()
    assert sum(r.total_encounters or 0 for r in got) == s.fact_encounter().where("provider_key IS NOT NULL").count()
