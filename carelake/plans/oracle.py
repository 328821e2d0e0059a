"""Independent DuckDB SQL for the correctness gate.

The same bindings and layers as ``sources/bindings.py`` and ``plans/star.py``
written once as plain SQL common table expressions over the driver views.
``sql(body)`` prepends exactly the CTEs the body (transitively) references,
in dependency order, so every oracle query is one self-contained statement.
"""

from __future__ import annotations

import re

from carelake.functions import vocab

AS_OF = "2002-01-01"
DATE_START = "1995-01-01"


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values, idx: str) -> str:
    return f"{lst(values)}[CAST({idx} AS INTEGER) + 1]"


def ident(prefix: str, expr: str, width: int) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"('{prefix}' || repeat('0', greatest(0, {width} - length({text}))) || {text})"


def initcap(expr: str) -> str:
    return ("array_to_string(list_transform(string_split(lower(" + expr + "), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def rnd(expr: str, digits: int = 4) -> str:
    """Round a double through a 10-dp decimal (matches metrics.rnd)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def dstr(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def todate(expr: str) -> str:
    return f"CAST(try_strptime(trim({expr}), '%Y-%m-%d') AS DATE)"


def hb(key: str, n: int, salt: str = "") -> str:
    k = f"CAST({key} AS VARCHAR)" + (f" || '{salt}'" if salt else "")
    return f"CAST((('0x' || substr(md5({k}), 1, 8))::BIGINT % {n}) AS INTEGER)"


def dkey(expr: str) -> str:
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) AS INTEGER)"


def case_map(expr: str, mapping: dict, default: str | None = None, passthrough: bool = False) -> str:
    parts = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = expr if passthrough else ("NULL" if default is None else f"'{default}'")
    return f"CASE {parts} ELSE {tail} END"


FN = pick(vocab.FIRST_NAMES, "c_custkey % 8")
ETYPE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in vocab.ENCOUNTER_TYPE_BY_PRIORITY.items()) + " ELSE 'Telehealth' END"
ACUTE = "('inpatient', 'emergency')"

CTES: dict[str, str] = {}

CTES["raw_patients"] = f"""
SELECT {ident('PAT', 'c_custkey', 6)} AS patient_id,
  CASE c_custkey % 3 WHEN 0 THEN '  ' || {FN} || ' ' WHEN 1 THEN upper({FN}) ELSE {FN} END AS first_name,
  {pick(vocab.LAST_NAMES, 'floor(c_custkey / 8) % 16')} AS last_name,
  CASE WHEN c_acctbal < -900 THEN 'not-a-date'
       ELSE {dstr("DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER)")} END AS date_of_birth,
  {pick(['F', 'M', 'female', ' MALE ', 'u'], 'c_custkey % 5')} AS gender,
  'City ' || CAST(c_nationkey AS VARCHAR) AS city,
  CASE WHEN c_custkey % 2 = 0 THEN ' st' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
       ELSE 'ST' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS state,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code,
  '(555) 01' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
  ' ' || {FN} || '.' || CAST(c_custkey AS VARCHAR) || '@Example.COM' AS email,
  c_mktsegment AS insurance_type,
  'PAY' || CAST(c_custkey % 5 AS VARCHAR) AS payer_id,
  c_acctbal AS account_balance
FROM customer"""

CTES["silver_patients"] = f"""
SELECT patient_id, {initcap('trim(first_name)')} AS first_name, {initcap('trim(last_name)')} AS last_name,
  {todate('date_of_birth')} AS date_of_birth,
  CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'Male'
       WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS gender,
  {initcap('trim(city)')} AS city, upper(trim(state)) AS state,
  regexp_replace(zip_code, '[^0-9]', '', 'g') AS zip_code, regexp_replace(phone, '[^0-9]', '', 'g') AS phone,
  lower(trim(email)) AS email, insurance_type, payer_id, account_balance
FROM raw_patients"""

CTES["dim_patient"] = f"""
SELECT *, CASE WHEN age IS NULL THEN NULL WHEN age < 18 THEN '0-17' WHEN age < 40 THEN '18-39'
               WHEN age < 65 THEN '40-64' ELSE '65+' END AS age_group
FROM (
  SELECT *, concat_ws(' ', first_name, last_name) AS full_name,
    CAST(floor(datediff('day', date_of_birth, DATE '{AS_OF}') / 365.25::DOUBLE) AS INTEGER) AS age,
    row_number() OVER (ORDER BY patient_id) AS patient_key,
    1 AS is_current, DATE '{DATE_START}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date
  FROM silver_patients)"""

CTES["silver_providers"] = f"""
SELECT {ident('PRV', 's_suppkey', 5)} AS provider_id,
  {initcap(pick(vocab.FIRST_NAMES, '(s_suppkey + 3) % 8'))} AS first_name,
  {initcap(pick(vocab.LAST_NAMES, 's_suppkey % 16'))} AS last_name,
  '1' || repeat('0', greatest(0, 9 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) AS npi,
  {pick(vocab.SPECIALTIES, 's_nationkey % 5')} AS specialty,
  {pick(vocab.DEPARTMENTS, 's_nationkey % 3')} AS department,
  {ident('FAC', 's_nationkey', 3)} AS facility_id,
  CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status,
  CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END AS is_active
FROM supplier"""

CTES["dim_provider"] = f"""
SELECT *, 'Dr. ' || concat_ws(' ', first_name, last_name) AS provider_name,
  row_number() OVER (ORDER BY provider_id) AS provider_key,
  1 AS is_current, DATE '{DATE_START}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date
FROM silver_providers"""

CTES["payers_ref"] = f"""
SELECT 'PAY' || CAST(r_regionkey AS VARCHAR) AS payer_id,
  {pick(vocab.PAYER_NAMES, 'r_regionkey')} AS payer_name,
  {pick(vocab.PAYER_TYPES, 'r_regionkey')} AS payer_type
FROM region"""

CTES["dim_payer"] = """
SELECT s.payer_id, coalesce(r.payer_name, s.payer_id) AS payer_name,
  coalesce(r.payer_type, 'Other') AS payer_type,
  row_number() OVER (ORDER BY s.payer_id) AS payer_key
FROM (SELECT DISTINCT payer_id FROM silver_claims WHERE payer_id IS NOT NULL) s
LEFT JOIN payers_ref r ON s.payer_id = r.payer_id"""

CTES["dim_facility"] = f"""
SELECT {ident('FAC', 'n_nationkey', 3)} AS facility_id, 'Facility ' || n_name AS facility_name,
  lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code, n_regionkey AS region_key,
  40.0::DOUBLE + n_nationkey * 0.1::DOUBLE AS latitude, -75.0::DOUBLE - n_nationkey * 0.1::DOUBLE AS longitude,
  row_number() OVER (ORDER BY {ident('FAC', 'n_nationkey', 3)}) AS facility_key
FROM nation"""


def _rate(base, mult, mod):
    return f"CAST(({base} + (n_nationkey * {mult}) % {mod}) / 100 AS DECIMAL(4,2))"


CTES["sdoh_raw"] = f"""
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code,
  CAST(30000 + n_nationkey * 2500 AS INTEGER) AS median_household_income,
  {_rate(5, 7, 45)} AS poverty_rate, {_rate(2, 3, 10)} AS unemployment_rate,
  {_rate(3, 11, 25)} AS uninsured_rate, {_rate(5, 13, 30)} AS food_insecurity_rate,
  {_rate(2, 17, 18)} AS no_vehicle_pct
FROM nation"""

CTES["dim_sdoh"] = """
SELECT zip_code, CAST(poverty_rate AS DOUBLE) AS poverty_rate,
  CASE WHEN food_insecurity_rate > 0.15 THEN 1 ELSE 0 END AS food_desert_flag,
  1.0::DOUBLE - coalesce(CAST(no_vehicle_pct AS DOUBLE), 0.0::DOUBLE) AS transportation_score,
  CAST(uninsured_rate AS DOUBLE) AS uninsured_rate, CAST(unemployment_rate AS DOUBLE) AS unemployment_rate,
  median_household_income, svi AS social_vulnerability_index,
  CASE WHEN svi > 0.25 THEN 'High' WHEN svi > 0.15 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM (
  SELECT *, round(CAST(poverty_rate AS DOUBLE) * 0.25::DOUBLE + CAST(uninsured_rate AS DOUBLE) * 0.20::DOUBLE
    + CAST(food_insecurity_rate AS DOUBLE) * 0.20::DOUBLE + CAST(unemployment_rate AS DOUBLE) * 0.15::DOUBLE
    + CAST(no_vehicle_pct AS DOUBLE) * 0.10::DOUBLE
    + (1.0::DOUBLE - CAST(median_household_income AS DOUBLE) / 120000.0::DOUBLE) * 0.10::DOUBLE, 4) AS svi
  FROM sdoh_raw)"""

CTES["dim_medication"] = f"""
SELECT {ident('NDC', 'p_partkey', 6)} AS medication_code,
  p_name || ' ' || CAST(p_size AS VARCHAR) || ' MG' AS medication_name,
  p_brand AS drug_class, p_type AS therapeutic_area, CAST(p_size % 2 AS INTEGER) AS is_chronic,
  p_retailprice AS unit_price,
  row_number() OVER (ORDER BY {ident('NDC', 'p_partkey', 6)}) AS medication_key
FROM part"""

CTES["dim_location"] = f"""
SELECT {ident('LOC', 's_suppkey', 4)} AS location_id, 'Unit ' || CAST(s_suppkey AS VARCHAR) AS unit_name,
  row_number() OVER (ORDER BY {ident('LOC', 's_suppkey', 4)}) AS location_key FROM supplier"""

CTES["dim_monitor"] = f"""
SELECT m.*, f.facility_key, l.location_key, l.unit_name, row_number() OVER (ORDER BY device_id) AS monitor_key
FROM (SELECT {ident('MON', 'p_partkey', 6)} AS device_id, p_type AS device_type, p_brand AS device_model,
        {ident('LOC', 'p_size * 3', 4)} AS location_id, {ident('FAC', 'p_size', 3)} AS facility_id, p_size > 2 AS is_active FROM part) m
LEFT JOIN dim_facility f ON m.facility_id = f.facility_id LEFT JOIN dim_location l ON m.location_id = l.location_id"""

CTES["dim_diagnosis"] = f"""
SELECT {ident('ICD', 'p_partkey', 5)} AS icd_code, p_name AS icd_description, p_type AS icd_category,
  CAST(p_size % 2 AS INTEGER) AS is_chronic, {pick(vocab.STANDARD_ICD, 'p_partkey % 10')} AS standard_code,
  row_number() OVER (ORDER BY {ident('ICD', 'p_partkey', 5)}) AS diagnosis_key
FROM part"""

CTES["order_lines"] = """
SELECT l_orderkey, min(l_suppkey) AS min_supp, min(l_partkey) AS min_part FROM lineitem GROUP BY l_orderkey"""

CTES["raw_encounters"] = f"""
SELECT {ident('ENC', 'o_orderkey', 8)} AS encounter_id, {ident('PAT', 'o_custkey', 6)} AS patient_id,
  CASE WHEN min_supp IS NOT NULL THEN {ident('PRV', 'min_supp', 5)} END AS provider_id,
  {ETYPE} AS encounter_type,
  {dstr('o_orderdate')} AS admit_date,
  {dstr('CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER)')} AS discharge_date,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 10 AS INTEGER) END AS length_of_stay,
  CASE WHEN min_part IS NOT NULL THEN {ident('ICD', 'min_part', 5)} END AS primary_diagnosis_code,
  {ident('FAC', 'o_orderkey % 25', 3)} AS facility_id,
  CASE o_orderstatus WHEN 'F' THEN 'Elective' WHEN 'O' THEN 'Urgent' END AS admission_type,
  {pick(vocab.DISCHARGE_DISPOSITIONS, 'o_orderkey % 5')} AS discharge_disposition,
  o_totalprice AS total_charges,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST((o_orderkey * 37) % 100 AS DOUBLE) / 100 END AS readmission_risk
FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey"""

CTES["silver_encounters"] = f"""
SELECT encounter_id, patient_id, provider_id, encounter_type, ed AS encounter_date, dd AS discharge_date,
  coalesce(CASE WHEN ed IS NOT NULL AND dd IS NOT NULL THEN CAST(datediff('day', ed, dd) AS INTEGER) END,
           TRY_CAST(length_of_stay AS INTEGER)) AS length_of_stay,
  upper(trim(primary_diagnosis_code)) AS primary_diagnosis_code, facility_id, admission_type,
  discharge_disposition, TRY_CAST(total_charges AS DECIMAL(18,2)) AS total_charges,
  TRY_CAST(readmission_risk AS DOUBLE) AS readmission_risk
FROM (SELECT *, {todate('admit_date')} AS ed, {todate('discharge_date')} AS dd FROM raw_encounters)"""

CTES["fact_encounter"] = f"""
SELECT e.encounter_id, e.patient_id, e.provider_id, e.facility_id, p.patient_key, pr.provider_key, f.facility_key,
  e.encounter_date, e.discharge_date,
  {dkey('e.encounter_date')} AS encounter_date_key,
  {dkey('coalesce(e.discharge_date, e.encounter_date)')} AS discharge_date_key,
  coalesce(e.encounter_type, 'Outpatient') AS encounter_type,
  coalesce(e.admission_type, 'Elective') AS admission_type,
  coalesce(e.discharge_disposition, 'Home') AS discharge_disposition,
  coalesce(e.length_of_stay, 1) AS length_of_stay,
  CAST(coalesce(e.total_charges, CAST(0 AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_charges,
  CAST(round(coalesce(e.total_charges, CAST(0 AS DECIMAL(18,2))) * CAST(0.7 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS total_cost,
  CASE WHEN e.acute AND e.prev_type IN {ACUTE} AND datediff('day', e.prev_end, e.encounter_date) BETWEEN 0 AND 30
       THEN 1 ELSE 0 END AS readmission_flag,
  CASE WHEN e.acute AND datediff('day', e.last_acute_end, e.encounter_date) BETWEEN 0 AND 30
       THEN 1 ELSE 0 END AS readmit_any_acute,
  e.primary_diagnosis_code, e.risk AS readmission_risk_score,
  CASE WHEN e.risk >= 0.7 THEN 'High' WHEN e.risk >= 0.3 THEN 'Medium' ELSE 'Low' END AS readmission_risk_category,
  row_number() OVER (ORDER BY e.encounter_id) AS encounter_key
FROM (
  SELECT *,
    lag(coalesce(discharge_date, encounter_date)) OVER w AS prev_end,
    lag(lower(coalesce(encounter_type, ''))) OVER w AS prev_type,
    max(CASE WHEN acute THEN coalesce(discharge_date, encounter_date) END)
      OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_acute_end,
    coalesce(readmission_risk,
      CASE WHEN coalesce(length_of_stay, 1) >= 10 THEN 0.80
           WHEN coalesce(length_of_stay, 1) >= 5 AND lower(coalesce(encounter_type, '')) = 'inpatient' THEN 0.65
           WHEN lower(coalesce(encounter_type, '')) = 'emergency' THEN 0.55
           WHEN coalesce(length_of_stay, 1) >= 3 THEN 0.35 ELSE 0.15 END) AS risk
  FROM (SELECT *, lower(coalesce(encounter_type, '')) IN {ACUTE} AS acute FROM silver_encounters)
  WINDOW w AS (PARTITION BY patient_id ORDER BY encounter_date NULLS FIRST, encounter_id NULLS FIRST)
) e
LEFT JOIN dim_patient p ON e.patient_id = p.patient_id AND p.is_current = 1
LEFT JOIN dim_provider pr ON e.provider_id = pr.provider_id AND pr.is_current = 1
LEFT JOIN dim_facility f ON e.facility_id = f.facility_id"""

_NET = "round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)"
CTES["raw_claims"] = f"""
SELECT 'CLM' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
  {ident('ENC', 'l_orderkey', 8)} AS encounter_id, {ident('PAT', 'o_custkey', 6)} AS patient_id,
  {ident('PRV', 'l_suppkey', 5)} AS provider_id, 'PAY' || CAST(o_custkey % 5 AS VARCHAR) AS payer_id,
  CASE WHEN l_tax >= 0.05::DOUBLE THEN 'Institutional' ELSE 'Professional' END AS claim_type,
  '9921' || CAST(l_partkey % 5 + 1 AS VARCHAR) AS cpt_code,
  {ident('ICD', 'l_partkey', 5)} AS primary_diagnosis_code,
  {dstr('o_orderdate')} AS service_date, {dstr('l_shipdate')} AS submit_date,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE {dstr('CAST(l_shipdate AS DATE) + 14')} END AS process_date,
  l_extendedprice AS billed_amount,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST({_NET} AS DOUBLE) END AS allowed_amount,
  CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE WHEN l_linestatus = 'O' THEN NULL
       ELSE CAST(round({_NET} * CAST(0.9 AS DECIMAL(2,1)), 2) AS DOUBLE) END AS paid_amount,
  CASE WHEN l_returnflag = 'R' THEN 'Denied' WHEN l_linestatus = 'O' THEN 'Pending' ELSE 'Paid' END AS claim_status,
  CASE WHEN l_returnflag = 'R' AND l_quantity <= 10 THEN {pick(vocab.RAW_DENIAL_LABELS, 'l_partkey % 6')} END AS denial_reason
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""

CTES["silver_claims"] = f"""
SELECT * FROM (
  SELECT claim_id, encounter_id, patient_id, provider_id, payer_id, claim_type, cpt_code,
    upper(trim(primary_diagnosis_code)) AS primary_diagnosis_code,
    {todate('service_date')} AS service_date, {todate('submit_date')} AS claim_date,
    {todate('process_date')} AS payment_date,
    TRY_CAST(billed_amount AS DECIMAL(18,2)) AS billed_amount,
    TRY_CAST(allowed_amount AS DECIMAL(18,2)) AS allowed_amount,
    TRY_CAST(paid_amount AS DECIMAL(18,2)) AS paid_amount, claim_status, denial_reason
  FROM raw_claims)
QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_date DESC NULLS LAST,
  encounter_id DESC NULLS LAST, patient_id DESC NULLS LAST, provider_id DESC NULLS LAST,
  payer_id DESC NULLS LAST, claim_type DESC NULLS LAST, cpt_code DESC NULLS LAST,
  primary_diagnosis_code DESC NULLS LAST, service_date DESC NULLS LAST, payment_date DESC NULLS LAST,
  billed_amount DESC NULLS LAST, allowed_amount DESC NULLS LAST, paid_amount DESC NULLS LAST,
  claim_status DESC NULLS LAST, denial_reason DESC NULLS LAST) = 1"""

_PCT = ("(CASE WHEN lower(coalesce(payer_type, '')) = 'medicaid' THEN 15 "
        "WHEN contains(lower(coalesce(payer_name, '')), 'medicaid') THEN 15 "
        "WHEN lower(coalesce(payer_type, '')) = 'self-pay' THEN 12 "
        "WHEN lower(coalesce(payer_type, '')) = 'workers comp' THEN 11 "
        "WHEN contains(lower(coalesce(payer_name, '')), 'medicare') THEN 6 "
        "WHEN lower(coalesce(payer_type, '')) = 'government' THEN 8 ELSE 8 END + "
        "CASE WHEN CAST(billed_amount AS DOUBLE) > 50000 THEN 4 "
        "WHEN CAST(billed_amount AS DOUBLE) > 20000 THEN 2 ELSE 0 END)")

CTES["denial_predictions"] = f"""
SELECT DISTINCT claim_id, {hb('claim_id', 100, '|risk')} / 100.0::DOUBLE AS ml_risk,
  {lst([*vocab.DENIAL_REASONS, 'Eligibility Lapsed'])}[{hb('claim_id', 8, '|why')} + 1] AS ml_reason,
  'Send to desk ' || CAST({hb('claim_id', 4, '|desk')} AS VARCHAR) AS ml_action
FROM raw_claims WHERE {hb('claim_id', 3, '|ml')} = 0"""

CTES["claims_scored"] = f"""
SELECT *,
  CASE WHEN is_denied THEN 'Denied' ELSE coalesce(claim_status, 'Paid') END AS claim_status_f,
  CASE WHEN risk >= 0.6 THEN 'High' WHEN risk >= 0.3 THEN 'Medium' ELSE 'Low' END AS denial_risk_category,
  CASE WHEN reason IS NULL THEN NULL
       ELSE coalesce({case_map('reason', vocab.DENIAL_ACTIONS)}, ml_action, '{vocab.DEFAULT_DENIAL_ACTION}') END AS recommended_action
FROM (
  SELECT *, {case_map('reason_raw', vocab.DENIAL_REASON_SYNONYMS, passthrough=True)} AS reason
  FROM (
    SELECT *, CASE WHEN is_denied THEN coalesce(denial_reason, ml_reason,
                {lst(vocab.DENIAL_REASONS)}[{hb('claim_id', len(vocab.DENIAL_REASONS))} + 1]) END AS reason_raw,
      round(coalesce(ml_risk, least(greatest((pct * 2 + {hb('claim_id', 40, '|7')} - 20) / 100.0::DOUBLE, 0.02::DOUBLE),
        0.95::DOUBLE)), 4) AS risk
    FROM (
      SELECT *, CASE WHEN denied_share >= 0.02 THEN contains(lower(coalesce(claim_status, '')), 'denied')
                     ELSE {hb('claim_id', 100)} < pct END AS is_denied
      FROM (
        SELECT c.*, p.payer_key, p.payer_name, p.payer_type, s.denied_share, {_PCT} AS pct, m.ml_risk, m.ml_reason, m.ml_action
        FROM silver_claims c LEFT JOIN dim_payer p ON c.payer_id = p.payer_id
        LEFT JOIN denial_predictions m ON c.claim_id = m.claim_id
        CROSS JOIN (SELECT CASE WHEN count(*) > 0 THEN
                      count(*) FILTER (WHERE contains(lower(coalesce(claim_status, '')), 'denied')) / count(*)
                      ELSE 0.0 END AS denied_share FROM silver_claims) s))))"""

CTES["fact_claim"] = f"""
SELECT c.claim_id, c.encounter_id, c.patient_id, c.provider_id, c.payer_id,
  p.patient_key, pr.provider_key, c.payer_key, e.encounter_key, e.facility_key,
  c.service_date, c.claim_date, c.payment_date,
  {dkey('c.claim_date')} AS claim_date_key,
  {dkey('coalesce(c.payment_date, c.claim_date)')} AS payment_date_key,
  coalesce(c.claim_type, 'Professional') AS claim_type, c.cpt_code, c.primary_diagnosis_code,
  c.claim_status_f AS claim_status,
  coalesce(c.billed_amount, CAST(0 AS DECIMAL(18,2))) AS billed_amount,
  CAST(coalesce(c.allowed_amount, round(coalesce(c.billed_amount, CAST(0 AS DECIMAL(18,2))) * CAST(0.85 AS DECIMAL(3,2)), 2)) AS DECIMAL(18,2)) AS allowed_amount,
  CAST(CASE WHEN c.is_denied THEN CAST(0 AS DECIMAL(18,2))
       ELSE coalesce(c.paid_amount, round(coalesce(c.billed_amount, CAST(0 AS DECIMAL(18,2))) * CAST(0.80 AS DECIMAL(3,2)), 2)) END
       AS DECIMAL(18,2)) AS paid_amount,
  CASE WHEN c.is_denied THEN 1 ELSE 0 END AS denial_flag,
  c.risk AS denial_risk_score, c.denial_risk_category, c.reason AS primary_denial_reason,
  c.recommended_action, c.payer_name, c.payer_type
FROM claims_scored c
LEFT JOIN dim_patient p ON c.patient_id = p.patient_id AND p.is_current = 1
LEFT JOIN dim_provider pr ON c.provider_id = pr.provider_id AND pr.is_current = 1
LEFT JOIN fact_encounter e ON c.encounter_id = e.encounter_id"""

_COST = "round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)), 2)"
CTES["silver_prescriptions"] = f"""
SELECT * FROM (
  SELECT 'RX' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS prescription_id,
    {ident('ENC', 'l_orderkey', 8)} AS encounter_id, {ident('PAT', 'o_custkey', 6)} AS patient_id,
    {ident('PRV', 'l_suppkey', 5)} AS provider_id, {ident('NDC', 'l_partkey', 6)} AS medication_code,
    CAST(l_shipdate AS DATE) AS fill_date, CAST(l_quantity AS INTEGER) AS days_supply,
    CAST(l_quantity * 2 AS INTEGER) AS quantity, CAST(l_linenumber - 1 AS INTEGER) AS refill_number,
    CAST({_COST} AS DECIMAL(18,2)) AS total_cost,
    CAST(round({_COST} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS copay_amount,
    l_discount < 0.05::DOUBLE AS is_generic, 'PAY' || CAST(o_custkey % 5 AS VARCHAR) AS payer_id
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
QUALIFY row_number() OVER (PARTITION BY prescription_id ORDER BY fill_date DESC NULLS LAST,
  encounter_id DESC NULLS LAST, patient_id DESC NULLS LAST, provider_id DESC NULLS LAST,
  medication_code DESC NULLS LAST, days_supply DESC NULLS LAST, quantity DESC NULLS LAST,
  refill_number DESC NULLS LAST, total_cost DESC NULLS LAST, copay_amount DESC NULLS LAST,
  is_generic DESC NULLS LAST, payer_id DESC NULLS LAST) = 1"""

CTES["encounter_payer"] = """
SELECT encounter_id, payer_id FROM silver_claims WHERE encounter_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY claim_date DESC NULLS LAST, payer_id DESC NULLS LAST) = 1"""

CTES["fact_prescription"] = f"""
SELECT r.prescription_id, r.patient_id, r.provider_id, coalesce(b.payer_id, r.payer_id) AS payer_id, r.encounter_id, r.medication_code,
  p.patient_key, pr.provider_key, m.medication_key, e.encounter_key, py.payer_key,
  r.fill_date, {dkey('r.fill_date')} AS fill_date_key, r.days_supply, r.quantity, r.refill_number,
  r.total_cost, r.copay_amount AS patient_copay,
  CAST(r.total_cost - r.copay_amount AS DECIMAL(18,2)) AS payer_paid,
  CASE WHEN r.is_generic THEN 1 ELSE 0 END AS is_generic
FROM silver_prescriptions r
LEFT JOIN encounter_payer b ON r.encounter_id = b.encounter_id
JOIN dim_patient p ON r.patient_id = p.patient_id AND p.is_current = 1
JOIN dim_provider pr ON r.provider_id = pr.provider_id AND pr.is_current = 1
LEFT JOIN dim_medication m ON r.medication_code = m.medication_code
LEFT JOIN fact_encounter e ON r.encounter_id = e.encounter_id
LEFT JOIN dim_payer py ON coalesce(b.payer_id, r.payer_id) = py.payer_id"""

CTES["silver_diagnoses"] = f"""
SELECT * FROM (
  SELECT 'DX' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS diagnosis_id,
    {ident('ENC', 'l_orderkey', 8)} AS encounter_id, {ident('PAT', 'o_custkey', 6)} AS patient_id,
    {ident('ICD', 'l_partkey', 5)} AS icd_code,
    CASE WHEN l_linenumber = 1 THEN 'Primary' ELSE 'Secondary' END AS diagnosis_type,
    CAST(l_linenumber AS INTEGER) AS sequence_number, CAST(o_orderdate AS DATE) AS diagnosis_date,
    upper(trim({pick(['Y', 'n', 'U '], 'l_partkey % 3')})) AS present_on_admission
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
QUALIFY row_number() OVER (PARTITION BY diagnosis_id ORDER BY diagnosis_date DESC NULLS LAST,
  encounter_id DESC NULLS LAST, patient_id DESC NULLS LAST, icd_code DESC NULLS LAST,
  diagnosis_type DESC NULLS LAST, sequence_number DESC NULLS LAST, present_on_admission DESC NULLS LAST) = 1"""

CTES["fact_diagnosis"] = f"""
SELECT d.diagnosis_id, d.encounter_id, d.patient_id, d.icd_code, p.patient_key, x.diagnosis_key,
  e.encounter_key, d.diagnosis_date, {dkey('d.diagnosis_date')} AS diagnosis_date_key,
  d.sequence_number, d.diagnosis_type, d.present_on_admission, coalesce(x.is_chronic, 0) AS is_chronic,
  row_number() OVER (ORDER BY d.diagnosis_id) AS diagnosis_fact_key
FROM silver_diagnoses d
LEFT JOIN dim_patient p ON d.patient_id = p.patient_id AND p.is_current = 1
LEFT JOIN dim_diagnosis x ON d.icd_code = x.icd_code
LEFT JOIN fact_encounter e ON d.encounter_id = e.encounter_id"""


CTES["agg_adherence"] = f"""
SELECT row_number() OVER (ORDER BY patient_key, medication_key) AS adherence_key, patient_key, medication_key,
  drug_class, therapeutic_area, measurement_period_start, measurement_period_end, total_fills,
  total_days_supply, days_in_period, covered_days, pdc_score,
  CASE WHEN pdc_score >= 0.80 THEN 'Adherent' WHEN pdc_score >= 0.50 THEN 'Partially Adherent'
       ELSE 'Non-Adherent' END AS adherence_category,
  total_medication_cost, total_payer_cost, total_patient_cost,
  CASE WHEN days_in_period > covered_days THEN days_in_period - covered_days ELSE 0 END AS gap_days,
  1 AS is_chronic
FROM (
  SELECT *, least(CASE WHEN days_in_period > 0 THEN CAST(covered_days AS DOUBLE) / days_in_period ELSE 1.0 END,
                  1.0::DOUBLE) AS pdc_score
  FROM (
    SELECT *, least(total_days_supply, days_in_period) AS covered_days
    FROM (
      SELECT *, CASE WHEN span <= 0 THEN total_days_supply ELSE span END AS days_in_period
      FROM (
        SELECT fp.patient_key, fp.medication_key, m.drug_class, m.therapeutic_area,
          min(fp.fill_date_key) AS measurement_period_start, max(fp.fill_date_key) AS measurement_period_end,
          count(*) AS total_fills, CAST(sum(fp.days_supply) AS BIGINT) AS total_days_supply,
          datediff('day', min(fp.fill_date), max(fp.fill_date))
            + coalesce(CAST(trunc(avg(fp.days_supply)) AS INTEGER), 30) AS span,
          sum(fp.total_cost) AS total_medication_cost, sum(fp.payer_paid) AS total_payer_cost,
          sum(fp.patient_copay) AS total_patient_cost
        FROM fact_prescription fp JOIN dim_medication m ON fp.medication_key = m.medication_key
        WHERE fp.patient_key IS NOT NULL AND fp.medication_key IS NOT NULL AND m.is_chronic = 1
          AND fp.fill_date IS NOT NULL
        GROUP BY fp.patient_key, fp.medication_key, m.drug_class, m.therapeutic_area))))"""

CTES["chronic_fills"] = """
SELECT fp.patient_key, m.drug_class, fp.fill_date, fp.days_supply, CAST(year(fp.fill_date) AS INTEGER) AS year,
  fp.fill_date + (fp.days_supply - 1) AS fill_end
FROM fact_prescription fp JOIN dim_medication m ON fp.medication_key = m.medication_key
WHERE m.is_chronic = 1 AND fp.days_supply > 0"""

CTES["fill_islands"] = """
SELECT patient_key, drug_class, year, island, min(fill_date) AS island_start, max(fill_end) AS island_end
FROM (
  SELECT *, sum(new_island) OVER (PARTITION BY patient_key, drug_class, year ORDER BY fill_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM (
    SELECT *, CASE WHEN prev_end IS NULL OR fill_date > prev_end + 1 THEN 1 ELSE 0 END AS new_island
    FROM (
      SELECT *, max(fill_end) OVER (PARTITION BY patient_key, drug_class, year ORDER BY fill_date
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
      FROM (SELECT patient_key, drug_class, year, fill_date, max(fill_end) AS fill_end FROM chronic_fills
            GROUP BY 1, 2, 3, 4))))
GROUP BY 1, 2, 3, 4"""

CTES["pdc_period"] = """
SELECT patient_key, drug_class, year, min(fill_date) AS period_start, count(*) AS fills
FROM chronic_fills GROUP BY 1, 2, 3"""

CTES["pdc_exact"] = f"""
SELECT p.patient_key, p.drug_class, p.year, p.period_start, p.fills, c.covered_days,
  CAST(datediff('day', p.period_start, make_date(p.year, 12, 31)) + 1 AS INTEGER) AS period_days,
  {rnd('CAST(c.covered_days AS DOUBLE) / (datediff(' + "'day'" + ', p.period_start, make_date(p.year, 12, 31)) + 1)')} AS pdc
FROM pdc_period p JOIN (
  SELECT patient_key, drug_class, year,
    CAST(sum(datediff('day', island_start, least(island_end, make_date(year, 12, 31))) + 1) AS BIGINT) AS covered_days
  FROM fill_islands GROUP BY 1, 2, 3) c
  ON p.patient_key = c.patient_key AND p.drug_class = c.drug_class AND p.year = c.year"""

CTES["inpatient_days"] = """
SELECT DISTINCT patient_key, CAST(unnest(generate_series(encounter_date, discharge_date, INTERVAL 1 DAY)) AS DATE) AS day
FROM fact_encounter WHERE encounter_type = 'Inpatient' AND patient_key IS NOT NULL"""

CTES["pdc_excl_stays"] = f"""
SELECT d.patient_key, d.drug_class, d.year, d.period_days, d.period_days_excl,
  coalesce(c.covered_days, 0) AS covered_days, coalesce(c.covered_days_excl, 0) AS covered_days_excl,
  CASE WHEN d.period_days_excl = 0 THEN NULL
       ELSE {rnd('CAST(coalesce(c.covered_days_excl, 0) AS DOUBLE) / d.period_days_excl')} END AS pdc_excl
FROM (
  SELECT x.patient_key, x.drug_class, x.year, count(*) AS period_days,
    count(*) FILTER (WHERE i.day IS NULL) AS period_days_excl
  FROM (SELECT patient_key, drug_class, year,
          CAST(unnest(generate_series(period_start, make_date(year, 12, 31), INTERVAL 1 DAY)) AS DATE) AS day
        FROM pdc_period) x
  LEFT JOIN inpatient_days i ON x.patient_key = i.patient_key AND x.day = i.day
  GROUP BY 1, 2, 3) d
LEFT JOIN (
  SELECT x.patient_key, x.drug_class, x.year, count(*) AS covered_days,
    count(*) FILTER (WHERE i.day IS NULL) AS covered_days_excl
  FROM (SELECT patient_key, drug_class, year,
          CAST(unnest(generate_series(island_start, least(island_end, make_date(year, 12, 31)), INTERVAL 1 DAY)) AS DATE) AS day
        FROM fill_islands) x
  LEFT JOIN inpatient_days i ON x.patient_key = i.patient_key AND x.day = i.day
  GROUP BY 1, 2, 3) c
  ON d.patient_key = c.patient_key AND d.drug_class = c.drug_class AND d.year = c.year"""


CTES["dim_date"] = f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
  strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
  CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
  CAST(floor(((month(d) - 7 + 12) % 12) / 3) + 1 AS INTEGER) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(make_date(y1, 1, 1), make_date(y2 + 1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(least(o1, l1) AS INTEGER) AS y1, CAST(greatest(o2, l2) AS INTEGER) AS y2
    FROM (SELECT year(min(CAST(o_orderdate AS DATE))) AS o1, year(max(CAST(o_orderdate AS DATE))) AS o2 FROM orders),
         (SELECT year(min(CAST(l_shipdate AS DATE))) AS l1, year(max(CAST(l_shipdate AS DATE))) AS l2 FROM lineitem)))"""

_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
CTES["landing_events"] = f"""
SELECT event_id, ts + to_days(CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 23 AS INTEGER)) AS event_timestamp,
  CASE event_type WHEN 'purchase' THEN 'claims_events' WHEN 'click' THEN 'claims_events'
       WHEN 'view' THEN 'adt_events' WHEN 'signup' THEN 'adt_events' WHEN 'error' THEN 'rx_events'
       ELSE 'unknown_events' END AS _table,
  {ident('PAT', 'user_id', 6)} AS patient_id, {ident('PRV', 'user_id', 5)} AS provider_id,
  {ident('FAC', 'user_id % 25', 3)} AS facility_id,
  CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS DECIMAL(18,2)) AS claim_amount,
  '9921' || CAST({_K} % 5 + 1 AS VARCHAR) AS procedure_code, {ident('ICD', _K, 5)} AS diagnosis_code,
  {pick(['ADMIT', 'DISCHARGE', 'OBSERVATION', 'TRANSFER'], _K + ' % 4')} AS adt_event_type,
  {pick(['EMERGENCY', 'URGENT', 'ELECTIVE'], _K + ' % 3')} AS admission_type,
  {ident('NDC', _K, 6)} AS medication_code, CAST({_K} % 90 + 1 AS INTEGER) AS quantity, 30 AS days_supply,
  40.0::DOUBLE + ({_K} % 20) * 0.1::DOUBLE AS latitude, -75.0::DOUBLE - ({_K} % 20) * 0.1::DOUBLE AS longitude
FROM events"""

CTES["claims_events"] = """
SELECT event_id, event_timestamp, 'EC' || CAST(event_id AS VARCHAR) AS claim_id, patient_id, provider_id, facility_id,
  claim_amount, procedure_code, diagnosis_code, latitude, longitude
FROM landing_events WHERE _table = 'claims_events'"""

CTES["adt_events"] = """
SELECT event_id, event_timestamp, adt_event_type AS event_type, patient_id, facility_id, admission_type, latitude, longitude
FROM landing_events WHERE _table = 'adt_events'"""

CTES["rx_events"] = """
SELECT event_id, event_timestamp, patient_id, provider_id, medication_code, quantity, days_supply, latitude, longitude
FROM landing_events WHERE _table = 'rx_events'"""

_NAME_RE = {name: re.compile(r"\b" + name + r"\b") for name in CTES}


def _deps(text: str) -> list[str]:
    return [n for n, rx in _NAME_RE.items() if rx.search(text)]


_LITERAL = re.compile(r"'[^']*'")


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Prepend the CTEs ``body`` needs (transitively), dependencies first."""
    ctes = dict(CTES)
    ctes.update(extra or {})
    rx = {n: re.compile(r"\b" + n + r"\b") for n in ctes}
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        text = _LITERAL.sub("''", ctes[name])
        for d in [n for n in ctes if n != name and rx[n].search(text)]:
            if d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for n in [n for n in ctes if rx[n].search(_LITERAL.sub("''", body))]:
        visit(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in order) + "\n" + body.strip()
