"""Driver tables -> raw healthcare source tables.

The driver ships TPC-H-shaped parquet. These functions give each table the
role it plays in a payer/provider lakehouse, producing frames shaped like the
raw CSV feeds (string ids and dates, double amounts, some noise) so the
cleaning layer has real work to do. Every mapping is a projection or a join
that Spark runs over the whole table; nothing is sampled.

Role map
  customer -> patients          supplier -> providers
  region   -> payers (5)        nation   -> facilities and SDOH zips (25)
  part     -> medications, ICD  orders   -> encounters
  lineitem -> claims, prescriptions, diagnoses
  events   -> claim/ADT/Rx event feed
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import vocab
from carelake.functions.exprs import hash_bucket
from carelake.sources.tables import Tables


def _id(prefix: str, key, width: int) -> Column:
    """Prefix and key, zero-padded to ``width`` and never shortened."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _dstr(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _money(c: Column) -> Column:
    """Exact 2-dp money as the double a CSV feed would carry."""
    return c.cast("decimal(18,2)")


#: What an encounter's key and a line's (claim, prescription, diagnosis) are made of.
ENCOUNTER_PARTS, LINE_PARTS = ("_order",), ("_order", "_line")


def _parts(names: tuple[str, ...], *cols: str) -> list[Column]:
    return [F.col(c).alias(n) for n, c in zip(names, cols, strict=True)]


def patient_id(col: str) -> Column:
    return _id("PAT", col, 6)


def provider_id(col: str) -> Column:
    return _id("PRV", col, 5)


def encounter_id(col: str) -> Column:
    return _id("ENC", col, 8)


def icd_code(col: str) -> Column:
    return _id("ICD", col, 5)


def ndc_code(col: str) -> Column:
    return _id("NDC", col, 6)


def raw_patients(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    fn = _pick(vocab.FIRST_NAMES, k % 8)
    dob = F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 25000).cast("int"))
    return c.select(
        patient_id("c_custkey").alias("patient_id"),
        F.when(k % 3 == 0, F.concat(F.lit("  "), fn, F.lit(" ")))
         .when(k % 3 == 1, F.upper(fn)).otherwise(fn).alias("first_name"),
        _pick(vocab.LAST_NAMES, F.floor(k / 8) % 16).alias("last_name"),
        F.when(F.col("c_acctbal") < -900, F.lit("not-a-date"))
         .otherwise(_dstr(dob)).alias("date_of_birth"),
        _pick(["F", "M", "female", " MALE ", "u"], k % 5).alias("gender"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(k % 2 == 0, F.concat(F.lit(" st"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
         .otherwise(F.concat(F.lit("ST"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
         .alias("state"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip_code"),
        F.concat(F.lit("(555) 01"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-"),
                 F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone"),
        F.concat(F.lit(" "), fn, F.lit("."), k.cast("string"), F.lit("@Example.COM")).alias("email"),
        F.col("c_mktsegment").alias("insurance_type"),
        F.concat(F.lit("PAY"), (k % 5).cast("string")).alias("payer_id"),
        F.col("c_acctbal").alias("account_balance"),
    )


def raw_providers(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    k = F.col("s_suppkey")
    return s.select(
        provider_id("s_suppkey").alias("provider_id"),
        _pick(vocab.FIRST_NAMES, (k + 3) % 8).alias("first_name"),
        _pick(vocab.LAST_NAMES, k % 16).alias("last_name"),
        _id("1", k, 9).alias("npi"),
        _pick(vocab.SPECIALTIES, F.col("s_nationkey") % 5).alias("specialty"),
        _pick(vocab.DEPARTMENTS, F.col("s_nationkey") % 3).alias("department"),
        _id("FAC", "s_nationkey", 3).alias("facility_id"),
        F.when(F.col("s_acctbal") < 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
    )


def raw_payers(t: Tables) -> DataFrame:
    r = t.region.select("r_regionkey")
    k = F.col("r_regionkey")
    return r.select(
        F.concat(F.lit("PAY"), k.cast("string")).alias("payer_id"),
        _pick(vocab.PAYER_NAMES, k).alias("payer_name"),
        _pick(vocab.PAYER_TYPES, k).alias("payer_type"),
        (F.lit(0.70) + k * F.lit(0.05)).alias("avg_reimbursement_pct"),
    )


def raw_facilities(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    return n.select(
        _id("FAC", "n_nationkey", 3).alias("facility_id"),
        F.concat(F.lit("Facility "), F.col("n_name")).alias("facility_name"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip_code"),
        F.col("n_regionkey").alias("region_key"),
        (F.lit(40.0) + F.col("n_nationkey") * 0.1).alias("latitude"),
        (F.lit(-75.0) - F.col("n_nationkey") * 0.1).alias("longitude"),
    )


def raw_sdoh(t: Tables) -> DataFrame:
    """One row per zip (nation). Rates are exact 2-dp decimals."""
    n = t.nation.select("n_nationkey")
    k = F.col("n_nationkey")

    def rate(base: int, mult: int, mod: int) -> Column:
        return ((F.lit(base) + (k * mult) % mod) / 100).cast("decimal(4,2)")

    return n.select(
        F.lpad(k.cast("string"), 5, "0").alias("zip_code"),
        (F.lit(30000) + k * 2500).cast("int").alias("median_household_income"),
        rate(5, 7, 45).alias("poverty_rate"),
        rate(2, 3, 10).alias("unemployment_rate"),
        rate(3, 11, 25).alias("uninsured_rate"),
        rate(5, 13, 30).alias("food_insecurity_rate"),
        rate(2, 17, 18).alias("no_vehicle_pct"),
    )


def survey_sdoh(t: Tables) -> DataFrame:
    """The other SDOH layout, one row per zip: gold column names, no state for every
    third zip."""
    k = F.col("n_nationkey")

    def rate(base: int, mult: int, mod: int) -> Column:
        return ((F.lit(base) + (k * mult) % mod) / 100).cast("decimal(4,2)")
    return t.nation.select(
        F.concat(F.lit("48"), F.lpad(k.cast("string"), 3, "0")).alias("zip_code"), F.when(k % 3 != 0, F.lit("OH")).alias("state"),
        rate(5, 7, 26).alias("poverty_rate"), (k % 4 == 0).cast("int").alias("food_desert_flag"),
        rate(30, 11, 61).alias("transportation_score"), rate(3, 5, 23).alias("housing_instability_rate"),
        rate(4, 3, 17).alias("uninsured_rate"), rate(50, 13, 49).alias("broadband_access_pct"),
        (F.lit(28000) + k * 2500).cast("int").alias("median_household_income"), (F.lit(1000) + k * 3000).cast("int").alias("population"))


def raw_locations(t: Tables) -> DataFrame:
    """Units in which devices stand: one per supplier."""
    k = F.col("s_suppkey")
    return t.supplier.select(_id("LOC", "s_suppkey", 4).alias("location_id"),
                             F.concat(F.lit("Unit "), k.cast("string")).alias("unit_name"),
                             (F.floor(k / 10) + 1).cast("int").alias("floor_number"))


def raw_monitors(t: Tables) -> DataFrame:
    """Devices: one per part; some stand in locations or facilities nobody knows."""
    return t.part.select(
        _id("MON", "p_partkey", 6).alias("device_id"), F.col("p_type").alias("device_type"), F.col("p_brand").alias("device_model"),
        _id("LOC", F.col("p_size") * 3, 4).alias("location_id"), _id("FAC", "p_size", 3).alias("facility_id"),
        (F.col("p_size") > 2).alias("is_active"))


def raw_medications(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        ndc_code("p_partkey").alias("medication_code"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit(" MG"))
         .alias("medication_name"),
        F.col("p_brand").alias("drug_class"),
        F.col("p_type").alias("therapeutic_area"),
        (F.col("p_size") % 2).cast("int").alias("is_chronic"),
        F.col("p_retailprice").alias("unit_price"),
    )


def raw_icd(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", "p_type", "p_size")
    return p.select(
        icd_code("p_partkey").alias("icd_code"),
        F.col("p_name").alias("icd_description"),
        F.col("p_type").alias("icd_category"),
        (F.col("p_size") % 2).cast("int").alias("is_chronic"),
        _pick(vocab.STANDARD_ICD, F.col("p_partkey") % len(vocab.STANDARD_ICD)).alias("standard_code"),
    )


def order_lines(t: Tables) -> DataFrame:
    """Every line with its order's patient and date, dealt by order: what claims,
    prescriptions and diagnoses are made of. ``Star`` keeps it, so that lines are
    dealt once for all of them."""
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                          "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                          "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # lines are dealt by order for what follows: merging moves only the orders, broadcast to no one
    return l.repartition("l_orderkey").join(o.hint("merge"), l.l_orderkey == o.o_orderkey, "left").drop("o_orderkey")


def order_lines_summary(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Per order: attending provider and primary diagnosis (lowest keys).

    A partial aggregate per input split runs before the shuffle, so only
    one row per order per split crosses the network; ``lines`` that are
    dealt by order are reduced where they are.
    """
    return ((t.lineitem if lines is None else lines).select("l_orderkey", "l_suppkey", "l_partkey")
            .groupBy("l_orderkey")
            .agg(F.min("l_suppkey").alias("min_supp"), F.min("l_partkey").alias("min_part")))


def raw_encounters(t: Tables, parts: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """With ``parts`` also the columns its key is made of (ENCOUNTER_PARTS); ``lines``
    as kept, if they are."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    lines = order_lines_summary(t, lines)
    k = F.col("o_orderkey")
    los = (k % 10).cast("int")
    prio = F.col("o_orderpriority")
    etype = F.lit("Telehealth")
    for p, name in reversed(list(vocab.ENCOUNTER_TYPE_BY_PRIORITY.items())):
        etype = F.when(prio == p, F.lit(name)).otherwise(etype)
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(
                encounter_id("o_orderkey").alias("encounter_id"),
                patient_id("o_custkey").alias("patient_id"),
                F.when(F.col("min_supp").isNotNull(), provider_id("min_supp")).alias("provider_id"),
                etype.alias("encounter_type"),
                _dstr(F.col("o_orderdate")).alias("admit_date"),
                _dstr(F.date_add(F.col("o_orderdate").cast("date"), los)).alias("discharge_date"),
                F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("int")).otherwise(los)
                 .alias("length_of_stay"),
                F.when(F.col("min_part").isNotNull(), icd_code("min_part")).alias("primary_diagnosis_code"),
                _id("FAC", k % 25, 3).alias("facility_id"),
                F.when(F.col("o_orderstatus") == "F", F.lit("Elective"))
                 .when(F.col("o_orderstatus") == "O", F.lit("Urgent")).alias("admission_type"),
                _pick(vocab.DISCHARGE_DISPOSITIONS, k % 5).alias("discharge_disposition"),
                F.col("o_totalprice").alias("total_charges"),
                F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
                 .otherwise(((k * 37) % 100).cast("double") / 100).alias("readmission_risk"),
                *(_parts(ENCOUNTER_PARTS, "o_orderkey") if parts else ()),
            ))


def raw_claims(t: Tables, parts: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """With ``parts`` also the columns its key is made of (LINE_PARTS); from ``lines``
    (``order_lines``) as kept, if they are."""
    price = _money(F.col("l_extendedprice"))
    net = F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
    denied = F.col("l_returnflag") == "R"
    pending = F.col("l_linestatus") == "O"
    return ((order_lines(t) if lines is None else lines)
            .select(
                F.concat(F.lit("CLM"), F.col("l_orderkey").cast("string"), F.lit("-"),
                         F.col("l_linenumber").cast("string")).alias("claim_id"),
                encounter_id("l_orderkey").alias("encounter_id"),
                patient_id("o_custkey").alias("patient_id"),
                provider_id("l_suppkey").alias("provider_id"),
                F.concat(F.lit("PAY"), (F.col("o_custkey") % 5).cast("string")).alias("payer_id"),
                F.when(F.col("l_tax") >= 0.05, F.lit("Institutional")).otherwise(F.lit("Professional"))
                 .alias("claim_type"),
                F.concat(F.lit("9921"), (F.col("l_partkey") % 5 + 1).cast("string")).alias("cpt_code"),
                icd_code("l_partkey").alias("primary_diagnosis_code"),
                _dstr(F.col("o_orderdate")).alias("service_date"),
                _dstr(F.col("l_shipdate")).alias("submit_date"),
                F.when(pending, F.lit(None).cast("string"))
                 .otherwise(_dstr(F.date_add(F.col("l_shipdate").cast("date"), 14))).alias("process_date"),
                F.col("l_extendedprice").alias("billed_amount"),
                F.when(pending, F.lit(None).cast("double")).otherwise(net.cast("double")).alias("allowed_amount"),
                F.when(denied, F.lit(0.0)).when(pending, F.lit(None).cast("double"))
                 .otherwise(F.round(net * F.lit(0.9).cast("decimal(2,1)"), 2).cast("double")).alias("paid_amount"),
                F.when(denied, F.lit("Denied")).when(pending, F.lit("Pending")).otherwise(F.lit("Paid"))
                 .alias("claim_status"),
                F.when(denied & (F.col("l_quantity") <= 10),
                       _pick(vocab.RAW_DENIAL_LABELS, F.col("l_partkey") % 6)).alias("denial_reason"),
                F.col("l_quantity").alias("_quantity"),
                *(_parts(LINE_PARTS, "l_orderkey", "l_linenumber") if parts else ()),
            ))


def raw_denial_predictions(t: Tables, parts: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Optional predictions for about a third of the claims: risk, reason (one label
    no vocabulary knows) and next step. With ``parts`` also ENCOUNTER_PARTS; ``lines``
    as kept, if they are."""
    claim = F.concat(F.lit("CLM"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    names = ENCOUNTER_PARTS if parts else ()
    p = (t.lineitem if lines is None else lines).select(claim.alias("claim_id"), *(_parts(names, "l_orderkey") if parts else ())).distinct().where(
        hash_bucket("claim_id", 3, "|ml") == 0)
    return p.select(
        *names, "claim_id", (hash_bucket("claim_id", 100, "|risk") / 100).alias("denial_risk_score"),
        _pick([*vocab.DENIAL_REASONS, "Eligibility Lapsed"], hash_bucket("claim_id", 8, "|why")).alias("primary_denial_reason"),
        F.concat(F.lit("Send to desk "), hash_bucket("claim_id", 4, "|desk").cast("string")).alias("recommended_action"))


def raw_prescriptions(t: Tables, parts: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """With ``parts`` also the columns its key is made of (LINE_PARTS); from ``lines``
    (``order_lines``) as kept, if they are."""
    cost = F.round(_money(F.col("l_extendedprice")) * F.lit(0.01).cast("decimal(3,2)"), 2)
    copay = F.round(cost * F.col("l_tax").cast("decimal(4,2)"), 2)
    return ((order_lines(t) if lines is None else lines)
            .select(
                F.concat(F.lit("RX"), F.col("l_orderkey").cast("string"), F.lit("-"),
                         F.col("l_linenumber").cast("string")).alias("prescription_id"),
                encounter_id("l_orderkey").alias("encounter_id"),
                patient_id("o_custkey").alias("patient_id"),
                provider_id("l_suppkey").alias("provider_id"),
                ndc_code("l_partkey").alias("medication_code"),
                _dstr(F.col("l_shipdate")).alias("fill_date"),
                F.col("l_quantity").cast("int").alias("days_supply"),
                (F.col("l_quantity") * 2).cast("int").alias("quantity"),
                (F.col("l_linenumber") - 1).cast("int").alias("refill_number"),
                cost.cast("double").alias("total_cost"),
                copay.cast("double").alias("copay_amount"),
                (F.col("l_discount") < 0.05).alias("is_generic"),
                F.concat(F.lit("PAY"), (F.col("o_custkey") % 5).cast("string")).alias("payer_id"),
                *(_parts(LINE_PARTS, "l_orderkey", "l_linenumber") if parts else ()),
            ))


def raw_diagnoses(t: Tables, parts: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """With ``parts`` also the columns its key is made of (LINE_PARTS); from ``lines``
    (``order_lines``) as kept, if they are."""
    return ((order_lines(t) if lines is None else lines)
            .select(
                F.concat(F.lit("DX"), F.col("l_orderkey").cast("string"), F.lit("-"),
                         F.col("l_linenumber").cast("string")).alias("diagnosis_id"),
                encounter_id("l_orderkey").alias("encounter_id"),
                patient_id("o_custkey").alias("patient_id"),
                icd_code("l_partkey").alias("icd_code"),
                F.when(F.col("l_linenumber") == 1, F.lit("Primary")).otherwise(F.lit("Secondary"))
                 .alias("diagnosis_type"),
                F.col("l_linenumber").cast("int").alias("sequence_number"),
                _dstr(F.col("o_orderdate")).alias("diagnosis_date"),
                _pick(["Y", "n", "U "], F.col("l_partkey") % 3).alias("present_on_admission"),
                *(_parts(LINE_PARTS, "l_orderkey", "l_linenumber") if parts else ()),
            ))


PROPS_SCHEMA = "k INT"

# driver event_type -> landing-table discriminator
EVENT_ROUTES = {"purchase": "claims_events", "click": "claims_events",
                "view": "adt_events", "signup": "adt_events", "error": "rx_events"}


#: The driver's events cover a month; their days are put so many days apart, the
#: time of day kept, so 30- and 90-day frames see growing and falling spend.
DAYS_APART, FEED_START = 24, "2024-01-01"


def spread_days(ts: str) -> Column:
    day = F.datediff(F.col(ts), F.lit(FEED_START).cast("date"))
    return (F.col(ts) + F.make_dt_interval(day * (DAYS_APART - 1))).cast("timestamp_ntz")


def landing_events(t: Tables) -> DataFrame:
    """The landing feed: one row per event, discriminator ``_table`` plus the
    union of all typed fields (nulls where a field does not apply).

    user_id plays the patient (and, for claims, the provider); the JSON
    ``props`` payload is parsed with an explicit schema (A11).
    """
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.from_json("props", PROPS_SCHEMA).getField("k")
    route = F.lit("unknown_events")  # set aside, not mixed into a typed feed
    for src, dst in reversed(list(EVENT_ROUTES.items())):
        route = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(route)
    lat = F.lit(40.0) + (k % 20) * 0.1
    lon = F.lit(-75.0) - (k % 20) * 0.1
    return e.select(
        "event_id", spread_days("ts").alias("event_timestamp"), route.alias("_table"),
        patient_id("user_id").alias("patient_id"), provider_id("user_id").alias("provider_id"),
        _id("FAC", F.col("user_id") % 25, 3).alias("facility_id"),
        (F.col("value").cast("decimal(18,2)") * 1000).cast("decimal(18,2)").alias("claim_amount"),
        F.concat(F.lit("9921"), (k % 5 + 1).cast("string")).alias("procedure_code"),
        _id("ICD", k, 5).alias("diagnosis_code"),
        _pick(["ADMIT", "DISCHARGE", "OBSERVATION", "TRANSFER"], k % 4).alias("adt_event_type"),
        _pick(["EMERGENCY", "URGENT", "ELECTIVE"], k % 3).alias("admission_type"),
        _id("NDC", k, 6).alias("medication_code"),
        (k % 90 + 1).cast("int").alias("quantity"),
        F.lit(30).alias("days_supply"),
        lat.alias("latitude"), lon.alias("longitude"),
    )


def claims_events(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("_table") == "claims_events").select(
        "event_id", "event_timestamp", F.concat(F.lit("EC"), F.col("event_id").cast("string")).alias("claim_id"),
        "patient_id", "provider_id", "facility_id", "claim_amount", "procedure_code", "diagnosis_code",
        "latitude", "longitude")


def adt_events(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("_table") == "adt_events").select(
        "event_id", "event_timestamp", F.col("adt_event_type").alias("event_type"), "patient_id",
        "facility_id", "admission_type", "latitude", "longitude")


def rx_events(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("_table") == "rx_events").select(
        "event_id", "event_timestamp", "patient_id", "provider_id", "medication_code", "quantity",
        "days_supply", "latitude", "longitude")
