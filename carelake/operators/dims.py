"""Dimension builders (D1, D12-D15) and SCD type 2 without MERGE.

SCD2 is expressed as snapshot arithmetic: the next version of a dimension
is a union of (kept rows, expired rows, inserted rows) computed from one
input snapshot, written beside the old one. Nothing is updated in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.cleaning import ensure_columns
from carelake.functions.exprs import date_key
from carelake.operators.keys import assign_stable_keys, dense_keys
from carelake.session import materialise


def date_dimension(spark: SparkSession, start: str, end: str, fiscal_start_month: int = 7) -> DataFrame:
    """D1 over a given range of days."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return calendar(span, fiscal_start_month)


def data_span(dates: DataFrame) -> DataFrame:
    """(start, end), one row: the years of the one date column of ``dates`` and
    the year after, in which what began at their end is paid or closed. No
    row without a date."""
    d = F.col(dates.columns[0]).cast("date")
    return (dates.agg(F.trunc(F.min(d), "year").alias("start"),
                      F.date_sub(F.add_months(F.trunc(F.max(d), "year"), 24), 1).alias("end"))
            .where(F.col("start").isNotNull()))


def calendar(span: DataFrame, fiscal_start_month: int = 7) -> DataFrame:
    """One row per day of ``span`` (start, end) with calendar and fiscal
    attributes. ``sequence`` + ``explode`` generates the days on executors."""
    days = span.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    m = F.month(d)
    fs = fiscal_start_month
    fiscal_month0 = F.pmod(m - fs, F.lit(12))  # 0 = first fiscal month
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        m.alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        F.when(m >= fs, F.year(d) + 1).otherwise(F.year(d)).alias("fiscal_year")
        if fs > 1 else F.year(d).alias("fiscal_year"),
        (F.floor(fiscal_month0 / 3) + 1).cast("int").alias("fiscal_quarter"),
    )


# FIXED VALUES: keyword in a payer's name -> type; Commercial without any.
PAYER_KEYWORDS = [("medicare", "Medicare"), ("medicaid", "Medicaid"), ("self", "Self-Pay"), ("cash", "Self-Pay")]


def classify_payer(name: Column) -> Column:
    """D12 helper: payer class from keywords in the name."""
    low = F.lower(F.coalesce(name, F.lit("")))
    out: Column = F.lit("Commercial")
    for kw, cls in reversed(PAYER_KEYWORDS):
        out = F.when(low.contains(kw), F.lit(cls)).otherwise(out)
    return out


def derive_payers(claims: DataFrame, payers_ref: DataFrame | None) -> DataFrame:
    """Distinct payers seen on claims; reference attributes when known,
    else a class derived from the name."""
    seen = claims.select("payer_id").where(F.col("payer_id").isNotNull()).distinct()
    if payers_ref is None:
        j = seen.withColumn("payer_name", F.col("payer_id")).withColumn("payer_type", F.lit(None).cast("string"))
    else:
        j = seen.join(payers_ref, "payer_id", "left")
    j = j.withColumn("payer_name", F.coalesce(F.col("payer_name"), F.col("payer_id")))
    return j.withColumn("payer_type", F.coalesce(F.col("payer_type"), classify_payer(F.col("payer_name"))))


def weighted_index(weights: dict[str, float], income_col: str | None = None,
                   income_ref: float = 120000.0, income_weight: float = 0.10) -> Column:
    """Weighted sum of rates (plus an inverse-income term)."""
    terms = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w) for c, w in weights.items()]
    if income_col:
        terms.append((F.lit(1.0) - F.col(income_col).cast("double") / income_ref) * F.lit(income_weight))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.round(total, 4)


# D14 generator weights (fixed values).
SVI_WEIGHTS = {"poverty_rate": 0.25, "uninsured_rate": 0.20, "food_insecurity_rate": 0.20,
               "unemployment_rate": 0.15, "no_vehicle_pct": 0.10}


# FIXED VALUES: weights of the survey layout's index (transport and broadband count inverted).
SURVEY_WEIGHTS = {"poverty_rate": 0.25, "food_desert_flag": 0.15, "_no_transport": 0.20, "housing_instability_rate": 0.15,
                  "uninsured_rate": 0.15, "_no_broadband": 0.10}


def survey_index(df: DataFrame) -> DataFrame:
    """D14 for the survey layout: index and tier (.30 / .15, inclusive)."""
    d = df.withColumns({"_no_transport": 1 - F.col("transportation_score"), "_no_broadband": 1 - F.col("broadband_access_pct")})
    d = d.withColumn("social_vulnerability_index", weighted_index(SURVEY_WEIGHTS))
    return d.withColumn("risk_tier", svi_tier(F.col("social_vulnerability_index"), 0.30, 0.15, inclusive=True)).drop(
        "_no_transport", "_no_broadband")


def svi_tier(col: Column, high: float = 0.25, medium: float = 0.15, inclusive: bool = False) -> Column:
    """D14 tier: generator cuts are strict (> .25 / > .15), the fallback
    layout uses >= .30 / >= .15."""
    if inclusive:
        return F.when(col >= high, "High").when(col >= medium, "Medium").otherwise("Low")
    return F.when(col > high, "High").when(col > medium, "Medium").otherwise("Low")


#: Gold SDOH schema: column, type.
SDOH_SCHEMA = {
    "zip_code": "string", "state": "string", "poverty_rate": "double", "food_desert_flag": "int", "transportation_score": "double",
    "housing_instability_rate": "double", "uninsured_rate": "double", "broadband_access_pct": "double",
    "unemployment_rate": "double", "median_household_income": "int", "population": "int",
    "social_vulnerability_index": "double", "risk_tier": "string"}
HOME_STATE = "MI"  # FIXED VALUE


def harmonise_sdoh(df: DataFrame) -> DataFrame:
    """Either source layout -> gold SDOH schema. The survey layout has the gold
    columns; the generated one has rates that the food-desert flag and the transport
    score are derived from. Columns a layout lacks are null, a missing state is the
    home state."""
    if "food_desert_flag" not in df.columns:
        df = df.withColumns({
            "food_desert_flag": F.when(F.col("food_insecurity_rate") > 0.15, 1).otherwise(0),
            "transportation_score": F.lit(1.0) - F.coalesce(F.col("no_vehicle_pct").cast("double"), F.lit(0.0))})
    df = ensure_columns(df, SDOH_SCHEMA)
    return df.select(*[(F.coalesce(c, F.lit(HOME_STATE)) if c == "state" else F.col(c)).cast(t).alias(c)
                       for c, t in SDOH_SCHEMA.items()])


# --- SCD type 2 ---------------------------------------------------------------

SCD_COLS = ["is_current", "effective_start_date", "effective_end_date"]


def scd2_initial(src: DataFrame, bk: str, sk: str, as_of: str) -> DataFrame:
    """First version of every key, open-ended."""
    keyed = dense_keys(src, bk, sk)
    return keyed.withColumns({
        "is_current": F.lit(1),
        "effective_start_date": F.lit(as_of).cast("date"),
        "effective_end_date": F.lit(None).cast("date"),
    })


def _tracked_differs(tracked: Sequence[str], a: str = "s", b: str = "d") -> Column:
    cond = F.lit(False)
    for c in tracked:
        cond = cond | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def scd2_changes(src: DataFrame, dim: DataFrame, bk: str, tracked: Sequence[str]) -> DataFrame:
    """Source rows whose tracked attributes differ from the current
    version (null equals null)."""
    cur = dim.where(F.col("is_current") == 1)
    return (src.alias("s").join(cur.alias("d"), F.col(f"s.{bk}") == F.col(f"d.{bk}"), "inner")
            .where(_tracked_differs(tracked)).select("s.*"))


def scd2_new(src: DataFrame, dim: DataFrame, bk: str) -> DataFrame:
    """Business keys with no version at all."""
    return src.join(dim.select(bk).distinct(), bk, "left_anti")


def scd2_expire(dim: DataFrame, changed_keys: DataFrame, bk: str, as_of: str) -> DataFrame:
    """Close current versions of changed keys (snapshot rewrite)."""
    flag = changed_keys.select(bk).distinct().withColumn("_chg", F.lit(1))
    j = dim.join(flag, bk, "left")
    hit = (F.col("_chg") == 1) & (F.col("is_current") == 1)
    return j.withColumns({
        "is_current": F.when(hit, F.lit(0)).otherwise(F.col("is_current")),
        "effective_end_date": F.when(hit, F.lit(as_of).cast("date")).otherwise(F.col("effective_end_date")),
    }).drop("_chg")


def scd2_apply(dim: DataFrame, src: DataFrame, bk: str, sk: str, tracked: Sequence[str],
               as_of: str) -> DataFrame:
    """Next snapshot = expired/kept old rows + new versions with fresh
    surrogate keys (max + position).

    One full outer join of the dimension with the source classes every row: a
    current version whose tracked attributes differ is expired and its source row
    inserted, a source row without any version is inserted, all else is kept. The
    classed rows are written once; only the inserts are numbered."""
    attrs = [c for c in src.columns if c != bk]
    old = dim.select(F.col(bk).alias("_bk"), F.struct(*dim.columns).alias("_old"))
    new = src.select(F.col(bk).alias("_sbk"), F.struct(*src.columns).alias("_new"))
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
    changed = (F.col("_old.is_current") == 1) & F.col("_new").isNotNull() & differs
    classed = (old.join(new, F.col("_bk") == F.col("_sbk"), "full_outer")
               .withColumn("_class", F.when(F.col("_old").isNull(), "new").when(changed, "changed").otherwise("kept")))
    classed = materialise(classed.select("_class", "_old", F.when(F.col("_class") != "kept", F.col("_new")).alias("_new")),
                          "scd2-classed")
    gone = F.col("_class") == "changed"
    versions = classed.where("_class <> 'new'").select(
        *[F.col(f"_old.{c}").alias(c) for c in dim.columns if c not in ("is_current", "effective_end_date")],
        F.when(gone, F.lit(0)).otherwise(F.col("_old.is_current")).alias("is_current"),
        F.when(gone, F.lit(as_of).cast("date")).otherwise(F.col("_old.effective_end_date")).alias("effective_end_date"))
    hw = classed.agg(F.coalesce(F.max(f"_old.{sk}"), F.lit(0)).cast("long").alias("_hw"))
    inserts = classed.where("_class <> 'kept'").select(*[F.col(f"_new.{c}").alias(c) for c in [bk, *attrs]])
    numbered = dense_keys(inserts.crossJoin(F.broadcast(hw)), bk, sk, start_col=F.col("_hw") + 1).drop("_hw")  # one row
    numbered = numbered.withColumns({
        "is_current": F.lit(1),
        "effective_start_date": F.lit(as_of).cast("date"),
        "effective_end_date": F.lit(None).cast("date"),
    })
    return versions.select(*dim.columns).unionByName(numbered.select(*dim.columns))


def current_rows(dim: DataFrame) -> DataFrame:
    """Current versions only."""
    return dim.where(F.col("is_current") == 1)


def version_counts(dim: DataFrame, bk: str) -> DataFrame:
    """One-row summary of current and historical rows."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_current") == 1).alias("current_rows"),
        F.count_if(F.col("is_current") == 0).alias("historical_rows"),
        F.countDistinct(bk).alias("distinct_keys"),
    )


def upsert(target: DataFrame, src: DataFrame, key: str, sk: str | None = None) -> DataFrame:
    """Update matched rows, insert new ones, keep surrogate keys.

    Full outer join on the business key; the source row wins where present.
    New rows get max(sk) + position when a surrogate key column is given.
    Idempotent: applying the same source twice gives the same snapshot.
    """
    cols = [c for c in target.columns if c != sk]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(1).alias("_in_t"))
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(1).alias("_in_s"))
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    merged = j.select(
        *[F.when(F.col("_in_s") == 1, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols],
        *([F.col(f"t_{sk}").alias(sk)] if sk else []),
    )
    if not sk:
        return merged
    merged = materialise(merged, "upsert-merged")  # the join runs once for both halves
    have = merged.where(F.col(sk).isNotNull())
    fresh = merged.where(F.col(sk).isNull()).drop(sk)
    hw = merged.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("_hw"))
    numbered = dense_keys(fresh.crossJoin(F.broadcast(hw)), key, sk, start_col=F.col("_hw") + 1).drop("_hw")
    return have.unionByName(numbered.select(*have.columns))


__all__ = [
    "date_dimension", "data_span", "calendar", "derive_payers", "classify_payer", "weighted_index", "svi_tier",
    "harmonise_sdoh", "scd2_initial", "scd2_changes", "scd2_new", "scd2_expire", "scd2_apply",
    "current_rows", "version_counts", "upsert", "assign_stable_keys", "SVI_WEIGHTS",
]
