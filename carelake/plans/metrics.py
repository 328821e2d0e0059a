"""Semantic-model measures (2-H) as column expressions.

A measure is an aggregate expression; ``measure_table`` evaluates any set
of them for any grouping over one fact, recomputing numerator and
denominator per group (rates are never averaged).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    """Sum of decimal money as a 2-dp double (exact decimal sum first)."""
    return F.round(c, 2).cast("double")


def rnd(c: Column, digits: int = 4) -> Column:
    """Round a double through a 10-dp decimal so decimal ties round the
    same way in every engine (half up on the decimal value)."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def rate(num: Column, den: Column, digits: int = 4) -> Column:
    return rnd(F.try_divide(num.cast("double"), den.cast("double")), digits)


# --- encounter measures -------------------------------------------------------
def total_encounters() -> Column:
    return F.count(F.lit(1))


def count_type(t: str) -> Column:
    return F.count_if(F.col("encounter_type") == t)


def readmissions() -> Column:
    return F.sum("readmission_flag").cast("long")


def readmission_rate() -> Column:
    return rate(F.sum("readmission_flag"), F.count(F.lit(1)))


def risk_count(level: str, col: str = "readmission_risk_category") -> Column:
    return F.count_if(F.col(col) == level)


def avg_of(col: str, digits: int = 4) -> Column:
    return rnd(F.avg(F.col(col).cast("double")), digits)


def total_of(col: str) -> Column:
    return money(F.sum(col))


# --- claim measures -------------------------------------------------------------
def denied_claims() -> Column:
    return F.sum("denial_flag").cast("long")


def denial_rate() -> Column:
    return rate(F.sum("denial_flag"), F.count(F.lit(1)))


def collection_rate() -> Column:
    return rate(F.sum("paid_amount"), F.sum("billed_amount"))


def at_risk_revenue() -> Column:
    hit = F.col("denial_risk_category").isin("High", "Medium")
    return F.coalesce(money(F.sum(F.when(hit, F.col("billed_amount")))), F.lit(0.0))


# --- prescription measures --------------------------------------------------------
def generic_fill_rate() -> Column:
    return rate(F.sum("is_generic"), F.count(F.lit(1)))


MEASURES = {
    "total_encounters": total_encounters,
    "inpatient_encounters": lambda: count_type("Inpatient"),
    "emergency_encounters": lambda: count_type("Emergency"),
    "readmissions": readmissions,
    "readmission_rate": readmission_rate,
    "high_risk_readmissions": lambda: risk_count("High"),
    "medium_risk_readmissions": lambda: risk_count("Medium"),
    "low_risk_readmissions": lambda: risk_count("Low"),
    "avg_length_of_stay": lambda: avg_of("length_of_stay"),
    "avg_readmission_risk": lambda: avg_of("readmission_risk_score"),
    "total_charges": lambda: total_of("total_charges"),
    "total_cost": lambda: total_of("total_cost"),
    "avg_cost_per_encounter": lambda: rnd(F.try_divide(F.sum("total_cost").cast("double"),
                                                       F.count(F.lit(1)).cast("double")), 2),
    "total_claims": lambda: F.count(F.lit(1)),
    "denied_claims": denied_claims,
    "denial_rate": denial_rate,
    "total_billed": lambda: total_of("billed_amount"),
    "total_paid": lambda: total_of("paid_amount"),
    "collection_rate": collection_rate,
    "at_risk_revenue": at_risk_revenue,
    "avg_denial_risk": lambda: avg_of("denial_risk_score"),
    "high_risk_denials": lambda: risk_count("High", "denial_risk_category"),
    "total_fills": lambda: F.count(F.lit(1)),
    "total_rx_cost": lambda: total_of("total_cost"),
    "avg_rx_cost_per_fill": lambda: rnd(F.try_divide(F.sum("total_cost").cast("double"),
                                                     F.count(F.lit(1)).cast("double")), 2),
    "generic_fill_rate": generic_fill_rate,
    "payer_rx_cost": lambda: total_of("payer_paid"),
    "patient_copay_total": lambda: total_of("patient_copay"),
}


def measure_table(fact: DataFrame, group_by: Iterable[str], measures: Iterable[str]) -> DataFrame:
    """J12 core: one aggregate over one fact for any grouping."""
    return fact.groupBy(*group_by).agg(*[MEASURES[m]().alias(m) for m in measures])
