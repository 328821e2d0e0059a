"""Scalar expression helpers: dates, ratios, buckets, tiers, distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(col) -> Column:
    """Yyyymmdd integer key of a date/timestamp."""
    c = _c(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def years_since(col, as_of) -> Column:
    """Whole years as floor(days / 365.25) to an as-of date parameter."""
    return F.floor(F.datediff(F.lit(as_of).cast("date"), _c(col)) / 365.25).cast("int")


def days_open(col, as_of) -> Column:
    """Age in days to an as-of date."""
    return F.datediff(F.lit(as_of).cast("date"), _c(col))


def bucketize(col, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Value < edges[i] -> labels[i]; beyond the last edge -> labels[-1]."""
    c = _c(col)
    out: Column = F.lit(labels[-1])
    for e, lab in reversed(list(zip(edges, labels))):
        out = F.when(c < e, F.lit(lab)).otherwise(out)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(out)


AGE_EDGES = (18, 40, 65)
AGE_LABELS = ("0-17", "18-39", "40-64", "65+")


def rnd(c, digits: int = 4) -> Column:
    """Round a double through a 10-dp decimal so decimal ties round half up
    identically in every engine."""
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num, den, digits: int | None = 4, default=0.0) -> Column:
    """Num / den rounded, ``default`` when den <= 0 or null."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    r = F.when(d > 0, n / d).otherwise(F.lit(default))
    return rnd(r, digits) if digits is not None else r


def hash_bucket(key, n: int, salt: str = "") -> Column:
    """Deterministic bucket in [0, n) from the first 32 bits of md5.

    md5 exists in every SQL engine, so the bucket is checkable; pmod keeps
    it non-negative under ANSI arithmetic.
    """
    k = _c(key).cast("string")
    if salt:
        k = F.concat(k, F.lit(salt))
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def clamp(col, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]."""
    return F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi))


def risk_tier(col, cuts: tuple[float, float]) -> Column:
    """E5: >= high -> High, >= medium -> Medium, else Low."""
    c = _c(col)
    return (F.when(c >= cuts[0], F.lit("High")).when(c >= cuts[1], F.lit("Medium"))
            .otherwise(F.lit("Low")))


def euclid_degrees(lat1, lon1, lat2, lon2) -> Column:
    """K3: Euclidean distance in degrees (what the fraud rule measures)."""
    return F.sqrt(F.pow(_c(lat1) - _c(lat2), 2) + F.pow(_c(lon1) - _c(lon2), 2))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km."""
    la1, la2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dla = la2 - la1
    dlo = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dla / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlo / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(a))


def map_values(col, mapping: dict, default=None, passthrough: bool = False) -> Column:
    """Literal lookup (E13/E14 style) compiled to a CASE chain."""
    c = _c(col)
    out: Column = c if passthrough else F.lit(default)
    for k, v in reversed(list(mapping.items())):
        out = F.when(c == F.lit(k), F.lit(v)).otherwise(out)
    return out
