"""Cleaning projections (built-in expressions only, ANSI-safe).

Every helper returns a DataFrame transformed with ``withColumns`` so the
whole chain stays one projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def clean_names(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B1: trim + title case."""
    return df.withColumns({c: F.initcap(F.trim(F.col(c))) for c in _present(df, cols)})


def map_category(df: DataFrame, col: str, mapping: Mapping[str, Iterable[str]],
                 default: str | None = "Unknown") -> DataFrame:
    """B2: fold case-insensitive variants onto a label (M/MALE -> Male)."""
    norm = F.upper(F.trim(F.col(col)))
    out: Column = F.lit(default)
    for label, variants in reversed(list(mapping.items())):
        out = F.when(norm.isin([v.upper() for v in variants]), F.lit(label)).otherwise(out)
    return df.withColumn(col, out)


GENDER_MAP = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}


def clean_codes(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim + upper (state, ICD, POA flags)."""
    return df.withColumns({c: F.upper(F.trim(F.col(c))) for c in _present(df, cols)})


def digits_only(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Strip everything but digits (zip, phone, NPI)."""
    return df.withColumns({c: F.regexp_replace(F.col(c), r"[^0-9]", "") for c in _present(df, cols)})


def clean_email(df: DataFrame, col: str) -> DataFrame:
    """Lower + trim."""
    return df.withColumn(col, F.lower(F.trim(F.col(col))))


def parse_dates(df: DataFrame, cols: Iterable[str], fmt: str = "yyyy-MM-dd") -> DataFrame:
    """String -> date; malformed values become null instead of failing."""
    return df.withColumns({c: F.try_to_date(F.trim(F.col(c)), fmt)
                           for c in _present(df, cols)})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Null-on-error casts (decimal(18,2) money, int counts)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def status_flag(df: DataFrame, col: str, value: str, out: str, as_int: bool = True) -> DataFrame:
    """Flag from a status column, case-insensitive."""
    hit = F.lower(F.trim(F.col(col))) == value.lower()
    return df.withColumn(out, F.when(hit, 1).otherwise(0) if as_int else F.coalesce(hit, F.lit(False)))


def length_of_stay(df: DataFrame, start: str, end: str, source: str = "length_of_stay") -> DataFrame:
    """Day difference when both dates exist, else the source value."""
    diff = F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), F.datediff(F.col(end), F.col(start)))
    return df.withColumn(source, F.coalesce(diff, F.col(source).try_cast("int")))


def rename_roles(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Role renames (admit -> encounter date, submit -> claim date ...)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def optional_filter(df: DataFrame, col: str, values: Iterable[str] | None) -> DataFrame:
    """Empty selection keeps everything; otherwise case-insensitive IN."""
    vals = [v.lower() for v in (values or [])]
    if not vals:
        return df
    return df.filter(F.lower(F.col(col)).isin(vals))


def ensure_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """C11: add missing optional columns as typed nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def display_name(first: str, last: str, prefix: str = "") -> Column:
    """Null-safe 'Dr. first last'."""
    body = F.concat_ws(" ", F.col(first), F.col(last))
    return F.concat(F.lit(prefix), body) if prefix else body


def require_columns(df: DataFrame, cols: Iterable[str], table: str = "input") -> DataFrame:
    """Fail early, naming every missing column (schema only, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{table} is missing required columns: {missing}")
    return df
