"""Versioned tables: data folders made valid by one commit row each.

A version's rows go to a folder of their own; only then one commit row names it.
A reader follows the commits, so a version whose writer died is never seen, and
versions that a reader holds stay as they are. A table is the last replacement
plus the appends after it, schemas merged: a column added later is null before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from carelake.sources.io import first_available

COMMIT = "version long, kind string, path string"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The committed versions of a table; none if there is no table yet."""
    return first_available(spark, [lambda: spark.read.schema(COMMIT).parquet(f"{root}/_commits/*")], COMMIT)


def stage(df: DataFrame, root: str) -> str:
    """Write rows that no reader sees before ``commit`` names their folder."""
    path = f"{root}/data/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def commit(spark: SparkSession, root: str, path: str, kind: str = "replace") -> int:
    """Make a staged folder the next version. The version's commit folder must not
    exist, so of two writers that claim one version the second fails."""
    if kind not in ("replace", "append"):
        raise ValueError(f"unknown kind of version: {kind}")
    version = 1 + max((r.version for r in commits(spark, root).collect()), default=0)  # one row per version
    row = spark.createDataFrame([(version, kind, path)], COMMIT).coalesce(1)
    row.write.mode("errorifexists").parquet(f"{root}/_commits/v{version}")
    return version


def write_version(df: DataFrame, root: str, kind: str = "replace") -> int:
    return commit(df.sparkSession, root, stage(df, root), kind)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (the newest, if None)."""
    log = sorted(r for r in commits(spark, root).collect() if version is None or r.version <= version)
    if not log or (version is not None and log[-1].version != version):
        raise ValueError(f"{root} has no version {version if version is not None else 'yet'}")
    start = max((i for i, r in enumerate(log) if r.kind == "replace"), default=0)
    return spark.read.option("mergeSchema", True).parquet(*[r.path for r in log[start:]])


def write_alerts(df: DataFrame, snapshot_root: str, feed_path: str, feed_cols: Sequence[str]) -> int:
    """Alert snapshot (a new version) plus a JSON-lines feed of a projected
    subset. The feed is made from the version written, so the alerts are scored once
    and both agree; all is written by executors."""
    version = write_version(df, snapshot_root)
    read_version(df.sparkSession, snapshot_root, version).select(*feed_cols).write.mode("append").json(feed_path)
    return version
