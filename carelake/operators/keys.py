"""Deduplication and surrogate keys.

``latest_per_key`` is an aggregate (``max`` of a struct) rather than a
``row_number`` window: the partial aggregate runs map-side, so a business
key holding a third of all rows is reduced inside each input split before
the shuffle instead of being sorted in one task.

``dense_keys`` numbers rows 1..n in business-key order without the
single-partition window the naive form needs: range-partition on the key,
sort within partitions, materialise once, count rows per partition (a frame
with one row per partition), turn the counts into offsets, and add each
row's position inside its partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import ensure_checkpoint_dir, materialise


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys, order, made_of: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one with the greatest ``order`` columns.

    Ties on ``order`` are broken by every remaining column, so the result is
    deterministic; exact duplicates collapse to one row. Nulls in ``order``
    sort lowest (newest-first, nulls last).

    ``made_of``: columns the key is made of, one to one, null where one of them is
    (left out of the result). Rows that a join has dealt by some of them are
    reduced where they are, so the wide rows are not shuffled a second time.
    """
    keys, order = _as_list(keys), _as_list(order)
    if made_of:
        (key,) = keys
        cols = [c for c in df.columns if c not in made_of]
        rest = [c for c in cols if c != key and c not in order]
        packed = F.max(F.struct(*order, *rest, key)).alias("_latest")
        whole = reduce(and_, [F.col(c).isNotNull() for c in made_of])
        known = df.where(whole).groupBy(*made_of).agg(packed).select(*[F.col(f"_latest.{c}") for c in cols])
        return known.unionByName(latest_per_key(df.where(~whole).select(*cols), key, order))
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_latest")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*[F.col(c) for c in keys], *[F.col(f"_latest.{c}").alias(c) for c in order + rest]) \
        .select(*df.columns)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their count."""
    keys = _as_list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dense_keys(df: DataFrame, bk, key_col: str, start: int | None = 1,
               num_partitions: int | None = None, start_col=None) -> DataFrame:
    """D3: ``key_col`` = start, start+1, ... in ascending ``bk`` order.

    ``bk`` should be unique (run ``latest_per_key`` first); equal keys get
    distinct numbers in an arbitrary but fixed order. ``start_col`` may be a
    column of a one-row frame already joined in (used by stable keys).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    bks = _as_list(bk)
    order = [F.col(c).asc_nulls_last() for c in bks]
    # Without an explicit count AQE sizes the range partitions from the data
    # (coalescing small ones); ids and positions are taken after that.
    parted = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = (parted
              .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in bks])
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    # One materialisation so the counting pass and the numbering pass see
    # the same partition ids and positions (range bounds come from
    # sampling; AQE could otherwise coalesce the two passes differently).
    # Both are stored as columns, so the read-back layout does not matter.
    ranged = materialise(ranged, "dense-keys")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")), "dense-offsets")
    base = F.lit(start if start is not None else 1) if start_col is None else start_col
    # offsets has one row per partition: bounded by the partition count.
    out = ranged.join(F.broadcast(offsets), "_pid")
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.withColumn(key_col, (F.col("_off") + local + base).cast("long")).drop("_pid", "_pos", "_off")


def high_water(df: DataFrame, col: str, pattern: str | None = None) -> DataFrame:
    """One-row frame with the max key, or the max number inside string ids."""
    c = F.col(col)
    if pattern:
        c = F.regexp_extract(c, pattern, 1).try_cast("bigint")
    return df.agg(F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias("high_water"))


def assign_stable_keys(src: DataFrame, dim: DataFrame, sk: str, bk) -> DataFrame:
    """Keep keys already assigned in ``dim``; new business keys get
    max(sk) + 1, + 2, ... in business-key order.

    The maximum is a one-row aggregate joined in (no driver round trip). Of
    several versions of a business key the newest (greatest key) counts, so
    a source row comes back once.
    """
    bks = _as_list(bk)
    known = dim.groupBy(*bks).agg(F.max(sk).alias(sk))
    matched = src.join(known, bks, "inner")
    new = src.join(known, bks, "left_anti")
    hw = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("_hw"))
    new = new.crossJoin(F.broadcast(hw))  # one row by construction
    numbered = dense_keys(new, bks, sk, start_col=F.col("_hw") + 1).drop("_hw")
    return matched.unionByName(numbered.select(*matched.columns))


def lag_by_key(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
               prefix: str = "prev_") -> DataFrame:
    """The previous row's ``cols`` within ``key`` in ``order`` (a ``lag``).

    Skew-proof form: rows are numbered globally in (key, order) with the
    range-partitioned ``dense_keys`` and joined to row n-1 on that unique
    number, so a key holding a third of all rows is still spread over every
    range partition. Nulls in ``order`` sort last.
    """
    g = dense_keys(df, [key, *order], "_g")
    prev = g.select(F.col(key).alias("_pk"), (F.col("_g") + 1).alias("_gp"),
                    *[F.col(c).alias(prefix + c) for c in cols])
    j = g.join(prev, (g["_g"] == prev["_gp"]) & (g[key] == prev["_pk"]), "left")
    return j.drop("_g", "_gp", "_pk")
