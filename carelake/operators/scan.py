"""Two-level scans: running aggregates per key that no hot key can pile up.

Rows are range-partitioned on (keys, order) and written once. A scan runs
inside each (partition, key) piece; what a key's earlier pieces add up to is
carried in (one row per piece, at most one piece per partition) and merged. A
key with a third of all rows spans many partitions and is never sorted or
summed in one task. Several scans of one order share the same single write.

On this rest prefix sums for rolling frames (a frame is the difference of two
prefixes), grouped ranks and exact grouped quantiles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import materialise

_PID, _POS, _KEY = "_scan_pid", "_scan_pos", "_scan_key"


@dataclass(frozen=True)
class Step:
    """An associative step: ``fold`` aggregates ``value`` over rows in order,
    ``whole`` does so for a group of rows in any order, ``merge`` joins what came
    before with what follows (either may be null: nothing there)."""

    value: Column
    fold: Callable[[Column], Column]
    whole: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


def summed(value: Column) -> Step:
    return Step(value, F.sum, F.sum, lambda a, b: F.coalesce(a + b, a, b))


def greatest(value: Column) -> Step:
    return Step(value, F.max, F.max, F.greatest)


def last(*cols: str | Column) -> Step:
    """The columns of the row before, as a struct (null where there is none)."""
    return Step(F.struct(*cols), F.last, lambda c: F.max_by(c, _POS), lambda a, b: F.coalesce(b, a))


def scan_by_key(df: DataFrame, keys: list[str], order: list[str], steps: dict[str, Step], peers: bool = False,
                num_partitions: int | None = None) -> DataFrame:
    """``df`` plus one column per step: the step over the earlier rows of the same
    keys in ``order`` (nulls last); with ``peers`` also over the row itself and all
    rows that tie with it. Null keys are a key of their own. Ties of ``order``
    follow each other in an arbitrary but fixed order."""
    by = [F.col(c).asc_nulls_last() for c in (*keys, *order)]
    d = df.withColumns({f"_v_{name}": s.value for name, s in steps.items()})
    parted = d.repartitionByRange(num_partitions, *by) if num_partitions else d.repartitionByRange(*by)
    # the keys as one struct, in which null equals null: the window's rows then lie as the
    # join with what is carried in needs them
    key = F.struct(*keys).alias(_KEY)
    kept = [c for c in d.columns if c not in keys]
    ranged = materialise(parted.sortWithinPartitions(*by).select(key, *kept, F.spark_partition_id().alias(_PID),
                                                                 F.monotonically_increasing_id().alias(_POS)), "scan")
    piece = Window.partitionBy(_PID, _KEY)
    # equal order values are in one range partition, so a row's peers are in its piece
    here = (piece.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if peers
            else piece.orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumns({f"_l_{n}": s.fold(F.col(f"_v_{n}")).over(here) for n, s in steps.items()})
    pieces = ranged.groupBy(_PID, _KEY).agg(*[s.whole(F.col(f"_v_{n}")).alias(f"_t_{n}") for n, s in steps.items()])
    before = Window.partitionBy(_KEY).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = pieces.select(_PID, _KEY, *[s.fold(F.col(f"_t_{n}")).over(before).alias(f"_c_{n}") for n, s in steps.items()])
    j = local.join(carry, [_PID, _KEY], "left")
    return j.select(*[F.col(_KEY)[c].alias(c) if c in keys else F.col(c) for c in df.columns],
                    *[s.merge(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n, s in steps.items()])


def rolling_sums(df: DataFrame, key: str, row_id: str, time: Column, outs: dict[str, tuple[int, Column | None]]) -> DataFrame:
    """``df`` plus, per entry of ``outs`` (frame, value), the sum of value (the
    number of rows, if None) over the rows of the key with time in [time - frame,
    time]: the prefix up to the row less the prefix before the frame.

    ``time`` is a whole number; rows that repeat a ``row_id`` must agree in key and
    time. The prefixes before the frames come from probe rows put in among the
    others, so all is one scan. Null times have null sums."""
    values = {name: F.lit(1).cast("long") if v is None else F.coalesce(v, F.lit(0)) for name, (_, v) in outs.items()}
    rows = df.select(F.col(key).alias("_key"), F.col(row_id).alias("_row"), time.cast("long").alias("_time"),
                     *[v.alias(f"_x_{n}") for n, v in values.items()]).where("_time IS NOT NULL")
    frames = sorted({f for f, _ in outs.values()})
    # odd places are rows, even ones the probes just before them
    events = rows.withColumns({"_at": F.col("_time") * 2 + 1, "_frame": F.lit(-1).cast("long")})
    probes = rows.withColumn("_frame", F.explode(F.array(*[F.lit(f).cast("long") for f in frames]))).withColumns(
        {"_at": (F.col("_time") - F.col("_frame")) * 2, **{f"_x_{n}": F.lit(None).cast(rows.schema[f"_x_{n}"].dataType) for n in outs}})
    mixed = events.unionByName(probes).drop("_time")
    done = scan_by_key(mixed, ["_key"], ["_at"], {f"_p_{n}": summed(F.col(f"_x_{n}")) for n in outs}, peers=True)

    def prefix(name: str, frame: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("_frame") == frame, F.col(f"_p_{name}"))), F.lit(0))
    sums = done.groupBy("_row").agg(*[(prefix(n, -1) - prefix(n, f)).alias(n) for n, (f, _) in outs.items()])
    return df.join(sums.withColumnRenamed("_row", row_id), row_id, "left")


def dense_ranks(df: DataFrame, group: str, value: str, out: str, descending: bool = True) -> DataFrame:
    """``df`` plus the dense rank of ``value`` within ``group``, counted over the
    distinct values by a scan and joined back."""
    distinct = df.select(group, value).distinct().withColumn("_by", -F.col(value) if descending else F.col(value))
    ranked = scan_by_key(distinct, [group], ["_by"], {"_before": summed(F.lit(1).cast("long"))})
    ranks = ranked.select(F.col(group).alias("_g"), F.col(value).alias("_v"),
                          (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias(out))
    same = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return df.join(ranks, same).drop("_g", "_v")


def quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """One row per group with the exact quantiles (interpolated between the two
    nearest values) named in ``shares``; null values are left out. Only the values at
    the wanted places meet in a group, found by their place in a scan."""
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = scan_by_key(counted, [group], [value], {"_first": summed(F.col("_n"))}).withColumn(
        "_first", F.coalesce("_first", F.lit(0)))
    sizes = counted.groupBy(F.col(group).alias("_g")).agg(F.sum("_n").alias("_size"))
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("share")) for n, p in shares.items()]))
    held = placed.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).select("*", wanted.alias("q"))
    at = (F.col("_size") - 1) * F.col("q.share")
    inside = [(F.col("_first") <= place) & (place < F.col("_first") + F.col("_n")) for place in (F.floor(at), F.ceil(at))]
    ends = held.select(F.col(group), F.col("q.name").alias("name"), (at - F.floor(at)).alias("part"), F.col(value).alias("v"),
                       inside[0].alias("low"), inside[1].alias("high")).where("low OR high")
    each = ends.groupBy(group, "name").agg(F.max("part").alias("part"), F.max(F.when(F.col("low"), F.col("v"))).alias("a"),
                                           F.max(F.when(F.col("high"), F.col("v"))).alias("b"))
    value_of = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    return each.groupBy(group).agg(*[F.max(F.when(F.col("name") == n, value_of)).alias(n) for n in shares])
