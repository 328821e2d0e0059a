"""Per-key rolling windows that stay balanced when one key is hot.

A plain ``Window.partitionBy(key).orderBy(t).rangeBetween(-frame, 0)``
sorts each key's whole timeline in one task. Here the timeline is cut into
chunks of ``chunk`` units (``chunk >= frame``) and the rows within ``frame``
before a chunk boundary are copied into the next chunk as halo rows, so
every row still sees its full frame while a hot key is spread over as many
tasks as it has chunks. Halo rows only feed the frames and are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WindowAgg = Callable[[Window], Column]


def epoch_micros(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def epoch_days(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_date(c.cast("date"))


def rolling_by_key(df: DataFrame, key: str | list[str], order: Column, frames: dict[int, dict[str, WindowAgg]],
                   chunk: int | None = None) -> DataFrame:
    """Add rolling aggregates over ``[order - frame, order]`` per key.

    ``order`` is a numeric column (epoch micros or days); ``frames`` maps a
    frame length (same unit) to {output column: fn(window) -> Column}.
    """
    keys = [key] if isinstance(key, str) else list(key)
    longest = max(frames)
    size = max(chunk or longest, longest, 1)
    d = df.withColumn("_ord", order).withColumn("_chunk", F.floor(F.col("_ord") / size))
    halo = (d.where(F.col("_ord") >= (F.col("_chunk") + 1) * size - longest)
            .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_halo", F.lit(True)))
    rows = d.withColumn("_halo", F.lit(False)).unionByName(halo)
    cols = {}
    for frame, aggs in frames.items():
        w = Window.partitionBy(*keys, "_chunk").orderBy("_ord").rangeBetween(-frame, 0)
        for name, fn in aggs.items():
            cols[name] = fn(w)
    return rows.withColumns(cols).where(~F.col("_halo")).drop("_ord", "_chunk", "_halo")


def latest_by(df: DataFrame, key: str | list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate of
    a struct (partial aggregation map-side; ties broken by ``cols``)."""
    keys = [key] if isinstance(key, str) else list(key)
    packed = F.max(F.struct(*[F.col(c) for c in order + [c for c in cols if c not in order]])).alias("_l")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])
