"""Reference lookups and enrichment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, ref: DataFrame, on: str | list[str], take: Iterable[str],
                prefix: str = "", ref_on: str | list[str] | None = None, small: bool = False) -> DataFrame:
    """Left join ``ref`` on ``on``; taken columns that collide with an
    existing column get ``prefix``.

    ``small=True`` marks a reference whose size is bounded by construction
    (a vocabulary); only then is it broadcast. Otherwise AQE picks the join
    from runtime sizes.
    """
    on_l = [on] if isinstance(on, str) else list(on)
    on_r = on_l if ref_on is None else ([ref_on] if isinstance(ref_on, str) else list(ref_on))
    have = set(df.columns)
    cols = []
    for c in take:
        out = f"{prefix}{c}" if (c in have or prefix and c not in on_r) else c
        cols.append(F.col(c).alias(out))
    r = ref.select(*[F.col(k).alias(f"_lk{i}") for i, k in enumerate(on_r)], *cols)
    if small:
        r = F.broadcast(r)
    cond = None
    for i, k in enumerate(on_l):
        c = df[k] == r[f"_lk{i}"]
        cond = c if cond is None else cond & c
    return df.join(r, cond, "left").drop(*[f"_lk{i}" for i in range(len(on_r))])
