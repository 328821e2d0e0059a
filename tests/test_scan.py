import datetime as dt
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators.aggs import pdc_excluding_stays
from carelake.operators.scan import dense_ranks, last, quantiles, rolling_sums, scan_by_key, summed


def _timeline(spark, n=900):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.choice([None, *range(60)]), rng.choice([None, 1, 5, -2]))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, t long, v long")


def test_scan_equals_a_window_and_splits_a_hot_key(spark):
    _, df = _timeline(spark)
    got = scan_by_key(df, ["k"], ["t", "id"], {"s": summed(F.col("v")), "p": last("id", "v")}, num_partitions=6)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.last("id").over(w).alias("pid"), F.last("v").over(w).alias("pv"))
    assert sorted(map(tuple, got.select("id", "s", "p.id", "p.v").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    spread = df.repartitionByRange(6, "k", "t", "id").where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert spread > 1


def test_rolling_sums_equal_brute_force(spark):
    rows, df = _timeline(spark)
    got = {r.id: (r.s, r.n, r.far) for r in rolling_sums(
        df, "k", "id", F.col("t"), {"s": (7, F.col("v")), "n": (7, None), "far": (40, None)}).collect()}
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        def near(f):
            return [x for x in rows if x[1] == k and x[2] is not None and t - f <= x[2] <= t]
        want = (None,) * 3 if t is None else (sum(x[3] or 0 for x in near(7)), len(near(7)), len(near(40)))
        assert got[i] == want


def test_ranks_and_quantiles(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), round(rng.random(), 2) if i % 9 else None) for i in range(400)] + [("one", 0.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.select("g", "v", F.dense_rank().over(w).alias("r")).collect()
    got = dense_ranks(df, "g", "v", "r").select("g", "v", "r").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    q = {r.g: r for r in quantiles(df, "g", "v", {"lo": 0.0, "q1": 0.25, "med": 0.5, "hi": 1.0}).collect()}
    for g in ("x", "y", None, "one"):
        v = [b for a, b in rows if a == g and b is not None]
        assert np.allclose([q[g].lo, q[g].q1, q[g].med, q[g].hi], np.quantile(v, [0, 0.25, 0.5, 1]))


def test_stays_are_cut_out_like_days(spark):
    rng, d0 = random.Random(6), dt.date(2023, 11, 1)

    def day(n):
        return d0 + dt.timedelta(days=n)
    fills = [(p, c, day(rng.randint(0, 500)), rng.choice([0, 5, 30, 400])) for p in (1, 2, 3) for c in "AB" for _ in range(8)]
    stays = [(p, day(s), day(s + rng.choice([0, 3, 90, -1]))) for p in (1, 2, 4) for s in rng.sample(range(500), 9)]
    got = {(r.patient_key, r.drug_class, r.year): (r.period_days, r.period_days_excl, r.covered_days, r.covered_days_excl)
           for r in pdc_excluding_stays(spark.createDataFrame(fills, "patient_key long, drug_class string, fill_date date, days_supply int"),
                                        spark.createDataFrame(stays, "patient_key long, stay_start date, stay_end date")).collect()}
    want, one = {}, dt.timedelta(days=1)
    away = {(p, a + one * i) for p, a, b in stays for i in range((b - a).days + 1)}
    for key in {(p, c, a.year) for p, c, a, n in fills if n > 0}:
        own = [(a, n) for p, c, a, n in fills if (p, c, a.year) == key and n > 0]
        end = dt.date(key[2], 12, 31)
        period = {min(a for a, _ in own) + one * i for i in range((end - min(a for a, _ in own)).days + 1)}
        covered = {a + one * i for a, n in own for i in range(n)} & period
        want[key] = (len(period), sum((key[0], x) not in away for x in period), len(covered), sum((key[0], x) not in away for x in covered))
    assert got == want


def test_scanned_rows_meet_what_is_carried_in_where_they_are(spark):
    """The window's rows are not shuffled again for the join; null keys still match."""
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7), ("a", 2, 8)], "k string, t int, v int")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scan_by_key(df, ["k"], ["t"], {"before": summed(F.col("v"))}, num_partitions=4)
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        rows = {tuple(r) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert rows == {(None, 1, 5, None), (None, 2, 6, 5), ("a", 1, 7, None), ("a", 2, 8, 7)}
    # the window, and of the pieces their sum, their order and the join
    assert plan.count("Exchange hashpartitioning") == 4
