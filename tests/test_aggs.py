import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators.aggs import exists_within, pdc_exact
from carelake.operators.windows import epoch_micros, rolling_by_key


def test_pdc_exact_overlap_gap_single_and_zero_supply(spark):
    d = dt.date
    rows = [("P1", "X", d(2024, 12, 1), 10), ("P1", "X", d(2024, 12, 5), 10),   # overlap: days 1..14
            ("P1", "X", d(2024, 12, 25), 30),                                   # clipped at Dec 31
            ("P2", "X", d(2024, 12, 22), 10),                                   # single fill
            ("P3", "X", d(2024, 12, 1), 0)]                                     # zero supply ignored
    df = spark.createDataFrame(rows, "patient_key string, drug_class string, fill_date date, days_supply int")
    got = {r.patient_key: r for r in pdc_exact(df).collect()}
    assert got["P1"].covered_days == 14 + 7 and got["P1"].period_days == 31
    assert got["P1"].pdc == round(21 / 31, 4)
    assert got["P2"].covered_days == 10 and got["P2"].pdc == 1.0
    assert "P3" not in got


def test_exists_within_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    left = [(i, f"K{rnd.randint(0, 3)}", base + dt.timedelta(days=rnd.randint(0, 60))) for i in range(80)]
    right = [(f"K{rnd.randint(0, 3)}", base + dt.timedelta(days=rnd.randint(0, 70))) for _ in range(60)]
    ldf = spark.createDataFrame(left, "id int, k string, d date")
    rdf = spark.createDataFrame(right, "k string, d2 date")
    got = sorted(r.id for r in exists_within(ldf, rdf, "k", "d", "d2", 1, 7).collect())
    exp = sorted(i for i, k, d in left if any(k == k2 and 1 <= (d2 - d).days <= 7 for k2, d2 in right))
    assert got == exp


def test_chunked_rolling_equals_plain_window(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, "HOT" if i % 3 else f"K{i % 5}", t0 + dt.timedelta(minutes=rnd.randint(0, 3000)), float(i))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp, v double")
    hour = 3600 * 10 ** 6
    got = rolling_by_key(df, "k", epoch_micros("ts"), {hour: {"n": lambda w: F.count(F.lit(1)).over(w),
                                                             "s": lambda w: F.sum("v").over(w)}}, chunk=hour)
    w = Window.partitionBy("k").orderBy(epoch_micros("ts")).rangeBetween(-hour, 0)
    ref = df.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum("v").over(w)})
    assert sorted(map(tuple, got.select("id", "n", "s").collect())) == \
        sorted(map(tuple, ref.select("id", "n", "s").collect()))


def test_prefix_max_two_level_scan_equals_window(spark):
    from carelake.operators.scan import greatest, scan_by_key
    rnd = random.Random(11)
    rows = [(i, "HOT" if i % 4 else f"K{i % 7}", rnd.randint(0, 50), rnd.choice([None, float(rnd.randint(0, 999))]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, d int, v double")
    got = scan_by_key(df, ["k"], ["d", "id"], {"pm": greatest(F.col("v"))}, num_partitions=6)
    w = Window.partitionBy("k").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("pm", F.max("v").over(w))
    assert sorted(map(tuple, got.select("id", "pm").collect())) == sorted(map(tuple, ref.select("id", "pm").collect()))


def test_adherence_keys_stay(spark):
    from carelake.operators.aggs import adherence_keys
    pairs = "patient_key long, medication_key long"
    first = adherence_keys(spark.createDataFrame([(2, 5), (1, 9), (1, 2)], pairs))
    assert sorted(map(tuple, first.select("patient_key", "medication_key", "adherence_key").collect())) == [
        (1, 2, 1), (1, 9, 2), (2, 5, 3)]
    more = spark.createDataFrame([(2, 5), (1, 9), (1, 2), (1, 1), (1, 100_001)], pairs)
    known = first.select("patient_key", "medication_key", "adherence_key")
    next_ = {(r.patient_key, r.medication_key): r.adherence_key for r in adherence_keys(more, known).collect()}
    assert next_ == {(1, 2): 1, (1, 9): 2, (2, 5): 3, (1, 1): 4, (1, 100_001): 5}
