import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from carelake.sources import versions as V
from carelake.streaming import alerts as A
from carelake.streaming import events as S

T0 = dt.datetime(2024, 1, 1)


def test_cooldown_is_the_same_for_any_order_of_arrival(spark):
    rng = random.Random(3)
    rows = [(f"i{i:03}", "r", f"P{i % 2}", T0 + dt.timedelta(minutes=rng.randint(0, 600)), float(i)) for i in range(40)]
    want = set()
    for p in ("P0", "P1"):
        last = None
        for item, _, _, t, _ in sorted((r for r in rows if r[2] == p), key=lambda r: (r[3], r[0])):
            if last is None or t - last >= dt.timedelta(minutes=45):
                want.add((p, item))
                last = t
    rng.shuffle(rows)
    folder = tempfile.mkdtemp(prefix="carelake-cooldown-")
    schema = "item_id string, rule string, patient_id string, alert_time timestamp, value double"
    end = [("end", "r", "~", dt.datetime(2024, 6, 1), 0.0)]
    for n in range(3):
        part = rows[n::3] + (end if n == 2 else [])
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").option("timestampFormat", S.MICROS).json(f"{folder}/in")
        stream = A.suppress(A.read_feed(spark, f"{folder}/in", schema, "alert_time", "1 day"), 45 * 60)
        (stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True)
         .start(f"{folder}/out").awaitTermination())
    assert {(r.patient_id, r.item_id) for r in spark.read.parquet(f"{folder}/out").collect()} == want


def test_rules_and_their_thresholds(spark):
    feed = spark.createDataFrame(
        [("fraud_scores", "a", 0.5, None, None), ("fraud_scores", "b", 0.49, None, None), ("fraud_scores", "c", None, 500, None),
         ("care_gap_alerts", "d", None, 90, None), ("care_gap_alerts", "e", None, 91, None), ("highcost_alerts", "f", None, None, 50000.0),
         ("highcost_alerts", "g", None, None, 50000.01), ("other", "h", 1.0, 999, 1e9), (None, "i", 1.0, 999, 1e9)],
        "alert_table string, item_id string, fraud_score double, gap_days_overdue int, rolling_spend_30d double")
    for c in A.ALERT_FEED.split(", "):
        name, typ = c.split(" ")
        feed = feed.withColumn(name, F.col(name).cast(typ) if name in feed.columns else F.lit(None).cast(typ))
    got = {r.item_id: r for r in A.raise_alerts(feed.withColumn("patient_id", F.lit("P1"))).collect()}
    assert set(got) == {"a", "e", "g"}
    assert got["g"].subject == "High-Cost Alert - Patient P1: $50000.01 in 30d" and got["a"].card.startswith("claim_id= | patient_id=P1")


def test_events_of_no_table_are_set_aside_and_a_replayed_batch_is_stored_once(spark):
    folder = tempfile.mkdtemp(prefix="carelake-route-")
    rows = [(1, T0, "claims_events"), (2, T0, "pharmacy_events"), (3, T0, None), (4, T0, "rx_events")]
    df = spark.createDataFrame(rows, "event_id long, event_timestamp timestamp, _table string")
    for c in S.LANDING_SCHEMA.split(", "):
        name, typ = c.split(" ")
        df = df if name in df.columns else df.withColumn(name, F.lit(None).cast(typ))
    S.export_landing(df, os.path.join(folder, "in"))
    for ck in ("ck1", "ck2"):  # the second run replays the batch
        S.route_to_tables(S.landing_stream(spark, os.path.join(folder, "in")), f"{folder}/out", f"{folder}/{ck}").awaitTermination()
    got = {t: sorted(r.event_id for r in spark.read.parquet(f"{folder}/out/{t}").collect())
           for t in ("claims_events", "rx_events", "unrouted_events")}
    assert got == {"claims_events": [1], "rx_events": [4], "unrouted_events": [2, 3]}


def test_versions_are_read_as_committed(spark):
    root = tempfile.mkdtemp(prefix="carelake-versions-") + "/t"
    with pytest.raises(ValueError):
        V.read_version(spark, root)
    assert V.write_version(spark.range(3), root) == 1
    assert V.write_version(spark.range(2).withColumn("x", F.lit(1)), root, "append") == 2
    path = V.stage(spark.range(100), root)
    assert V.read_version(spark, root).count() == 5 and V.read_version(spark, root).where("x IS NULL").count() == 3
    assert V.commit(spark, root, path) == 3 and V.read_version(spark, root).count() == 100
    assert V.read_version(spark, root, 1).columns == ["id"] and V.read_version(spark, root, 2).count() == 5
    with pytest.raises(ValueError):
        V.read_version(spark, root, 9)


def test_a_repeated_event_is_counted_as_often_as_it_comes(spark, tmp_path):
    """Three deliveries of each event: its rows meet its one alert, not each other's."""
    import __spark_entry__ as e
    from carelake.plans.compare import compare, duckdb_conn
    small, d = "/root/testdata/sf0.001", str(tmp_path)
    for name in os.listdir(small):
        os.symlink(f"{small}/{name}", f"{d}/{name}") if name != "events.parquet" else None
    events = spark.read.parquet(f"{small}/events.parquet")
    (events.crossJoin(spark.range(3).select(F.lit(1).alias("_n"))).drop("_n").coalesce(1)
     .write.parquet(f"{d}/_events"))
    part = next(f for f in os.listdir(f"{d}/_events") if f.endswith(".parquet"))
    os.symlink(f"{d}/_events/{part}", f"{d}/events.parquet")
    name = "s16_stream_alert_latency"
    r = compare(e.queries()[name](spark, d), e.oracle_sql()[name], duckdb_conn(d))
    assert r["ok"], r
