import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators.keys import assign_stable_keys, dense_keys, duplicate_keys, high_water, latest_per_key


def test_latest_per_key_newest_wins_and_ties_are_deterministic(spark):
    rows = [("P1", dt.date(2024, 1, 1), "old", 1), ("P1", dt.date(2024, 2, 1), "new", 2),
            ("P2", dt.date(2024, 1, 1), "a", 1), ("P2", dt.date(2024, 1, 1), "b", 1),   # tie on date
            ("P3", None, "x", 1), ("P3", dt.date(2023, 1, 1), "y", 1),                 # null date sorts last
            ("P4", dt.date(2024, 1, 1), "dup", 1), ("P4", dt.date(2024, 1, 1), "dup", 1)]  # exact duplicate
    df = spark.createDataFrame(rows, "id string, d date, v string, n int")
    got = {r.id: r.v for r in latest_per_key(df, "id", ["d"]).collect()}
    assert got == {"P1": "new", "P2": "b", "P3": "y", "P4": "dup"}
    assert latest_per_key(df, "id", ["d"]).count() == 4


def test_dense_keys_match_row_number_across_partitions(spark):
    df = spark.range(0, 500).select(F.format_string("K%05d", (F.col("id") * 7919) % 500).alias("bk"))
    got = dense_keys(df, "bk", "k", num_partitions=5)
    ref = df.withColumn("k", F.row_number().over(Window.orderBy("bk")).cast("long"))
    assert sorted(got.collect()) == sorted(ref.collect())
    assert got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 500, 500)


def test_dense_keys_single_partition_step_only_sees_partition_counts(spark):
    """The only single-partition step is the running sum over one row per
    partition, and it sits under the broadcast side of the join."""
    df = spark.range(0, 50).select(F.col("id").cast("string").alias("bk"))
    plan = dense_keys(df, "bk", "k")._jdf.queryExecution().executedPlan().toString()
    if "SinglePartition" in plan:
        assert plan.index("BroadcastExchange") < plan.index("SinglePartition")
        assert "partial_count" in plan.split("SinglePartition", 1)[1]


def test_stable_keys_keep_old_and_number_new_after_max(spark):
    old = spark.createDataFrame([("A", 1), ("C", 7)], "bk string, k long")
    src = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "bk string")
    got = {r.bk: r.k for r in assign_stable_keys(src, old, "k", "bk").collect()}
    assert got == {"A": 1, "C": 7, "B": 8, "D": 9}


def test_stable_keys_of_a_versioned_dimension_come_back_once(spark):
    old = spark.createDataFrame([("A", 1), ("A", 4), ("C", 2)], "bk string, k long")
    src = spark.createDataFrame([("A",), ("B",)], "bk string")
    assert sorted(tuple(r) for r in assign_stable_keys(src, old, "k", "bk").collect()) == [("A", 4), ("B", 5)]


def test_duplicate_keys_and_high_water(spark):
    df = spark.createDataFrame([("ENC0001",), ("ENC0001",), ("ENC0042",), (None,)], "id string")
    assert [tuple(r) for r in duplicate_keys(df, "id").collect()] == [("ENC0001", 2)]
    assert high_water(df, "id", r"ENC0*(\d+)").first()[0] == 42


def test_long_identifiers_are_never_cut(spark):
    from pyspark.sql import functions as F
    from carelake.sources.bindings import _id
    df = spark.range(99_990, 100_010).unionByName(spark.range(1_000_000, 1_000_010))
    got = df.select(_id("P", "id", 5).alias("a"), _id("P", F.col("id"), 6).alias("b"))
    assert got.select("a").distinct().count() == got.select("b").distinct().count() == 30


def test_latest_per_key_made_of_parts_keeps_rows_where_a_join_dealt_them(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.createDataFrame([(1, 1, 5, "x"), (1, 1, 7, "y"), (1, 1, 7, "z"), (1, 2, None, "p"), (2, 1, 1, "q"), (2, 1, 1, "q"),
                                   (None, 1, 3, "n"), (None, 1, 4, "m"), (3, None, 4, "o")], "o long, l int, t int, v string")
        j = a.join(spark.createDataFrame([(1, "c"), (2, "d")], "k long, w string"), F.col("o") == F.col("k"), "left")
        key = F.concat(F.lit("K"), F.col("o").cast("string"), F.lit("-"), F.col("l").cast("string")).alias("id")
        plain = latest_per_key(j.select(key, "t", "v", "w"), "id", ["t"])
        made = latest_per_key(j.select(key, "t", "v", "w", F.col("o").alias("_o"), F.col("l").alias("_l")), "id", ["t"], made_of=("_o", "_l"))
        assert made.columns == plain.columns and sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
        assert made.count() == 4  # three keys and one row for the null key
        wide = [x for x in made._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(_o" in x]
        assert not wide
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
