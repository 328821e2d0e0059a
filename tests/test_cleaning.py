import datetime as dt

import duckdb
from pyspark.sql import functions as F

from carelake.functions import cleaning as C
from carelake.functions.exprs import bucketize, hash_bucket, safe_ratio, years_since


def test_cleaning_chain(spark):
    df = spark.createDataFrame([("  mary ", " MALE ", "02134", "(555) 010-1234", " A@B.Com ", "2024-02-29"),
                                ("JOHN", "f", "00501", None, None, "13/45/2020")],
                               "name string, gender string, zip string, phone string, email string, dob string")
    df = C.clean_names(df, ["name"])
    df = C.map_category(df, "gender", C.GENDER_MAP)
    df = C.digits_only(df, ["zip", "phone"])
    df = C.clean_email(df, "email")
    df = C.parse_dates(df, ["dob"])
    rows = df.collect()
    assert rows[0].name == "Mary" and rows[0].gender == "Male" and rows[0].zip == "02134"
    assert rows[0].phone == "5550101234" and rows[0].email == "a@b.com" and rows[0].dob == dt.date(2024, 2, 29)
    assert rows[1].gender == "Female" and rows[1].zip == "00501" and rows[1].dob is None


def test_length_of_stay_and_missing_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 5), 9), (None, None, 3)],
                               "a date, b date, length_of_stay int")
    out = C.length_of_stay(df, "a", "b").collect()
    assert [r.length_of_stay for r in out] == [4, 3]
    assert "extra" in C.ensure_columns(df, {"extra": "double"}).columns


def test_hash_bucket_matches_duckdb(spark):
    keys = ["CLM1", "CLM42-3", "ENC00000017", ""]
    got = {r.k: r.b for r in spark.createDataFrame([(k,) for k in keys], "k string")
           .select("k", hash_bucket("k", 100).alias("b")).collect()}
    con = duckdb.connect()
    for k in keys:
        exp = con.execute(f"SELECT (('0x' || substr(md5('{k}'), 1, 8))::BIGINT % 100)").fetchall()[0][0]
        assert got[k] == exp
    assert got["CLM1"] == 61


def test_ratio_age_bucket(spark):
    df = spark.createDataFrame([(50.0, 0.0, dt.date(2000, 2, 29)), (1.0, 3.0, None)], "n double, d double, dob date")
    r = df.select(safe_ratio("n", "d", 4).alias("r"), years_since("dob", "2018-02-28").alias("age")).collect()
    assert r[0].r == 0.0 and r[1].r == 0.3333 and r[0].age == 17 and r[1].age is None
    b = spark.createDataFrame([(17,), (18,), (64,), (65,), (None,)], "a int").select(
        bucketize("a", (18, 40, 65), ("0-17", "18-39", "40-64", "65+")).alias("g")).collect()
    assert [x.g for x in b] == ["0-17", "18-39", "40-64", "65+", None]
