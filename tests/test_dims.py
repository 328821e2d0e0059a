import datetime as dt

from pyspark.sql import functions as F

from carelake.operators import dims as D


def _dim(spark):
    src = spark.createDataFrame([("P1", "Gold", "A"), ("P2", "Silver", None), ("P3", None, "C")],
                                "id string, plan string, city string")
    return D.scd2_initial(src, "id", "sk", "2024-01-01")


def test_scd2_apply_expires_changed_inserts_new_keeps_rest(spark):
    dim = _dim(spark)
    src = spark.createDataFrame([("P1", "Platinum", "A"),   # changed
                                 ("P2", "Silver", None),     # unchanged, null tracked on both sides
                                 ("P3", None, "C"),          # unchanged
                                 ("P4", "Gold", "D")],       # new
                                "id string, plan string, city string")
    out = D.scd2_apply(dim, src, "id", "sk", ["plan", "city"], "2024-06-01")
    rows = {(r.id, r.is_current): r for r in out.collect()}
    assert rows[("P1", 0)].effective_end_date == dt.date(2024, 6, 1)
    assert rows[("P1", 1)].plan == "Platinum" and rows[("P1", 1)].sk == 4
    assert rows[("P4", 1)].sk == 5
    assert ("P2", 0) not in rows and ("P3", 0) not in rows
    cur = out.where("is_current = 1").groupBy("id").count().where("count <> 1").count()
    assert cur == 0  # exactly one current version per key
    assert out.count() == 5


def test_upsert_updates_inserts_keeps_keys_and_is_idempotent(spark):
    tgt = spark.createDataFrame([("C1", 10.0, 1), ("C2", 20.0, 2)], "id string, amt double, sk long")
    src = spark.createDataFrame([("C2", 25.0), ("C3", 30.0)], "id string, amt double")
    once = D.upsert(tgt, src, "id", "sk")
    got = {r.id: (r.amt, r.sk) for r in once.collect()}
    assert got == {"C1": (10.0, 1), "C2": (25.0, 2), "C3": (30.0, 3)}
    twice = D.upsert(once.select(*tgt.columns), src, "id", "sk")
    assert sorted(map(tuple, twice.select("id", "amt", "sk").collect())) == \
        sorted(map(tuple, once.select("id", "amt", "sk").collect()))


def test_date_dimension_fiscal_and_weekend(spark):
    d = {r.full_date: r for r in D.date_dimension(spark, "2024-02-28", "2024-07-01").collect()}
    assert d[dt.date(2024, 2, 29)].date_key == 20240229
    assert d[dt.date(2024, 7, 1)].fiscal_year == 2025 and d[dt.date(2024, 7, 1)].fiscal_quarter == 1
    assert d[dt.date(2024, 3, 2)].is_weekend == 1 and d[dt.date(2024, 3, 1)].is_weekend == 0
    assert d[dt.date(2024, 3, 3)].day_of_week == 1  # Sunday = 1


def test_payer_type_from_name(spark):
    from carelake.operators.dims import classify_payer
    df = spark.createDataFrame([("Medicare A",), ("State MEDICAID",), ("self pay",), ("Cash",), ("Acme",), (None,)], "n string")
    assert [r[0] for r in df.select(classify_payer(df.n)).collect()] == [
        "Medicare", "Medicaid", "Self-Pay", "Self-Pay", "Commercial", "Commercial"]


def test_calendar_takes_its_range_from_the_data(spark):
    dates = spark.createDataFrame([("1999-05-04",), ("2000-02-29",), (None,)], "d string").select(F.col("d").cast("date"))
    days = D.calendar(D.data_span(dates))
    got = days.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (str(got[0]), str(got[1]), got[2]) == ("1999-01-01", "2001-12-31", 365 + 366 + 365)
    assert D.calendar(D.data_span(dates.where("false"))).count() == 0
