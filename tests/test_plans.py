import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from carelake.plans.star import Star
from carelake.session import where_dealt
from carelake.sources import bindings as B

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_scan_prunes_columns_and_pushes_filters(spark):
    fc = Star(spark, SF).fact_claim()
    q = fc.where(F.col("claim_date") >= "2000-01-01").select("claim_id", "billed_amount")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(claim_date), GreaterThanOrEqual(claim_date" in plan
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "claim_id" in read and "billed_amount" in read and "payer_name" not in read


def test_raw_binding_scan_reads_only_used_columns(spark):
    from carelake.sources import bindings as B
    plan = _plan(B.raw_patients(Star(spark, SF).t).select("patient_id", "zip_code"))
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "c_custkey" in read and "c_mktsegment" not in read


def test_snapshots_follow_the_input_files(spark, tmp_path):
    """A table rewritten in place is not answered from old snapshots."""
    from carelake.sources.tables import STAR_TABLES
    for name in STAR_TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    before = Star(spark, str(tmp_path)).dim_facility().count()
    assert Star(spark, str(tmp_path)).t.version() == Star(spark, str(tmp_path)).t.version()
    spark.read.parquet(f"{SF}/nation.parquet").where("n_nationkey < 10").write.mode("overwrite").parquet(
        f"{tmp_path}/nation.parquet")
    assert (before, Star(spark, str(tmp_path)).dim_facility().count()) == (25, 10)


def test_graph_counts_scan_each_table_once(spark):
    from carelake.operators.graph import NODE_TYPES
    from carelake.plans.q_graph import graph
    plan = graph(Star(spark, SF)).counts()._jdf.queryExecution().optimizedPlan().toString()
    # the adherence table is itself an aggregate of several scans
    assert plan.count("Aggregate [count(") == len({t for t, _ in NODE_TYPES.values()})


def test_graph_validation_counts_orphans(spark):
    from carelake.operators.graph import Graph
    from carelake.plans.q_graph import graph
    tables = graph(Star(spark, SF)).tables
    tables["dim_payer"] = tables["dim_payer"]().where("payer_key < 0")
    claims = tables["fact_claim"]()
    got = {r.edge: r for r in Graph(tables).validate().collect()}
    assert len(got) == 17 and all(r.pk_exists and r.fk_exists for r in got.values())
    assert got["ClaimHasPayer"].orphan_edges == claims.where("payer_key IS NOT NULL").count() > 0
    assert got["submittedBy"].orphan_edges == 0


def _unbroadcast(spark, build):
    """The plan of ``build()`` where nothing is small enough to be broadcast."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with where_dealt(spark):
            return _plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_lines_are_dealt_once_for_claims_prescriptions_and_diagnoses(spark):
    s = Star(spark, SF)
    s._lines()
    for build in (s._silver_claims, s._silver_prescriptions, s._silver_diagnoses):
        plan = _unbroadcast(spark, build)
        assert "Bucketed: true" in plan
        assert "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(_order" not in plan
    # of encounters only the orders travel
    plan = _unbroadcast(spark, s._silver_encounters)
    assert "hashpartitioning(o_orderkey" in plan and "hashpartitioning(l_orderkey" not in plan


def test_lines_come_with_their_orders_as_before(spark):
    """Lines without an order, of null orders and repeated ones are all there."""
    lines = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    when = dt.datetime(1997, 3, 4)
    rest = (7, 3, 1, 5.0, 100.0, 0.1, 0.05, "N", "F", when)
    t = SimpleNamespace(
        lineitem=spark.createDataFrame([(1, *rest), (1, *rest), (2, *rest), (None, *rest)], lines),
        orders=spark.createDataFrame([(1, 10, when), (1, 11, when), (3, 12, when)],
                                     "o_orderkey long, o_custkey long, o_orderdate timestamp"))
    got = sorted((str(r.l_orderkey), str(r.o_custkey)) for r in B.order_lines(t).collect())
    assert got == [("1", "10"), ("1", "10"), ("1", "11"), ("1", "11"), ("2", "None"), ("None", "None")]
    claims = [sorted(map(str, B.raw_claims(t, parts=True, lines=x).collect())) for x in (None, B.order_lines(t))]
    assert claims[0] == claims[1] and len(claims[0]) == 6


def test_adherence_is_written_once(spark):
    from carelake.plans.q_rx import adherence
    files = adherence(Star(spark, SF)).inputFiles()
    assert any("/dense-keys-" in f for f in files) and not any("/agg_adherence-" in f for f in files)


def test_dimensions_show_joins_their_size(spark, tmp_path):
    """Many short rows that pack well don't pass for a table small enough to broadcast."""
    n, key = 40_000, F.col("id")
    made = {"customer": [key.alias("c_custkey"), (key % 25).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")],
            "supplier": [key.alias("s_suppkey"), (key % 25).alias("s_nationkey"), F.lit(1.0).alias("s_acctbal")],
            "part": [key.alias("p_partkey"), F.lit("part").alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("TIN").alias("p_type"),
                     (key % 50).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice")]}
    for name, cols in made.items():
        spark.range(n).select(*cols).write.parquet(f"{tmp_path}/{name}.parquet")
    s = Star(spark, str(tmp_path))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(n * 16))  # shorter than an id and a key are
    try:
        for dim, bk, sk in ((s.dim_patient(), "patient_id", "patient_key"), (s.dim_provider(), "provider_id", "provider_key"),
                            (s.dim_medication(), "medication_code", "medication_key"), (s.dim_diagnosis(), "icd_code", "diagnosis_key")):
            assert dim.count() == n
            facts = spark.range(10 ** 7).select(F.col("id").alias(sk))
            assert "Broadcast" not in _plan(facts.join(dim.select(bk, sk), sk)), bk
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
