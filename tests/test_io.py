import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carelake.functions.cleaning import require_columns
from carelake.sources import io as IO


def test_ingest_new_files_once_and_archive(spark):
    root = tempfile.mkdtemp(prefix="carelake-ingest-")
    src, out, ck, arch = (os.path.join(root, x) for x in ("in", "out", "ck", "archive"))
    os.makedirs(src)
    with open(os.path.join(src, "claims_1.csv"), "w") as f:
        f.write("claim_id,amount\nC1,10.5\nC2,20\n")
    IO.ingest_new_files(spark, src, "claim_id string, amount double", out, ck, archive_dir=arch)
    with open(os.path.join(src, "claims_2.csv"), "w") as f:
        f.write("claim_id,amount\nC3,5\n")
    IO.ingest_new_files(spark, src, "claim_id string, amount double", out, ck, archive_dir=arch)
    got = sorted(r.claim_id for r in spark.read.parquet(out).collect())
    assert got == ["C1", "C2", "C3"]  # each file consumed exactly once


def test_parse_events_keeps_corrupt_rows(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("not json",), (None,)], "props string")
    rows = IO.parse_events(df, "props", "k int").collect()
    assert rows[0].k == 5 and rows[0]._corrupt is None
    assert rows[1].k is None and rows[1]._corrupt == "not json"
    assert rows[2]._corrupt is None


def test_union_evolving_manifest_and_required_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "y", 3.0)], "id int, v string, extra double")
    u = IO.union_evolving(a, b)
    assert u.columns == ["id", "v", "extra"] and u.where(F.col("extra").isNull()).count() == 1
    exp = spark.createDataFrame([("claims",), ("payers",)], "table string")
    found = spark.createDataFrame([("claims",)], "table string")
    assert [r.table for r in IO.manifest_check(exp, found).collect()] == ["payers"]
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(a, ["id", "claim_date"], "claims")


def test_first_available_passes_over_missing_inputs_only(spark):
    gone = lambda: spark.read.parquet("/no/such/folder")
    assert IO.first_available(spark, ["no_such_table", gone, lambda: spark.range(3)], "id long").count() == 3
    assert IO.first_available(spark, [gone], "id long").count() == 0
    with pytest.raises(ZeroDivisionError):
        IO.first_available(spark, [lambda: 1 / 0], "id long")
    assert "_source_file" not in IO.with_lineage(spark.range(1), "memory").columns


def test_increments_in_both_layouts_or_none(spark):
    root = tempfile.mkdtemp(prefix="carelake-increments-")
    assert IO.read_csv_increment(spark, root, "claims", "claim_id string").count() == 0
    os.makedirs(f"{root}/2024-06-01")
    for path, key in ((f"{root}/claims_1.csv", "C1"), (f"{root}/2024-06-01/claims_2.csv", "C2"), (f"{root}/other_1.csv", "X")):
        with open(path, "w") as f:
            f.write(f"claim_id\n{key}\n")
    got = sorted(r.claim_id for r in IO.read_csv_increment(spark, root, "claims", "claim_id string").collect())
    assert got == ["C1", "C2"]
