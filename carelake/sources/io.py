"""Sources and sinks (A1-A4, A7-A12). Versioned tables and what is written as
one (A5, A6, A13) are in ``sources.versions``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_full(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
                  infer: bool = False) -> DataFrame:
    """A1: headered CSV with an explicit schema (inference only as a fallback)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_increment(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """A2: increments named ``<table>_*.csv`` (files, or folders of part
    files as Spark writes them), flat in ``root`` or in dated sub-folders, read
    in one scan. Without any increment the result has zero rows."""
    layouts = f"{root.rstrip('/')}/{{{table}_*.csv,*/{table}_*.csv}}"
    return first_available(spark, [
        lambda: spark.read.option("header", True).schema(schema).csv(layouts)], schema)


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """A3: load time, source tag and originating file (file-based frames)."""
    cols = {"_load_timestamp": F.current_timestamp(), "_source": F.lit(source)}
    try:
        cols["_source_file"] = F.col("_metadata.file_path")
        return df.withColumns(cols)
    except AnalysisException as e:  # not a file source
        if "_metadata" not in str(e):
            raise
        cols.pop("_source_file")
        return df.withColumns(cols)


def union_evolving(base: DataFrame, incr: DataFrame) -> DataFrame:
    """A4: union by name; columns missing on either side become null."""
    return base.unionByName(incr, allowMissingColumns=True)


def manifest_check(expected: DataFrame, found: DataFrame, key: str = "table") -> DataFrame:
    """Required inputs that are missing (left anti join)."""
    return expected.join(found.select(key).distinct(), key, "left_anti")


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """File listing as a DataFrame (binary-file source reads metadata only
    when the content column is not selected)."""
    return (spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime"))


def load_audit(df: DataFrame, table: str, sink: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows and sum a status while the load runs (``observe``),
    avoiding a second pass; returns the observed frame and the handle
    whose ``.get`` is filled after the action."""
    obs = Observation(f"audit_{table}")
    return df.observe(obs, F.count(F.lit(1)).alias("row_count")), obs


def audited(spark: SparkSession, table: str, load) -> DataFrame:
    """Run ``load``, a function that returns the number of rows it loaded, and
    return its audit row; a load that fails is recorded, with the error's name."""
    try:
        return audit_row(spark, table, "OK", load(), None)
    except PySparkException as e:
        return audit_row(spark, table, "FAILED", None, e.getCondition() or type(e).__name__)


def audit_row(spark: SparkSession, table: str, status: str, rows: int | None, error: str | None) -> DataFrame:
    return spark.createDataFrame([(table, status, rows, error)],
                                 "table_name string, status string, row_count long, error string") \
        .withColumn("audit_timestamp", F.current_timestamp())


def first_available(spark: SparkSession, candidates: Iterable, empty_schema: T.StructType | str) -> DataFrame:
    """A10: first candidate that resolves (catalog table name, or a
    callable returning a DataFrame), else a typed empty frame. Only a table
    or path that does not exist is passed over; any other failure is raised."""
    for c in candidates:
        if not callable(c):
            if spark.catalog.tableExists(c):
                return spark.table(c)
            continue
        try:
            return c()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
    return spark.createDataFrame([], empty_schema)


def parse_events(raw: DataFrame, col: str, schema: T.StructType | str, corrupt_col: str = "_corrupt") -> DataFrame:
    """JSON text -> typed columns; undecodable rows keep their text in
    ``corrupt_col`` instead of failing the job."""
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"})
    out = raw.withColumn("_p", parsed)
    fields = schema.fieldNames() if isinstance(schema, T.StructType) else \
        T._parse_datatype_string(schema).fieldNames()
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f"_p.{f}").isNull()
    corrupt = F.col(col).isNotNull() & (F.col("_p").isNull() | all_null)
    return out.select("*", *[F.col(f"_p.{f}").alias(f) for f in fields],
                      F.when(corrupt, F.col(col)).alias(corrupt_col)).drop("_p")


def reference_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small in-line lookup table; broadcast wherever it is joined."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def ingest_new_files(spark: SparkSession, src_dir: str, schema, target: str, checkpoint: str,
                     archive_dir: str | None = None, fmt: str = "csv"):
    """Consume each new file exactly once (the file-source checkpoint
    remembers what was read), optionally archiving consumed files, and
    append to ``target``. Runs as an ``availableNow`` batch."""
    r = spark.readStream.schema(schema).option("header", True)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = r.format(fmt).load(src_dir)
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(target))
    q.awaitTermination()
    return q
