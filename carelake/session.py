"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (the
# size check behind any automatic broadcast) and splits skewed partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "carelake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the input (roughly
    input bytes / 128 MB), not left at a local-mode value.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only when nothing is set and the master is local (tests,
    laptops) is a private folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="carelake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams started from here on in RocksDB. Spark's default
    store holds one kind of state per operator, a ``StatefulProcessor`` has several;
    a session made elsewhere need not have SESSION_DEFAULTS. A stream that already
    has a checkpoint keeps the store named there."""
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, SESSION_DEFAULTS[name])


#: Parquet that is about as long as its rows are in memory: neither packed nor coded.
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}


def materialise(df, label: str = "snap", plain: bool = False):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return a frame reading it back: cuts lineage in a single job (a reliable
    RDD checkpoint would recompute the plan a second time) and survives
    executor loss because the files live in the shared folder.

    Spark takes the length of the files for the size of the rows when it decides on a
    broadcast; ``plain`` files keep that true for tables that joins look things up in
    (packed, millions of short rows pass for a few MB)."""
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/carelake-snapshots/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**(PLAIN if plain else {"compression": "zstd"})).parquet(path)
    return spark.read.parquet(path)


def materialise_dealt(df, label: str, by: str):
    """``materialise`` with the rows dealt by ``by`` on disk (a bucketed table over the
    same shared folder): joins and groupings that have ``by`` among their keys, run
    ``where_dealt``, read the rows where they are and move only the other side."""
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    mark = uuid.uuid4().hex
    name = f"carelake_{label.replace('-', '_')}_{mark}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(n, by).option("path", f"{base}/carelake-snapshots/{label}-{mark}")
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    return spark.table(name)


@contextmanager
def where_dealt(spark: SparkSession):
    """Joins planned inside keep rows that are dealt by some of the join's keys where
    they are; Spark's default deals both sides anew by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
