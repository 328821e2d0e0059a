"""Access to the driver-provided parquet tables.

Each table is read lazily; callers select only the columns they use so the
parquet scan prunes (``ReadSchema``) and filters reach ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")
#: What the star schema and the event feeds are built from.
STAR_TABLES = TABLE_NAMES[:8]


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        return self.spark.read.parquet(self.path(name))

    def version(self, names: tuple[str, ...] = STAR_TABLES) -> int:
        """A number that changes when a file of these tables is added, removed
        or rewritten. Only file names, lengths and times are read, in tasks."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(f"{self.sf_dir}/{{{','.join(names)}}}.parquet"))
        mark = F.xxhash64("path", "length", "modificationTime")
        return files.agg(F.coalesce(F.bit_xor(mark), F.lit(0))).first()[0]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
