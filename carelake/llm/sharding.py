"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Each shard has a preference order over the slots of a table of prime size: a
walk from its own offset with its own step. Shards take turns claiming their
most preferred free slot until the table is full. A key's hash picks a slot and
the table names the shard: one broadcast of a table whose size is a parameter,
and no shuffle. Shards get equal shares (to one part in the table size) and
adding or losing a shard moves few keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 32 shards on at least 100 slots a shard; the size is prime.
SHARDS = tuple(f"shard-{i:03d}" for i in range(32))
SLOTS = 3203


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def fill_table(shards: tuple[str, ...] | list[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. Small and fixed by its parameters: it has
    ``slots`` entries and never looks at data."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime, no smaller than the number of shards")
    offset = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    tried, table, free = [0] * len(shards), [""] * slots, slots
    while free:
        for i, shard in enumerate(shards):
            while table[at := (offset[i] + tried[i] * step[i]) % slots]:
                tried[i] += 1
            table[at] = shard
            free -= 1
            if not free:
                break
    return table


def table_frame(spark: SparkSession, shards, slots: int = SLOTS) -> DataFrame:
    """(slot int, shard string), made from one literal."""
    listed = F.split(F.lit("\n".join(fill_table(shards, slots))), "\n")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the
    table size, so any engine places keys alike. Null counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("bigint") % slots).cast("int")


def assign_shards(df: DataFrame, key_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS,
                  slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """All rows and columns of ``df`` plus slot and shard (columns of these
    names are replaced). Equal keys, null among them, share a shard; every row
    is placed, an empty table stays empty."""
    table = table_frame(df.sparkSession, shards, slots).toDF("__slot", "__shard")
    rest = [c for c in df.columns if c not in (slot_col, shard_col)]
    return (df.select(*rest, slot_of(F.col(key_col), slots).alias("__slot"))
            .join(F.broadcast(table), "__slot")
            .select(*rest, F.col("__slot").alias(slot_col), F.col("__shard").alias(shard_col)))


def write_shards(df: DataFrame, path: str, key_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS,
                 parts_per_shard: int = 8) -> None:
    """Write ``df`` as Parquet with one folder per shard. Each shard is split
    over ``parts_per_shard`` tasks by the whole row's hash, so a key that holds
    a third of all rows isn't written by one task."""
    placed = assign_shards(df, key_col, shards, slots)
    salt = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]), F.lit(parts_per_shard))
    (placed.withColumn("__salt", salt).repartition("shard", "__salt").drop("__salt")
     .write.mode("overwrite").partitionBy("shard").parquet(path))


def oracle_sql(shards=SHARDS, slots: int = SLOTS) -> str:
    """DuckDB SQL for slot and shard of every document: the table is filled
    anew, one claim per step of a recursion."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))
    number = "CAST('0x' || substr(md5('{0}:' || name), 1, 15) AS BIGINT)"
    return f"""
WITH RECURSIVE shard(i, name) AS (VALUES {names}),
pref AS MATERIALIZED (
  SELECT i, j, ({number.format('offset')} % {slots} + j * ({number.format('step')} % {slots - 1} + 1)) % {slots} AS slot
  FROM shard, range({slots}) r(j)),
turn(slot, i, t) USING KEY (slot) AS (
  SELECT slot, i, 0 FROM pref WHERE i = 0 AND j = 0
  UNION
  SELECT arg_min(p.slot, p.j), any_value(p.i), any_value(c.t) + 1
  FROM turn c JOIN pref p ON p.i = (c.t + 1) % {len(shards)}
  WHERE p.slot NOT IN (SELECT slot FROM recurring.turn)
  HAVING count(*) > 0)
SELECT d.doc_id, CAST(turn.slot AS INTEGER) AS slot, shard.name AS shard
FROM documents d
JOIN turn ON turn.slot = CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {slots}
JOIN shard ON shard.i = turn.i"""
