"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into blocks. A first pass compares the
queries with the longest vectors, which gives each query a lower bound of its
k-th best product. For every other block the bound becomes a local cosine
threshold, bound / (|query| * longest of the block): above 1 the block is
skipped; at or above COORDINATE_FROM candidates are pruned by the range that
the query's largest coordinates leave for theirs; below that by their length
alone. Products of what remains are exact integers.

Work is dealt to a grid of groups of query blocks and lanes of vector blocks. A
cell holds the query blocks of its group (about HELD bytes, or one block) and
streams the vector blocks of its lane past them, whatever many equal vectors
there are. A vector block goes to the groups in which some query can gain from it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import materialise

BLOCK, QUERY_BLOCK = 1024, 256
#: Vectors per range partition, and how many of the longest blocks give the bounds.
PER_PARTITION, FIRST_BLOCKS = 8192, 2
COORDINATE_FROM, FOCUS = 0.6, 3
#: Bytes of query blocks held beside the vector blocks that stream past.
HELD = 64 << 20
PAIR = "query_id long, vec_id long, score long"


@contextmanager
def _small_batches(spark, rows: int):
    """Block rows are large: hand few of them to a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, was)


def _pack(size: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, made = [], [], 0

        def flush():
            nonlocal ids, rows, made
            width = max(map(len, rows))
            block = np.zeros((len(rows), width), dtype=np.int64)
            for i, r in enumerate(rows):
                block[i, :len(r)] = r
            norm = float(np.sqrt((block.astype(np.float64) ** 2).sum(axis=1).max()))
            out = pa.RecordBatch.from_arrays(
                [pa.array([min(ids)], pa.int64()), pa.array([norm]), pa.array([width], pa.int32()),
                 pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()), pa.array([block.tobytes()], pa.binary())],
                names=[f"{kind}_{n}" for n in ("key", "norm", "width", "ids", "block")])
            ids, rows, made = [], [], made + 1
            return out

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(rows) == size:
                    yield flush()
        if rows:
            yield flush()
    return run


def _blocks(vectors: DataFrame, size: int, kind: str) -> DataFrame:
    return vectors.select("vec_id", "v").mapInArrow(
        _pack(size, kind), ", ".join(f"{kind}_{c}" for c in ("key long", "norm double", "width int", "ids binary", "block binary")))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a with the rows of b."""
    size = np.sqrt((a.astype(np.float64) ** 2).sum(axis=1).max(initial=0) * (b.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    if size < 2.0 ** 52:  # every partial sum is an exact double
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = ids != own
    scores, ids = scores[other], ids[other]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = scores >= least
        scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _cap_range(d: float, t: float) -> tuple[float, float]:
    """Least and largest coordinate of the unit vectors whose cosine with a
    unit vector is at least ``t``, where that vector's coordinate is ``d``."""
    spread = np.sqrt(max(0.0, (1 - d * d) * (1 - t * t)))
    return -1.0 if d <= -t else d * t - spread, 1.0 if d >= t else d * t + spread


def _search_block(q: np.ndarray, q_ids: np.ndarray, bound: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int):
    """(query_id, vec_id, score) arrays: per query the best k of the block that
    can still matter. ``bound`` is NaN where a query has no bound yet."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    q_len, c_len = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (q, c))
    order = np.argsort(-c_len, kind="stable")
    c, c_len, c_ids = c[order], c_len[order], c_ids[order]
    slack = 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        local = bound / (q_len * c_len[0])
    local = np.where(np.isnan(bound) | (q_len * c_len[0] == 0), -1.0, local)
    out = []
    by_length = np.flatnonzero(local < COORDINATE_FROM)
    if len(by_length):
        # the shortest candidate that can reach the bound of any of these queries
        need = np.where(local[by_length] > 0, local[by_length] * c_len[0], 0.0).min()
        reach = int(np.searchsorted(-c_len, -need * (1 - slack), side="right"))
        scores = _products(q[by_length], c[:reach])
        for row, i in enumerate(by_length):
            out.append((i, *_best(scores[row], c_ids[:reach], q_ids[i], k)))
    if len(by_length) < len(q):
        unit = c / np.maximum(c_len, 1e-300)[:, None]
        for i in np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1 + slack)):
            t, direction = min(local[i], 1.0), q[i] / q_len[i]
            live = c_len >= bound[i] / q_len[i] * (1 - slack)
            for f in np.argsort(-np.abs(direction))[:FOCUS]:
                least, most = _cap_range(direction[f], t)
                live &= (unit[:, f] >= least - 1e-7) & (unit[:, f] <= most + 1e-7)
            if live.any():
                out.append((i, *_best(_products(q[i:i + 1], c[live])[0], c_ids[live], q_ids[i], k)))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return (np.concatenate([np.full(len(s), q_ids[i], np.int64) for i, s, _ in out]),
            np.concatenate([d for _, _, d in out]), np.concatenate([s for _, s, _ in out]))


def _grid(query_bytes: int, vector_bytes: int, query_blocks: int, tasks: int) -> tuple[int, int]:
    """Groups of query blocks and lanes of vector blocks, about ``tasks`` cells.

    Vector blocks are copied to the groups and query blocks to the lanes: the
    copies are fewest where both sides ship alike, unless HELD asks for more groups."""
    even = math.sqrt(tasks * query_bytes / max(vector_bytes, 1))
    groups = max(1, min(query_blocks, tasks, round(even)), -(-query_bytes // HELD))
    return groups, max(1, -(-tasks // groups))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, c_ids = (np.frombuffer(r[f"{x}_ids"], np.int64) for x in "qc")
                q, c = (np.frombuffer(r[f"{x}_block"], np.int64).reshape(len(n), r[f"{x}_width"])
                        for x, n in (("q", q_ids), ("c", c_ids)))
                bound = np.frombuffer(r["bound"], np.float64) if r.get("bound") else np.full(len(q), np.nan)
                found = _search_block(q, q_ids, bound, c, c_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])
    return run


def _with_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bounds = []
        for r in batch.select(["q_ids", "known"]).to_pylist():
            have = {x["query_id"]: x["score"] for x in r["known"] or []}
            bounds.append(np.array([have.get(i, np.nan) for i in np.frombuffer(r["q_ids"], np.int64)], np.float64).tobytes())
        q_len = [np.sqrt((np.frombuffer(b, np.int64).reshape(len(n) // 8, w).astype(np.float64) ** 2).sum(axis=1))
                 for b, n, w in zip(*(batch.column(c).to_pylist() for c in ("q_block", "q_ids", "q_width")), strict=True)]
        # the length below which no vector matters to any query of the block; 0 if some query has no bound
        need = []
        for b, n in zip(bounds, q_len, strict=True):
            b = np.frombuffer(b, np.float64)
            need.append(0.0 if np.isnan(b).any() else float(np.where(n > 0, b / np.maximum(n, 1e-300), 0).min(initial=np.inf)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("q_key", "q_norm", "q_width", "q_ids", "q_block")]
            + [pa.array(bounds, pa.binary()), pa.array(need, pa.float64())],
            names=["q_key", "q_norm", "q_width", "q_ids", "q_block", "bound", "need"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "v") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest integer inner
    products over all vectors but those with its own id, ties to the smaller id;
    fewer if there are fewer vectors.

    Both tables hold an id and an array<bigint>. Null ids, null vectors and
    vectors with null components take no part. Missing components of shorter
    vectors, even all of them, count as 0. Repeated rows count once; an id with
    several vectors asks as one query, its products with all of them ranked
    together. Products must fit a long.
    Other columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession

    def clean(df):
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
                .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
                .distinct())

    vectors = materialise(clean(vectors).withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)), "topk-vectors")
    parts = max(1, -(-vectors.count() // PER_PARTITION))
    longest = vectors.repartitionByRange(parts, F.desc("norm2"), "vec_id").sortWithinPartitions(F.desc("norm2"), "vec_id")
    asked = clean(queries).repartitionByRange(F.col("vec_id"))
    with _small_batches(spark, 2048):
        blocks = materialise(_blocks(longest, BLOCK, "c"), "topk-blocks")
        asked = materialise(_blocks(asked, QUERY_BLOCK, "q"), "topk-queries")
    # equal longest norms: the key decides, so the first blocks are the same on every read
    first = materialise(blocks.orderBy(F.desc("c_norm"), "c_key").limit(FIRST_BLOCKS), "topk-first")
    tasks = 2 * spark.sparkContext.defaultParallelism
    with _small_batches(spark, 16):
        start = asked.repartition(tasks, "q_key").withColumn("s", F.lit(0)).join(F.broadcast(first.withColumn("s", F.lit(0))), "s")
        seen = materialise(start.drop("s").mapInArrow(_search(k), PAIR), "topk-seen")
        place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        kth = seen.withColumn("rank", F.row_number().over(place)).where(F.col("rank") == k).select("query_id", "score")
        of = asked.select("q_key", "q_ids").mapInArrow(_members, "q_key long, query_id long")
        known = of.join(kth, "query_id").groupBy("q_key").agg(F.collect_list(F.struct("query_id", "score")).alias("known"))
        bounded = materialise(asked.join(known, "q_key", "left").mapInArrow(
            _with_bounds, "q_key long, q_norm double, q_width int, q_ids binary, q_block binary, bound binary, need double"),
            "topk-bounded")
        same = F.xxhash64("c_ids", "c_block").alias("same")  # an id with many vectors may give several blocks one key
        rest = blocks.select("*", same).join(first.select("c_key", "c_norm", same), ["c_key", "c_norm", "same"], "left_anti").drop("same")
        queries_size = bounded.agg(F.count("*"), F.sum(F.length("q_block"))).first()
        groups, lanes = _grid(queries_size[1] or 0, rest.agg(F.sum(F.length("c_block"))).first()[0] or 0, queries_size[0], tasks)
        grouped = bounded.withColumn("group", F.pmod(F.xxhash64("q_key", "q_ids"), F.lit(groups)).cast("int"))
        # a block goes to the groups, and meets the query blocks, in which some query can still gain from it
        gain = F.col("c_norm") * (1 + 1e-9) >= F.col("need")
        least = grouped.groupBy("group").agg(F.min("need").alias("need")).withColumn("s", F.lit(0))
        dealt = (rest.withColumn("s", F.lit(0)).join(F.broadcast(least), "s").where(gain).drop("s", "need")
                 .withColumn("lane", F.pmod(F.xxhash64("c_key", "c_norm"), F.lit(lanes)).cast("int")))
        copied = grouped.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
        cells = (dealt.repartition(groups * lanes, "group", "lane")
                 .join(copied.repartition(groups * lanes, "group", "lane"), ["group", "lane"]).where(gain))
        more = materialise(cells.drop("group", "lane", "need").mapInArrow(_search(k), PAIR), "topk-more")
    return (seen.unionByName(more).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key)), pa.array(own)], names=["q_key", "query_id"])


def scaled_integers(vector: Column) -> Column:
    """floor(256 * x) of each component, as longs; null where a component is
    null or not finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(fine, F.transform(x, lambda c: F.floor(c * 256)))
