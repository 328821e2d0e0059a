"""Near-duplicate groups by HyperMinHash sketches.

A document's shingle hashes fall into REGISTERS buckets by their high bits.
The smallest value of a bucket is stored as a HyperMinHash register: its
count of leading zeros and the next MANTISSA bits. An empty bucket borrows the
register of the filled bucket that a fixed random ranking prefers, so short
documents band as well as long ones. BANDS groups of ROWS registers give the
candidate buckets. Candidates pass a Jaccard estimate that is corrected for
chance collisions of registers (with a margin of six standard errors), and
are then confirmed on full sets.

At Jaccard 0.8 a pair shares no band with a probability of
(1 - 0.8**6)**48, below 5e-7.

Skew: documents with equal sets become one class first. In a candidate bucket
every member is compared with the bucket's smallest id only; after components
are known, members outside the bucket's main component are compared with the
rest, so links that the first comparison can't see are not lost, and a bucket
of thousands of copies never becomes all its pairs. That second comparison
(and the first) is a join on the bucket whose condition holds an exact bound:
each document carries 64 * PARITY_WORDS bits, bit h being the parity of its
shingles that hash to h, so two documents differ in at least as many shingles
as these bits differ. Pairs that differ in too many are never made. The second
comparison deals each bucket's two sides to a grid of lanes of about LANE rows
a side, so a bucket with a third of all rows is many tasks and not one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.components import connected_components
from carelake.llm.shingles import mix, shingle_set, word_hashes
from carelake.session import materialise

BANDS, ROWS, MANTISSA = 48, 6, 10
REGISTERS = BANDS * ROWS
PARITY_WORDS = 32
#: Up to so many ids (8 bytes each) are broadcast to pick the texts to confirm;
#: beyond that, the texts are shuffled by id.
BROADCAST_IDS = 1_000_000
#: Rows a side that one lane of a bucket holds on average.
LANE = 1024
_U = np.uint64
_RANK = np.random.default_rng(7).random((REGISTERS, REGISTERS), dtype=np.float32)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """uint16 registers of a sorted, non-empty hash set. The high bits pick
    the bucket, so each bucket is a run and its first member the smallest."""
    spread = (hashes >> _U(32)) * _U(REGISTERS)
    bucket = (spread >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    filled, low = bucket[first], (spread[first] & _U(0xFFFFFFFF)).astype(np.float64)
    zeros = 31 - np.floor(np.log2(np.maximum(low, 0.5)))
    top = np.floor(low * 2.0 ** (zeros - 31 + MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
    code = ((zeros.astype(np.int64) << MANTISSA) | top).astype(np.uint16)
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[filled] = code
    if len(filled) < REGISTERS:
        empty = np.ones(REGISTERS, dtype=bool)
        empty[filled] = False
        hole = np.flatnonzero(empty)
        out[hole] = code[_RANK[np.ix_(hole, filled)].argmin(axis=1)]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(n, REGISTERS) registers -> (n, BANDS) int64 keys."""
    rows = registers.astype(np.uint64).reshape(len(registers), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key * _U(0x9FB21C651E98DF25) + rows[:, :, j])
    return key.view(np.int64)


def estimated_jaccard(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers of (n, REGISTERS) pairs, corrected for the
    chance that different minima share leading zeros and mantissa."""
    equal = (a == b).mean(axis=1)
    zeros_a, zeros_b = a >> MANTISSA, b >> MANTISSA
    chance = np.minimum((zeros_a == zeros_b).mean(axis=1) * 2.0 ** -MANTISSA, 0.5)
    return (equal - chance) / (1 - chance)


def parity(hashes: np.ndarray) -> np.ndarray:
    """PARITY_WORDS int64 words whose differing bits never outnumber the
    differing members of two sets."""
    odd = np.bincount((hashes & _U(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_reach(left: str, right: str, numerator: int, denominator: int):
    """Join condition on (n, par) of two sides: their sizes and parities allow
    the threshold. |A ^ B| <= (1 - t) / (1 + t) * (|A| + |B|) iff J >= t."""
    na, nb = F.col(f"n{left}"), F.col(f"n{right}")
    differ = sum((F.bit_count(F.get(f"p{left}", i).bitwiseXOR(F.get(f"p{right}", i))) for i in range(PARITY_WORDS)),
                 F.lit(0))
    return ((F.least(na, nb) * denominator >= F.greatest(na, nb) * numerator)
            & (differ * (denominator + numerator) <= (na + nb) * (denominator - numerator)))


def _lane(lanes: str):
    return F.pmod(F.xxhash64("id"), F.col(lanes))


def _each_lane(lanes: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(lanes) - 1))


def _sketch_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            n, c1, c2, regs, par = [], [], [], [], []
            for text in texts:
                own = shingle_set(word_hashes(text.as_py()), k)
                n.append(len(own))
                with np.errstate(over="ignore"):
                    c1.append(int(own.sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                    c2.append(int(mix(own + _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                regs.append(sketch(own).tobytes() if len(own) else None)
                par.append(parity(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                 pa.array(regs, pa.binary()), pa.array(par, pa.list_(pa.int64()))],
                names=["doc_id", "n", "c1", "c2", "regs", "par"])
    return run


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            regs = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(band_keys(regs).ravel(), pa.int64())],
                                             names=["id", "bucket"])


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own = [shingle_set(word_hashes(t.as_py()), k).tobytes() for t in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary())], names=["id", "items"])
    return run


def _estimate(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                        for c in (2, 3)]
                n = np.minimum(*(part.column(c).to_numpy(zero_copy_only=False) for c in (4, 5)))
                # Registers of short documents repeat; only distinct shingles are evidence.
                error = np.sqrt(threshold * (1 - threshold) / np.minimum(n, REGISTERS).clip(1))
                keep = estimated_jaccard(*regs) >= threshold - 6 * error
                yield part.select(["a", "b"]).filter(pa.array(keep))
    return run


def _confirm(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if min(len(a), len(b)) * denominator < max(len(a), len(b)) * numerator:
                    keep.append(False)
                    continue
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(denominator * both >= numerator * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, written out."""
    side = classes.select("id", "regs", "n", "par")
    likely = (pairs.join(side.toDF("a", "ra", "na", "pa"), "a").join(side.toDF("b", "rb", "nb", "pb"), "b")
              .where(_may_reach("a", "b", numerator, denominator))
              .select("a", "b", "ra", "rb", "na", "nb")
              .mapInArrow(_estimate(numerator / denominator), "a long, b long"))
    likely = materialise(likely, "near-dup-likely")
    ids = materialise(likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct(), "near-dup-ids")
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    # a doc_id that comes with several texts stands for the class of that text only
    sets = materialise(docs.join(ids, "id", "left_semi").select("id", "text")
                       .mapInArrow(_set_rows(k), "id long, items binary"), "near-dup-sets")
    return materialise(likely.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                       .select("a", "b", "sa", "sb")
                       .mapInArrow(_confirm(numerator, denominator), "a long, b long").distinct(), "near-dup-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    numerator: int = 80, denominator: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if ``denominator * |A & B| >= numerator * |A | B|``
    for their sets of distinct shingles. ``component_id`` is the smallest
    doc_id reachable over links. Null or empty texts have no shingles and are
    linked with nothing. Rows with a null id are linked with nothing either
    (component_id null, kept). Repeated rows share a component and are all
    returned; of equal ids with different texts each row goes with its own
    text. Other columns of the input are neither read nor returned. An empty
    table gives an empty result."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(docs.select(F.col("id").alias("doc_id"), "text").mapInArrow(
        _sketch_rows(shingle_words), "doc_id long, n long, c1 long, c2 long, regs binary, par array<long>"), "near-dup-sketches")
    member = rows.where("n > 0 AND doc_id IS NOT NULL")
    # the class of equal sets, represented by its smallest doc_id
    classes = materialise(member.groupBy("n", "c1", "c2").agg(F.min(F.struct("doc_id", "regs", "par")).alias("top"))
                          .select("n", "c1", "c2", F.col("top.doc_id").alias("id"), F.col("top.regs").alias("regs"),
                                  F.col("top.par").alias("par")),
                          "near-dup-classes")
    # sets below this size reach the threshold only by being equal
    least = -(-numerator // max(1, denominator - numerator))
    buckets = materialise(
        classes.where(F.col("n") >= least).select("id", "regs").mapInArrow(_band_rows, "id long, bucket long"),
        "near-dup-buckets")
    shared = (buckets.groupBy("bucket").agg(F.min("id").alias("head"), F.max("id").alias("last"))
              .where("head <> last").select("bucket", "head"))
    shared = materialise(shared, "near-dup-shared")
    held = materialise(buckets.join(shared, "bucket"), "near-dup-held")
    star = materialise(held.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(),
                       "near-dup-star")
    links = _verified(star, classes, docs, shingle_words, numerator, denominator)
    labels = connected_components(links)
    # what the comparison with the bucket's head can't see
    tagged = (held.join(labels, "id", "left").select("bucket", "id", "head", F.coalesce("comp", "id").alias("comp"))
              .join(labels.toDF("head", "head_comp"), "head", "left")
              .select("bucket", "id", "comp", F.coalesce("head_comp", "head").alias("main"), "head"))
    tagged = materialise(tagged, "near-dup-tagged")
    # only buckets with members outside their main component, each with its grid of lanes
    lanes = (tagged.groupBy("bucket").agg(F.count_if(F.expr("comp <> main")).alias("outer"),
                                           F.count_if(F.expr("id <> head")).alias("others"))
             .where("outer > 0").select("bucket", F.ceil(F.col("outer") / LANE).alias("out_lanes"),
                                        F.ceil(F.col("others") / LANE).alias("rest_lanes")))
    open_ = tagged.join(lanes, "bucket")
    size = classes.select("id", "n", "par")
    open_ = materialise(open_.join(size, "id"), "near-dup-open")
    # a row has one lane of its own side and is copied to each lane of the other
    out = (open_.where("comp <> main").select("bucket", F.col("id").alias("x"), F.col("comp").alias("cx"),
                                              F.col("n").alias("nx"), F.col("par").alias("px"), _lane("out_lanes").alias("row"),
                                              _each_lane("rest_lanes").alias("col")))
    rest = (open_.where("id <> head").select(F.col("bucket").alias("bucket_y"), F.col("id").alias("y"), F.col("comp").alias("cy"),
                                             F.col("n").alias("ny"), F.col("par").alias("py"),
                                             (F.col("comp") == F.col("main")).alias("inner"), _lane("rest_lanes").alias("col_y"),
                                             _each_lane("out_lanes").alias("row_y")))
    cell = [F.col(c) == F.col(f"{c}_y") for c in ("bucket", "row", "col")]
    near = [F.col("cx") != F.col("cy"), F.col("inner") | (F.col("x") < F.col("y")), _may_reach("x", "y", numerator, denominator)]
    more = (out.join(rest, cell + near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
            .join(star, ["a", "b"], "left_anti"))
    more = materialise(more, "near-dup-more")
    if more.limit(1).count():
        extra = _verified(more, classes, docs, shingle_words, numerator, denominator)
        labels = connected_components(links.unionByName(extra))
    component = (classes.join(labels, "id", "left")
                 .select("n", "c1", "c2", F.coalesce("comp", "id").alias("component_id")))
    return (rows.join(component, ["n", "c1", "c2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
