"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

Words (runs of letters, digits or ``_``, lower-cased) are hashed to 64 bits.
Each fixed mask of MASKS keeps five positions of a window and ignores the
others, so a hit survives substituted words at the ignored positions. The
seeds of every document window are joined with the seeds of the benchmark;
each hit fixes an alignment of an item against the text, which is verified at
once: some window of ``min(WINDOW, item length)`` aligned words must agree in
at least 80 of 100 positions. Items shorter than WINDOW have masks of their own
(SHORT_MASKS; below five words the whole item), which miss no allowed
substitution; texts are cut by them only if the benchmark holds such items.

Only hits (document, item, alignment) leave a task, after a map-side
distinct, so a passage that a third of all documents share costs one row per
document; the texts of those documents are then read once more to verify.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 5, 8))
#: For items of 5 to 12 words; five words need all of them, more the first two.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 1, 2, 4), (0, 2, 3, 4))
#: For items of one to four words, which must agree as a whole.
WHOLE_MASKS = tuple(tuple(range(n)) for n in range(1, 5))
ALL_MASKS = MASKS + SHORT_MASKS + WHOLE_MASKS
WINDOW = 13
NUMERATOR, DENOMINATOR = 80, 100
#: The benchmark's seeds are broadcast below this many, else joined by shuffle.
BROADCAST_SEEDS = 500_000
NOT_WORD = r"[^\p{L}\p{N}_]+"


def word_hashes(text: Column) -> Column:
    """array<bigint>: one hash per word, empty for null or no words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _masks_for(words: int) -> tuple[int, ...]:
    """Numbers (in ALL_MASKS) of the masks for items of so many words."""
    if words >= WINDOW:
        return tuple(range(len(MASKS)))
    if words > 4:
        return tuple(range(len(MASKS), len(MASKS) + (4 if words == 5 else 2)))
    return (len(MASKS) + len(SHORT_MASKS) + words - 1,)


def _seeds(hashes: Column, at: Column, masks) -> Column:
    """The seeds that start at 0-based ``at``: array of (mask, seed); a mask
    that runs past the end gives a null seed."""
    return F.array(*[
        F.struct(F.lit(m).alias("mask"),
                 F.when(at + ALL_MASKS[m][-1] < F.size(hashes),
                        F.xxhash64(F.lit(m), *[F.get(hashes, at + j) for j in ALL_MASKS[m]])).alias("seed"))
        for m in masks])


def _windows(rows: DataFrame, masks) -> DataFrame:
    """Every seed of every window of ``rows`` (id, h): id, at, seed. One stage
    of generated code; the word arrays are never copied per window."""
    least = min(ALL_MASKS[m][-1] + 1 for m in masks)
    at = F.when(F.size("h") >= least, F.sequence(F.lit(0), F.size("h") - least))
    return (rows.select("*", F.explode(at).alias("at"))
            .select("id", "at", F.explode(_seeds(F.col("h"), F.col("at"), masks)).alias("s"))
            .select("id", "at", F.col("s.seed").alias("seed")).where("seed IS NOT NULL"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, matched_words, item_words): the pairs where the document
    holds the item's words with at most one in five substituted over a window
    of 13 words (or the whole item, if shorter); matched_words counts agreeing
    positions of the best alignment over the whole item.

    Null ids and null texts match nothing; items or texts without words match
    nothing. Repeated rows and ties give one row per (doc_id,
    item_id). Other columns are not read. Empty tables give an empty result."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("id"), word_hashes(F.col(item_text_col)).alias("h")).distinct()
    # items without words match nothing; the others have at most five words a seed
    items = items.where(F.size("h") > 0)
    # the masks in use, each with the lengths of the items it is for (WINDOW: or more)
    length = F.least(F.size("h"), F.lit(WINDOW))
    lengths = {}
    for (n,) in items.select(length).distinct().collect():
        lengths.setdefault(_masks_for(n), []).append(n)
    lengths = lengths or {_masks_for(WINDOW): [WINDOW]}
    masks = sorted({m for group in lengths for m in group})
    seeds = reduce(DataFrame.unionByName, [
        _windows(items.where(length.isin(of)), group).withColumn("whole", F.lit(max(of) < 5)) for group, of in lengths.items()])
    seeds = seeds.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "seed", "whole").distinct()
    items = items.toDF("item_id", "item_h")
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        seeds, items = F.broadcast(seeds), F.broadcast(items)
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hits = (_windows(docs.select("id", word_hashes(F.col("text")).alias("h")), masks).join(seeds, "seed")
            .select("id", "item_id", (F.col("at") - F.col("item_at")).alias("start"), "whole"))
    # where the seed is the whole item, one alignment says as much as all
    hits = (hits.groupBy("id", "item_id", F.when(~F.col("whole"), F.col("start")).alias("of"))
            .agg(F.min("start").alias("start")).drop("of"))
    # item word j stands against text word start + j; words outside the text don't agree
    agree = F.transform("item_h", lambda w, j: F.coalesce(
        (F.get(F.col("h"), F.col("start") + j) == w) & (F.col("start") + j >= 0), F.lit(False)).cast("int"))
    total = F.aggregate("agree", F.lit(0), lambda s, x: s + x)
    passes = F.exists(F.sequence(F.lit(1), F.size("agree") - F.col("width") + 1),
                      lambda i: F.aggregate(F.slice("agree", i, F.col("width")), F.lit(0), lambda s, x: s + x)
                      * DENOMINATOR >= F.col("width") * NUMERATOR)
    # only the texts of documents with a hit are looked at again
    return (hits.join(items, "item_id").join(docs, "id")
            .select("id", "item_id", "item_h", "start", word_hashes(F.col("text")).alias("h"))
            .select("id", "item_id", agree.alias("agree"), F.least(F.lit(WINDOW), F.size("item_h")).alias("width"))
            .select("id", "item_id", F.when(passes, total).alias("matched"), F.size("agree").alias("words"))
            .groupBy(F.col("id").alias("doc_id"), "item_id")
            .agg(F.max("matched").alias("matched_words"), F.max("words").alias("item_words"))
            .where("matched_words IS NOT NULL"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, that hold no benchmark item.
    Rows with a null id stay."""
    # Only the ids of contaminated documents are shuffled against the table.
    bad = contamination(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
