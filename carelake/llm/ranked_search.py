"""Ranked lexical search by presence masks.

The items' terms are a small vocabulary. One pass over the whole texts keeps of
each document its number of terms and, for the vocabulary, term and count. A
second pass ranks: for up to DOCS documents at a time, each term gets a bitmap
of the documents that hold it, the bitmaps of an item's terms are turned into
one presence mask a document, and documents of equal mask are one group. The
best score a group can reach is the sum of its terms' greatest contributions
among these documents. Groups are scored exactly, greatest bound first, until
the next bound lies below the item's current k-th score. A task carries its
k best per item over all its documents and returns those only; two ranked
steps merge them.

Items are taken in blocks of about TERMS terms, so what a task and the driver
hold of them is bounded whatever the number of items. Documents are never
limited.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import materialise

TERMS = 20_000
DOCS = 4096
#: First-step groups of the final ranking, per item.
MERGE = 64

#: A-Z become a-z; 0-9, a-z and all bytes of other characters stay; the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    return text.translate(_FOLD).split() if text else []


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            own = set(terms_of(text.as_py()))
            ids += [i] * len(own)
            terms += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])


def _count_rows(vocabulary: dict[bytes, int]):
    """Per document with terms: id, number of terms, vocabulary terms and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                tf = Counter(map(vocabulary.get, words))
                tf.pop(None, None)
                ids.append(i)
                n.append(len(words))
                terms.append(list(tf))
                counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "counts"])
    return run


def _frequency_rows(size: int):
    """Documents per term, added up within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], names=["term", "df"])
    return run


def presence_masks(bitmaps: np.ndarray, docs: int) -> np.ndarray:
    """(terms, docs / 8) bitmaps -> (docs, words) masks, 64 terms to a word."""
    k = len(bitmaps)
    masks = np.packbits(np.unpackbits(bitmaps, axis=1, count=docs), axis=0)
    out = np.zeros((docs, 8 * -(-k // 64)), dtype=np.uint8)
    out[:, :len(masks)] = masks.T
    return out.view(np.uint64)


class Best:
    """An item's k best documents so far: greatest score first, then smallest id
    (documents without an id last)."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.nameless, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def floor(self) -> int:
        """No document below this score can enter any more."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, nameless: np.ndarray, doc: np.ndarray) -> None:
        use = score >= self.floor()
        score, nameless, doc = (np.concatenate(p) for p in (
            (self.score, score[use]), (self.nameless, nameless[use]), (self.doc, doc[use])))
        order = np.lexsort((doc, nameless, -score))[:self.k]
        self.score, self.nameless, self.doc = score[order], nameless[order], doc[order]


class DocumentBlock:
    """Postings, bitmaps and contributions of up to DOCS documents."""

    def __init__(self, n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray,
                 total_docs: int, total_terms: int):
        self.size = len(n)
        if int(n.max()) * 50 * total_docs < 1 << 63:
            m = 50 + (50 * n * total_docs) // total_terms
        else:
            m = np.array([50 + 50 * int(x) * total_docs // total_terms for x in n], dtype=np.int64)
        rows = np.repeat(np.arange(self.size), lengths)
        order = np.argsort(terms, kind="stable")
        terms, self.rows, counts = terms[order], rows[order], counts[order]
        part = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m[self.rows]))
        first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else np.zeros(0, np.int64)
        self.ends = np.append(first, len(terms))
        self.part = part
        self.rank = np.full(len(weights), -1)
        self.rank[terms[first]] = np.arange(len(first))
        self.greatest = np.maximum.reduceat(part, first) if len(first) else np.zeros(0, np.int64)
        width = -(-self.size // 8)
        bits = np.zeros((len(first), width * 8), dtype=bool)
        bits[np.repeat(np.arange(len(first)), np.diff(self.ends)), self.rows] = True
        self.bitmaps = np.packbits(bits, axis=1)

    def scores(self, present: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` (ascending rows) over the terms ``present``."""
        out = np.zeros(len(docs), dtype=np.int64)
        for t in present:
            rows, part = self.rows[self.ends[t]:self.ends[t + 1]], self.part[self.ends[t]:self.ends[t + 1]]
            at = np.minimum(np.searchsorted(rows, docs), len(rows) - 1)
            out += np.where(rows[at] == docs, part[at], 0)
        return out

    def search(self, item: np.ndarray, best: Best, nameless: np.ndarray, ids: np.ndarray) -> int:
        """Adds this block's documents to ``best``; returns how many were scored."""
        present = self.rank[item]
        present = present[present >= 0]
        present = present[self.greatest[present] > 0]
        if not len(present) or int(self.greatest[present].sum()) < best.floor():
            return 0
        masks = presence_masks(self.bitmaps[present], self.size)
        if masks.shape[1] == 1:
            groups, group = np.unique(masks[:, 0], return_inverse=True)
            groups = groups.reshape(-1, 1)
        else:
            groups, group = np.unique(masks, axis=0, return_inverse=True)
            group = group.reshape(-1)
        held = np.unpackbits(np.ascontiguousarray(groups).view(np.uint8), axis=1, count=len(present))
        bound = held.astype(np.int64) @ self.greatest[present]
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        by_group = np.argsort(place[group], kind="stable")
        ends = np.cumsum(np.bincount(place[group], minlength=len(order)))
        at, scored, step = 0, 0, 2 * best.k
        while at < len(bound) and bound[at] >= best.floor():
            # next groups, enough for about ``step`` documents, none below the floor
            to = max(at + 1, int(np.searchsorted(ends, scored + step)))
            to = min(to, int(np.searchsorted(-bound, -best.floor(), side="right")))
            docs = np.sort(by_group[scored:ends[to - 1]])
            best.add(self.scores(present, docs), nameless[docs], ids[docs])
            at, scored, step = to, int(ends[to - 1]), 2 * step
        return scored


def _search_rows(items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, total_docs: int, total_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS):
                batch = whole.slice(at, DOCS)
                terms = batch.column(2)
                nameless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                block = DocumentBlock(
                    batch.column(1).to_numpy(), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(),
                    batch.column(3).flatten().to_numpy(), weights, total_docs, total_terms)
                for (_, item), top in zip(items, best, strict=True):
                    block.search(item, top, nameless, ids)
        for (item_id, _), top in zip(items, best, strict=True):
            if len(top.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * len(top.score), pa.int64()), pa.array(top.doc, pa.int64(), mask=top.nameless),
                     pa.array(top.score, pa.int64())], names=["item_id", "doc_id", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` documents of greatest
    score above 0, ties by ascending doc_id.

    The score sums, over the item's distinct terms, weight (from the number of
    documents that hold the term) times saturated frequency (from its count and
    the document's length); all but the logarithm is integer. Null and empty
    texts have no terms. Rows that repeat a doc_id are documents of their own;
    those without an id count like others and come last among equal scores. Rows
    that repeat an item_id (null among them) are one item with the terms of all.
    Items without terms and empty tables give no rows. Other columns are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    wanted = materialise(
        items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
        .mapInArrow(_item_rows, "item_id long, term binary").distinct(), "search-items")
    blocks = -(-wanted.count() // TERMS)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    stats = None
    for b in range(blocks):
        # about TERMS rows: bounded, whatever the number of items
        mine = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in mine}))}
        if not vocabulary:
            continue
        by_item: dict[int | None, list[int]] = {}
        for r in mine:
            by_item.setdefault(r.item_id, []).append(vocabulary[bytes(r.term)])
        lists = [(i, np.array(sorted(t), dtype=np.int64)) for i, t in by_item.items()]
        counted = materialise(docs.mapInArrow(_count_rows(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>"),
                              "search-counts")
        if stats is None:
            stats = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in (counted.select("terms").mapInArrow(_frequency_rows(len(vocabulary)), "term long, df long")
                  .groupBy("term").agg(F.sum("df").alias("df")).collect()):  # at most one row per vocabulary term
            df[r.term] = r.df
        weights = np.floor(1000 * np.log((2 * stats.docs + 2) / (2 * df + 1))).astype(np.int64)
        found = found.unionByName(counted.mapInArrow(
            _search_rows(lists, weights, stats.docs, stats.terms, k), "item_id long, doc_id long, score long"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # a task returns at most k rows an item; these merge in two steps
    part = found.withColumn("part", F.spark_partition_id() % MERGE)
    first = part.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("r") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return (first.select("item_id", "doc_id", "score").withColumn("rank", rank).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
