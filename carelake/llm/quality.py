"""Quality scores by Bradley-Terry pairwise ranking.

Each document has a vector of surface features. Preference pairs set a
document of quality 1 over one of quality 0; a linear score is learned by the
logistic loss on feature differences, without intercept, so only the order
matters. The quantile of the scores at the share of rejected documents becomes
the threshold, and the distance from it, through the logistic function, the
score in 0..1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.keys import dense_keys
from carelake.operators.scan import quantiles
from carelake.session import materialise

#: Pairs for each preferred document. Weights and threshold come from all labelled
#: documents; the bound of earlier versions is gone and its name has no effect.
TRAIN_PER_LABEL, PAIRS_EACH = None, 4
FEATURES = ("log_words", "log_chars", "word_length", "distinct_words", "repeated_neighbours", "commonest_word",
            "symbols", "pipes", "digits", "capitals", "stops", "lines_per_word", "repeated_lines", "sentence_words",
            "long_words", "non_ascii", "markup")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True


def features(text: str | None) -> list[float]:
    """The feature vector; all zeros for null, empty or blank texts."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, chars = len(words), len(raw)
    sizes = list(map(len, words))
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = int(count[46] + count[33] + count[63])
    return [float(np.log1p(n)), float(np.log1p(chars)), sum(sizes) / n, len(seen) / n,
            sum(map(eq, words, words[1:])) / n, max(seen.values()) / n,
            float(count[_SYMBOL].sum()) / chars, float(count[124]) / n, float(count[48:58].sum()) / chars,
            float(count[65:91].sum()) / chars, ends / n, len(lines) / n, 1 - len(set(lines)) / len(lines),
            min(n / (ends + 1), 200.0) / 200.0, sum(s > 20 for s in sizes) / n, float(count[128:].sum()) / chars,
            float(count[60] + count[62]) / n]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])


def _dot(x: str, weights) -> Column:
    return sum((F.get(x, i) * float(w) for i, w in enumerate(weights)), F.lit(0.0))


def learn(sample: DataFrame) -> tuple[list[float], float]:
    """Weights on the raw features and the threshold, from (doc_id, x, label).
    Zeros if one of the labels is missing. Nothing but sums, weights and one
    quantile reaches the driver."""
    k = len(FEATURES)
    share = sample.agg(F.avg("label"), F.countDistinct("label")).first()
    if share[1] != 2:
        return [0.0] * k, 0.0
    spread = sample.agg(*[F.stddev_pop(F.get("x", i)) for i in range(k)]).first()
    scale = [1.0 / s if s and s > 1e-9 else 0.0 for s in spread]
    placed = sample.withColumn("_place", F.xxhash64("doc_id"))
    good, bad = (dense_keys(placed.where(F.col("label") == v), ["_place", "doc_id"], "i", start=0).select("i", "x") for v in (1, 0))
    n_bad = bad.count()
    pairs = (good.select("x", F.explode(F.sequence(F.lit(0), F.lit(PAIRS_EACH - 1))).alias("s"), "i")
             .select("x", ((F.col("i") * PAIRS_EACH + F.col("s")) % n_bad).alias("i"), "s")
             .join(bad.withColumnRenamed("x", "y"), "i"))
    sign = F.when((F.col("i") + F.col("s")) % 2 == 0, 1.0).otherwise(-1.0)
    apart = F.array(*[(F.get("x", i) - F.get("y", i)) * scale[i] * F.col("sign") for i in range(k)])
    data = materialise(pairs.withColumn("sign", sign).select(
        array_to_vector(apart).alias("features"), (F.col("sign") > 0).cast("double").alias("label")), "quality-pairs")
    fit = LogisticRegression(fitIntercept=False, standardization=False, regParam=1e-3, maxIter=60).fit(data)
    weights = [float(w) * s for w, s in zip(fit.coefficients, scale, strict=True)]
    scores = sample.select(F.lit(0).alias("all"), _dot("x", weights).alias("raw"))
    return weights, float(quantiles(scores, "all", "raw", {"threshold": 1 - float(share[0])}).first()["threshold"])


def quality_scores(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    ``held_out`` is a Column over doc_id; labels of such rows are never read.
    Labels other than 0 and 1 are ignored. Null, empty and blank texts are
    scored by their (zero) features; null ids are kept, with held_out false.
    Without labels of both kinds every score is 0.5. Repeated rows are scored
    alike. Other columns are not read."""
    ids = docs.schema[id_col].dataType.simpleString()
    x = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                    .mapInArrow(_feature_rows, f"doc_id {ids}, x array<double>"), "quality-features")
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("label IN (0, 1)").where(~held_out).groupBy("doc_id").agg(F.max("label").alias("label")))
    sample = materialise(x.join(known, "doc_id").select("doc_id", "x", "label"), "quality-labelled")
    weights, threshold = learn(sample)
    score = 1 / (1 + F.exp(-F.greatest(F.least(_dot("x", weights) - threshold, F.lit(500.0)), F.lit(-500.0))))
    return (x.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
