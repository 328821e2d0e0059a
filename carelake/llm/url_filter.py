"""URL filter: longest-match rules, and gradient-boosted trees for the rest.

A rule is a host and a path prefix with a verdict; it fits its host and all
subdomains, and the longest fitting rule decides. URLs that rules decide are
the labelled URLs: boosted trees (Spark ML, on DataFrames) are trained on their
lexical features, and judge the URLs that no rule fits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import materialise

#: (rule, verdict), as the query uses them.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
#: At most so many labelled URLs are used for training: those with the
#: smallest hash, so the same ones at every layout.
TRAIN_ROWS = 20_000
TREES, DEPTH = 10, 4
FEATURES = ("url_length", "host_length", "path_length", "path_depth", "digit_ratio", "entropy", "parameters",
            "host_labels", "hyphens", "fragment", "secure", "last_segment_length", "suffix_block_rate", "suffix_seen")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty
    for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest fitting rule; nulls if none fits."""
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    out = none
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        cut = rule.index("/")
        fits = ((host == rule[:cut]) | host.endswith("." + rule[:cut])) & path.startswith(rule[cut:])
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(x: Column, c: str) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))).cast("double")


def _suffix() -> Column:
    return F.substring_index("host", ".", -2)


def lexical_features(df: DataFrame) -> DataFrame:
    """Adds the lexical features of url, host and path, and the host's suffix
    (its last two labels)."""
    url, n = F.coalesce("url", F.lit("")), F.greatest(F.length(F.coalesce("url", F.lit(""))), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    # Shannon entropy of the characters: one term per distinct character
    chars = F.filter(F.array_distinct(F.split(url, "")), lambda c: c != "")
    share = F.transform(chars, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    return df.select(
        "*", F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), _count(F.col("path"), "/").alias("path_depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("digit_ratio"),
        F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p)).alias("entropy"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1).alias("parameters"),
        F.when(F.col("host") == "", 0.0).otherwise(_count(F.col("host"), ".") + 1).alias("host_labels"),
        _count(url, "-").alias("hyphens"), F.contains(url, F.lit("#")).cast("double").alias("fragment"),
        F.startswith(url, F.lit("https")).cast("double").alias("secure"),
        F.length(F.element_at(F.split("path", "/"), -1)).cast("double").alias("last_segment_length"),
        _suffix().alias("suffix"))


def _with_suffix_statistics(df: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    return (df.join(stats, "suffix", "left")
            .withColumn("suffix_block_rate", F.coalesce("suffix_block_rate", F.lit(prior)))
            .withColumn("suffix_seen", F.coalesce("suffix_seen", F.lit(0.0))))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per row of
    ``pages``. ``verdict`` is the rule's where one fits, else the trees'
    (``block`` if their probability ``score`` reaches 0.5). Null and odd URLs
    have empty host and path and are judged by the trees. If the rules decide no
    URL, or all alike, there is nothing to learn: the share of blocked labelled
    URLs (0 without any) is the score. Other columns are not read."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    urls = urls.withColumn("m", match_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "url", "host", "path", "m.*")
    # Distinct first, so copies neither count nor fill the sample.
    labelled = (urls.where("verdict IS NOT NULL")
                .select("url", "host", "path", (F.col("verdict") == "block").cast("double").alias("label")).distinct())
    # Per suffix over all labelled URLs; the trees are fitted on a bounded sample of them.
    seen = materialise(labelled.groupBy(_suffix().alias("suffix")).agg(
        F.sum("label").alias("blocked"), F.count(F.lit(1)).cast("double").alias("n")), "url-suffixes")
    blocked, n = seen.agg(F.sum("blocked"), F.sum("n")).first()
    prior = blocked / n if n else 0.0
    train = materialise(lexical_features(labelled.orderBy(F.xxhash64("url"), "url").limit(TRAIN_ROWS)), "url-train")
    if train.agg(F.countDistinct("label")).first()[0] == 2:
        stats = seen.select("suffix", ((F.col("blocked") + prior * 4) / (F.col("n") + 4)).alias("suffix_block_rate"),
                            F.log1p("n").alias("suffix_seen"))
        pack = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(
            pack.transform(_with_suffix_statistics(train, stats, prior)).select("features", "label"))
        rest = _with_suffix_statistics(lexical_features(urls.where("verdict IS NULL")), stats, prior)
        judged = model.transform(pack.transform(rest)).select(
            "page_id", "host", "path", "rule", F.when(F.col("prediction") == 1, "block").otherwise("allow").alias("verdict"),
            _block_probability().alias("score"))
    else:
        share = float(prior)
        judged = urls.where("verdict IS NULL").select(
            "page_id", "host", "path", "rule", F.lit("block" if share >= 0.5 else "allow").alias("verdict"),
            F.lit(share).alias("score"))
    ruled = urls.where("verdict IS NOT NULL").select("page_id", "host", "path", "rule", "verdict",
                                                     F.lit(None).cast("double").alias("score"))
    return reduce(DataFrame.unionByName, [ruled, judged])


def _block_probability() -> Column:
    from pyspark.ml.functions import vector_to_array
    return F.get(vector_to_array("probability"), 1)
