"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: (a long, b long), any direction, repeats allowed. Returns
    (id, comp): every id that has a link, with the smallest id it can reach.

    Each round takes the smallest label among neighbours and then follows
    the label's own label (pointer jumping), so long chains shrink fast. A
    hub is a hot key only in plain equi-joins (which Spark can split) and in
    ``min`` aggregates (combined map-side). Every round is written to the
    shared checkpoint folder, so lost executors cost one round at most."""
    both = materialise(
        edges.where("a <> b").select("a", "b")
        .unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "cc-edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                         .select("id", F.least("id", "m").alias("comp")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "a"), "a")
                .groupBy(F.col("b").alias("id")).agg(F.min("comp").alias("m")))
        step = labels.join(near, "id").select("id", F.least("comp", "m").alias("comp"), F.col("comp").alias("was"))
        step = materialise(step, "cc-step")
        jump = step.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        labels = materialise(
            step.join(jump, "comp", "left")
            .select("id", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "was"), "cc-labels")
        moved = labels.where("comp <> was").limit(1).count()
        labels = labels.select("id", "comp")
        if not moved:
            return labels
