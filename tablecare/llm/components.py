"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablecare.session import cut_lineage


def components(links: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(id, label) of every linked value: the smallest value that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains shrink by halves
    and stars end at once. A round is written to the shared folder; only the number of changes comes to the driver.
    """
    both = cut_lineage(links.select(F.col(x).alias("id"), F.col(y).alias("other")).unionAll(links.select(F.col(y).alias("id"), F.col(x).alias("other"))).distinct())
    labels = cut_lineage(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("id").alias("other"), "label"), "other").groupBy("id").agg(F.min("label").alias("seen"))
        nearer = labels.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "seen").alias("near"))
        jump = labels.select(F.col("id").alias("near"), F.col("label").alias("far"))
        moved = cut_lineage(nearer.join(jump, "near").select("id", "old", F.least("near", "far").alias("label")))
        changed = moved.where("old <> label").limit(1).count()
        labels = moved.select("id", "label")
        if not changed:
            return labels
