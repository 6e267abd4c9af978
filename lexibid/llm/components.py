"""Connected components of links, by the smallest label in reach."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexibid.llm.common import discard, written


def smallest_labels(links: DataFrame) -> DataFrame:
    """The smallest node reachable from every linked node: ``node, label``, from ``a, b`` rows.

    Each round every node takes the smallest label among its own and its neighbours', then the
    label of that label, so labels travel ever further. Rounds are written to the shared folder
    and end when nothing changes. Minima combine within tasks, so a node with many links is
    one row per task.
    """
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = written(
            lowered.join(further, "label").select(
                "node", F.least("label", "beyond").alias("label"), (F.least("label", "beyond") < F.col("old")).alias("changed")
            ),
            "labels",
        )
        discard(labels)
        labels = moved.select("node", "label")
        if moved.where("changed").isEmpty():
            discard(both)
            return labels
