"""Connected components of links, by passing the least label on and jumping along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import stored


def components(links: DataFrame, path: str) -> DataFrame:
    """node and label (the least node reachable) of all nodes of `links` (a, b); each round is stored under `path`.

    A round takes the least label among a node and its neighbours and then the label of that label,
    so chains shorten quickly. It ends when no label changes; only that fact reaches the driver.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    both = both.union(both.select("near", "node")).where("node <> near").distinct()
    both = stored(both, f"{path}/links")
    labels = both.groupBy("node").agg(F.least("node", F.min("near")).alias("label"))
    labels = stored(labels, f"{path}/labels0")
    for round_no in range(1, 1_000):
        near = both.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("label").alias("seen"))
        passed = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        jumped = passed.join(jump, "next").select("node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("changed"))
        jumped = stored(jumped, f"{path}/labels{round_no}")
        labels = jumped.select("node", "label")
        if jumped.where("changed").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
