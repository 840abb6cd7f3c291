"""Connected components of a table of links, as joins; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links (a, b)``; the component is its smallest id.

    Each round gives an id the least label among its neighbours' and its own, and then the label of
    that label, so paths shorten by more than half a round. Links may repeat and point either way. An
    empty table has no ids.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        met = labels.join(near, labels["id"] == near["a"]).select("id", "component", F.least("component", "c").alias("least"))
        jump = labels.select(F.col("id").alias("least"), F.col("component").alias("beyond"))
        after = met.join(jump, "least", "left").select(
            "id",
            F.least("least", "beyond").alias("component"),
            (F.least("least", "beyond") < F.col("component")).alias("moved"),
        )
        after = materialize(after, "labels")
        labels = after.select("id", "component")
        if after.where("moved").isEmpty():
            return labels
