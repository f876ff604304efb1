"""Connected components of a table of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.groups import attach
from trackside.llm.store import keep


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) reaches.

    Every round a node takes the smallest label among its neighbours, and then its label's own
    label, so paths shorten by half. Labels are written to the shared folder each round; a
    node of any degree and a component of any size is joined without meeting in one task.
    """
    both = keep(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(),
        "links",
    )
    total = both.count()
    degrees = keep(both.groupBy("a").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    labels = degrees.select(F.col("a").alias("node"), "degree", F.col("a").alias("component"))
    while True:
        seen = attach(both, labels.withColumnRenamed("node", "b"), "b", "degree", total)
        lowest = seen.groupBy("a").agg(F.min("component").alias("lowest"))
        lower = keep(
            labels.join(lowest, labels["node"] == lowest["a"]).select(
                "node", "degree", F.col("component").alias("before"),
                F.least("component", "lowest").alias("component"),
            ),
            "lower",
        )
        sizes = lower.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
        roots = sizes.join(
            lower.select(F.col("node").alias("component"), F.col("component").alias("root")),
            "component",
        )
        labels = keep(
            attach(lower, keep(roots, "roots"), "component", "members", lower.count()).select(
                "node", "degree", "before", F.least("component", "root").alias("component")
            ),
            "labels",
        )
        if labels.filter("component <> before").isEmpty():
            return labels.select("node", "component")
        labels = labels.drop("before")
