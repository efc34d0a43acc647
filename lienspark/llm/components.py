"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.llm.io import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of each linked node.

    ``links`` has columns ``a`` and ``b`` of one type, without nulls; repeated
    links and links to oneself change nothing. Each turn takes the smallest label
    of the neighbours and then the label of that label, so the turns grow with the
    logarithm of a component's width. Labels are written to the shared folder in
    each turn. A node with very many links is a hot key on one side of a plain
    join only, where adaptive execution cuts it.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("low"))
        nearest = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("before"), F.least("label", "low").alias("label")
        )
        nearest = written(nearest, "nearest")
        of = nearest.select(F.col("node").alias("via"), F.col("label").alias("next"))
        turned = written(
            nearest.join(of, nearest.label == of.via).select("node", F.col("next").alias("label"), (F.col("next") < F.col("before")).alias("moved")),
            "labels",
        )
        labels = turned.select("node", "label")
        if turned.where("moved").isEmpty():
            return labels
