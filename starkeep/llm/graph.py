"""Connected components by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.sources.files import materialize


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(a, b)``.

    The component is the smallest node that can be reached. Self-loops and repeated edges do no
    harm; an edge with a null end is ignored; no edges give no rows. Each round links all
    neighbours of a node to the smallest among them, first upwards, then downwards, until all are
    linked to their root; the number of rounds grows with the logarithm of the longest path. Only
    two numbers a round reach the driver, and every round's edges are written to the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        label,
    )
    seen = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct()
            )
        seen = sign
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        up = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("low").alias("b"))
        up = up.filter(a != b).distinct()
        least = up.groupBy("a").agg(F.min("b").alias("low"))
        down = up.join(least, "a")
        down = down.select(b.alias("a"), F.col("low").alias("b")).union(down.select("a", "low"))
        now = materialize(down.filter(a != b).distinct(), label)
