"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root) for every vertex of ``links``; root is the smallest vertex reachable.

    Each round gives a vertex the smallest label among its neighbours and then the label of that
    label, so rounds grow with the logarithm of the longest path.  Minima are taken before the
    shuffle, so a vertex with very many links sends one row a task; a round's labels are written,
    which bounds the lineage.  Only the number of changes comes to the driver."""
    one = links.select(F.col(a).alias("v"), F.col(b).alias("w"))
    both = written(one.unionByName(one.select(F.col("w").alias("v"), F.col("v").alias("w"))).distinct(), "links")
    label = written(both.groupBy("v").agg(F.min("w").alias("w"))
                    .select("v", F.least("v", "w").alias("root")), "labels")
    while True:
        near = (both.join(label.select(F.col("v").alias("w"), "root"), "w").groupBy("v")
                .agg(F.min("root").alias("near")))
        step = label.join(near, "v").select("v", F.col("root").alias("was"), F.least("root", "near").alias("mid"))
        # the label of the label: labels are vertices
        up = label.select(F.col("v").alias("mid"), F.col("root").alias("top"))
        step = written(step.join(up, "mid").select("v", "was", F.least("mid", "top").alias("root")), "labels")
        label = step.select("v", "root")
        if not step.filter("root != was").limit(1).count():
            return label
