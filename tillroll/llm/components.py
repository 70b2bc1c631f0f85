"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); a component is named by its smallest node.

    Every round a node takes the smallest name among its neighbours, then the
    name of its name, until no name changes: about as many rounds as the log of
    the longest path. Each round is a written table. Nodes with very many links
    meet as partial minima.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a <> b").distinct(), "links")
    names = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "names")
    while True:
        near = both.join(names, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        nearer = names.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("before"), F.least("component", F.coalesce("near", "component")).alias("named")
        )
        ends = names.select(F.col("node").alias("named"), F.col("component").alias("end"))
        jumped = nearer.join(ends, "named").select(
            "node", F.least("named", "end").alias("component"), (F.least("named", "end") != F.col("before")).alias("moved")
        )
        jumped = materialize(jumped, "names")
        names = jumped.select("node", "component")
        if jumped.filter("moved").isEmpty():
            return names
