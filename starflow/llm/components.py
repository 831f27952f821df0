"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import saved


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `links` (a, b), of any type that can be ordered.

    A component is named by its smallest node. Each round, a node takes the smallest
    name among its own and its neighbours', and then that name's own name, which doubles
    the distance covered. Neighbours' names are combined before the shuffle, and a
    node with very many links is a hot key only of a join, which AQE splits. Rounds are
    written, so that neither plans nor lost work pile up. Nothing but the number of
    changes comes to the driver.
    """
    both = saved(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    names = saved(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("component")),
        "names",
    )
    while True:
        heard = (
            both.join(names.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = names.join(heard, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "heard").alias("via")
        )
        jump = nearer.select(F.col("node").alias("via"), F.col("via").alias("next"))
        moved = saved(
            nearer.join(jump, "via").select(
                "node", F.least("via", "next").alias("component"), "was"
            ),
            "names",
        )
        done = moved.filter(F.col("component") != F.col("was")).isEmpty()
        names = moved.select("node", "component")
        if done:
            return names
