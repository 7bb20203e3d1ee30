"""Connected components of a link table, by alternating stars.

Links stay in Spark: each round is two joins and two aggregations over tables
written to the shared folder, so a lost executor costs its tasks only.  A node with
very many links is aggregated map-side, and the joins are between plain shuffles,
which adaptive execution splits when one node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.sources.tables import stage


def _is_star_forest(edges: DataFrame) -> bool:
    once = edges.agg(F.count("*").alias("n"), F.count_distinct("node").alias("d")).first()
    if once.n != once.d:
        return False
    return edges.join(edges.select(F.col("root").alias("node")), "node", "left_semi").isEmpty()


def _lowest(edges: DataFrame) -> DataFrame:
    return stage(edges.groupBy("node").agg(F.min("root").alias("low")), "lowest")


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root`` (smallest node it is connected with) for every node
    that is not its own root.

    ``links`` is undirected.  Self-links, repeated links and links with a null end
    count for nothing; no links give no rows.  Rounds grow with the logarithm of the
    longest path.
    """
    high, low = F.greatest(left, right), F.least(left, right)
    known = F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))
    edges = stage(
        links.filter(known).select(high.alias("node"), low.alias("root")).distinct(), "links"
    )
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        lowest = _lowest(both).withColumn("low", F.least("node", "low"))
        upper = stage(
            both.filter("root > node")
            .join(lowest, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .distinct(),
            "upper",
        )
        lowest = _lowest(upper)
        edges = stage(
            upper.join(lowest, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .filter("node <> root")
            .unionByName(lowest.withColumnRenamed("low", "root"))
            .distinct(),
            "edges",
        )
    return edges
