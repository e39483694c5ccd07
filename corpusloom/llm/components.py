"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import as_table, drop_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Return (node, component) for every node on an edge; component is the smallest node reachable.

    Every step joins the links with each node's minimum, so a hub's links stay many rows
    (which adaptive execution splits) and are never gathered in one task. The steps
    are shuffles of the link table, which is written in the shared folder after each round.
    Null ends and self-links are ignored; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    now, path = as_table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
    )
    seen = _digest(now)
    while seen[0]:
        # large-star: every larger neighbour of u is linked to the smallest neighbour of u
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small-star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        )
        last, (now, path) = path, as_table(small)
        drop_table(spark, last)
        was, seen = seen, _digest(now)
        if was == seen:
            break
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")))
    return ends.groupBy("node").agg(F.min("component").alias("component"))


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
