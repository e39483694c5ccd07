"""Link resolution and degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.state import checkpointed, stored


def first_by_path(pages: DataFrame, *order: str) -> DataFrame:
    """One row per path, the first in ``order``."""
    nth = F.row_number().over(Window.partitionBy("path").orderBy(*order))
    return pages.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def numbered_paths(pages: DataFrame) -> DataFrame:
    """(id, path): the different paths numbered from 1 in their order.

    Paths are range-partitioned and numbered in each range; the numbers before a range are a sum over one row per range.
    """
    ranged = checkpointed(pages.select("path").distinct().repartitionByRange("path").withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("path"))
    return ranged.withColumn("nth", nth).join(F.broadcast(sizes.select("part", before.alias("ahead"))), "part").select((F.col("ahead") + F.col("nth")).cast("long").alias("id"), "path")


def resolve_links(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Different (source_id, target_id) of links (source_id, target_path) whose target is an article's path; self-links stay.

    Links outside the range of the articles' paths cannot be resolved and go before the join.
    """
    targets = articles.select(F.col("path").alias("target_path"), F.col("id").alias("target_id"))
    least, most = articles.select(F.min("path")).scalar(), articles.select(F.max("path")).scalar()
    return links.where(F.col("target_path").between(least, most)).join(targets, "target_path").select("source_id", "target_id").distinct()


def unresolved_links(links: DataFrame, articles: DataFrame) -> DataFrame:
    """(source_id, target_path) rows without an article."""
    return links.join(articles.select(F.col("path").alias("target_path")), "target_path", "left_anti").select("source_id", "target_path")


def with_degrees(articles: DataFrame, edges: DataFrame) -> DataFrame:
    """articles with inbound_count and outbound_count over different edges."""
    inbound = edges.groupBy(F.col("target_id").alias("id")).agg(F.count("*").alias("inbound_count"))
    outbound = edges.groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("outbound_count"))
    joined = articles.join(inbound, "id", "left").join(outbound, "id", "left")
    return joined.fillna(0, ["inbound_count", "outbound_count"])


def induced_edges(edges: DataFrame, selected: DataFrame) -> DataFrame:
    """Edges with both ends selected (selected has id)."""
    ids = selected.select("id")
    return edges.join(ids, edges.source_id == ids.id, "left_semi").join(ids.withColumnRenamed("id", "__t"), F.col("target_id") == F.col("__t"), "left_semi")


def adjacency(edges: DataFrame, selected: DataFrame) -> DataFrame:
    """(id, outbound, inbound) sorted neighbour lists in the induced subgraph, empty where there are none; that subgraph is written once."""
    inner = stored(induced_edges(edges, selected))
    out = inner.groupBy(F.col("source_id").alias("id")).agg(F.array_sort(F.collect_list("target_id")).alias("outbound"))
    inn = inner.groupBy(F.col("target_id").alias("id")).agg(F.array_sort(F.collect_list("source_id")).alias("inbound"))
    none = F.array().cast("array<bigint>")
    return selected.select("id").join(out, "id", "left").join(inn, "id", "left").select("id", F.coalesce("outbound", none).alias("outbound"), F.coalesce("inbound", none).alias("inbound"))
