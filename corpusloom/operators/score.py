"""The stability score: graph, length and category signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import ScoreConfig
from corpusloom.functions.text import contains_any
from corpusloom.operators.classify import score_columns

#: Category anchors of lasting and of passing subjects.
LONGEVITY_ANCHORS = (
    "ancient", "medieval", "classical", "renaissance", "early modern", "late antiquity", "bronze age", "iron age", "neolithic", "paleolithic",
    "prehistoric", "antiquity", "byzantine", "ottoman", "roman", "greek", "viking", "feudal", "colonial era", "17th century", "18th century",
    "19th century", "early 20th century",
)
RECENCY_ANCHORS = (
    "living people", "2010s", "2011", "2012", "2013", "2014", "2015", "2016", "2017", "2018", "2019", "2020s", "2020", "2021", "2022",
    "2023", "2024", "2025", "2026", "21st century", "21st-century", "current",
)


def log_norm(n: Column, most: Column) -> Column:
    return F.when(most > 0, F.log1p(n) / F.log1p(most)).otherwise(0.0)


def length_signal(n: Column, floor: int, cap: int) -> Column:
    return F.when(n <= floor, 0.0).when(n >= cap, 1.0).otherwise((n - floor) / F.lit(float(cap - floor)))


def category_share(categories: DataFrame, anchors, name: str) -> DataFrame:
    """(article_id, name): share of an article's category rows with an anchor."""
    return categories.groupBy("article_id").agg(F.avg(contains_any(F.col("category"), anchors).cast("double")).alias(name))


def cross_domain_fractions(edges: DataFrame, domains: DataFrame) -> DataFrame:
    """(id, cross_domain): share of a source's links into other domains, over links with both domains known."""
    named = domains.where("domain is not null")
    source = named.select(F.col("id").alias("source_id"), F.col("domain").alias("__s"))
    target = named.select(F.col("id").alias("target_id"), F.col("domain").alias("__t"))
    known = edges.join(target, "target_id").join(source, "source_id")  # sources last: they are grouped where they are joined
    return known.groupBy(F.col("source_id").alias("id")).agg(F.avg((F.col("__s") != F.col("__t")).cast("double")).alias("cross_domain"))


def maxima(passing: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: max_inbound and max_coverage over passing articles, 1 where there is none or it is 0."""
    covered = scores.withColumnRenamed("article_id", "id").join(passing.select("id"), "id", "left_semi")
    total = sum((F.col(s) for s in score_columns()[1:]), F.col(score_columns()[0]))
    one = lambda c: F.coalesce(F.nullif(F.max(c), F.lit(0)), F.lit(1))
    return passing.agg(one(F.col("inbound_count")).alias("max_inbound")).crossJoin(covered.agg(one(total).alias("max_coverage")))


def signals(
    passing: DataFrame, domains: DataFrame, edges: DataFrame, categories: DataFrame, scores: DataFrame,
    cfg: ScoreConfig | None = None, longevity=LONGEVITY_ANCHORS, recency=RECENCY_ANCHORS,
) -> DataFrame:
    """(id, domain, the six signals, kss) of passing articles (id, inbound_count, text_chars) that have a domain.

    The two maxima are one row and joined to all; sums keep one order of operands.
    """
    cfg = cfg or ScoreConfig()
    w = cfg.weights
    share = categories.groupBy("article_id").agg(
        F.avg(contains_any(F.col("category"), longevity).cast("double")).alias("longevity"), F.avg(contains_any(F.col("category"), recency).cast("double")).alias("recency")
    ).withColumnRenamed("article_id", "id")
    coverage = sum((F.col(s) for s in score_columns()[1:]), F.col(score_columns()[0]))
    rows = (
        passing.select("id", "inbound_count", "text_chars").join(domains.where("domain is not null").select("id", "domain"), "id")
        .join(cross_domain_fractions(edges, domains), "id", "left")
        .join(scores.select(F.col("article_id").alias("id"), coverage.alias("__coverage")), "id", "left")
        .join(share, "id", "left").fillna(0, ["cross_domain", "__coverage", "longevity", "recency"])
        .join(F.broadcast(maxima(passing, scores)))
    )
    rows = rows.select(
        "id", "domain", log_norm(F.col("inbound_count"), F.col("max_inbound")).alias("log_inbound"), "cross_domain",
        length_signal(F.col("text_chars"), cfg.length_floor, cfg.length_soft_cap).alias("length_score"), (F.col("__coverage") / F.col("max_coverage")).alias("category_coverage"), "longevity", "recency",
    )
    total = (
        F.lit(w.log_inbound) * F.col("log_inbound") + F.lit(w.cross_domain) * F.col("cross_domain") + F.lit(w.length_score) * F.col("length_score")
        + F.lit(w.category_coverage) * F.col("category_coverage") + F.lit(w.longevity) * F.col("longevity") - F.lit(w.recency_penalty) * F.col("recency")
    )
    return rows.withColumn("kss", F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def score_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("kss").alias("n"), F.avg("kss").alias("mean_kss"))
