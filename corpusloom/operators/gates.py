"""The pre-filter: the first rule that an article breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import PrefilterConfig


def gate(articles: DataFrame, cfg: PrefilterConfig | None = None) -> DataFrame:
    """articles with stage1_pass (1 or 0) and stage1_fail_reason (null where passed)."""
    cfg = cfg or PrefilterConfig()
    reason = (
        F.when(F.col("is_redirect") == 1, "redirect").when(F.col("is_disambig") == 1, "disambiguation").when(F.col("is_stub") == 1, "stub")
        .when(F.col("text_chars") < cfg.min_text_chars, f"text_chars<{cfg.min_text_chars}")
        .when(F.col("inbound_count") < cfg.min_inbound_links, f"inbound_links<{cfg.min_inbound_links}")
    )
    return articles.withColumn("stage1_fail_reason", reason).withColumn("stage1_pass", F.col("stage1_fail_reason").isNull().cast("int"))


def fail_histogram(gated: DataFrame) -> DataFrame:
    return gated.where("stage1_pass = 0").groupBy(F.col("stage1_fail_reason").alias("reason")).agg(F.count("*").alias("n"))


def pass_counts(gated: DataFrame) -> DataFrame:
    return gated.agg(F.count_if(F.col("stage1_pass") == 1).alias("passed"), F.count_if(F.col("stage1_pass") == 0).alias("failed"))


def uncategorised(articles: DataFrame, categories: DataFrame) -> DataFrame:
    """Articles without any category row."""
    return articles.join(categories.select(F.col("article_id").alias("id")), "id", "left_anti")
