"""Quota selection: the best articles of each domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compared(kss: str = "kss"):
    """kss as it is compared: at twelve places, so that rounding in the last bit decides nothing."""
    return F.round(kss, 12)


def quota_frame(spark, quotas: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(d, int(q)) for d, q in quotas.items()], "domain string, quota long")


def select_top(scored: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """(id, domain, kss, rank): per domain the ``quota`` highest kss, ties by id; null kss and quotas of 0 select nothing.

    The literal bound beside the quota lets Spark cut every task's input to its own best rows before the shuffle.
    """
    spark = scored.sparkSession
    most = max([0, *quotas.values()])
    if most > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(most))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(compared().desc(), F.col("id").asc()))
    ranked = scored.where("kss is not null").select("id", "domain", "kss", rank.alias("rank")).where(F.col("rank") <= most)
    return ranked.join(F.broadcast(quota_frame(spark, quotas)), "domain").where("rank <= quota").select("id", "domain", "kss", "rank")


def selection_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("domain").agg(F.count("*").alias("n"))
