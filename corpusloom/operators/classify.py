"""Domains from categories and titles, with a balanced fallback."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DOMAINS
from corpusloom.functions.text import contains_any
from corpusloom.operators.state import checkpointed


def score_columns() -> list[str]:
    return [f"s_{d.lower()}" for d in DOMAINS]


def category_scores(categories: DataFrame, anchors: dict[str, list[str]]) -> DataFrame:
    """(article_id, s_<domain>...): category rows (repeats counted) with an anchor of each domain."""
    sums = [F.sum(contains_any(F.col("category"), anchors.get(d, [])).cast("int")).alias(s) for d, s in zip(DOMAINS, score_columns())]
    return categories.groupBy("article_id").agg(*sums)


def best_domain(scores: list[Column]) -> tuple[Column, Column]:
    """(highest score, its domain); of equal scores the alphabetically first domain."""
    top = F.greatest(*scores)
    pick = F.lit(None).cast("string")
    for d, s in reversed(list(zip(DOMAINS, scores))):
        pick = F.when(s == top, d).otherwise(pick)
    return top, pick


def matched_domains(passing: DataFrame, scores: DataFrame, anchors: dict[str, list[str]]) -> DataFrame:
    """(id, matched_domain, match_kind) of passing articles (id, title): category, else title, else null and ``balanced``."""
    names = score_columns()
    joined = passing.select("id", "title").join(scores.withColumnRenamed("article_id", "id"), "id", "left").fillna(0, names)
    by_cat, cat_domain = best_domain([F.col(s) for s in names])
    by_title, title_domain = best_domain([contains_any(F.lower("title"), anchors.get(d, [])).cast("int") for d in DOMAINS])
    return joined.select(
        "id", F.when(by_cat > 0, cat_domain).when(by_title > 0, title_domain).alias("matched_domain"),
        F.when(by_cat > 0, "category").when(by_title > 0, "title").otherwise("balanced").alias("match_kind"),
    )


def balance(matched: DataFrame) -> DataFrame:
    """(id, domain, match_kind): rows without a match get, in order of id, the domain with the fewest rows so far (ties alphabetical).

    How many matched rows of each domain come before a row is counted in parallel over ranges of ids; only the rows without a match then
    pass through one ordered task, as nine narrow numbers each, because each choice depends on all before.
    """
    spark = matched.sparkSession
    n = len(DOMAINS)
    index = F.array_position(F.lit(list(DOMAINS)), F.col("matched_domain")) - 1
    narrow = matched.select("id", F.coalesce(index, F.lit(-1)).cast("int").alias("d"))
    ordered = narrow.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id").sortWithinPartitions("id")

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, part = np.zeros(n, np.int64), TaskContext.get().partitionId()
        for f in frames:
            d = f["d"].to_numpy()
            hits = (d[:, None] == np.arange(n)).astype(np.int64)
            before = held + np.cumsum(hits, axis=0) - hits
            lone = d < 0
            if lone.any():
                yield pd.DataFrame({"part": part, "id": f["id"][lone].to_numpy(), "total": False, "counts": before[lone].tolist()})
            held = held + hits.sum(axis=0)
        yield pd.DataFrame({"part": [part], "id": [0], "total": [True], "counts": [held.tolist()]})

    rows = checkpointed(ordered.mapInPandas(local, "part int, id long, total boolean, counts array<long>"))
    ahead, offsets = np.zeros(n, np.int64), {}
    for r in sorted(rows.where("total").collect(), key=lambda r: r.part):
        offsets[r.part] = ahead
        ahead = ahead + np.array(r.counts)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = np.zeros(n, np.int64)
        for f in frames:
            out = []
            for part, counts in zip(f["part"], f["counts"]):
                k = int(np.argmin(offsets[part] + counts + given))
                given[k] += 1
                out.append(DOMAINS[k])
            yield pd.DataFrame({"id": f["id"], "fallback": out})

    lone = rows.where("not total").drop("total").repartition(1).sortWithinPartitions("id")
    chosen = lone.mapInPandas(fold, "id long, fallback string")
    return matched.join(chosen, "id", "left").select("id", F.coalesce("matched_domain", "fallback").alias("domain"), "match_kind")


def domain_histogram(domains: DataFrame) -> DataFrame:
    return domains.groupBy("domain").agg(F.count("*").alias("n"))
