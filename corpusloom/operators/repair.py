"""Adjacency repair: pull well-scored missing link targets, evict overflow, until nothing is left to pull."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import RepairConfig
from corpusloom.operators.select import compared, quota_frame
from corpusloom.operators.state import checkpointed, stored


@dataclass
class RepairResult:
    selection: DataFrame  # id, domain, kss, anchor
    rounds: list[tuple[int, int]]  # pulled, evicted
    ended: Callable[[], str]

    @cached_property
    def reason(self) -> str:
        """Why it ended; looked up among all edges when first asked for."""
        return self.ended()


def missing_links(selection: DataFrame, edges: DataFrame, attrs: DataFrame, top_n: int) -> DataFrame:
    """(source_id, target_id, rank, target attributes): the ``top_n`` links of each selected source to targets that are not selected, by kss.

    Ineligible targets take up ranks too.
    """
    chosen = selection.select("id")
    out = edges.join(chosen, edges.source_id == chosen.id, "left_semi").join(chosen, edges.target_id == chosen.id, "left_anti")
    return _ranked(out.join(attrs.withColumnRenamed("id", "target_id"), "target_id").withColumn("__key", _key()), top_n).drop("__key")


def _key() -> Column:
    return F.coalesce(compared(), F.lit(0.0))


def _ranked(known: DataFrame, top_n: int) -> DataFrame:
    order = Window.partitionBy("source_id").orderBy(F.col("__key").desc(), F.col("target_id").asc())
    return known.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def _fit(min_kss: float) -> Column:
    """Whether an article can be pulled."""
    return F.coalesce((F.col("stage1_pass") == 1) & (F.col("kss") >= min_kss) & F.col("domain").isNotNull(), F.lit(False))


def open_edges(selected: DataFrame, edges: DataFrame, attrs: DataFrame, min_kss: float) -> DataFrame:
    """(source_id, target_id, __key, fit): the edges that can decide a pull in some round.

    Only articles of the first selection and those that can be pulled are ever sources. A target of a lower key than ``min_kss`` comes in every
    source's order after all that can be pulled, so it takes none of their ranks; others that cannot be pulled stay.
    """
    known = attrs.select(F.col("id").alias("target_id"), _key().alias("__key"), _fit(min_kss).alias("fit"))
    targets = known.where(F.col("__key") >= F.round(F.lit(float(min_kss)), 12))
    sources = selected.select("id").unionByName(attrs.where(_fit(min_kss)).select("id")).distinct()
    return edges.join(targets, "target_id").join(sources, F.col("source_id") == sources.id, "left_semi").select("source_id", "target_id", "__key", "fit")


def pulls(now: DataFrame, reach: DataFrame, attrs: DataFrame, top_n: int) -> DataFrame:
    """Different eligible targets (id, domain, kss) among the ``top_n`` missing links of each selected source; reach has open edges."""
    chosen = now.select("id")
    out = reach.join(chosen, reach.target_id == chosen.id, "left_anti").join(chosen, reach.source_id == chosen.id, "left_semi")
    ids = _ranked(out, top_n).where("fit").select(F.col("target_id").alias("id")).distinct()
    return attrs.select("id", "domain", "kss").join(ids, "id", "left_semi").distinct()


def evictions(selection: DataFrame, quotas: dict[str, int], overage: float) -> DataFrame:
    """Ids of the lowest non-anchors beyond each domain's ceiling; anchors are never evicted."""
    ceilings = quota_frame(selection.sparkSession, {d: int(q * (1 + overage)) for d, q in quotas.items()}).withColumnRenamed("quota", "ceiling")
    excess = selection.groupBy("domain").agg(F.count("*").alias("n")).join(F.broadcast(ceilings), "domain").select("domain", (F.col("n") - F.col("ceiling")).alias("excess"))
    order = Window.partitionBy("domain").orderBy(compared().asc_nulls_first(), F.col("id").desc())
    weak = selection.where("anchor = 0").withColumn("__nth", F.row_number().over(order))
    return weak.join(F.broadcast(excess), "domain").where("__nth <= excess").select("id")


def repair(selected: DataFrame, edges: DataFrame, attrs: DataFrame, quotas: dict[str, int], cfg: RepairConfig | None = None) -> RepairResult:
    """Rounds of pull and evict on (id, domain, kss); attrs has (id, stage1_pass, kss, domain).

    A round's pulls are decided on one snapshot and all become anchors before evictions. It ends with no missing link, no eligible
    target, or after ``max_iterations``; each round pulls a new permanent anchor, so it ends. The edges that can matter are written once,
    a round reads those alone and writes its pulls and the selection.
    """
    cfg = cfg or RepairConfig()
    facts = stored(attrs.select("id", "stage1_pass", "kss", "domain"))
    fit = facts.where(_fit(cfg.min_pull_kss)).select("id", "domain", "kss")
    now = checkpointed(selected.select("id", "domain", "kss", F.lit(0).alias("anchor")))
    reach = stored(open_edges(now, edges, facts, cfg.min_pull_kss))
    n = now.count()
    rounds: list[tuple[int, int]] = []
    for _ in range(cfg.max_iterations):
        fresh = checkpointed(pulls(now, reach, fit, cfg.top_n_links))
        pulled = fresh.count()
        if not pulled:
            break
        grown = now.unionByName(fresh.select("id", "domain", "kss", F.lit(1).alias("anchor")))
        now = checkpointed(grown.join(evictions(grown, quotas, cfg.max_overage_fraction), "id", "left_anti"))
        before, n = n, now.count()
        rounds.append((pulled, before + pulled - n))
    else:
        return RepairResult(now, rounds, lambda: "max_iterations")
    return RepairResult(now, rounds, lambda: "no_missing_links" if missing_links(now, edges, facts, 1).isEmpty() else "no_candidates")
