"""Checks on a selection: coverage, quotas, size, random walks, hash."""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.operators.links import adjacency, induced_edges
from corpusloom.operators.package import build_hash
from corpusloom.operators.select import quota_frame
from corpusloom.operators.state import checkpointed


class ValidationError(RuntimeError):
    """Some check failed; the report is written before it is raised."""


def inbound_orphans(selected: DataFrame, edges: DataFrame) -> DataFrame:
    """Selected articles that no selected article links to (a self-link counts)."""
    inner = induced_edges(edges, selected)
    return selected.select("id").join(inner, F.col("id") == inner.target_id, "left_anti")


def outbound_orphans(selected: DataFrame, edges: DataFrame) -> DataFrame:
    """Selected articles without a link to a selected article."""
    inner = induced_edges(edges, selected)
    return selected.select("id").join(inner, F.col("id") == inner.source_id, "left_anti")


def quota_compliance(selected: DataFrame, quotas: dict[str, int], tolerance: float) -> DataFrame:
    """(domain, quota, n, ok): whether each domain's count is within the tolerance of its quota."""
    counts = selected.groupBy("domain").agg(F.count("*").alias("n"))
    rows = quota_frame(selected.sparkSession, quotas).join(counts, "domain", "left").fillna(0, ["n"])
    return rows.withColumn("ok", F.col("n").between(F.col("quota") * (1 - tolerance), F.col("quota") * (1 + tolerance)).cast("int"))


def walk_dead_end_mass(selected: DataFrame, edges: DataFrame, steps: int, cut_every: int = 8) -> DataFrame:
    """One row, dead_end_rate: the expected share of uniform random walks that stand on a node without links within ``steps`` steps.

    Probability mass starts evenly; before each step the mass on dead ends is taken out, the rest spreads evenly. Without
    any selected node the rate is 1.
    """
    spark = selected.sparkSession
    inner = induced_edges(edges, selected)
    degree = inner.groupBy("source_id").agg(F.count("*").alias("degree"))
    spread = checkpointed(inner.join(degree, "source_id"))
    n = selected.count()
    if not n:
        return spark.range(1).select(F.lit(1.0).alias("dead_end_rate"))
    mass = checkpointed(selected.select("id", F.lit(1.0 / n).alias("mass")))
    sources = degree.select(F.col("source_id").alias("id"))
    dead = []
    if mass.join(sources, "id", "left_anti").isEmpty():
        return spark.range(1).select(F.lit(0.0).alias("dead_end_rate"))
    for step in range(steps):
        dead.append(mass.join(sources, "id", "left_anti").agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("mass")))
        mass = mass.join(spread, mass.id == spread.source_id).groupBy(F.col("target_id").alias("id")).agg(F.sum(F.col("mass") / F.col("degree")).alias("mass"))
        if step % cut_every == cut_every - 1:
            mass = checkpointed(mass)
            dead = [checkpointed(_union(dead))]
    return (_union(dead) if dead else spark.createDataFrame([], "mass double")).agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("dead_end_rate"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Selected articles whose neighbour lists a simulation may broadcast; larger selections take the exact expectation.
SIMULATED_NODES = 1_000_000


def random_walk_dead_end_rate(selected: DataFrame, edges: DataFrame, walks: int, steps: int, seed: int = 42) -> float:
    """Share of simulated walks that meet a dead end; every walk has its own generator, so partitions do not matter. No walks: 0."""
    spark = selected.sparkSession
    n = selected.count()
    if not n:
        return 1.0
    if not walks:
        return 0.0
    if n > SIMULATED_NODES:
        return float(walk_dead_end_mass(selected, edges, steps).first()[0])
    near = {r.id: r.outbound for r in adjacency(edges, selected).select("id", "outbound").toLocalIterator()}
    held = spark.sparkContext.broadcast((sorted(near), near))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, out = held.value
        for f in frames:
            dead = []
            for walk in f["id"]:
                r = random.Random(f"{seed}:{walk}")
                at, end = r.choice(ids), 0
                for _ in range(steps):
                    if not out[at]:
                        end = 1
                        break
                    at = r.choice(out[at])
                dead.append(end)
            yield pd.DataFrame({"dead": dead})

    total = spark.range(walks).mapInPandas(run, "dead long").agg(F.sum("dead").alias("n")).first()["n"]
    return total / walks


def validate(selected: DataFrame, edges: DataFrame, cfg: Config, write: bool = True) -> dict:
    """Run all checks, write the report, raise ValidationError if one fails."""
    v, checks, failures = cfg.validation, {}, []

    def add(name: str, ok: bool, message: str, **facts) -> None:
        checks[name] = {"pass": bool(ok), **facts}
        if not ok:
            failures.append(f"{name}: {message}")

    for name, frame, most in (("inbound_coverage", inbound_orphans, v.max_inbound_orphans), ("outbound_coverage", outbound_orphans, v.max_outbound_orphans)):
        n = frame(selected, edges).count()
        add(name, n <= most, f"{n} orphans > {most}", orphans=n, max_allowed=most)
    bad = [r.asDict() for r in quota_compliance(selected, cfg.quotas, v.quota_tolerance).where("ok = 0").collect()]
    add("quota_compliance", not bad, str(bad), failures=bad)
    report, most = cfg.path("report"), cfg.build.max_total_compressed_bytes
    size = json.loads(report.read_text()).get("total_compressed_bytes", 0) if report.exists() else None
    add("size_budget", size is not None and size <= most, f"{size} > {most}", total_compressed_bytes=size or 0, max_bytes=most)
    rate = random_walk_dead_end_rate(selected, edges, v.random_walk_count, v.random_walk_steps)
    add("random_walk", rate <= v.max_dead_end_rate, f"{rate:.4f} > {v.max_dead_end_rate}", dead_end_rate=round(rate, 5), max_allowed=v.max_dead_end_rate)
    manifest, stored = cfg.path("manifest"), cfg.path("build_hash")
    there = manifest.exists() and stored.exists()
    same = there and build_hash(json.loads(manifest.read_text())) == stored.read_text().strip()
    add("build_hash", same, "mismatch" if there else "manifest or hash missing", mismatch=not same)
    out = {"overall": "FAIL" if failures else "PASS", "failure_count": len(failures), "failures": failures, "checks": checks}
    if write:
        Path(cfg.path("validation_report")).parent.mkdir(parents=True, exist_ok=True)
        cfg.path("validation_report").write_text(json.dumps(out, ensure_ascii=False, indent=2), encoding="utf-8")
    if failures:
        raise ValidationError("; ".join(failures))
    return out
