"""Compression, manifest, report and build hash."""

from __future__ import annotations

import hashlib
import json
import shutil
import warnings
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.functions.batches import pieces


class SizeLimitError(RuntimeError):
    """The corpus is larger than its budget."""


def check_size(total: int, cfg: Config) -> None:
    if total > cfg.build.max_total_compressed_bytes:
        raise SizeLimitError(f"{total} bytes > {cfg.build.max_total_compressed_bytes}")


def compressed(pages: DataFrame, level: int = 9) -> DataFrame:
    """pages (path, title, domain, kss, output_path, html) with payload (zstd) and compressed_bytes."""

    kept = [c for c in pages.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=level)
        for part in pieces(batches, "html"):
            payload = [None if h is None else pack.compress(h.encode("utf-8")) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(payload, pa.binary())], [*kept, "payload"])

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in pages.schema if c.name != "html") + ", payload binary"
    return pages.mapInArrow(run, schema).withColumn("compressed_bytes", F.length("payload").cast("long"))


def manifest(packed: DataFrame) -> DataFrame:
    """(path, title, domain, kss, output_path, compressed_bytes) of packed pages; kss half-even at six places."""
    return packed.select("path", "title", "domain", F.bround("kss", 6).alias("kss"), F.concat("output_path", F.lit(".zst")).alias("output_path"), "compressed_bytes")


def domain_report(entries: DataFrame) -> DataFrame:
    return entries.groupBy("domain").agg(F.count("*").alias("n"), F.sum("compressed_bytes").alias("compressed_bytes"))


def build_hash(entries: list[dict]) -> str:
    """SHA-256 of the entries sorted by path as canonical JSON."""
    canonical = json.dumps(sorted(entries, key=lambda e: e["path"]), sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canonical.encode()).hexdigest()


def file_sha256(path: str | Path) -> str:
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def verify_file(path: str | Path, expected: str | None) -> None:
    """The file must exist and, unless expected is None, have this SHA-256."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    if expected is not None and (found := file_sha256(path)) != expected.lower():
        raise ValueError(f"{path}: SHA-256 {found}, expected {expected.lower()}")


def write_outputs(entries: DataFrame, cfg: Config, failed: int = 0) -> dict:
    """Write manifest.json, report.json and BUILD_HASH (one row per selected article, at most the quotas' sum); enforce the size limit before the hash."""
    rows = [r.asDict() for r in entries.orderBy("path").collect()]
    total = sum(r["compressed_bytes"] for r in rows)
    by: dict[str, dict] = {}
    for r in rows:
        d = by.setdefault(r["domain"], {"count": 0, "compressed_bytes": 0})
        d["count"] += 1
        d["compressed_bytes"] += r["compressed_bytes"]
    report = {
        "total_articles": len(rows), "total_compressed_bytes": total, "total_compressed_mb": round(total / 1e6, 2),
        "failed_to_package": failed, "domain_distribution": {d: by[d] for d in sorted(by)},
    }
    cfg.path("manifest").parent.mkdir(parents=True, exist_ok=True)
    cfg.path("manifest").write_text(json.dumps(rows, ensure_ascii=False, indent=2), encoding="utf-8")
    cfg.path("report").write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")
    check_size(total, cfg)
    cfg.path("build_hash").write_text(build_hash(rows) + "\n")
    return report


def _export(rows: DataFrame, folder: str) -> None:
    """Write (name, data) rows as files below a folder that all executors share; a row that is written twice is the same file."""

    def write(part) -> None:
        for r in part:
            to = Path(folder, r.name)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(bytes(r.data))

    rows.select("name", "data").foreachPartition(write)


def export_files(packed: DataFrame, folder: str) -> None:
    """One .zst file per row."""
    _export(packed.select(F.concat("output_path", F.lit(".zst")).alias("name"), F.col("payload").alias("data")), folder)


def export_pages(pages: DataFrame, folder: str) -> None:
    """One HTML file in UTF-8 per row."""
    _export(pages.select(F.col("output_path").alias("name"), F.encode("html", "UTF-8").alias("data")), folder)


def copy_stylesheet(source: str | None, cfg: Config) -> bool:
    """Copy the stylesheet to the assets; a missing one is only warned of."""
    if source is None or not Path(source).exists():
        warnings.warn(f"no stylesheet at {source}", stacklevel=2)
        return False
    to = cfg.path("assets") / cfg.build.css_filename
    to.parent.mkdir(parents=True, exist_ok=True)
    shutil.copyfile(source, to)
    return True
