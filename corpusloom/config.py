"""Settings: dataclasses with defaults, loaded from YAML."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path

#: The eight domains in their order, and their default quotas.
DOMAIN_ORDER = (
    "Geography", "Biography", "History", "Science_Math",
    "Arts_Culture", "Technology_Computing", "Society_Politics_Economics", "Meta_Reference",
)
QUOTAS = dict(zip(DOMAIN_ORDER, (6000, 6000, 4000, 4000, 4000, 3000, 2000, 1000)))
DOMAINS = tuple(sorted(DOMAIN_ORDER))
ENV = "CORPUSLOOM_CONFIG"


@dataclass(frozen=True)
class InputConfig:
    zim_path: str = "data/input/wikipedia_en.zim"
    zim_sha256: str | None = None


@dataclass(frozen=True)
class BuildConfig:
    build_dir: str = "data/build"
    normalized_dir: str = "normalized"
    corpus_dir: str = "corpus"
    css_filename: str = "style.css"
    max_total_compressed_bytes: int = 419_430_400
    zstd_level: int = 9
    workers: int = 0


@dataclass(frozen=True)
class PrefilterConfig:
    min_text_chars: int = 5000
    min_inbound_links: int = 5


@dataclass(frozen=True)
class Weights:
    log_inbound: float = 0.30
    cross_domain: float = 0.20
    length_score: float = 0.15
    category_coverage: float = 0.15
    longevity: float = 0.15
    recency_penalty: float = 0.05


@dataclass(frozen=True)
class ScoreConfig:
    weights: Weights = field(default_factory=Weights)
    length_soft_cap: int = 100_000
    length_floor: int = 5000


@dataclass(frozen=True)
class RepairConfig:
    top_n_links: int = 8
    min_pull_kss: float = 0.40
    max_overage_fraction: float = 0.05
    max_iterations: int = 50


@dataclass(frozen=True)
class ValidationConfig:
    random_walk_count: int = 5000
    random_walk_steps: int = 200
    max_dead_end_rate: float = 0.01
    quota_tolerance: float = 0.05
    max_inbound_orphans: int = 0
    max_outbound_orphans: int = 0


@dataclass(frozen=True)
class Config:
    input: InputConfig = field(default_factory=InputConfig)
    build: BuildConfig = field(default_factory=BuildConfig)
    prefilter: PrefilterConfig = field(default_factory=PrefilterConfig)
    kss: ScoreConfig = field(default_factory=ScoreConfig)
    quotas: dict[str, int] = field(default_factory=lambda: dict(QUOTAS))
    repair: RepairConfig = field(default_factory=RepairConfig)
    validation: ValidationConfig = field(default_factory=ValidationConfig)

    def path(self, name: str) -> Path:
        """normalized, corpus, assets, manifest, report, build_hash or validation_report below the build folder."""
        base = Path(self.build.build_dir)
        return {
            "normalized": base / self.build.normalized_dir, "corpus": base / self.build.corpus_dir, "assets": base / self.build.corpus_dir / "assets",
            "manifest": base / "manifest.json", "report": base / "report.json", "build_hash": base / "BUILD_HASH", "validation_report": base / "validation_report.json",
        }[name]


def _filled(kind, given: dict | None):
    """A dataclass with the given known keys; unknown keys are ignored."""
    known = {f.name for f in fields(kind)}
    return kind(**{k: v for k, v in (given or {}).items() if k in known})


def load_config(path: str | Path | None = None) -> Config:
    """From the argument, else the environment variable, else config/default.yaml; a missing file raises."""
    import yaml

    where = Path(path or os.environ.get(ENV) or "config/default.yaml")
    if not where.exists():
        raise FileNotFoundError(f"config file not found: {where}")
    raw = yaml.safe_load(where.read_text()) or {}
    score = dict(raw.get("kss") or {})
    score["weights"] = _filled(Weights, score.get("weights"))
    return Config(
        input=_filled(InputConfig, raw.get("input")), build=_filled(BuildConfig, raw.get("build")), prefilter=_filled(PrefilterConfig, raw.get("prefilter")),
        kss=_filled(ScoreConfig, score), quotas=QUOTAS | {k: int(v) for k, v in (raw.get("quotas") or {}).items() if k in QUOTAS},
        repair=_filled(RepairConfig, raw.get("repair")), validation=_filled(ValidationConfig, raw.get("validation")),
    )


def load_domain_rules(path: str | Path) -> dict[str, list[str]]:
    """Lower-cased anchors of every domain from a YAML file {domain: {anchors: [...]}}; a missing domain has none."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text()) or {}
    return {d: [str(a).lower() for a in (raw.get(d) or {}).get("anchors") or []] for d in DOMAINS}
