"""Running the curation stages in order, with a build log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.functions.text import article_links, output_path
from corpusloom.operators import classify, gates, html, links, package, repair, score, select, validate
from corpusloom.operators.state import STATE_SCHEMA, checkpointed, latest_states, stage_row, stored_log

#: Stages in order; a stage uses only what earlier ones made.
ORDER = ("index", "categories", "gate", "classify", "score", "select", "repair", "normalise", "package", "validate")


@dataclass
class Pipeline:
    """Stages as pure functions of inputs that do not change: running one again drops what later ones made.

    pages: (path, title, html, ...), optionally with ``entry``, their order; categories: optional (path, category) for articles whose page
    names none; anchors: per domain. ``made`` holds each stage's output, ``log`` the build states; a failed validation is not logged.
    """

    spark: SparkSession
    pages: DataFrame
    anchors: dict[str, list[str]]
    cfg: Config = field(default_factory=Config)
    category_dump: DataFrame | None = None
    content_id: str | None = html.CONTENT_ID
    made: dict[str, object] = field(default_factory=dict)
    log: DataFrame | None = None
    log_path: str | None = None

    def __post_init__(self) -> None:
        """With ``log_path``, the log goes on from the table there, whichever process wrote it."""
        if self.log_path and self.log is None:
            self.log = stored_log(self.spark, self.log_path)

    def _index(self) -> dict[str, DataFrame]:
        """Of records with one path the first in entry order is the article; the links and categories of all are the article's."""
        entry = "entry" if "entry" in self.pages.columns else "title"
        kept = self.pages.where(F.col("path").isNotNull()).select("path", "title", "html", F.col(entry).alias("entry"))
        records = checkpointed(kept.join(links.numbered_paths(kept), "path").withColumn("record", F.monotonically_increasing_id()))
        pages = checkpointed(links.first_by_path(records, "entry", "title", "html", "record").select("id", "path", "title", "html", "record"))
        facts = checkpointed(html.page_features(records, "record", "html", self.content_id).withColumnRenamed("id", "record").join(records.select("record", "id"), "record"))
        own = pages.select("id", "path", "title", F.length("html").cast("long").alias("html_size"), "record")
        articles = own.join(facts.select("record", "text_chars", "is_disambig", "is_stub"), "record").drop("record").withColumn("is_redirect", F.lit(0))
        raw = facts.select(F.col("id").alias("source_id"), F.explode(article_links(F.col("hrefs"))).alias("target_path"))
        edges = checkpointed(links.resolve_links(raw, articles))
        named = facts.select(F.col("id").alias("article_id"), F.explode("categories").alias("category"))
        return {"pages": pages.drop("record"), "articles": checkpointed(links.with_degrees(articles, edges)), "links": raw, "edges": edges, "own_categories": named}

    def _categories(self) -> dict[str, DataFrame]:
        made = self.made["index"]
        if self.category_dump is None:
            return {"categories": made["own_categories"]}
        bare = gates.uncategorised(made["articles"], made["own_categories"]).select("id", F.translate("path", " ", "_").alias("key"))
        dump = self.category_dump.select(F.translate("path", " ", "_").alias("key"), F.lower(F.trim("category")).alias("category")).where("category <> ''")
        return {"categories": made["own_categories"].unionByName(bare.join(dump, "key").select(F.col("id").alias("article_id"), "category"))}

    def _gate(self) -> DataFrame:
        return gates.gate(self.made["index"]["articles"], self.cfg.prefilter)

    def _classify(self) -> dict[str, DataFrame]:
        scores = checkpointed(classify.category_scores(self.made["categories"]["categories"], self.anchors))
        passing = self.made["gate"].where("stage1_pass = 1")
        return {"scores": scores, "domains": checkpointed(classify.balance(classify.matched_domains(passing, scores, self.anchors)))}

    def _score(self) -> DataFrame:
        passing = self.made["gate"].where("stage1_pass = 1")
        return checkpointed(score.signals(passing, self.made["classify"]["domains"], self.made["index"]["edges"], self.made["categories"]["categories"], self.made["classify"]["scores"], self.cfg.kss))

    def _select(self) -> DataFrame:
        return checkpointed(select.select_top(self.made["score"], self.cfg.quotas))

    def _repair(self) -> repair.RepairResult:
        attrs = self.made["gate"].select("id", "stage1_pass").join(self.made["score"].select("id", "domain", "kss"), "id", "left")
        return repair.repair(self.made["select"], self.made["index"]["edges"], attrs, self.cfg.quotas, self.cfg.repair)

    def _normalise(self) -> DataFrame:
        kept = self.made["repair"].selection.join(self.made["index"]["pages"], "id").select("id", "path", "title", "domain", "kss", "html")
        out = kept.select(F.col("path").alias("target"), output_path(F.col("domain"), F.col("path")).alias("output_path"))
        targets = self.made["index"]["links"].join(out, F.col("target_path") == F.col("target")).select("source_id", "target", "output_path")
        done = checkpointed(html.normalised_pages(kept, targets))
        package.check_size(done.agg(F.coalesce(F.sum("gzip_size"), F.lit(0))).first()[0], self.cfg)
        return done

    def _package(self) -> DataFrame:
        good = self.made["normalise"].where("html is not null")
        packed = checkpointed(package.compressed(good.select("path", "title", "domain", "kss", "output_path", "html"), self.cfg.build.zstd_level))
        package.write_outputs(package.manifest(packed), self.cfg, self.made["normalise"].where("html is null").count())
        return packed

    def _validate(self) -> dict:
        return validate.validate(self.made["repair"].selection, self.made["index"]["edges"], self.cfg)

    def run_stage(self, name: str) -> None:
        if name not in ORDER:
            raise ValueError(f"unknown stage {name}; stages are {', '.join(ORDER)}")
        for later in ORDER[ORDER.index(name) :]:
            self.made.pop(later, None)
        made: Callable[[], object] = getattr(self, f"_{name}")
        self.made[name] = made()
        row = stage_row(self.spark, name)
        if self.log_path:
            row.write.mode("append").parquet(self.log_path)
            self.log = stored_log(self.spark, self.log_path)
        else:
            self.log = checkpointed(row if self.log is None else self.log.unionByName(row))

    def run(self, from_stage: str | None = None, force: bool = False) -> None:
        """All stages in order from ``from_stage``; those already made are skipped unless forced."""
        for name in ORDER[ORDER.index(from_stage) if from_stage else 0 :]:
            if force or name not in self.made:
                self.run_stage(name)

    def run_stages(self, names: list[str], force: bool = False) -> None:
        """The named stages in the order given."""
        for name in names:
            if name not in ORDER:
                raise ValueError(f"unknown stage {name}; stages are {', '.join(ORDER)}")
        for name in names:
            if force or name not in self.made:
                self.run_stage(name)

    def export(self, stylesheet: str | None = None) -> None:
        """Write pages and packed pages as files below the build folder, which all executors must share, and copy the stylesheet beside them."""
        package.export_pages(self.made["normalise"].where("html is not null"), str(self.cfg.path("normalized")))
        package.export_files(self.made["package"], str(self.cfg.path("corpus")))
        package.copy_stylesheet(stylesheet, self.cfg)

    def validate(self) -> dict:
        """Always runs the checks."""
        self.run_stage("validate")
        return self.made["validate"]

    def status(self) -> DataFrame:
        return latest_states(self.log) if self.log is not None else self.spark.createDataFrame([], STATE_SCHEMA)
