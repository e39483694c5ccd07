"""Curation queries by name, over the bridge tables, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import RepairConfig, ScoreConfig
from corpusloom.functions import text
from corpusloom.operators import classify, gates, links, package, repair, score, select, validate
from corpusloom.operators.html import normalised_pages, page_features
from corpusloom.operators.state import stored
from corpusloom.plans import bridge
from corpusloom.plans.bridge import sql


class Curation:
    """The curation steps over one input, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def articles(self) -> DataFrame:
        return bridge.articles(self.spark, self.sf_dir)

    @cached_property
    def links(self) -> DataFrame:
        return bridge.links(self.spark, self.sf_dir)

    @cached_property
    def categories(self) -> DataFrame:
        return bridge.categories(self.spark, self.sf_dir)

    @cached_property
    def edges(self) -> DataFrame:
        return links.resolve_links(self.links, self.articles)

    @cached_property
    def kept_edges(self) -> DataFrame:
        """Edges written once, for queries that read them several times."""
        return stored(self.edges)

    @cached_property
    def gated(self) -> DataFrame:
        return gates.gate(links.with_degrees(self.articles, self.kept_edges))

    @cached_property
    def passing(self) -> DataFrame:
        """Passing articles, written once: domains and scores read them five times, and their degrees come from all edges."""
        return stored(self.gated.where("stage1_pass = 1").select("id", "title", "inbound_count", "text_chars"))

    @cached_property
    def scores(self) -> DataFrame:
        return classify.category_scores(self.categories, bridge.ANCHORS)

    @cached_property
    def kept_scores(self) -> DataFrame:
        """Scores written once, for queries that read them several times."""
        return stored(self.scores)

    @cached_property
    def matched(self) -> DataFrame:
        return classify.matched_domains(self.passing, self.kept_scores, bridge.ANCHORS)

    @cached_property
    def domains(self) -> DataFrame:
        return stored(classify.balance(self.matched))  # read three times by the scores

    @cached_property
    def signals(self) -> DataFrame:
        return score.signals(self.passing, self.domains, self.kept_edges, self.categories, self.kept_scores, ScoreConfig(), bridge.LONGEVITY, bridge.RECENCY)

    @cached_property
    def scored(self) -> DataFrame:
        return stored(self.signals)

    @cached_property
    def quotas(self) -> dict[str, int]:
        return {r.domain: int(r.n * bridge.QUOTA_SHARE) for r in self.scored.groupBy("domain").agg(F.count("*").alias("n")).collect()}

    @cached_property
    def selected(self) -> DataFrame:
        return select.select_top(self.scored, self.quotas)

    @cached_property
    def kept_selected(self) -> DataFrame:
        """The selection written once, for queries that read it several times."""
        return stored(self.selected)

    @cached_property
    def attrs(self) -> DataFrame:
        return self.articles.select("id").join(self.scored.select("id", "domain", "kss"), "id", "left").withColumn("stage1_pass", F.col("kss").isNotNull().cast("int"))

    def repaired(self) -> repair.RepairResult:
        return repair.repair(self.selected, self.kept_edges, self.attrs, self.quotas, RepairConfig(min_pull_kss=bridge.MIN_PULL))


def _nine(c: str):
    return F.round(c, 9).alias(c)


Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, body: str | None = None, last: str | None = None):
    """Register a function of a Curation under a name, with SQL: a body over the bridge steps up to ``last``, or plain SQL."""

    def keep(f: Callable[[Curation], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: f(Curation(spark, sf_dir))
        if body:
            _SQL[name] = sql(body, last) if last else body
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


query("link_resolution", "SELECT source_id, target_id FROM edges", "edges")(lambda c: c.edges)
query("unresolved_links", "SELECT l.source_id, l.target_path FROM links l WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.path = l.target_path)", "links")(lambda c: links.unresolved_links(c.links, c.articles))
query("degree_counts", "SELECT id, inbound_count, outbound_count FROM degrees", "degrees")(lambda c: links.with_degrees(c.articles, c.edges).select("id", "inbound_count", "outbound_count"))
query("gate_reasons", "SELECT id, stage1_pass, stage1_fail_reason FROM gated", "gated")(lambda c: c.gated.select("id", "stage1_pass", "stage1_fail_reason"))
query("gate_fail_histogram", "SELECT stage1_fail_reason AS reason, count(*) AS n FROM gated WHERE stage1_pass = 0 GROUP BY 1", "gated")(lambda c: gates.fail_histogram(c.gated))
query("gate_counts", "SELECT count(*) FILTER (WHERE stage1_pass = 1) AS passed, count(*) FILTER (WHERE stage1_pass = 0) AS failed FROM gated", "gated")(lambda c: gates.pass_counts(c.gated))
query("uncategorised", "SELECT id FROM articles WHERE id NOT IN (SELECT article_id FROM categories)", "categories")(lambda c: gates.uncategorised(c.articles, c.categories).select("id"))
query("category_distinct_count", "SELECT count(*) AS n_rows, count(DISTINCT article_id) AS n_articles, count(DISTINCT category) AS n_categories FROM categories", "categories")(
    lambda c: c.categories.agg(F.count("*").alias("n_rows"), F.countDistinct("article_id").alias("n_articles"), F.countDistinct("category").alias("n_categories"))
)
query("domain_scores", "SELECT * FROM scores", "scores")(lambda c: c.scores)
query("domain_argmax", "SELECT id, matched_domain FROM matched WHERE match_kind = 'category'", "matched")(lambda c: c.matched.where("match_kind = 'category'").select("id", "matched_domain"))
query("title_fallback", "SELECT id, matched_domain FROM matched WHERE match_kind = 'title'", "matched")(lambda c: c.matched.where("match_kind = 'title'").select("id", "matched_domain"))
query("balanced_fallback", "SELECT id, domain, match_kind FROM domains", "domains")(lambda c: c.domains)
query("domain_histogram", "SELECT domain, count(*) AS n FROM domains GROUP BY 1", "domains")(lambda c: classify.domain_histogram(c.domains))
query("cross_domain_fraction", "SELECT id, round(cross_domain, 9) AS cross_domain FROM crossing", "crossing")(lambda c: score.cross_domain_fractions(c.kept_edges, c.domains).select("id", _nine("cross_domain")))
query("length_signal", "SELECT id, round(length_score, 9) AS length_score FROM signals", "signals")(lambda c: c.signals.select("id", _nine("length_score")))
query("lognorm_signal", "SELECT id, round(log_inbound, 9) AS log_inbound FROM signals", "signals")(lambda c: c.signals.select("id", _nine("log_inbound")))
query("coverage_signal", "SELECT id, round(category_coverage, 9) AS category_coverage FROM signals", "signals")(lambda c: c.signals.select("id", _nine("category_coverage")))
query("longevity_signal", "SELECT article_id, round(longevity, 9) AS longevity FROM shares", "shares")(lambda c: score.category_share(c.categories, bridge.LONGEVITY, "longevity").select("article_id", _nine("longevity")))
query("recency_signal", "SELECT article_id, round(recency, 9) AS recency FROM shares", "shares")(lambda c: score.category_share(c.categories, bridge.RECENCY, "recency").select("article_id", _nine("recency")))
query("kss", "SELECT id, domain, round(kss, 9) AS kss FROM signals", "signals")(lambda c: c.signals.select("id", "domain", _nine("kss")))
query("kss_stats", "SELECT count(kss) AS n, round(avg(kss), 9) AS mean_kss FROM signals", "signals")(lambda c: score.score_stats(c.signals).select("n", _nine("mean_kss")))
query("quota_topk", "SELECT id, domain, round(kss, 9) AS kss, rank FROM selected", "selected")(lambda c: c.selected.select("id", "domain", _nine("kss"), F.col("rank").cast("long").alias("rank")))
query("selection_counts", "SELECT domain, count(*) AS n FROM selected GROUP BY 1", "selected")(lambda c: select.selection_counts(c.selected))
query("missing_link_rank", "SELECT source_id, target_id, rank FROM missing", "missing")(
    lambda c: repair.missing_links(c.kept_selected, c.kept_edges, c.attrs, 8).select("source_id", "target_id", F.col("rank").cast("long").alias("rank"))
)


@query("repair_round1", "SELECT id, domain, anchor FROM round1", "round1")
def repair_round1(c: Curation) -> DataFrame:
    one = RepairConfig(min_pull_kss=bridge.MIN_PULL, max_iterations=1)
    return repair.repair(c.selected, c.kept_edges, c.attrs, c.quotas, one).selection.select("id", "domain", "anchor")


query("repair_fixpoint")(lambda c: c.repaired().selection.select("id", "domain", "anchor"))
query("induced_subgraph", "SELECT source_id, target_id FROM inner_edges", "inner_edges")(lambda c: links.induced_edges(c.kept_edges, c.kept_selected))
query("adjacency_lists", """SELECT s.id, coalesce(o.ids, '') AS outbound, coalesce(i.ids, '') AS inbound FROM selected s
LEFT JOIN (SELECT source_id AS id, string_agg(CAST(target_id AS VARCHAR), ' ' ORDER BY target_id) AS ids FROM inner_edges GROUP BY 1) o ON o.id = s.id
LEFT JOIN (SELECT target_id AS id, string_agg(CAST(source_id AS VARCHAR), ' ' ORDER BY source_id) AS ids FROM inner_edges GROUP BY 1) i ON i.id = s.id""", "inner_edges")(
    lambda c: links.adjacency(c.kept_edges, c.kept_selected).select("id", F.array_join("outbound", " ").alias("outbound"), F.array_join("inbound", " ").alias("inbound"))
)
query("inbound_orphans", "SELECT id FROM selected WHERE id NOT IN (SELECT target_id FROM inner_edges)", "inner_edges")(lambda c: validate.inbound_orphans(c.kept_selected, c.kept_edges))
query("outbound_orphans", "SELECT id FROM selected WHERE id NOT IN (SELECT source_id FROM inner_edges)", "inner_edges")(lambda c: validate.outbound_orphans(c.kept_selected, c.kept_edges))
query("quota_compliance", """SELECT q.domain, q.quota, count(s.id) AS n, CAST(count(s.id) >= q.quota * (1 - 0.05) AND count(s.id) <= q.quota * (1 + 0.05) AS INT) AS ok
FROM quotas q LEFT JOIN selected s ON s.domain = q.domain GROUP BY 1, 2""", "selected")(lambda c: validate.quota_compliance(c.selected, c.quotas, 0.05))

WALK_STEPS = 4
_steps = ["m0 AS (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM selected) AS mass FROM selected)"]
for _k in range(1, WALK_STEPS):
    _steps.append(f"m{_k} AS (SELECT e.target_id AS id, sum(m.mass / d.degree) AS mass FROM m{_k - 1} m JOIN inner_edges e ON e.source_id = m.id JOIN degree d ON d.source_id = m.id GROUP BY 1)")
_WALK = sql("", "inner_edges").rstrip() + ",\ndegree AS (SELECT source_id, count(*) AS degree FROM inner_edges GROUP BY 1),\n" + ",\n".join(_steps) + "\nSELECT round(" + " + ".join(
    f"coalesce((SELECT sum(mass) FROM m{k} WHERE id NOT IN (SELECT source_id FROM degree)), 0)" for k in range(WALK_STEPS)) + ", 9) AS dead_end_rate"
query("walk_dead_end_mass", _WALK)(lambda c: validate.walk_dead_end_mass(c.kept_selected, c.kept_edges, WALK_STEPS).select(_nine("dead_end_rate")))

_SKIP = " OR ".join(f"starts_with(h, '{p}')" for p in text.SKIP_LINK_PREFIXES)
query("href_filter", f"""SELECT page_id, count(DISTINCT target) AS n, coalesce(string_agg(DISTINCT target, ' ' ORDER BY target), '') AS targets
FROM (SELECT page_id, CASE WHEN h <> '' AND NOT ({_SKIP}) THEN nullif(ltrim(url_decode(split_part(h, '#', 1)), './'), '') END AS target
      FROM (SELECT page_id, trim(unnest(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS h FROM pages)) GROUP BY 1""")(
    lambda c: bridge.read(c.spark, c.sf_dir, "pages").select("page_id", F.array_sort(text.article_links(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1))).alias("t"))
    .select("page_id", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("targets"))
)
query("slug", r"SELECT page_id, left(regexp_replace(replace(url, ' ', '_'), '[^\w\-.]', '_', 'g'), 200) AS slug FROM pages")(
    lambda c: bridge.read(c.spark, c.sf_dir, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))
)
query("output_path_collisions", r"""SELECT output_path, count(*) AS n FROM (SELECT lang || '/' || left(regexp_replace(replace(source || ' ' || n_chars, ' ', '_'), '[^\w\-.]', '_', 'g'), 200) || '.html' AS output_path FROM documents)
GROUP BY 1 HAVING count(*) > 1""")(
    lambda c: bridge.read(c.spark, c.sf_dir, "documents").select(text.output_path(F.col("lang"), F.concat("source", F.lit(" "), F.col("n_chars").cast("string"))).alias("output_path"))
    .groupBy("output_path").agg(F.count("*").alias("n")).where("n > 1")
)
query("html_escape", """SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped FROM pages""")(
    lambda c: bridge.read(c.spark, c.sf_dir, "pages").select("page_id", text.html_escape(F.col("html")).alias("escaped"))
)
query("article_paths", "SELECT page_id, CAST(NOT (" + " OR ".join(f"starts_with(url, '{p}')" for p in text.NON_ARTICLE_PREFIXES) + ") AS INT) AS is_article FROM pages")(
    lambda c: bridge.read(c.spark, c.sf_dir, "pages").select("page_id", text.is_article_path(F.col("url")).cast("int").alias("is_article"))
)
query("page_features")(lambda c: page_features(bridge.read(c.spark, c.sf_dir, "pages"), content_id=None))


def _pages(c: Curation) -> DataFrame:
    pages = bridge.read(c.spark, c.sf_dir, "pages")
    return pages.select(F.col("page_id").alias("id"), F.col("url").alias("path"), F.col("url").alias("title"), F.lit("Geography").alias("domain"), F.lit(0.5).alias("kss"), "html")


def _targets(c: Curation) -> DataFrame:
    """(source_id, target, output_path) of every link of a page to a page."""
    found = page_features(bridge.read(c.spark, c.sf_dir, "pages"), content_id=None)
    hrefs = found.select(F.col("id").alias("source_id"), F.explode(text.article_links(F.col("hrefs"))).alias("target"))
    kept = _pages(c).select(F.col("path").alias("target"), text.output_path(F.col("domain"), F.col("path")).alias("output_path")).distinct()
    return hrefs.join(kept, "target").select("source_id", "target", "output_path")


query("normalised_pages")(lambda c: normalised_pages(_pages(c), _targets(c)).select("id", "output_path", F.length("html").alias("chars"), "gzip_size"))
query("packed_manifest")(lambda c: package.manifest(package.compressed(_pages(c).withColumn("output_path", text.output_path(F.col("domain"), F.col("path"))))))
query("domain_report", "SELECT domain, count(*) AS n, sum(html_size)::BIGINT AS compressed_bytes FROM domains d JOIN articles a ON a.id = d.id GROUP BY 1", "domains")(
    lambda c: package.domain_report(c.domains.join(c.articles, "id").select("domain", F.col("html_size").alias("compressed_bytes")))
)
query("manifest_sha", "SELECT sha256(string_agg(path || ',' || domain || ',' || title, ';' ORDER BY path)) AS digest FROM domains d JOIN articles a ON a.id = d.id", "domains")(
    lambda c: c.domains.join(c.articles, "id").agg(F.sha2(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("path", F.concat_ws(",", "path", "domain", "title").alias("line")))), lambda s: s["line"])), 256).alias("digest"))
)
