"""Articles, links and categories made from the order tables: the curation queries' test bed.

``CTES`` is the same in SQL that both Spark and DuckDB read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.config import DOMAINS

#: Anchors that fit the words of the part names; domains without one have no matches.
ANCHORS = {
    "Arts_Culture": ["widget"], "Biography": ["gear"], "Geography": ["plate"], "History": ["bolt", "old"], "Meta_Reference": ["promo"],
    "Science_Math": ["ring", "hot", "cold"], "Society_Politics_Economics": ["rod"], "Technology_Computing": ["gizmo", "new"],
}
LONGEVITY, RECENCY = ("old",), ("new",)
QUOTA_SHARE, MIN_PULL = 0.25, 0.55


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    size = F.col("p_size").cast("long") * 2500
    return part.select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("part_"), F.col("p_partkey")).alias("path"), F.col("p_name").alias("title"), F.lit(0).alias("is_redirect"),
        (F.col("p_brand") == "Brand#2").cast("int").alias("is_disambig"), (F.col("p_brand") == "Brand#1").cast("int").alias("is_stub"), size.alias("text_chars"), (size * 2).alias("html_size"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, target_path): each line item's part to the next one's, and to its supplier, which is no article.

    Line items are shuffled once; a number that an order has twice gives every pair.
    """
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    following = Window.partitionBy("l_orderkey").orderBy(F.col("l_linenumber").cast("long")).rangeBetween(1, 1)
    numbered = items.where("l_orderkey is not null and l_linenumber is not null")
    pairs = numbered.select(F.col("l_partkey").alias("source_id"), F.collect_list(F.struct("l_partkey")).over(following).alias("after"))
    along = pairs.select("source_id", F.explode("after").alias("next")).select("source_id", F.concat(F.lit("part_"), F.col("next.l_partkey")).alias("target_path"))
    return along.unionByName(items.select(F.col("l_partkey").alias("source_id"), F.concat(F.lit("supp_"), F.col("l_suppkey")).alias("target_path")))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").where("p_partkey % 5 <> 0")
    kinds = part.select(F.col("p_partkey").alias("article_id"), F.concat(F.lower("p_type"), F.lit(" goods")).alias("category"))
    words = part.select(F.col("p_partkey").alias("article_id"), F.explode(F.split("p_name", " ")).alias("word")).select("article_id", F.concat("word", F.lit(" things")).alias("category"))
    return kinds.unionByName(words)


def _any(column: str, anchors) -> str:
    return "(" + " OR ".join(f"contains({column}, '{a}')" for a in anchors) + ")"


_SCORES = ", ".join(f"CAST(sum(CAST({_any('category', ANCHORS[d])} AS INT)) AS BIGINT) AS s_{d.lower()}" for d in DOMAINS)
_S = [f"s_{d.lower()}" for d in DOMAINS]
_COVERAGE = " + ".join(_S)


def _pick(scores: list[str]) -> str:
    top = f"greatest({', '.join(scores)})"
    return "CASE " + " ".join(f"WHEN {s} = {top} THEN '{d}'" for d, s in zip(DOMAINS, scores)) + " END"


_TITLE = [f"CAST({_any('lower(title)', ANCHORS[d])} AS INT)" for d in DOMAINS]
_COUNTS = ", ".join(f"count(*) FILTER (WHERE matched_domain = '{d}') OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c{k}" for k, d in enumerate(DOMAINS))
_LOW = "least(" + ", ".join(f"l.c{k} + b.g{k}" for k in range(8)) + ")"
_CHOICE = "CASE " + " ".join(f"WHEN l.c{k} + b.g{k} = {_LOW} THEN {k}" for k in range(8)) + " END"

#: Named steps as SQL, each using those before it.
CTES: dict[str, str] = {
    "articles": """SELECT p_partkey AS id, 'part_' || p_partkey AS path, p_name AS title, 0 AS is_redirect, CAST(p_brand = 'Brand#2' AS INT) AS is_disambig,
      CAST(p_brand = 'Brand#1' AS INT) AS is_stub, CAST(p_size AS BIGINT) * 2500 AS text_chars, CAST(p_size AS BIGINT) * 5000 AS html_size FROM part""",
    "links": """SELECT a.l_partkey AS source_id, 'part_' || b.l_partkey AS target_path FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber
      UNION ALL SELECT l_partkey, 'supp_' || l_suppkey FROM lineitem""",
    "edges": "SELECT DISTINCT source_id, id AS target_id FROM links JOIN articles ON path = target_path",
    "categories": """SELECT p_partkey AS article_id, lower(p_type) || ' goods' AS category FROM part WHERE p_partkey % 5 <> 0
      UNION ALL SELECT p_partkey, word || ' things' FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_partkey % 5 <> 0)""",
    "degrees": """SELECT a.*, coalesce(i.n, 0) AS inbound_count, coalesce(o.n, 0) AS outbound_count FROM articles a
      LEFT JOIN (SELECT target_id, count(*) AS n FROM edges GROUP BY 1) i ON i.target_id = a.id LEFT JOIN (SELECT source_id, count(*) AS n FROM edges GROUP BY 1) o ON o.source_id = a.id""",
    "gated": """SELECT *, CAST(stage1_fail_reason IS NULL AS INT) AS stage1_pass FROM (SELECT *, CASE WHEN is_redirect = 1 THEN 'redirect' WHEN is_disambig = 1 THEN 'disambiguation' WHEN is_stub = 1 THEN 'stub'
      WHEN text_chars < 5000 THEN 'text_chars<5000' WHEN inbound_count < 5 THEN 'inbound_links<5' END AS stage1_fail_reason FROM degrees)""",
    "passing": "SELECT * FROM gated WHERE stage1_pass = 1",
    "scores": f"SELECT article_id, {_SCORES} FROM categories GROUP BY article_id",
    "matched": f"""SELECT id, CASE WHEN top > 0 THEN by_cat WHEN title_top > 0 THEN by_title END AS matched_domain, CASE WHEN top > 0 THEN 'category' WHEN title_top > 0 THEN 'title' ELSE 'balanced' END AS match_kind
      FROM (SELECT id, greatest({', '.join(_S)}) AS top, {_pick(_S)} AS by_cat, greatest({', '.join(_TITLE)}) AS title_top, {_pick(_TITLE)} AS by_title
      FROM (SELECT id, title, {', '.join(f'coalesce({s}, 0) AS {s}' for s in _S)} FROM passing LEFT JOIN scores ON article_id = id))""",
    "lone": f"SELECT *, row_number() OVER (ORDER BY id) AS k FROM (SELECT id, matched_domain, {_COUNTS} FROM matched) WHERE matched_domain IS NULL",
    "balanced": f"""SELECT 0 AS k, CAST(0 AS BIGINT) AS id, -1 AS choice, {', '.join(f'0 AS g{k}' for k in range(8))} UNION ALL
      SELECT k, id, choice, {', '.join(f'g{k} + CAST(choice = {k} AS INT)' for k in range(8))} FROM (SELECT l.k AS k, l.id AS id, {_CHOICE} AS choice, {', '.join(f'b.g{k} AS g{k}' for k in range(8))} FROM balanced b JOIN lone l ON l.k = b.k + 1)""",
    "domains": "SELECT m.id, coalesce(matched_domain, " + "CASE b.choice " + " ".join(f"WHEN {k} THEN '{d}'" for k, d in enumerate(DOMAINS)) + " END) AS domain, match_kind FROM matched m LEFT JOIN balanced b ON b.id = m.id AND b.k > 0",
    "crossing": "SELECT e.source_id AS id, avg(CAST(s.domain <> t.domain AS INT)) AS cross_domain FROM edges e JOIN domains s ON s.id = e.source_id JOIN domains t ON t.id = e.target_id GROUP BY 1",
    "shares": f"SELECT article_id, avg(CAST({_any('category', LONGEVITY)} AS INT)) AS longevity, avg(CAST({_any('category', RECENCY)} AS INT)) AS recency FROM categories GROUP BY 1",
    "maxima": f"SELECT coalesce(nullif((SELECT max(inbound_count) FROM passing), 0), 1) AS max_inbound, coalesce(nullif((SELECT max({_COVERAGE}) FROM scores JOIN passing ON id = article_id), 0), 1) AS max_coverage",
    "signals": f"""SELECT *, greatest(0.0, least(1.0, 0.30::DOUBLE * log_inbound + 0.20::DOUBLE * cross_domain + 0.15::DOUBLE * length_score + 0.15::DOUBLE * category_coverage + 0.15::DOUBLE * longevity - 0.05::DOUBLE * recency)) AS kss
      FROM (SELECT p.id, d.domain, ln(1.0::DOUBLE + p.inbound_count) / ln(1.0::DOUBLE + max_inbound) AS log_inbound, coalesce(c.cross_domain, 0) AS cross_domain,
      CASE WHEN text_chars <= 5000 THEN 0.0::DOUBLE WHEN text_chars >= 100000 THEN 1.0::DOUBLE ELSE (text_chars - 5000) / 95000.0::DOUBLE END AS length_score,
      coalesce({_COVERAGE}, 0) / CAST(max_coverage AS DOUBLE) AS category_coverage, coalesce(longevity, 0) AS longevity, coalesce(recency, 0) AS recency
      FROM passing p JOIN domains d ON d.id = p.id LEFT JOIN crossing c ON c.id = p.id LEFT JOIN scores s ON s.article_id = p.id LEFT JOIN shares h ON h.article_id = p.id CROSS JOIN maxima)""",
    "quotas": f"SELECT domain, CAST(floor(count(*) * {QUOTA_SHARE}) AS BIGINT) AS quota FROM signals GROUP BY domain",
    "ranked": "SELECT id, domain, kss, row_number() OVER (PARTITION BY domain ORDER BY round(kss, 12) DESC, id) AS rank FROM signals",
    "selected": "SELECT r.id, r.domain, r.kss, r.rank FROM ranked r JOIN quotas q ON q.domain = r.domain WHERE r.rank <= q.quota",
    "missing": """SELECT * FROM (SELECT e.source_id, e.target_id, t.kss, t.domain, row_number() OVER (PARTITION BY e.source_id ORDER BY coalesce(round(t.kss, 12), 0) DESC, e.target_id) AS rank
      FROM edges e JOIN selected s ON s.id = e.source_id LEFT JOIN signals t ON t.id = e.target_id WHERE e.target_id NOT IN (SELECT id FROM selected)) WHERE rank <= 8""",
    "pulled": f"SELECT DISTINCT target_id AS id, domain, kss FROM missing WHERE kss >= {MIN_PULL}",
    "grown": "SELECT id, domain, kss, 0 AS anchor FROM selected UNION ALL SELECT id, domain, kss, 1 FROM pulled",
    "excess": "SELECT g.domain, count(*) - max(CAST(floor(q.quota * 1.05) AS BIGINT)) AS excess FROM grown g JOIN quotas q ON q.domain = g.domain GROUP BY 1",
    "round1": """SELECT g.id, g.domain, g.anchor FROM grown g LEFT JOIN (SELECT w.id FROM (SELECT id, domain, row_number() OVER (PARTITION BY domain ORDER BY round(kss, 12), id DESC) AS nth FROM grown WHERE anchor = 0) w
      JOIN excess x ON x.domain = w.domain WHERE nth <= excess) v ON v.id = g.id WHERE v.id IS NULL""",
    "inner_edges": "SELECT source_id, target_id FROM edges WHERE source_id IN (SELECT id FROM selected) AND target_id IN (SELECT id FROM selected)",
}


def sql(body: str, last: str) -> str:
    """WITH all steps up to ``last``, then body."""
    names = list(CTES)
    used = names[: names.index(last) + 1]
    recursive = "RECURSIVE " if "balanced" in used else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({CTES[n]})" for n in used) + f"\n{body}"
