"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise, read_documents, unnamed

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one window of the running word count holds, on average.
PER_BUCKET = 2000


def source_targets(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: sid, source, source_size, n_docs, target; sized has (source, size, times).

    Sources in code-point order (null last) weigh ``weights``, repeating. ``share`` of all words is
    dealt by weight; a source stops at ``cap`` times its size and the excess is dealt again by
    weight. That water level is found in closed form: sorted by size per weight, the capped
    sources are a prefix, and the first source that is not capped fixes the level.
    The window runs over one row per source.
    """
    total = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.sum("times").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    ranked = total.withColumn("sid", rank).withColumn("w", weigh).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("w"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("free", F.col("level") * F.col("w") <= F.col("most"))
    found = F.min(F.when(F.col("free"), F.struct(F.col("most") / F.col("w"), F.col("sid"), F.col("level").alias("level")))).over(every)["level"]
    return levels.withColumn("found", found).select(
        "sid", "source", "source_size", "n_docs", F.least("most", F.coalesce(F.col("found") * F.col("w"), F.col("most"))).alias("target")
    )


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Return doc_id, size, source, source_size, target, copies, taken for every row of docs; see ``units``."""
    found = units(docs, id_col, text_col, source_col, **options)
    each = found.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return each.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "pareto",
) -> DataFrame:
    """Return doc_id, key, times, size, source, source_size, target, copies of every different document; key is a hash of its text and source.

    Rows with one identifier, source and text are one document that occurs ``times``: it is taken as a whole, with equal copies. A source with target T and size S is due T/S copies of its words: floor(T/S) of every document are certain. The rest, a share r of S,
    is a sample with unequal inclusion probabilities: p = r + r (1 - r) (g - G), where g = size / (size + mean size), in steps of 1/1024,
    favours longer documents, and G is its mean over the words of the source, so that the expected words are r S. Documents are ranked by the
    Pareto variable (U / (1 - U)) / (p / (1 - p)), where U is a fixed hash of the identifier, and the smallest ranks are selected until the
    words still due are used up (the fixed size is a number of words). One more document per source, the one whose size is nearest to
    the words still missing, closes the gap.

    The running word count is a window over buckets of about ``PER_BUCKET`` documents, which follow the ranks, plus the words of
    the buckets before, so a source with a third of all rows is spread over many tasks.
    Null texts have size 0 and take 0; texts are counted whole, whatever their length; a null source is a source of its own; equal ranks go by
    identifier, size and key; an empty table gives an empty result; other columns are not read.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text_col, source_col).alias("key"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + seed))), 1, 13), 16, 10).cast("long").alias("x"),
    )
    sized = materialise(sized.groupBy("doc_id", "source", "key", "size", "x").agg(F.count("*").alias("times")))
    targets = source_targets(sized, weights, share, cap)
    rows = sized.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    favour = F.floor(F.lit(1024.0) * F.col("size") / (F.col("size") + F.col("source_size") / F.col("n_docs")))
    rows = rows.withColumn("words", F.col("size") * F.col("times")).withColumn("certain", F.floor(due)).withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")).withColumn("g", F.when(F.col("source_size") > 0, favour).otherwise(0))
    usual = rows.groupBy("sid").agg(F.sum(F.col("g") * F.col("words")).alias("favoured"))
    u = (F.col("x") + F.lit(0.5)) / F.lit(float(1 << 52))
    r = F.col("rest") / F.col("source_size")
    p = r + r * (F.lit(1.0) - r) * (F.col("g") / F.lit(1024.0) - F.col("favoured") / (F.lit(1024.0) * F.col("source_size")))
    drawing = (F.col("rest") > 0) & (F.col("source_size") > 0)
    rank = F.when(drawing, (u / (F.lit(1.0) - u)) * ((F.lit(1.0) - F.col("p")) / F.col("p"))).otherwise(u)
    # the place in the order that a rank has if all probabilities are r
    even = F.col("rank") * r / (F.lit(1.0) - r)
    place = F.when(drawing & (r < 1), even / (F.lit(1.0) + even)).otherwise(u)
    n_buckets = F.ceil(F.col("n_docs") / F.lit(PER_BUCKET))
    rows = (
        rows.join(usual, "sid").withColumn("p", F.when(drawing, p)).withColumn("rank", rank)
        .withColumn("bucket", F.floor(F.least(place, F.lit(1.0)) * n_buckets))
    )
    # a document of more words than are due never is drawn, and does not end the drawing
    fits = F.when(F.col("words") <= F.col("rest"), F.col("words")).otherwise(0)
    sums = rows.groupBy("sid", "bucket").agg(F.sum(fits).alias("words"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("sid", "bucket").orderBy("rank", "x", "doc_id", "size", "key")
    ran = (
        rows.withColumn("upto", F.sum(fits).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(sums, ["sid", "bucket"])
        .withColumn("drawn", ((F.col("words") <= F.col("rest")) & (F.col("ahead") + F.col("upto") <= F.col("rest"))).cast("long"))
    )
    gap = ran.groupBy("sid").agg((F.first("rest") - F.sum(F.col("drawn") * F.col("words"))).alias("gap"))
    near = F.struct(F.abs(F.col("words") - F.col("gap")).alias("off"), "x", "doc_id", "bucket", "nth", "size", "gap")
    last = (
        ran.where((F.col("drawn") == 0) & (F.col("rest") > 0)).join(gap, "sid").groupBy("sid").agg(F.min(near).alias("n"))
        .where("n.off < n.gap").select("sid", F.col("n.bucket").alias("bucket"), F.col("n.nth").alias("nth"), F.lit(1).alias("closes"))
    )
    copies = F.col("certain") + F.when(F.col("rest") > 0, F.col("drawn") + F.coalesce(F.col("closes"), F.lit(0))).otherwise(0)
    return ran.join(last, ["sid", "bucket", "nth"], "left").select(
        "doc_id", "key", "times", "size", "source", "source_size", "target", copies.cast("long").alias("copies")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Rows of docs, with all their columns, each as often as ``pareto_mix`` takes it.

    Texts meet their decision in one join; nothing else of docs is moved.
    """
    taken = units(docs, id_col, text_col, source_col, **options).where("copies > 0").select(F.col("doc_id").alias("t_id"), F.col("key").alias("t_key"), "copies")
    old, plain = docs.columns, unnamed(docs)
    c_id, c_text, c_source = (f"c{old.index(c)}" for c in (id_col, text_col, source_col))
    joined = plain.withColumn("key", F.xxhash64(c_text, c_source)).join(taken, F.col(c_id).eqNullSafe(F.col("t_id")) & (F.col("key") == F.col("t_key")))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*plain.columns).toDF(*old)


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents."""
    return pareto_mix(read_documents(spark, sf_dir, "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, size, x, count(*) AS times, size * count(*) AS words FROM (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':pareto'), 1, 13))::BIGINT AS x
  FROM documents) GROUP BY doc_id, source, text, size, x),
ranked AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         CASE sid % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
  FROM (SELECT source, sum(words)::BIGINT AS source_size, sum(times)::BIGINT AS n_docs, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
        FROM sized GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY most / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM ranked),
targets AS (
  SELECT *, least(most, coalesce((SELECT arg_min(level, (most / w, sid)) FROM levels WHERE level * w <= most) * w, most)) AS target FROM levels),
due AS (
  SELECT s.*, t.sid, t.source_size, t.n_docs, t.target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS certain
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
favours AS (
  SELECT *, target - certain * source_size AS rest,
         CASE WHEN source_size > 0 THEN floor(1024.0::DOUBLE * size / (size + source_size / n_docs))::BIGINT ELSE 0 END AS g,
         (x + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM due),
chances AS (
  SELECT *, CASE WHEN rest > 0 AND source_size > 0 THEN
           rest / source_size + rest / source_size * (1.0::DOUBLE - rest / source_size)
             * (g / 1024.0::DOUBLE - (sum(g * words) OVER (PARTITION BY sid))::BIGINT / (1024.0::DOUBLE * source_size)) END AS p
  FROM favours),
ran AS (
  SELECT *, sum(CASE WHEN words <= rest THEN words ELSE 0 END) OVER w AS upto, row_number() OVER w AS nth
  FROM (SELECT *, CASE WHEN p IS NULL THEN u ELSE (u / (1.0::DOUBLE - u)) * ((1.0::DOUBLE - p) / p) END AS rank FROM chances)
  WINDOW w AS (PARTITION BY sid ORDER BY rank, x, doc_id, size ROWS UNBOUNDED PRECEDING)),
drawn AS (SELECT *, (words <= rest AND upto <= rest)::BIGINT AS drawn FROM ran),
gaps AS (SELECT sid, any_value(rest) - sum(drawn * words) AS gap FROM drawn GROUP BY sid),
closing AS (
  SELECT sid, nth FROM (
    SELECT d.sid, d.nth, abs(d.words - g.gap) AS off, g.gap, row_number() OVER (PARTITION BY d.sid ORDER BY abs(d.words - g.gap), x, doc_id, nth) AS k
    FROM drawn d JOIN gaps g USING (sid) WHERE d.drawn = 0 AND d.rest > 0)
  WHERE k = 1 AND off < gap)
SELECT doc_id, size, source_size, target, taken FROM (
SELECT doc_id, size, source_size, target, unnest(range(times)) AS nth,
       ((certain + CASE WHEN rest > 0 THEN drawn + (c.nth IS NOT NULL)::BIGINT ELSE 0 END) * size)::BIGINT AS taken
FROM drawn d LEFT JOIN closing c USING (sid, nth))
"""
