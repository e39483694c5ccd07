"""Fuzzy line deduplication by MinHash, in DataFrame operations only."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import as_table, drop_table, materialise, read_documents
from corpusloom.llm.differences import components_of, differences, few

#: Characters per shingle. Five-character shingles of unrelated lines coincide so often that bands would fill with chance pairs.
SHINGLE = 8
#: Minima per signature: a square of ``SIDE`` by ``SIDE``. The bands are the 16 sloped lines of the affine plane over four elements,
#: four minima each: a pair of similarity 0.8 shares one with probability 0.989, of 0.9 with 0.9994.
SIDE = 4
#: Bytes of a character in UTF-16, in which lines are cut; one beyond the basic plane counts as two.
WIDE = 2
SIMILARITY = 0.8
#: Shingle positions that one array holds, and those that one row takes at once.
PIECE, STEP = 4096, 6


def _seeds() -> list[int]:
    r = random.Random(20)
    return [r.getrandbits(64) - (1 << 63) for _ in range(SIDE * SIDE)]


def _band_rows() -> list[list[int]]:
    """The lines y = m x + c of the affine plane of order four."""
    times = [[0, 0, 0, 0], [0, 1, 2, 3], [0, 2, 3, 1], [0, 3, 1, 2]]  # products in the field of four elements; sums are exclusive or
    return [[SIDE * x + (times[m][x] ^ c) for x in range(SIDE)] for m in range(SIDE) for c in range(SIDE)]


def _not_blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t\x0b\f\r")) != ""


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, key) of every line that is not blank; the keys are 64-bit hashes of the text and the line."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(_not_blank(F.col("line"))).withColumn("key", F.xxhash64("line"))


def _shingle_count(wide) -> Column:
    return F.greatest((F.octet_length(wide) / F.lit(WIDE)).cast("int") - F.lit(SHINGLE - 1), F.lit(1))


def _shingle(wide, i: Column) -> Column:
    return F.xxhash64(F.substring(wide, i * WIDE + 1, F.lit(WIDE * SHINGLE)))


def signatures(lines: DataFrame) -> DataFrame:
    """(key, m0 ...): the minima of every different line.

    A line is encoded with two bytes per character, so that a shingle is a slice found in constant time. Its positions are
    exploded, ``STEP`` to a row, and the minima of the xored shingle hashes aggregated by line before any exchange: texts are not shuffled.
    """
    wide = lines.select("key", F.encode("line", "UTF-16BE").alias("wide")).select("key", "wide", _shingle_count("wide").alias("n"))
    pieces = wide.select("key", "wide", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(PIECE))).alias("base"))
    steps = F.sequence("base", F.least(F.col("base") + F.lit(PIECE - 1), F.col("n") - 1), F.lit(STEP))
    places = pieces.select("key", "wide", "n", F.explode(steps).alias("i"))
    hashes = places.select("key", *[_shingle("wide", F.least(F.col("i") + F.lit(j), F.col("n") - 1)).alias(f"h{j}") for j in range(STEP)])
    least = [F.min(F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(s)) for j in range(STEP)])) for s in _seeds()]
    return hashes.groupBy("key").agg(*[m.alias(f"m{i}") for i, m in enumerate(least)])


def band_keys(signed: DataFrame) -> DataFrame:
    """(key, band): the band hashes of every signature."""
    bands = [F.xxhash64(F.lit(b), *[f"m{i}" for i in rows]) for b, rows in enumerate(_band_rows())]
    return signed.select("key", F.explode(F.array(*bands)).alias("band"))


def _bound(value: Column, use) -> Column:
    """use(value) with value computed once, not in every step of a lambda inside."""
    return F.transform(F.array(value), use)[0]


def shingles(line: str) -> Column:
    """The shingle hashes of a line, repeats included."""
    cut = lambda wide: F.transform(F.sequence(F.lit(0), _shingle_count(wide) - 1), lambda i: _shingle(wide, i))
    return _bound(F.encode(line, "UTF-16BE"), cut)


def band_members(lines: DataFrame) -> DataFrame:
    """(key, lead): every line of a band of several with the band's leader, the line whose bands hold most lines (the original among its copies)."""
    spark = lines.sparkSession
    signed, path = as_table(signatures(lines), "line-signatures", plain=True)
    sizes = materialise(band_keys(signed).groupBy("band").agg(F.count("*").alias("n")).where("n > 1"))
    rows = materialise(band_keys(signed).join(few(sizes), "band"))
    drop_table(spark, path)
    # one number, so that the aggregate stays in generated code; of two lines with equal orders either may lead
    order = F.shiftleft(F.sum("n"), 24) + F.col("key").bitwiseAND(F.lit((1 << 24) - 1))
    leads = rows.join(rows.groupBy("key").agg(order.alias("order")), "key").groupBy("band").agg(F.max_by("key", "order").alias("lead"))
    return materialise(rows.join(leads, "band").where("key <> lead").select("key", "lead").distinct())


def _compared(members: DataFrame, lines: DataFrame) -> DataFrame:
    """The differences of the members' shingle sets from their leaders'."""
    keys = members.select("key").unionByName(members.select(F.col("lead").alias("key"))).distinct()
    texts = materialise(lines.select("key", "line").join(few(materialise(keys)), "key", "left_semi").groupBy("key").agg(F.first("line").alias("line")))
    leads = members.groupBy("lead").agg(F.count("*").alias("n"))
    sets = leads.join(texts.withColumnRenamed("key", "lead"), "lead").select("lead", "n", F.array_distinct(shingles("line")).alias("theirs"))
    return differences(members.join(texts, "key").join(sets, "lead").select("lead", "key", "n", "theirs", shingles("line").alias("own")), SIMILARITY)


def similar_lines(lines: DataFrame) -> DataFrame:
    """(node, component) of the keys of lines that have similar lines: no similar pair of a band is lost."""
    compared, path = as_table(_compared(band_members(lines), lines), "line-differences", plain=True)
    out = components_of(compared, SIMILARITY)
    drop_table(lines.sparkSession, path)
    return out


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, line_no, key) of the one line that stays of every group of similar lines.

    Lines whose sets of character shingles have a similarity of at least 0.8 are linked; of every connected group (equal lines
    included) the line with the smallest (doc_id, line_no) stays; ties of rows with one identifier go by the hash of the text. Rows
    without doc_id come first, equal rows are one document, a line shorter than a shingle is its own only shingle. Null, empty and
    blank texts have no lines, an empty table none. Texts of any length are taken whole, and only the two columns named are read.
    """
    lines = lines_of(_source(docs, id_col, text_col))
    groups = similar_lines(lines).withColumnRenamed("node", "key")
    places = lines.groupBy("key").agg(F.min(F.struct("doc_id", "line_no", "text_key")).alias("place"))
    grouped = places.join(groups, "key", "left").groupBy(F.coalesce("component", "key").alias("line_group"))
    first = grouped.agg(F.min(F.struct("place", "key")).alias("first"))
    return materialise(first.select("first.place.doc_id", "first.place.text_key", "first.place.line_no", "first.key"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, line_no, key, kept) of every line that is not blank, once per different row; see ``kept_lines``."""
    lines = lines_of(_source(docs, id_col, text_col)).select("doc_id", "text_key", "line_no", "key").distinct()
    stay = kept_lines(docs, id_col, text_col).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("line_no").alias("l"), F.lit(True).alias("stays"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("line_no") == F.col("l"))
    return lines.join(stay, same, "left").select("doc_id", "text_key", "line_no", "key", F.coalesce("stays", F.lit(False)).alias("kept"))


def _with_kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """rows, whose identifier and text are known as own_id and own_key, with ``kept`` (one row per document, or null)."""
    return rows.join(kept, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")), "left")


def drop_lines(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text that ``kept_lines`` and blank lines leave; null texts and all other columns stay."""
    stay = kept.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("stay"))
    text = F.col("row")[text_col]
    left = F.filter(F.split(text, "\n"), lambda line, i: ~_not_blank(line) | F.coalesce(F.array_contains("stay", i), F.lit(False)))
    joined = _with_kept(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_key")), stay)
    return joined.select(*[F.array_join(left, "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines (not blank), n_removed, kept_digest (exclusive or of the hashes of the kept lines and their numbers)."""
    docs = read_documents(spark, sf_dir)
    counts = kept_lines(docs).groupBy("doc_id", "text_key").agg(F.count("*").alias("n_kept"), F.bit_xor(F.xxhash64("line_no", "key")).alias("digest"))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.filter(F.split("text", "\n"), _not_blank))).cast("long")
    every = _with_kept(docs.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_key"), lines.alias("n_lines")), counts)
    n_removed = F.col("n_lines") - F.coalesce("n_kept", F.lit(0))
    return every.select(F.col("own_id").alias("doc_id"), "n_lines", n_removed.alias("n_removed"), F.lpad(F.lower(F.hex(F.coalesce("digest", F.lit(0)))), 16, "0").alias("kept_digest"))
