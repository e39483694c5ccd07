"""All operators and pipeline stages on extra columns with their own names, repeated rows, null and string identifiers, empty tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import context_mixing, decontaminate, fuzzy_lines, langid, mixing, pii, progressive_jpeg, simhash, sstable, suffix_dedup

EXTRA = (
    "score rejected lang_pred cross_entropy copies __copies copy key taken size target nth t_id row rank bucket component_id fingerprint fp component "
    "item_id n_bytes feature spans line_no kept start n_tokens own least c0 c1 bits_per_byte"
).split()
ITEM = " ".join(f"w{k}x" for k in range(30))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(6)
    word = lambda: r.choice("the of river stone ending thered alpha houses quickly brown under seven".split()) + r.choice(("", "s", "ed"))
    texts = [" ".join(word() for _ in range(r.randint(20, 60))) for _ in range(30)] + [None, "", " ".join(word() for _ in range(30_000))]
    out = [(i, t, "en", r.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    return out + [out[0], out[0], (None, texts[3], "en", "a", 1), (None, None, None, None, None), (7, "the same identifier and another text of some words", None, "b", 5)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(EXTRA)]).repartition(3)


def shards(docs):
    return sstable.read_token_shards(sstable.write_token_shards(docs, corpus_pipeline.scratch_path(docs.sparkSession, "odd")))


def benchmark(docs):
    return docs.sparkSession.createDataFrame([(1, ITEM)], "item_id long, text string")


PER_ROW = {
    "media": lambda d, **k: progressive_jpeg.media_digests(d, **k),
    "pii": lambda d, **k: pii.pii_spans(d, **k),
    "mix": lambda d, **k: mixing.pareto_mix(d, **k),
    "language": lambda d, **k: langid.predict_language(d.select(k.get("id_col", "doc_id"), "text"), langid.train_language_models(d, **k), **k),
    "repeats": lambda d, **k: suffix_dedup.remove_repeats(d, **k),
    "simhash": lambda d, **k: simhash.simhash_components(d, **k),
    "mixing": lambda d, **k: context_mixing.score_texts(d, d, **k),
}
INTEGERS = {k: f for k, f in PER_ROW.items() if k not in ("mix", "language")} | {
    "near": lambda d, **k: simhash.near_duplicates(d, **k),
    "leaks": lambda d, **k: decontaminate.contaminated(d, benchmark(d), **k),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row(docs, rows, name):
    got = PER_ROW[name](docs).collect()
    assert Counter(x[0] for x in got) == Counter(x[0] for x in rows)
    assert PER_ROW[name](docs.limit(0)).count() == 0


def test_the_others(docs, rows):
    assert shards(docs).count() == len(rows) and shards(docs.limit(0)).count() == 0
    assert decontaminate.contaminated(docs, benchmark(docs)).count() == 0 and decontaminate.contaminated(docs.limit(0), benchmark(docs)).count() == 0
    assert {x.doc_id for x in simhash.near_duplicates(docs).collect()} == {31} and simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = fuzzy_lines.kept_lines(docs)
    assert fuzzy_lines.drop_lines(docs, kept).columns == docs.columns and fuzzy_lines.kept_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", INTEGERS)
def test_identifiers_must_be_integers(docs, name):
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    with pytest.raises(TypeError):
        INTEGERS[name](named)
    other = docs.select(F.col("doc_id").cast("int").alias("number"), "text").limit(3)
    INTEGERS[name](other, id_col="number").count()


def test_names_as_identifiers(docs, rows):
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("name"), "text", "lang", "source")
    for f in (PER_ROW["mix"], PER_ROW["language"]):
        assert f(named, id_col="name").count() == len(rows)


def test_stages_keep_columns_and_rows(spark, docs, rows, tmp_path):
    benchmark(docs).write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.count() == 0 and (name == "token_shards" or none.columns == docs.columns)
    key = lambda x: (x.doc_id, x.text, x.lang, x.source, x.n_chars)
    found = stages["language_id"](spark, docs, str(tmp_path))
    assert Counter(map(key, found.collect())) == Counter(r for r in rows if r[1])
    found = stages["simhash_near_dedup"](spark, docs, str(tmp_path))
    assert Counter(map(key, found.collect())) == Counter(r for r in rows if r[0] != 31)
    found = stages["decontamination"](spark, docs, str(tmp_path))
    assert Counter(map(key, found.collect())) == Counter(rows)
    found = stages["token_shards"](spark, docs, str(tmp_path))
    assert Counter(x.doc_id for x in found.collect()) == Counter(r[0] for r in rows)


def test_the_mix_writes_what_it_takes(spark, docs, rows):
    taken = sum(x.taken for x in mixing.pareto_mix(docs).collect())
    out = mixing.mixed(docs).collect()
    assert sum(len((x.text or "").split()) for x in out) == taken and out[0].asDict().keys() == set(docs.columns)
    by = Counter()
    for x in mixing.pareto_mix(docs.where("size(split(text, ' ')) < 1000")).collect():
        by[x.source, x.target] += x.taken
    assert all(abs(n - target) < 60 for (_, target), n in by.items())


def test_inclusion_is_unequal_and_pareto_ranked(spark):
    """Longer documents are drawn more often, by the ratio of odds, and the certain copies are everybody's."""
    rows = [(i, "w " * (10 if i % 2 else 200), "abc"[i % 3 - 1]) for i in range(3000)]
    got = mixing.pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(x.copies <= 2 for x in got)
    for source in "abc":
        own = [x for x in got if x.source == source]
        due = own[0].target / own[0].source_size
        assert abs(sum(x.taken for x in own) - own[0].target) <= 100
        share = [sum(x.copies for x in own if x.size == n) / sum(1 for x in own if x.size == n) for n in (10, 200)]
        if due % 1:
            assert share[1] > share[0] + 0.01 and min(x.copies for x in own) >= int(due)
