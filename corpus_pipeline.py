"""The training-data pipeline: five stages over the documents table, each on one operator of ``corpusloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import release_driver, scratch_path, unnamed
from corpusloom.llm.decontaminate import contaminated
from corpusloom.llm.langid import predict_language, train_language_models
from corpusloom.llm.mixing import mixed
from corpusloom.llm.simhash import near_duplicates
from corpusloom.llm.sstable import read_token_shards, write_token_shards


#: Rows that travel to a Python worker at once. The stages share their workers and executors, so batches are kept to a few megabytes.
BATCH_ROWS = 1000


def _begin(spark: SparkSession) -> None:
    """Give back what the stage before left; hold Arrow batches to ``BATCH_ROWS`` in this session, unless they are smaller: stages are run after they return."""
    release_driver(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, str(min(BATCH_ROWS, int(spark.conf.get(name)) if int(spark.conf.get(name)) > 0 else BATCH_ROWS)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model accepts; those it rejects (null, empty, without letters, or unlike every language learned) go.

    Texts of any length are read whole; repeated rows are decided alike; without labelled rows every document is rejected.
    """
    _begin(spark)
    model = train_language_models(docs)
    plain = unnamed(docs)
    found = predict_language(plain, model, plain.columns[0], f"c{docs.columns.index('text')}", keep=tuple(plain.columns[1:]))
    return found.where(~F.col("rejected")).select(*plain.columns).toDF(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id: five-word shingles, similarity 0.8.

    Texts without words (null, empty) are one group; rows with one doc_id are one document and stay or go together; rows without
    doc_id stay.
    """
    _begin(spark)
    gone = near_duplicates(docs).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts have none, rows with one doc_id go together, rows without stay."""
    _begin(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    hit = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, at most twice, with the same columns.

    Null, empty and wordless texts are due like others of their source, but take no words; repeated rows are mixed row by row.
    """
    _begin(spark)
    return mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as token identifiers in shard images, read back: doc_id, start, n_tokens, ids_crc32 per row of docs.

    Null and empty texts are their end identifier alone; repeated rows follow each other.
    """
    _begin(spark)
    # the workers also hold what earlier stages left: a smaller word cache than a run of this operator alone would take
    return read_token_shards(write_token_shards(docs, scratch_path(spark, "pipeline-shards"), cache_words=150_000))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("token_shards", token_shards),
]

#: Language models, fingerprints and tokenizers are beyond SQL; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
