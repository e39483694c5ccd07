"""Cutting lineage, and the build log."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = "stage string, completed_at timestamp, article_count long, notes string"


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut in the folder of ``spark.checkpoint.dir`` (a temporary one only where it is not set and the master is local)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints, which driver and executors share."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="corpusloom-"))
    return context._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the folder of checkpoints: what is read several times is read by column there. Tables stay as long as the folder does."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_row(spark: SparkSession, stage: str, article_count: int | None = None, notes: str | None = None) -> DataFrame:
    one = spark.range(1).select(F.lit(stage).alias("stage"), F.current_timestamp().alias("completed_at"), F.lit(article_count).cast("long").alias("article_count"), F.lit(notes).cast("string").alias("notes"))
    return one


def stored_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's rows below a path; none where nothing has been written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(STATE_SCHEMA).parquet(path) if there else spark.createDataFrame([], STATE_SCHEMA)


def latest_states(log: DataFrame) -> DataFrame:
    """The last row per stage."""
    last = log.groupBy("stage").agg(F.max(F.struct("completed_at", "article_count", "notes")).alias("s"))
    return last.select("stage", "s.completed_at", "s.article_count", "s.notes")
