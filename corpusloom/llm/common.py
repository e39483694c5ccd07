"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, NullType, ShortType

#: Text bytes that one vectorised step works on; bounds a Python worker's memory.
CHUNK_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests, a laptop) a temporary folder is made.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(found)
        return found.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of df by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, name: str = "step", plain: bool = False) -> tuple[DataFrame, str]:
    """df written as a table in the shared folder and read again, and its path: for plans that join a result with itself.

    ``plain``: hashes, which no encoding makes smaller, are written as they are.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", "none").option("parquet.enable.dictionary", "false") if plain else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def integer_id(docs: DataFrame, id_col: str) -> Column:
    """The identifier as a 64-bit integer; other identifiers are refused, since a cast would fail on some rows or merge others."""
    kind = docs.select(id_col).schema[0].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType, NullType)):
        raise TypeError(f"{id_col}: identifiers must be integers, not {kind.simpleString()}")
    return F.col(id_col).cast("long")


def unnamed(docs: DataFrame) -> DataFrame:
    """docs with its columns called c0, c1 ...: what is added then clashes with none; ``toDF`` with the old names undoes it."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def read_documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The named columns of the documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(cols or ("doc_id", "text")))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its task, and the next operator's task runs in it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def release_driver(spark: SparkSession) -> None:
    """Give back what ended queries hold: the driver's memory, and through Spark's cleaner the shuffles and checkpoints that nothing refers to."""
    release_memory()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    with contextlib.suppress(Py4JError):  # a virtual machine without this command
        commands = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        none = [spark.sparkContext._gateway.new_array(kind, 0) for kind in (jvm.Object, jvm.String)]
        commands.invoke(jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", *none)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of consecutive texts of about ``limit`` bytes; a longer text stands alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield slice(start, i)
            start, held = i, 0
        held += len(t) + 64
    if start < len(texts):
        yield slice(start, len(texts))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def partitions_for(spark: SparkSession, n_bytes: float, each: float = 16e6, least: int = 12) -> int:
    """Partitions so that each holds about ``each`` bytes, never fewer than the session's shuffle partitions."""
    return int(max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // each)))


def plan_bytes(df: DataFrame) -> float:
    """Catalyst's size estimate of df, in bytes (compressed, for a file scan); where Catalyst knows none, the bytes are counted."""
    estimate = float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < 1e16:
        return estimate
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    return float(df.agg(F.sum(sum(wide, F.lit(16)))).first()[0] or 0)


def _coefficients(n: int) -> np.ndarray:
    """Odd pseudo-random multipliers by place in a word."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) | np.uint64(1)


COEFFICIENTS = _coefficients(256)
#: The white space that parts words (space and 9 to 13).
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of different uint64 values, and for every element the number of its value; what collides in the table is sorted."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slot = ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 22)).astype(np.int64)
    table = np.zeros(1 << 22, np.int32)
    table[slot] = np.arange(len(values), dtype=np.int32)
    rep = table[slot]
    own = np.flatnonzero(rep == np.arange(len(values)))
    number = np.zeros(len(values), np.int64)
    number[own] = np.arange(len(own))
    index = number[rep]
    missed = np.flatnonzero(values[rep] != values)
    if len(missed):
        _, first, more = np.unique(values[missed], return_index=True, return_inverse=True)
        index[missed] = len(own) + more
        own = np.concatenate((own, missed[first]))
    return own, index


def index_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words of texts (A-Z lower-cased), the number of each word in reading order, and the words per text.

    Words are told apart by their length and a 64-bit multilinear hash, computed over all bytes at once.
    """
    joined = b"\n".join(texts).lower()
    flat = np.frombuffer(joined, np.uint8)
    gap = np.concatenate(([True], SPACE[flat], [True]))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    per_text = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
    if not len(starts):
        return [], np.zeros(0, np.int64), per_text
    longest = int(lengths.max())
    by = COEFFICIENTS if longest <= len(COEFFICIENTS) else _coefficients(longest)
    h = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), 1 << 15):  # slices stay in the processor's cache
        s, n = starts[lo : lo + (1 << 15)], lengths[lo : lo + (1 << 15)]
        part = flat[s[0] : s[-1] + n[-1]]
        inside = np.flatnonzero(~gap[s[0] + 1 : s[-1] + n[-1] + 1])
        place = inside - np.repeat(s - s[0], n)
        h[lo : lo + len(s)] = np.add.reduceat(by[place] * (part[inside].astype(np.uint64) + np.uint64(1)), np.cumsum(n) - n)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + lengths.astype(np.uint64)
    own, index = distinct(h)
    return [joined[a:b] for a, b in zip(starts[own].tolist(), (starts + lengths)[own].tolist())], index, per_text
