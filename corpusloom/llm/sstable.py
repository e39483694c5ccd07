"""Token identifiers in sorted-string-table shards.

A shard image is: data blocks, index block, Bloom filter, footer. A block holds prefix-compressed entries
(varint shared key bytes, varint own key bytes, varint value bytes, key suffix, value), then the offsets of its
restart points, where a whole key stands, and is compressed as one. The index block has the last key, place
and length of every data block. All integers in the fixed parts are little-endian.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import CHUNK_BYTES, chunks, index_words, integer_id, partitions_for, plan_bytes, ranges, read_documents, release_memory, scratch_path, text_bytes

MAGIC = b"CLSST001"
FOOTER = struct.Struct("<QQQQQQ8s")
RESTART_EVERY = 16
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 8 << 20
BITS_PER_KEY, PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    """Order-preserving key of an identifier; null sorts first."""
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


class _Block:
    def __init__(self):
        self.out, self.restarts, self.last, self.n = bytearray(), [], b"", 0

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.n % RESTART_EVERY:
            shared = len(os.path.commonprefix((self.last, key)))
        else:
            self.restarts.append(len(self.out))
        self.out += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last, self.n = key, self.n + 1

    def finish(self) -> bytes:
        tail = struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))
        return zstandard.ZstdCompressor(level=1).compress(bytes(self.out) + tail)


class _BlockReader:
    def __init__(self, packed: bytes):
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = struct.unpack_from("<I", raw, len(raw) - 4)[0]
        self.end = len(raw) - 4 - 4 * n
        self.restarts, self.raw = struct.unpack_from(f"<{n}I", raw, self.end), raw

    def entries(self, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < self.end:
            shared, at = _read_varint(self.raw, at)
            own, at = _read_varint(self.raw, at)
            size, at = _read_varint(self.raw, at)
            key = key[:shared] + self.raw[at : at + own]
            at += own
            yield key, self.raw[at : at + size]
            at += size

    def seek(self, key: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Entries from the last restart point whose key is below ``key``."""
        lo, hi = 0, len(self.restarts)
        while lo < hi:
            mid = (lo + hi) // 2
            if next(self.entries(self.restarts[mid]))[0] < key:
                lo = mid + 1
            else:
                hi = mid
        return self.entries(self.restarts[max(lo - 1, 0)])


def _probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh64_intdigest(key)
    step = (h >> 33) | 1
    return [(h + i * step) % bits for i in range(PROBES)]


class SSTableWriter:
    """Collects entries in ascending key order (equal keys may repeat) and gives the shard image."""

    def __init__(self):
        self.body, self.index, self.block, self.keys, self.first, self.last = bytearray(), _Block(), _Block(), [], None, b""

    def add(self, key: bytes, value: bytes) -> None:
        if self.keys and key < self.last:
            raise ValueError("keys must ascend")
        self.block.add(key, value)
        self.keys.append(key)
        self.last = key
        if len(self.block.out) >= BLOCK_BYTES:
            self._cut()

    def _cut(self) -> None:
        if self.block.n:
            data = self.block.finish()
            self.index.add(self.block.last, struct.pack("<QQ", len(self.body), len(data)))
            self.body += data
            self.block = _Block()

    def size(self) -> int:
        return len(self.body) + len(self.block.out)

    def finish(self) -> bytes:
        self._cut()
        at_index, index = len(self.body), self.index.finish()
        bits = max(64, -(-len(self.keys) * BITS_PER_KEY // 8) * 8)
        bloom = bytearray(bits // 8)
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        at_bloom = at_index + len(index)
        return bytes(self.body) + index + bytes(bloom) + FOOTER.pack(at_index, len(index), at_bloom, len(bloom), len(self.keys), zlib.crc32(self.body), MAGIC)


class SSTable:
    """Reads a shard image: ``get`` by Bloom filter and binary searches, ``items`` in order."""

    def __init__(self, image: bytes):
        self.image = image
        at_index, n_index, at_bloom, n_bloom, self.count, crc, magic = FOOTER.unpack_from(image, len(image) - FOOTER.size)
        if magic != MAGIC or zlib.crc32(memoryview(image)[:at_index]) != crc:
            raise ValueError("not a whole shard image")
        self.blocks = [(k, *struct.unpack("<QQ", v)) for k, v in _BlockReader(image[at_index : at_index + n_index]).entries()]
        self.lasts, self.bloom = [b[0] for b in self.blocks], image[at_bloom : at_bloom + n_bloom]

    def may_hold(self, key: bytes) -> bool:
        return all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, 8 * len(self.bloom)))

    def _open(self, k: int) -> _BlockReader:
        _, at, size = self.blocks[k]
        return _BlockReader(self.image[at : at + size])

    def get(self, key: bytes) -> list[bytes]:
        """Values of all entries with this key."""
        found: list[bytes] = []
        if not self.may_hold(key):
            return found
        for k in range(bisect_left(self.lasts, key), len(self.blocks)):
            for own, value in self._open(k).seek(key):
                if own > key:
                    return found
                if own == key:
                    found.append(value)
        return found

    def items(self) -> Iterator[tuple[bytes, bytes]]:
        for k in range(len(self.blocks)):
            yield from self._open(k).entries()


class WordCachedEncoder:
    """Encodes texts by a tokenizer that never merges across white space, each different word once.

    Words are cut at ASCII white space and A-Z lower-cased (the tokenizer lower-cases all; texts with
    ``<|``, which may start a special token, go to the tokenizer whole). Trailing punctuation is a token of its own behind a
    letter, so the stem is encoded alone. At ``limit`` words the cache is cut back to those of the last texts.
    """

    PUNCTUATION = b".,!?:;"

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.limit, self.cache = limit, {}
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _encode(self, words: list[bytes]) -> None:
        """Cache words: ASCII letters by the tokenizer's model; other letters in one call, cut at the tokens that end a word; the rest one by one."""
        width, rest, plain, ascii_ = self.dtype.itemsize, [], [], []
        for w in words:
            (ascii_ if w.isalpha() else plain if w.decode().isalpha() else rest).append(w)
        tokenize = self.tokenizer.model.tokenize  # a lower-case ASCII word passes the steps before the model as it is
        parts = [[t.id for t in tokenize(w.decode())] for w in ascii_]
        data = self._pack([i for p in parts for i in p])
        ends = np.cumsum([len(p) * width for p in parts]).tolist()
        self.cache.update(zip(ascii_, (data[a:b] for a, b in zip([0, *ends], ends))))
        for lo in range(0, len(plain), 4096):
            part = plain[lo : lo + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, self.dtype)
            ends = ((np.flatnonzero(self.word_end[ids]) + 1) * width).tolist()
            if len(ends) == len(part):
                data = ids.tobytes()
                self.cache.update(zip(part, (data[a:b] for a, b in zip([0, *ends], ends))))
            else:
                rest += part
        for w, e in zip(rest, self.tokenizer.encode_batch([w.decode() for w in rest], add_special_tokens=False)):
            self.cache[w] = self._pack(e.ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed identifiers of each text."""
        words, index, per_text = index_words([b"" if b"<|" in t else t for t in texts])
        cache = self.cache
        missing = set(words).difference(cache)
        if missing:
            if len(cache) + len(missing) > self.limit:
                cache = self.cache = {w: cache[w] for w in words if w not in missing}
            cut = [(w, s) for w in missing if (s := w.rstrip(self.PUNCTUATION)) != w and s[-1:].isalpha()]
            tails = {w[len(s) :] for w, s in cut}
            self._encode(sorted((missing.difference(w for w, _ in cut) | {s for _, s in cut} | tails).difference(cache)))
            cache.update((w, cache[s] + cache[w[len(s) :]]) for w, s in cut)
        packed = [cache[w] for w in words]
        width = self.dtype.itemsize
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // width
        ids = np.frombuffer(b"".join(packed), self.dtype)
        flat = ids[ranges((np.cumsum(size) - size)[index], size[index])].tobytes()
        ends = (np.concatenate(([0], np.cumsum(size[index])))[np.cumsum(per_text)] * width).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for i, t in enumerate(texts):
            if b"<|" in t:
                out[i] = self._pack(self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return out


#: Words that a worker keeps; about 250 bytes each.
CACHE_WORDS = 500_000


@lru_cache(2)
def encoder_for(path: str, limit: int = CACHE_WORDS) -> WordCachedEncoder:
    """One encoder per Python worker: tasks that run in the same worker share its cache."""
    return WordCachedEncoder(path, limit)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """Write shard images below ``path`` and return their table, read back.

    Columns: shard, part (shards in ascending order of (shard, part) hold ascending identifiers), first_id, last_id, n_docs, n_tokens,
    image. Documents are range-partitioned by identifier and sorted, so no task sees more than its range. Images are
    cells of a Parquet table: Spark's committer makes them whole or absent when executors are lost, and
    any store that Spark writes to can hold them. A null text is an empty one (only the end identifier); rows with equal
    identifiers are all kept, ordered by text; null identifiers come first.
    """
    spark = docs.sparkSession
    where = tokenizer or default_tokenizer()
    rows = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        encoder = encoder_for(where, cache_words)
        end, shard, part = encoder._pack([end_id]), TaskContext.get().partitionId(), 0
        table, ids, tokens = SSTableWriter(), [], 0
        names = ["shard", "part", "first_id", "last_id", "n_docs", "n_tokens", "image"]

        def cut() -> pa.RecordBatch:
            row = (shard, part, ids[0], ids[-1], len(ids), tokens, table.finish())
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            texts, own = text_bytes(batch.column(1)), batch.column(0).to_pylist()
            for s in chunks(texts, CHUNK_BYTES):
                for doc_id, packed in zip(own[s], encoder.encode(texts[s])):
                    value = bytes([encoder.dtype.itemsize]) + packed + end
                    table.add(key_of(doc_id), value)
                    ids.append(doc_id)
                    tokens += (len(value) - 1) // encoder.dtype.itemsize
                    if table.size() >= SHARD_BYTES:
                        yield cut()
                        table, ids, tokens, part = SSTableWriter(), [], 0, part + 1
        if ids:
            yield cut()
        release_memory()

    parts = partitions_for(spark, plan_bytes(rows), 16e6)
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(build, "shard int, part int, first_id long, last_id long, n_docs long, n_tokens long, image binary").write.parquet(path)
    return spark.read.parquet(path)


def read_token_shards(shards: DataFrame) -> DataFrame:
    """One row per document from the images: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the identifiers of all documents before it: a running sum over the shard list (one row per image)
    plus the running sum inside the image.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part, image in zip(*(batch.column(k).to_pylist() for k in range(3))):
                out, at = [], 0
                for key, value in SSTable(image).items():
                    ids = np.frombuffer(value, f"<u{value[0]}", offset=1)
                    out.append((id_of(key), at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                doc_id, start, n, crc = (pa.array(c, pa.int64()) for c in zip(*out))
                same = [pa.array(np.full(len(out), x, np.int32)) for x in (shard, part)]
                yield pa.RecordBatch.from_arrays([*same, doc_id, start, n, crc], ["shard", "part", "doc_id", "at", "n_tokens", "ids_crc32"])

    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", "part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    docs = shards.select("shard", "part", "image").mapInArrow(scan, "shard int, part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, ["shard", "part"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents, from the images read back."""
    return read_token_shards(write_token_shards(read_documents(spark, sf_dir), scratch_path(spark, "token-shards")))
