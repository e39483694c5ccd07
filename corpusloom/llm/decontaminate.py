"""Benchmark decontamination: rare word n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import chunks, index_words, integer_id, ranges, read_documents, release_memory, text_bytes

#: Words per seed; shorter items are not searched (nothing tells a copy from chance).
SEED_WORDS = 4
#: Items are searched in blocks of at most so many items and bytes: the bound of what is broadcast at once.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
#: A seed is rare in at most this share of the documents, or in at most so many times the documents of its item's median seed.
RARE_SHARE, RARE_TIMES = 1e-4, 4
#: Score of an equal word, a different word, a word left out; and the share of an item's full score that is contamination.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
#: Punctuation is white space to the word splitter.
PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
ORIGIN = 20


@dataclass
class Block:
    """Items as word numbers, and their seeds as sorted hashes with every (item, place) that has each."""

    ids: list
    words: dict[bytes, int]
    items: list[np.ndarray]
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Block:
        words: dict[bytes, int] = {}
        items = []
        for _, text in rows:
            items.append(np.array([words.setdefault(w, len(words)) for w in (text or "").encode().translate(PLAIN).lower().split()], np.int64))
        hashes = [seed_hashes(x) for x in items]
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, np.int64)])
        h = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        order = np.argsort(h, kind="stable")
        seeds, first = np.unique(h[order], return_index=True)
        return cls([r[0] for r in rows], words, items, seeds, np.append(first, len(h)), owner[order], place[order])

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(document, word place in it, seed number) of every seed in texts, the word numbers of all texts (-1: not in an item), and the words per text."""
        words, index, sizes = index_words([t.translate(PLAIN) for t in texts])
        get = self.words.get
        number = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        flat = number[index] if len(words) else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        ok = flat >= 0
        at = np.flatnonzero(ok[: len(ok) - SEED_WORDS + 1]) if len(ok) >= SEED_WORDS else np.zeros(0, np.int64)
        for k in range(1, SEED_WORDS):
            at = at[ok[at + k]]
        at = at[doc[at] == doc[at + SEED_WORDS - 1]]
        h = _hash([flat[at + k] for k in range(SEED_WORDS)])
        found = np.minimum(np.searchsorted(self.seeds, h), max(len(self.seeds) - 1, 0))
        hit = self.seeds[found] == h if len(self.seeds) else np.zeros(len(h), bool)
        starts = np.cumsum(sizes) - sizes
        return doc[at[hit]], at[hit] - starts[doc[at[hit]]], found[hit], flat, sizes


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ (c.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def seed_hashes(item: np.ndarray) -> np.ndarray:
    n = len(item) - SEED_WORDS + 1
    return _hash([item[k : k + n] for k in range(SEED_WORDS)]) if n > 0 else np.zeros(0, np.uint64)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its window: score, first and last window word.

    A cell holds its score above its origin (places counted backwards, so that of equal scores the leftmost start wins); a row is
    computed at once, the gap along it by a running maximum.
    """
    n, width = len(items), max(map(len, windows))
    depth = max(map(len, items))
    a, b = np.full((n, depth), -2, np.int64), np.full((n, width), -1, np.int64)
    for i, (x, y) in enumerate(zip(items, windows)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    place = np.arange(width)
    zero = (1 << ORIGIN) - 1 - place  # a path that starts at this word
    unit = 1 << ORIGIN
    row = np.tile((1 << ORIGIN) - 1 - np.arange(width + 1), (n, 1))
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(depth):
        step = np.where(a[:, k : k + 1] == b, MATCH * unit, MISMATCH * unit)
        now = np.maximum(row[:, :-1] + step, np.maximum(row[:, 1:] + GAP * unit, zero))
        run = np.maximum.accumulate(now - GAP * unit * place, axis=1) + GAP * unit * place
        now = np.maximum(now, run)
        now = np.where(now < unit, zero, now)
        top = now.argmax(axis=1)
        value = now[np.arange(n), top]
        better = (value > best) & (a[:, k] >= 0)
        best, end = np.where(better, value, best), np.where(better, top, end)
        # cell j + 1 of the next row's left neighbour is word j: its path may start at word j + 1
        row = np.concatenate((np.full((n, 1), (1 << ORIGIN) - 1), np.where(now < unit, zero - 1, now)), axis=1)
    return best >> ORIGIN, (1 << ORIGIN) - 1 - (best & (unit - 1)), end


def candidates(block: Block, rare: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(document, item, first word, seeds, window) around every cluster of an item's rare seeds."""
    doc, place, seed, flat, counts = block.hits(texts)
    live = rare[seed]
    doc, place, seed = doc[live], place[live], seed[live]
    if not len(doc):
        return
    n = block.first[seed + 1] - block.first[seed]
    at = ranges(block.first[seed], n)
    doc, place, item = np.repeat(doc, n), np.repeat(place, n), block.item[at]
    offset = block.place[at]
    order = np.lexsort((place, item, doc))
    doc, place, item, offset = doc[order], place[order], item[order], offset[order]
    length = np.array([len(x) for x in block.items])
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > length[item[1:]])
    cut = np.flatnonzero(new)
    stop = np.append(cut[1:], len(doc)) - 1
    base = np.cumsum(counts) - counts
    for i, j in zip(cut.tolist(), stop.tolist()):
        d, m = int(doc[i]), int(length[item[i]])
        # a long stretch of seeds (a passage repeated on end) is cut into windows of a few item lengths, overlapping by two
        lo, last = max(0, int(place[i]) - 2 * m), int(place[j]) + 2 * m
        while True:
            hi = min(last, lo + 8 * m, int(counts[d]))
            yield d, int(item[i]), lo, j - i + 1, flat[base[d] + lo : base[d] + hi]
            if hi >= min(last, int(counts[d])):
                break
            lo = hi - 2 * m


def matches_of(block: Block, rare: np.ndarray, texts: list[bytes], least: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(document, item, score, first word, last word, seeds) with at least this share of the full score; the best per pair."""
    best: dict[tuple[int, int], tuple] = {}
    sized = defaultdict(list)

    def settle(group) -> None:
        items = [block.items[c[1]] for c in group]
        for c, item, score, first, last in zip(group, items, *(x.tolist() for x in align(items, [c[4] for c in group]))):
            share = score / (MATCH * len(item))
            if share >= least and share > best.get(c[:2], (0,))[0]:
                best[c[:2]] = (share, c[2] + first, c[2] + last, c[3])

    for c in candidates(block, rare, texts):
        group = sized[len(c[4]).bit_length()]
        group.append(c)
        if len(group) * len(c[4]) >= 40_000:
            settle(group)
            group.clear()
    for group in sized.values():
        if group:
            settle(group)
    for (doc, item), (score, first, last, n) in best.items():
        yield doc, item, score, first, last, n


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The items in blocks of bounded size, streamed to the driver one block at a time."""
    rows, held = [], 0
    for r in benchmark.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        rows.append((r[0], r[1]))
        held += len(r[1] or "")
        if len(rows) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
            yield Block.of(rows)
            rows, held = [], 0
    if rows:
        yield Block.of(rows)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", least: float = LEAST_SCORE
) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word, n_seeds) of every document and benchmark item that align.

    Two passes over the documents per block of items, neither with a shuffle of texts: the first counts in how many documents
    each seed occurs, the second aligns items with the words around their rare seeds. Score 1 is a verbatim copy.
    Words are lower-cased (A-Z), ASCII punctuation parts them. Null and empty texts match nothing, repeated rows
    give one match, items under four words are not searched.
    """
    spark = docs.sparkSession
    source = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, first_word long, last_word long, n_seeds long"
    names = [c.split()[0] for c in schema.split(", ")]
    out = spark.createDataFrame([], schema)
    n_docs = None
    for block in benchmark_blocks(benchmark, item_id_col, item_text_col):
        held = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = held.value
            total = np.zeros(len(block.seeds), np.int64)
            for batch in batches:
                texts = text_bytes(batch.column(0))
                for s in chunks(texts):
                    doc, _, seed, *_ = block.hits(texts[s])
                    total += np.bincount(np.unique(doc * len(block.seeds) + seed) % max(len(block.seeds), 1), minlength=len(block.seeds))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["seed", "n"])

        found = np.zeros(len(block.seeds), np.int64)
        for r in source.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
            found[r.seed] = r.n
        n_docs = source.count() if n_docs is None else n_docs
        rare = spark.sparkContext.broadcast(rare_seeds(block, found, n_docs))

        def search(batches: Iterator[pa.RecordBatch], held=held, rare=rare) -> Iterator[pa.RecordBatch]:
            block = held.value
            for batch in batches:
                texts, ids = text_bytes(batch.column(1)), batch.column(0).to_pylist()
                for s in chunks(texts):
                    own = ids[s]
                    rows = [(own[d], block.ids[i], *rest) for d, i, *rest in matches_of(block, rare.value, texts[s], least)]
                    if rows:
                        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            release_memory()

        out = out.unionByName(source.mapInArrow(search, schema))
    return out.distinct()


def rare_seeds(block: Block, found: np.ndarray, n_docs: int) -> np.ndarray:
    """Which seeds are rare: in at most ``RARE_SHARE`` of the documents, or not far more frequent than their item's other seeds.

    Of the seeds of an item that occur, the median document count is that of its copies, if it has many; seeds of common words are
    beyond ``RARE_TIMES`` the median. So an item in very many documents, some of them edited, keeps its seeds.
    """
    rare = found <= RARE_SHARE * n_docs
    seed = np.repeat(np.arange(len(block.seeds)), np.diff(block.first))
    occurs = found[seed] > 0
    seed, item = seed[occurs], block.item[occurs]
    order = np.lexsort((found[seed], item))
    seed, item = seed[order], item[order]
    size = np.bincount(item, minlength=len(block.items))
    start = np.cumsum(size) - size
    median = np.zeros(len(block.items), np.int64)
    median[size > 0] = found[seed[(start + (size - 1) // 2)[size > 0]]]
    rare[seed[found[seed] <= RARE_TIMES * median[item]]] = True
    return rare


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) that aligns, with its score and place, over all documents and items."""
    return contaminated(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
