"""SimHash near-duplicates linked through the anchors of a covering code."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import as_table, chunks, drop_table, integer_id, materialise, partitions_for, ranges, read_documents, release_driver, release_memory, scratch_path, text_bytes
from corpusloom.llm.components import connected_components
from corpusloom.llm.differences import components_of, with_far_groups

SEED = 42
#: Shingles whose bits are counted in one numpy step.
STEP = 1 << 16
#: Above so many different fingerprints two wide blocks replace three narrow ones.
WIDE_ABOVE = 30_000_000
#: Members of one anchor that are compared by shifted arrays; larger groups are compared in blocks.
SMALL = 48


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of every ``width``-word shingle of a text, A-Z lower-cased, repeats kept."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    return [digest(joined[i:j], SEED) for i, j in zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())]


def fingerprints(texts: list[bytes], width: int = 4) -> np.ndarray:
    """Majority-vote fingerprints (uint64); a text without words has fingerprint 0."""
    return votes((shingle_hashes(t, width) for t in texts), len(texts))


def votes(hashes: Iterable[list[int]], n: int) -> np.ndarray:
    """Majority-vote fingerprints of n lists of shingle hashes."""
    out = np.zeros(n, np.uint64)
    held: list[list[int]] = []
    at: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            h = np.fromiter((x for hs in held for x in hs), np.uint64, int(lengths.sum()))
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            ones = np.zeros((len(held), 64), np.int64)
            for lo in range(0, len(h), STEP):
                part = np.unpackbits(h[lo : lo + STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
                first = int(np.searchsorted(starts, lo, "right")) - 1
                cuts = np.maximum(starts[first : int(np.searchsorted(starts, lo + len(part), "left"))] - lo, 0)
                ones[first : first + len(cuts)] += np.add.reduceat(part, cuts, axis=0, dtype=np.int32)
            out[at] = np.packbits(ones * 2 > lengths[:, None], axis=1).view(">u8")[:, 0]
        held.clear()
        at.clear()
        size = 0

    for i, hs in enumerate(hashes):
        if hs:
            held.append(hs)
            at.append(i)
            size += len(hs)
            if size >= STEP:
                flush()
    flush()
    return out


def with_fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, fp) of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            fps = [fingerprints(texts[s], width) for s in chunks(texts)]
            fp = np.concatenate(fps) if fps else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


class Covering:
    """A covering code over blocks of a 64-bit fingerprint.

    At most ``threshold`` differing bits leave one of ``n_blocks`` blocks with at most
    t = threshold // n_blocks. In a block, the anchors are the words of a perfect Hamming code (covering radius 1) on
    its low bits times all values of its other bits. A fingerprint is replicated to every anchor within 1 + t: the
    anchor nearest to one fingerprint of a linked pair then also gets the other.
    """

    def __init__(self, threshold: int, n_blocks: int):
        parity = 4 if n_blocks > 2 else 5
        self.code = (1 << parity) - 1
        cuts = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
        self.blocks = list(zip(cuts[:-1], cuts[1:]))
        reach = 1 + threshold // n_blocks
        self.masks = []
        for lo, hi in self.blocks:
            by: list[list[int]] = [[] for _ in range(self.code + 1)]
            for weight in range(reach + 1):
                for bits in combinations(range(hi - lo), weight):
                    syndrome = 0
                    for b in bits:
                        syndrome ^= b + 1 if b < self.code else 0
                    by[syndrome].append(sum(1 << b for b in bits))
            self.masks.append([np.array(sorted(m), np.uint64) for m in by])

    def anchors(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(indexes of fps, anchor keys), a pair of arrays per block and syndrome."""
        for k, (lo, hi) in enumerate(self.blocks):
            part = (fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            syndrome = np.zeros(len(fps), np.int64)
            for b in range(min(self.code, hi - lo)):
                syndrome ^= ((part >> np.uint64(b)) & np.uint64(1)).astype(np.int64) * (b + 1)
            for s, masks in enumerate(self.masks[k]):
                rows = np.flatnonzero(syndrome == s)
                if len(rows) and len(masks):
                    keys = (part[rows][:, None] ^ masks[None, :]) | np.uint64(k << 40)
                    yield np.repeat(rows, len(masks)), keys.ravel().view(np.int64)


def _linked(fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked members, comparing within each group; each group gives a spanning forest only."""
    label = np.arange(len(fp))

    def join(i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = label[i], label[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up

    small = sizes <= SMALL
    at = ranges(starts[small], sizes[small])
    end = np.repeat(starts[small] + sizes[small], sizes[small])
    found_i, found_j = [], []
    for lag in range(1, int(sizes[small].max(initial=1))):
        live = at + lag < end
        at, end = at[live], end[live]
        near = np.bitwise_count(fp[at] ^ fp[at + lag]) <= threshold
        found_i.append(at[near])
        found_j.append(at[near] + lag)
    if found_i:
        join(np.concatenate(found_i), np.concatenate(found_j))
    for s, n in zip(starts[~small].tolist(), sizes[~small].tolist()):
        own = fp[s : s + n]
        for lo in range(0, n, 256):
            rows = own[lo : lo + 256]
            for col in range(lo, n, 8192):
                i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ own[None, col : col + 8192]) <= threshold)
                i, j = i + s + lo, j + s + col
                new = label[i] != label[j]
                join(i[new], j[new])
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return moved, label[moved]


def fingerprint_links(fps: DataFrame, threshold: int, n: int) -> DataFrame:
    """Links (a, b) between the ids of different fingerprints within ``threshold`` bits; fps has (id, fp), ``n`` rows."""
    cover = Covering(threshold, 2 if n > WIDE_ABOVE else 3)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 10_000):
                part = batch.slice(lo, 10_000)
                ids, fp = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                for rows, keys in cover.anchors(fp.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[rows]), pa.array(fp[rows])], ["anchor", "id", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def settle(key, ids, fp):
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            several = sizes > 1
            i, j = _linked(fp.view(np.uint64), starts[several], sizes[several], threshold)
            return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], ["a", "b"])

        for batch in batches:
            held = [np.concatenate((x, batch.column(k).to_numpy(zero_copy_only=False))) for k, x in enumerate(held)]
            if len(held[0]) and held[0][0] != held[0][-1]:
                cut = int(np.searchsorted(held[0], held[0][-1], "left"))  # the last group may go on in the next batch
                yield settle(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield settle(*held)

    parts = partitions_for(fps.sparkSession, n * 45 * 24, 24e6)
    dealt = fps.select("id", "fp").mapInArrow(replicate, "anchor long, id long, fp long").repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def fingerprint_pairs(fps: DataFrame, threshold: int, n: int) -> DataFrame:
    """All pairs (fp_a, fp_b) within ``threshold`` bits, a fingerprint with itself included, but those with all documents in one component.

    fps has (fp, lo, hi), each fingerprint once with the least and the greatest component of its documents.
    """
    cover = Covering(threshold, 2 if n > WIDE_ABOVE else 3)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 10_000):
                part = batch.slice(start, 10_000)
                fp, lo, hi = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
                for rows, keys in cover.anchors(fp.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, fp[rows], lo[rows], hi[rows])], ["anchor", "fp", "lo", "hi"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4

        def settle(key, fp, lo, hi) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            bits, found_i, found_j = fp.view(np.uint64), [], []

            def keep(i: np.ndarray, j: np.ndarray) -> None:
                hit = (np.minimum(lo[i], lo[j]) != np.maximum(hi[i], hi[j])) & (np.bitwise_count(bits[i] ^ bits[j]) <= threshold)
                found_i.append(fp[i[hit]])
                found_j.append(fp[j[hit]])

            small = sizes <= SMALL
            at = ranges(starts[small], sizes[small])
            end = np.repeat(starts[small] + sizes[small], sizes[small])
            for lag in range(1, int(sizes[small].max(initial=1))):
                live = at + lag < end
                at, end = at[live], end[live]
                keep(at, at + lag)
            for s, m in zip(starts[~small].tolist(), sizes[~small].tolist()):
                for row in range(s, s + m, 256):
                    rows = np.arange(row, min(row + 256, s + m))
                    i, j = np.nonzero(np.bitwise_count(bits[rows][:, None] ^ bits[None, row : s + m]) <= threshold)
                    i, j = rows[i], j + row
                    keep(i[i < j], j[i < j])
            i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_j))
            pair = np.unique(np.stack((i, j), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["fp_a", "fp_b"])

        for batch in batches:
            held = [np.concatenate((x, batch.column(k).to_numpy(zero_copy_only=False))) for k, x in enumerate(held)]
            if len(held[0]) and held[0][0] != held[0][-1]:
                cut = int(np.searchsorted(held[0], held[0][-1], "left"))  # the last group may go on in the next batch
                yield settle(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield settle(*held)

    parts = partitions_for(fps.sparkSession, n * 45 * 32, 24e6)
    dealt = fps.select("fp", "lo", "hi").mapInArrow(replicate, "anchor long, fp long, lo long, hi long").repartition(parts, "anchor").sortWithinPartitions("anchor")
    itself = fps.where("lo <> hi").select(F.col("fp").alias("fp_a"), F.col("fp").alias("fp_b"))
    return dealt.mapInArrow(compare, "fp_a long, fp_b long").select(F.greatest("fp_a", "fp_b").alias("fp_a"), F.least("fp_a", "fp_b").alias("fp_b")).distinct().unionByName(itself)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, threshold: int = 4) -> DataFrame:
    """Return (doc_id, fingerprint, component_id) for every row of docs.

    A text with fewer than ``width`` words has its whole word sequence as its only shingle; without words (or null) its
    fingerprint is zero and links like any other. Equal fingerprints are brought together by an aggregate first, so that a
    group of copies is one row in the anchor join, whatever its size. Documents without id are kept, and
    belong to the component of their fingerprint (null when no document there has an id).
    """
    prints = materialise(with_fingerprints(docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text")), width))
    firsts = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("id")))
    known = firsts.where("id is not null")
    links = fingerprint_links(known, threshold, known.count())
    roots = connected_components(links)
    classes = firsts.join(roots, firsts.id == roots.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Anchors of the far search: so many of a document's least shingle hashes.
LEAST_HASHES = 8
#: Similarity of halved hashes, as a share of the one wanted, that has a pair compared in full.
HALF_BAR = 0.99
#: Documents whose texts are fetched through a broadcast of their ids (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Members (16 bytes each) whose sets are compared with their leaders' in one round.
MEMBERS_AT_ONCE = 1_000_000


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, fp, least) of (doc_id, text): the fingerprint and the least shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for s in chunks(texts):
                least: list[np.ndarray] = []

                def each(own: slice, least=least, texts=texts) -> Iterator[list[int]]:
                    for t in texts[own]:
                        hashes = shingle_hashes(t, width)
                        least.append(np.array(heapq.nsmallest(LEAST_HASHES, set(hashes)), np.uint64).view(np.int64))
                        yield hashes

                fp = votes(each(s), s.stop - s.start)
                ids = batch.column(0).slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(fp.view(np.int64)), pa.array(least, pa.list_(pa.int64()))], ["doc_id", "fp", "least"])
        release_memory()

    return docs.mapInArrow(run, "doc_id long, fp long, least array<long>")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of some documents; of rows with one identifier the least text."""
    wanted = materialise(ids.select("doc_id").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    return docs.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def _compared(members: DataFrame, docs: DataFrame, width: int, similarity: float) -> tuple[DataFrame, str]:
    """The differences of the members' shingle sets (key, lead) from their leaders', as a table, and its path.

    Members are taken in rounds of ``MEMBERS_AT_ONCE``, which are broadcast to the sets: a set is shuffled once per leader of its member, and
    of the other sets only the leaders' are, so that the shuffles of a round, not of all members, are on disk beside the tables.
    """

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for s in chunks(texts):
                sets = [np.unique(np.array(shingle_hashes(t, width), np.uint64)).view(np.int64) for t in texts[s]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, s.stop - s.start), pa.array(sets, pa.list_(pa.int64()))], ["key", "own"])
        release_memory()

    spark = docs.sparkSession
    ids = members.select(F.col("key").alias("doc_id")).unionByName(members.select(F.col("lead").alias("doc_id")))
    sets, path = as_table(_texts_of(ids, docs).mapInArrow(shingled, "key long, own array<long>"), "near-sets", plain=True)
    counted = materialise(members.join(members.groupBy("lead").agg(F.count("*").alias("n")), "lead"))
    rounds, out = max(1, -(-counted.count() // MEMBERS_AT_ONCE)), scratch_path(spark, "near-differences")
    paths = [f"{out}/round-{k}" for k in range(rounds)]
    for k in range(rounds):
        release_driver(spark)
        mine = counted.where(F.pmod(F.xxhash64("lead", "key"), F.lit(rounds)) == k)
        theirs = sets.withColumnsRenamed({"key": "lead", "own": "theirs"}).join(F.broadcast(mine.select("lead", "n").distinct()), "lead")
        found = with_far_groups(sets.join(F.broadcast(mine.select("lead", "key")), "key").join(theirs, "lead"), similarity)
        found.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(paths[k])
    drop_table(spark, path)
    return spark.read.schema(found.schema).parquet(*paths), out


def _cut_sets(texts: DataFrame, width: int, kind: type) -> DataFrame:
    """(doc_id, shingles, n): every text's different shingle hashes, ascending and packed, in all their bits or the upper 32, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = text_bytes(batch.column(1))
            for s in chunks(own):
                sets = [np.unique(np.array(shingle_hashes(t, width), np.uint64)) for t in own[s]]
                packed = [(x >> np.uint64(64 - 8 * np.dtype(kind).itemsize)).astype(kind).tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, s.stop - s.start), pa.array(packed, pa.binary()), pa.array([len(x) for x in sets], pa.int64())], ["doc_id", "shingles", "n"])
        release_memory()

    return texts.mapInArrow(run, "doc_id long, shingles binary, n long")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float, kind: type) -> DataFrame:
    """The pairs (a, b) whose packed sets have at least this similarity; sizes, which bound it, are looked at before."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                both = np.frombuffer(x + y, kind).copy()
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[k] = shared >= similarity * max(1, len(both) - shared) or not len(both)
            yield batch.filter(pa.array(keep)).select([0, 1])
        release_memory()

    sizes = sets.select("doc_id", "n")
    sized = pairs.join(sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b")), "b")
    likely = sized.where(F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b")).select("a", "b")
    left, right = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"of_{x}")) for x in "ab")
    return likely.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(compare, "a long, b long")


def _alike(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have at least this similarity, from their whole texts.

    Pairs are looked through by the upper halves of the shingle hashes (halves that coincide only make sets more alike, but for equal
    ones within a text, one in 10^5 texts), and what passes a slightly lower bar is compared in full.
    """
    both = lambda found: found.select(F.col("a").alias("doc_id")).unionByName(found.select(F.col("b").alias("doc_id")))
    likely = materialise(_similar(pairs, materialise(_cut_sets(_texts_of(both(pairs), docs), width, np.uint32)), similarity * HALF_BAR, np.uint32))
    return _similar(likely, materialise(_cut_sets(_texts_of(both(likely), docs), width, np.uint64)), similarity, np.uint64)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, threshold: int = 4
) -> DataFrame:
    """(doc_id, component_id) of every document that has a near duplicate: similarity of word shingles at least ``similarity``.

    Documents of similarity 0.8 differ in about 10 bits of their fingerprints, further than any covering code of 64 bits can reach cheaply.
    So the documents' least shingle hashes are anchors too (a pair of that similarity shares none of eight with probability 0.2^8). The
    most central member of an anchor leads, all others are compared with it on whole texts, and every similar pair of an anchor is
    found from the differences to the leader (see ``differences``): no pair is lost, and no anchor is compared pair by pair. Then the
    covering code's pairs within ``threshold`` bits that are in different components yet are checked on whole texts. Documents of one
    fingerprint and equal least hashes are merged first. Texts without words (null, empty) are one group; rows without identifier are
    left out; rows with equal identifiers are one document (its least text); an empty table gives no rows.
    """
    source = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    sketches = materialise(_sketches(source, width))
    lone = materialise(sketches.groupBy("fp", "least").agg(F.min("doc_id").alias("id")))
    points = lone.select(F.explode("least").alias("anchor"), "id")
    sizes = points.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    points = materialise(points.join(sizes, "anchor"))
    order = points.groupBy("id").agg((-F.sum("n")).alias("order"))
    leads = points.join(order, "id").groupBy("anchor").agg(F.min(F.struct("order", "id"))["id"].alias("lead"))
    members = materialise(points.join(leads, "anchor").where("id <> lead").select(F.col("id").alias("key"), "lead").distinct())
    compared, path = _compared(members, source, width, similarity)
    roots, _ = as_table(components_of(compared, similarity, path).withColumnRenamed("node", "id"), "near-roots")
    release_driver(docs.sparkSession)

    held = materialise(lone.select("id", "fp").join(roots, "id", "left").withColumn("own", F.coalesce("component", "id")).drop("component"))
    firsts = held.groupBy("fp").agg(F.min("own").alias("lo"), F.max("own").alias("hi"))
    near = fingerprint_pairs(firsts, threshold, lone.count())
    left, right = (held.select(F.col("fp").alias(f"fp_{x}"), F.col("id").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab")
    close = materialise(_ordered(near.join(left, "fp_a").join(right, "fp_b").where("own_a <> own_b")))
    links = roots.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(_alike(close, source, width, similarity))
    release_driver(docs.sparkSession)
    roots = connected_components(links).withColumnRenamed("node", "id")
    classes = lone.join(roots, "id", "left").select("fp", "least", F.coalesce("component", "id").alias("component_id"))
    sized = sketches.join(classes, ["fp", "least"]).select("doc_id", "component_id")
    return sized.where("doc_id <> component_id")


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents: four-word shingles, four bits."""
    return simhash_components(read_documents(spark, sf_dir))
