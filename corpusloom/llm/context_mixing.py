"""Language-model scores: word counts as a base, and bit predictors mixed by online logistic regression.

The model predicts the bits of a text's bytes (and a final zero byte). Each of the contexts of one to four
bytes before, hashed with the bits of the byte seen so far, has a slot of bit counts in a table sized by the contexts counted; their log odds are mixed by two sets of weights, each chosen by a gate. A last
mixer, which starts equal for every text and follows its own text by online gradient steps, combines the two with own weights for every place of
a bit in its byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import chunks, distinct, index_words, integer_id, materialise, ranges, read_documents, text_bytes
from corpusloom.llm.langid import held_out

ORDERS = 4
#: The bits of a gram: a symbol and the bytes before.
GRAM = np.uint64((1 << 8 * (ORDERS + 1)) - 1)
#: The least size of an order's slot table, and of a block in which its counts travel.
SLOT_BITS, BLOCK_BITS = 20, 15
#: Slots for every different context (with the bits before) of an order, at least.
SLOTS_PER_CONTEXT = 2
P1, P2, P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Bytes of text in one numpy step; a longer text is scored in pieces that carry the mixer on.
STEP_BYTES = 2 << 20
#: Bytes after which the last mixer of a text moves its weights.
MIX_BLOCK = 16
#: Step of the last mixer: the mean slope of a block moves a weight by this.
RATE = 0.12
#: Texts of about one size that the last mixer follows at once: its arrays stay in the processor's cache.
GROUP_TEXTS = 256
#: Word counts that are broadcast at most; rarer words are joined.
BROADCAST_WORDS = 1_000_000
#: Newton steps for the gated weights at most; they end when a step promises less than this (nats for every symbol learned from).
NEWTON_STEPS, LEAST_GAIN = 12, 1e-8
#: The first steps take one gram in so many (by hash, so they grow with the input), the last ones all of them.
FIRST_SHARE = 16
#: Tasks that sum up slopes at least, and the grams of each if there are more.
GRAM_TASKS, TASK_GRAMS = 12, 250_000
#: Blocks of slots that one task counts, and the largest count that travels (both counts of a slot are scaled to it).
TASK_BLOCKS, MOST = 64, 60_000.0
END = xxhash.xxh64_intdigest(b"\n") - (1 << 63)


# ---- the model -------------------------------------------------------------------------------------------------------


def grams(texts: list[bytes], before: bytes = b"", last: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol with its ``ORDERS`` bytes before, packed in one integer; and the symbols per text."""
    head = (b"\0" * ORDERS + before)[-ORDERS:]
    tail = b"\0" if last else b""
    flat = np.frombuffer(b"".join(x for t in texts for x in (head, t, tail)), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(tail)
    wide = sizes + ORDERS
    g = flat.copy()
    for k in range(1, ORDERS + 1):
        g[k:] |= flat[:-k] << np.uint64(8 * k)
    keep = np.ones(len(flat), bool)
    keep[ranges(np.cumsum(wide) - wide, np.full(len(texts), ORDERS))] = False
    return g[keep], sizes


def pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], bytes, bool]]:
    """Arguments of ``grams``: batches of texts, and longer texts in pieces that know the bytes before."""
    for s in chunks(texts, STEP_BYTES):
        if s.stop - s.start == 1 and len(texts[s.start]) > 2 * STEP_BYTES:
            t = texts[s.start]
            for at in range(0, len(t), STEP_BYTES):
                yield [t[at : at + STEP_BYTES]], t[max(0, at - ORDERS) : at], at + STEP_BYTES >= len(t)
        else:
            yield texts[s], b"", True


def _context_hash(g: np.ndarray, order: int) -> np.ndarray:
    h = (((g >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)) ^ np.uint64(order << 56)) * P1
    return h ^ (h >> np.uint64(31))


def block_of(g: np.ndarray, order: int, n_slots: int) -> np.ndarray:
    """Block of slots of a context of ``order`` bytes: all slots of a context are in one, whatever the bits before."""
    bits = n_slots.bit_length() - 1 - BLOCK_BITS
    return ((_context_hash(g, order) * P2) >> np.uint64(64 - bits)).astype(np.int64) if bits > 0 else np.zeros(len(g), np.int64)


def inner_slot(h: np.ndarray, g: np.ndarray, bit: int) -> np.ndarray:
    """Slot within the block of a context (by its hash) and the bits before."""
    cur = ((g & np.uint64(255)) | np.uint64(256)) >> np.uint64(8 - bit)
    return (((h ^ (cur * P2)) * P3) >> np.uint64(64 - BLOCK_BITS)).astype(np.int64)


def slots(g: np.ndarray, order: int, n_slots: int) -> np.ndarray:
    """[bit, gram] slot of a context of ``order`` bytes and the bits before, in a table of ``n_slots``, a power of two."""
    h = _context_hash(g, order)
    base = block_of(g, order, n_slots) << BLOCK_BITS
    return np.stack([base | inner_slot(h, g, j) for j in range(8)])


def bits_of(g: np.ndarray) -> np.ndarray:
    """[bit, gram] bits of the last byte, the highest first."""
    low = g.astype(np.uint8)
    return np.stack([(low >> np.uint8(7 - j)) & np.uint8(1) for j in range(8)]).astype(np.float32)


def of_order(g: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending different grams of a shorter context, with their summed counts."""
    return _merge([(g & np.uint64((1 << 8 * (order + 1)) - 1), n)])


def count_order(ones: np.ndarray, every: np.ndarray, base: np.ndarray, g: np.ndarray, n: np.ndarray, order: int) -> None:
    """Add n occurrences of each gram (ascending) to the slots of one order; ``base`` is where a gram's block begins.

    Ascending grams of one context and of the same bits before are neighbours: they are summed up first.
    """
    if not len(g):
        return
    h = _context_hash(g, order)
    for j in range(8):
        node = g >> np.uint64(8 - j)
        cut = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        at = base[cut] + inner_slot(h[cut], g[cut], j)
        np.add.at(every, at, np.add.reduceat(n, cut))
        np.add.at(ones, at, np.add.reduceat(n * ((g >> np.uint64(7 - j)) & np.uint64(1)).astype(n.dtype), cut))


def count_bits(ones, every, g: np.ndarray, n: np.ndarray) -> None:
    """Add n occurrences of each gram to the [order, slot] counts."""
    for order in range(1, ORDERS + 1):
        key, times = of_order(g, n, order)
        count_order(ones[order - 1], every[order - 1], block_of(key, order, len(every[order - 1])) << BLOCK_BITS, key, times.astype(np.float64), order)


def log_odds(ones, zeros):
    return np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -9, 9).astype(np.float32)


#: Classes of the byte before, by its value: letters, signs, digits and the kinds of UTF-8 bytes.
BYTE_CLASS = np.select(
    [(v := np.arange(256)) == 0, v == 10, v <= 32, (v >= 48) & (v < 58), (v >= 97) & (v < 123), (v >= 65) & (v < 91), v >= 192, v >= 128], [0, 1, 2, 3, 4, 5, 6, 7], 8
)
#: Weight sets per gate: the class of the byte before; the number of contexts that are known.
N_SETS = (9, ORDERS + 1)


def gates(g: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """The set that each gate chooses for each gram (every set has own weights per bit place)."""
    return BYTE_CLASS[((g >> np.uint64(8)) & np.uint64(255)).astype(np.int64)], known


@dataclass
class MixingModel:
    odds: list[np.ndarray]  # per order [slot]
    weights: list[np.ndarray]  # per gate [set, bit, order + 1]

    def logits(self, g: np.ndarray) -> np.ndarray:
        """[gate, bit, gram] mixed log odds."""
        x = [self.odds[o][slots(g, o + 1, len(self.odds[o]))].astype(np.float32) for o in range(ORDERS)]
        known = sum((own[0] != 0).astype(np.int64) for own in x)
        out = np.empty((len(N_SETS), 8, len(g)), np.float32)
        for k, chosen in enumerate(gates(g, known)):
            for c in range(N_SETS[k]):
                rows = np.flatnonzero(chosen == c)
                w = self.weights[k][c]
                for j in range(8):
                    z = x[0][j][rows] * w[j, 0] + w[j, ORDERS]
                    for o in range(1, ORDERS):
                        z += x[o][j][rows] * w[j, o]
                    out[k, j, rows] = z
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each text costs, its end included."""
        out, state, at = np.zeros(len(texts)), None, 0
        for own, before, last in pieces(texts):
            cost, state = self._follow(own, before, last, state if before else None)
            out[at : at + len(own)] += cost
            at += len(own) * last
        return out

    def _follow(self, texts: list[bytes], before: bytes, last: bool, state):
        g, sizes = grams(texts, before, last)
        own, index = distinct(g)
        values = g[own]
        # signed so that larger is better for the bit that came: a gram knows its own bits
        mixed = np.ascontiguousarray((self.logits(values) * (2 * bits_of(values) - 1)).reshape(-1, len(values)).T)
        first = np.cumsum(sizes) - sizes
        w = np.full((len(texts), 2, 8), 0.5, np.float32) if state is None else state
        nats = np.zeros(len(texts))
        by_size = np.argsort(-sizes, kind="stable")
        for lo in range(0, len(texts), GROUP_TEXTS):
            group = by_size[lo : lo + GROUP_TEXTS]
            moved = w[group]
            nats[group] = self._mix(mixed, index, first[group], sizes[group], moved)
            w[group] = moved
        return nats / np.log(2), w

    @staticmethod
    def _mix(mixed, index, first, sizes, w) -> np.ndarray:
        """Follow some texts in step; w is moved on in place."""
        at, nats = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
        one, rate = np.float32(1), np.float32(RATE)
        while True:
            # blocks are short and alike for every text: none depends on the other texts of the batch
            take = np.minimum(MIX_BLOCK, sizes - at)
            live = np.flatnonzero(take > 0)
            if not len(live):
                return nats
            n = take[live]
            rows = ranges((first + at)[live], n)
            x = np.ascontiguousarray(mixed[index[rows]].T).reshape(2, 8, -1)
            own = np.repeat(-w[live].transpose(1, 2, 0), n, axis=2)
            e = x[0] * own[0]
            e += x[1] * own[1]
            np.exp(e, out=e)
            e += one  # 1 / e is the probability of the bit that came
            starts = np.cumsum(n) - n
            nats[live] += np.add.reduceat(np.log(e).sum(axis=0), starts, dtype=np.float64)
            np.reciprocal(e, out=e)
            np.subtract(one, e, out=e)
            x *= e
            w[live] += (rate * np.add.reduceat(x, starts, axis=2) / n.astype(np.float32)).transpose(2, 0, 1)
            at[live] += n


def slopes(ones, every, g: np.ndarray, n: np.ndarray, weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per gate, the gradient and curvature of the log likelihood of n occurrences of each gram; each is taken out of its own counts."""
    out = [(np.zeros(w.shape), np.zeros((*w.shape, ORDERS + 1))) for w in weights]
    for lo in range(0, len(g), 8192):
        part, times = g[lo : lo + 8192], n[lo : lo + 8192].astype(np.float32)
        y = bits_of(part)
        x = np.ones((8, len(part), ORDERS + 1), np.float32)
        for o in range(ORDERS):
            s = slots(part, o + 1, len(every[o]))
            one, total = ones[o][s].astype(np.float32), every[o][s].astype(np.float32)
            x[:, :, o] = log_odds(np.maximum(one - y, 0), np.maximum(total - one - (1 - y), 0))
        known = (x[0, :, :ORDERS] != 0).sum(axis=1)
        for k, chosen in enumerate(gates(part, known)):
            for c in np.unique(chosen):
                rows = np.flatnonzero(chosen == c)
                own = x[:, rows]
                p = 1 / (1 + np.exp(-(own @ weights[k][c][:, :, None])[:, :, 0]))
                out[k][0][c] += (own * (times[rows] * (y[:, rows] - p))[:, :, None]).sum(axis=1, dtype=np.float64)
                out[k][1][c] += own.transpose(0, 2, 1) @ (own * (times[rows] * p * (1 - p))[:, :, None])
    return out


def fit_weights(*steps) -> list[np.ndarray]:
    """Gated weights by Newton steps; each of ``steps`` is (slopes of weights, least gain), and goes on from the one before."""
    start = [np.concatenate((np.full((n, 8, ORDERS), 0.35, np.float32), np.zeros((n, 8, 1), np.float32)), axis=2) for n in N_SETS]
    weights = [w.copy() for w in start]
    for step, least in steps:
        for _ in range(NEWTON_STEPS):
            gain = 0.0
            for k, (slope, curve) in enumerate(step(weights)):
                slope = slope + start[k] - weights[k]  # what has no occurrences stays at its start
                by = np.clip(np.linalg.solve(curve + np.eye(ORDERS + 1), slope[..., None])[..., 0], -1, 1)
                weights[k] = (weights[k] + by).astype(np.float32)
                gain += float((slope * by).sum()) / 2
            if gain < least:
                break
    return weights


def learn_weights(ones, every, texts: list[bytes]) -> list[np.ndarray]:
    """Gated weights from all occurrences in texts."""
    if not texts:
        return fit_weights()
    g, n = np.unique(grams(texts)[0] & GRAM, return_counts=True)
    return fit_weights((lambda weights: slopes(ones, every, g, n, weights), LEAST_GAIN * int(n.sum())))


def learn_from_grams(counts: DataFrame, ones, every) -> list[np.ndarray]:
    """Gated weights from all occurrences of the counted grams; every partition sums up its slopes. The first steps take a share of the grams."""
    held = counts.sparkSession.sparkContext.broadcast((ones, every))
    size = counts.agg(F.count("*").alias("grams"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    least = LEAST_GAIN * int(size.n)
    every_gram = counts.coalesce(max(GRAM_TASKS, size.grams // TASK_GRAMS))
    some = materialise(every_gram.where(F.pmod(F.xxhash64("gram"), F.lit(FIRST_SHARE)) == 0))

    def step(grams_of: DataFrame, weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                own = slopes(*held.value, batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), weights)
                own = np.concatenate([x.ravel() for pair in own for x in pair])
                total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["slopes"])

        width = ORDERS + 1
        total = np.zeros(sum(n * 8 * width * (width + 1) for n in N_SETS))
        for row in grams_of.mapInArrow(run, "slopes binary").toLocalIterator():
            total += np.frombuffer(row.slopes)
        out, at = [], 0
        for n in N_SETS:
            cut = at + n * 8 * width
            end = cut + n * 8 * width * width
            out.append((total[at:cut].reshape(n, 8, width), total[cut:end].reshape(n, 8, width, width)))
            at = end
        return out

    try:
        return fit_weights((lambda w: step(some, w), least / FIRST_SHARE), (lambda w: step(every_gram, w), least))
    finally:
        held.unpersist()


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending grams and their summed counts."""
    g, n = (np.concatenate(x) for x in zip(*held))
    by = np.argsort(g)
    g, n = g[by], n[by]
    cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))[: len(g)]
    return g[cut], np.add.reduceat(n, cut) if len(cut) else n


def gram_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): occurrences of every different gram of all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            g, n = _merge(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n)], ["gram", "n"])

        for batch in batches:
            for own in pieces(text_bytes(batch.column(0))):
                g = np.sort(grams(*own)[0] & GRAM)
                cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))[: len(g)]
                held.append((g[cut], np.diff(np.append(cut, len(g)))))
                if sum(len(h[0]) for h in held) > 4_000_000:
                    held[:] = [_merge(held)]
                    if len(held[0][0]) > 2_000_000:
                        yield out()
        if held:
            yield out()

    return train.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def table_sizes(counts: DataFrame) -> list[int]:
    """Slots of each order's table, from the number of different contexts (with the bits before) among the grams counted."""

    def node(order: int, j: int):
        return F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)), 8 - j)

    # there are no fewer nodes with more bits: what is not counted is bounded by the next that is
    stands_for = {0: 1, 3: 3, 5: 2, 7: 2}
    found = counts.agg(*[F.approx_count_distinct(node(o, j)).alias(f"c{o}_{j}") for o in range(1, ORDERS + 1) for j in stands_for]).first()
    every = [sum(times * (found[f"c{o}_{j}"] or 0) for j, times in stands_for.items()) for o in range(1, ORDERS + 1)]
    return [max(1 << SLOT_BITS, 1 << (SLOTS_PER_CONTEXT * n - 1).bit_length()) for n in every]


def bit_tables(counts: DataFrame, sizes: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per order, the slots' counts of one bits and of all bits, in half precision and scaled to ``MOST`` where larger.

    All slots of a context are in one block, so grams are dealt by block: a task counts its blocks alone, and no tables are added up.
    """
    size, spark = 1 << BLOCK_BITS, counts.sparkSession
    first = np.concatenate(([0], np.cumsum([n >> BLOCK_BITS for n in sizes])))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for order in range(1, ORDERS + 1):
                key, times = of_order(g, n, order)
                block = first[order - 1] + block_of(key, order, sizes[order - 1])
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(key.view(np.int64)), pa.array(times)], ["block", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(k).to_numpy() for k in range(3)] for b in batches]
        if not held:
            return
        block, g, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        pack = zstandard.ZstdCompressor(level=1)
        order_of = np.searchsorted(first, block, "right")
        for order in np.unique(order_of).tolist():
            rows = np.flatnonzero(order_of == order)
            key, times = _merge([(g[rows].view(np.uint64), n[rows])])
            own = np.unique(block[rows])
            base = np.searchsorted(own, first[order - 1] + block_of(key, order, sizes[order - 1])) << BLOCK_BITS
            ones, every = (np.zeros(len(own) * size) for _ in range(2))
            count_order(ones, every, base, key, times.astype(np.float64), order)
            scale = np.minimum(1, MOST / np.maximum(every, 1))
            cells = np.stack([(x * scale).astype(np.float16).reshape(-1, size) for x in (ones, every)], axis=1)
            for b, cell in zip(own.tolist(), cells):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([pack.compress(cell.tobytes())], pa.binary())], ["block", "counts"])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first[-1]) // TASK_BLOCKS)
    dealt = counts.mapInArrow(deal, "block long, gram long, n long").repartition(tasks, "block")
    ones, every = ([np.zeros(k, np.float16) for k in sizes] for _ in range(2))
    unpack = zstandard.ZstdDecompressor()
    for row in dealt.mapInArrow(count, "block long, counts binary").toLocalIterator():
        o = int(np.searchsorted(first, row.block, "right")) - 1
        at = (row.block - int(first[o])) << BLOCK_BITS
        ones[o][at : at + size], every[o][at : at + size] = np.frombuffer(unpack.decompress(row.counts), np.float16).reshape(2, size)
    return ones, every


def train_model(train: DataFrame, text_col: str = "text") -> MixingModel:
    """Bit counts over all training texts in tables that grow with the different contexts, then weights over all their grams."""
    counts = materialise(gram_counts(train, text_col))
    ones, every = bit_tables(counts, table_sizes(counts))
    weights = learn_from_grams(counts, ones, every)
    return MixingModel([log_odds(a.astype(np.float32), b.astype(np.float32) - a).astype(np.float16) for a, b in zip(ones, every)], weights)


# ---- word counts -----------------------------------------------------------------------------------------------------


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of every token (XXH64 of the word, A-Z lower-cased; one end per text) in all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for s in chunks(texts):
                table, index, _ = word_index(texts[s])
                n = np.bincount(index, minlength=len(table))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(table, END)), pa.array(np.append(n, s.stop - s.start))], ["word", "n"])

    return train.select(text_col).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_index(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words of texts, the index of each word in order, and the words per text."""
    words, index, sizes = index_words(texts)
    digest = xxhash.xxh64_intdigest
    return (np.fromiter(map(digest, words), np.uint64, len(words)) - np.uint64(1 << 63)).view(np.int64), index, sizes


def score_texts(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of docs.

    Base: add-one word probabilities over the counts of all training texts. The commonest ``BROADCAST_WORDS`` counts at most go to
    every task; rarer words are (row, word) rows joined with the count table, which has no hot key since frequent
    words are not in it. ``score`` is the mixing model's log10 probability of the whole text and its end.
    Null texts count as empty, repeated rows are scored each, and without training texts every count is 0.
    """
    spark = docs.sparkSession
    counts = materialise(word_counts(train, text_col))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, n_words = int(total.n), int(total.v)
    level, kept = 62, 0
    for row in sorted(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect(), key=lambda r: -r.level):
        if kept + row["count"] > BROADCAST_WORDS:
            break
        level, kept = row.level, kept + row["count"]
    common = counts.where(F.col("n") >= F.lit(1 << level)).toArrow() if kept else None
    keys, values = (common.column(k).to_numpy() for k in ("word", "n")) if kept else (np.zeros(0, np.int64),) * 2
    end = int(counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    order = np.argsort(keys)
    model = train_model(train, text_col)
    held = spark.sparkContext.broadcast((keys[order], values[order], model))
    complete = kept == n_words

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, model = held.value
        logs = np.log10(values + 1.0)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for s in chunks(texts):
                part = texts[s]
                table, index, sizes = word_index(part)
                at = np.minimum(np.searchsorted(keys, table), max(len(keys) - 1, 0))
                found = keys[at] == table if len(keys) else np.zeros(len(table), bool)
                row = np.repeat(np.arange(len(part)), sizes)
                hit = found[index]
                known = np.bincount(row, hit, len(part)).astype(np.int64) + (end > 0)
                base = np.bincount(row, np.where(hit, logs[at[index]] if len(keys) else 0.0, 0.0), len(part)) + np.log10(end + 1)
                rare_row, rare_word = row[~hit], table[index[~hit]]
                cuts = np.searchsorted(rare_row, np.arange(len(part) + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(cuts), pa.array(rare_word))
                bits = model.bits(part)
                size = np.array([len(t) for t in part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, s.stop - s.start), pa.array(sizes + 1), pa.array(known), pa.array(base), pa.array(-bits * np.log10(2)), pa.array(bits / np.maximum(size, 1)), rare],
                    ["doc_id", "n_tokens", "known", "base", "score", "bits_per_byte", "rare"],
                )

    source = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.mapInArrow(score, "doc_id long, n_tokens long, known long, base double, score double, bits_per_byte double, rare array<long>")
    spread = F.lit(float(np.log10(n_train + n_words + 1.0)))
    if complete:  # what was not found has count 0
        rows = rows.withColumn("more", F.lit(0.0)).withColumn("known_too", F.lit(0))
    else:
        rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()))
        pairs = rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
        rare = counts.where(F.col("n") < F.lit(1 << level))
        sums = pairs.join(rare, "word").groupBy("row").agg(
            F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("more"), F.sum("times").alias("known_too")
        )
        rows = rows.join(sums, "row", "left")
    return rows.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("known_too", F.lit(0))).cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * spread).alias("base_score"), "score", "bits_per_byte",
    )


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents; learned from those outside fold 2 of 7."""
    docs = read_documents(spark, sf_dir)
    scored = score_texts(docs, docs.where(~held_out("doc_id", 7, 2)))
    return scored.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
