"""Exact removal of byte strings that repeat across documents, by sharded suffix arrays.

Every 50-byte window belongs to its minimizer, the least hash of the 24-byte strings inside it; equal windows have equal minimizers.
Consecutive windows of a document with one minimizer form a run, whose bytes are its context.

1. Documents are dealt to text shards. A shard sends its different minimizers to their owners, which
   answer which of them occur in several documents (a filter without loss).
2. Contexts of repeated minimizers go to suffix shards: equal contexts are merged, and over different contexts with one
   minimizer a suffix array is refined by
   Larsson-Sadakane doubling, Kasai's method gives the common prefixes, and suffixes that share 50 bytes form a class with its least
   document. Suffix shards of one owner are merged by binary search of their sorted class strings.
3. The windows with a smaller document go back to the text shards, which remove the bytes they cover.

What is moved besides the texts (once) grows with the repeated part of the corpus only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import integer_id, plan_bytes, ranges, read_documents, text_bytes

WINDOW, GRAM = 50, 24
SPAN = WINDOW - GRAM + 1
P1, P2, P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Text bytes per text shard (a guess from the size of the input files) and per suffix array.
SHARD_BYTES, SUFFIX_BYTES = 4_000_000, 4_000_000
STEP = 1 << 16
KEY_BITS = 48


# ---- suffix arrays ---------------------------------------------------------------------------------------------------


def words_at(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as a big-endian number; zeros follow the text."""
    n = len(text)
    a = np.zeros(n + 8, np.uint64)
    a[:n] = text
    a[:-1] = a[:-1] << np.uint64(8) | a[1:]
    a[:-2] = a[:-2] << np.uint64(16) | a[2:]
    a[:-4] = a[:-4] << np.uint64(32) | a[4:]
    return a[:n]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order.

    Larsson-Sadakane: groups of equal prefixes of h bytes are sorted by the rank of the suffix h bytes on, and h
    doubles; only suffixes in groups of several are touched again. (Kasai's method needs the whole order.)
    """
    n = len(text)
    first = words_at(text)
    sa = np.argsort(first)
    if not text.all():  # a suffix of under eight bytes sorts before a longer one that goes on with zeros
        sa = np.lexsort((np.minimum(n - np.arange(n), 8), first))
    fresh = np.ones(n + 1, bool)
    if n > 1:
        size = np.minimum(n - sa, 8)
        fresh[1:n] = (first[sa[1:]] != first[sa[:-1]]) | (size[1:] != size[:-1])
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(fresh[:n], np.arange(n), 0))
    h = 8
    while True:
        at = np.flatnonzero(~(fresh[:n] & fresh[1:]))
        if not len(at):
            break
        p = sa[at]
        key = rank[p] * (n + 1) + rank[np.minimum(p + h, n)] + 1
        order = np.argsort(key)
        sa[at], key = p[order], key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        fresh[at] = new
        rank[sa[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        h *= 2
    return sa


#: Least number with so many significant bytes.
_BYTES = np.array([1 << 8 * k for k in range(8)], np.uint64)


def common_prefixes(text: np.ndarray, sa: np.ndarray, chains: np.ndarray, cap: int = WINDOW) -> np.ndarray:
    """Kasai's method: for every place, bytes shared with the suffix sorted before it, ``cap`` at most.

    The text is cut in chains (their starts, ascending); all chains walk in step, each keeping the bytes known from its place
    before, less one.
    """
    n = len(text)
    before = np.full(n, n, np.int64)
    before[sa[1:]] = sa[:-1]
    word = np.concatenate((words_at(text), np.zeros(cap + 16, np.uint64)))
    out = np.zeros(n, np.int64)
    ends = np.append(chains[1:], n)
    at, end, h = chains.copy(), ends, np.zeros(len(chains), np.int64)
    while len(at):
        j = before[at]
        todo = np.flatnonzero(j < n)
        h[j >= n] = 0
        while len(todo):
            a, b = at[todo] + h[todo], j[todo] + h[todo]
            same = 8 - np.searchsorted(_BYTES, word[a] ^ word[b], "right")
            same = np.minimum(same, n - np.maximum(a, b))
            h[todo] += np.maximum(same, 0)
            todo = todo[(same == 8) & (h[todo] < cap)]
        np.minimum(h, cap, out=h)
        out[at] = h
        h = np.maximum(h - 1, 0)
        at = at + 1
        live = at < end
        if not live.all():
            at, end, h = at[live], end[live], h[live]
    return out


# ---- windows ---------------------------------------------------------------------------------------------------------


def minimizers(flat: np.ndarray) -> np.ndarray:
    """For every place the least hash of the 24-byte strings in the 50 bytes from there (places near the end: meaningless)."""
    n = len(flat)
    out = np.empty(n, np.uint64)
    padded = np.concatenate((flat, np.zeros(WINDOW + GRAM, np.uint8)))
    for lo in range(0, n, STEP):
        part = padded[lo : lo + STEP + WINDOW + GRAM]
        w = words_at(part)
        h = (w[:-16] * P1) ^ ((w[8:-8] ^ (w[8:-8] >> np.uint64(29))) * P2) ^ ((w[16:] ^ (w[16:] >> np.uint64(31))) * P3)
        h ^= h >> np.uint64(32)
        h *= P3
        h ^= h >> np.uint64(29)
        for d in (1, 2, 4, 8):
            h = np.minimum(h[:-d], h[d:])
        h = np.minimum(h[: -(SPAN - 16)], h[SPAN - 16 :])
        m = min(STEP, n - lo)
        out[lo : lo + m] = h[:m]
    return out


def runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, 48-bit key, document number) of every run of windows with one minimizer."""
    m = minimizers(flat)
    n_windows = np.maximum(lengths - WINDOW + 1, 0)
    at = ranges(starts, n_windows)
    doc = np.repeat(np.arange(len(starts)), n_windows)
    m = m[at]
    cut = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (doc[1:] != doc[:-1])))[: len(m)])
    return at[cut], np.diff(np.append(cut, len(m))), (m[cut] * P1) >> np.uint64(64 - KEY_BITS), doc[cut]


def equal_strings(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For every string (of eight bytes at least), the first one in the given order with the same bytes; a hash proposes, bytes decide."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    word = words_at(flat)
    n_words = (lengths + 7) // 8  # the last word ends with the string and may overlap the one before
    ends = np.cumsum(n_words)
    nth = np.arange(int(ends[-1])) - np.repeat(ends - n_words, n_words)
    at = np.repeat(starts, n_words) + np.minimum(nth * 8, np.repeat(lengths - 8, n_words))
    salt = (nth.astype(np.uint64) + np.uint64(1)) * P1
    x = (word[at] ^ salt) * P2
    x = (x ^ (x >> np.uint64(31))) * (salt | np.uint64(1))
    h = np.add.reduceat(x ^ (x >> np.uint64(29)), ends - n_words) + lengths.astype(np.uint64) * P3
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    rep = np.empty(n, np.int64)
    rep[order] = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
    other = np.flatnonzero((rep != np.arange(n)) & (lengths == lengths[rep]))
    if len(other):
        n_own = n_words[other]
        mine, its = ranges((ends - n_words)[other], n_own), ranges((ends - n_words)[rep[other]], n_own)
        ok = np.logical_and.reduceat(word[at[mine]] == word[at[its]], np.cumsum(n_own) - n_own)
        rep[other[~ok]] = other[~ok]
    differ = lengths != lengths[rep]
    rep[differ] = np.flatnonzero(differ)
    return rep


def least_documents(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all contexts (their places in flat) and the least document with the same 50 bytes, by suffix arrays."""
    parts, none = [], np.iinfo(np.int64).max
    ends = np.cumsum(lengths)
    cuts = [0]
    while cuts[-1] < len(starts):
        done = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + SUFFIX_BYTES, "right"))))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        size = lengths[lo:hi]
        text = flat[ranges(starts[lo:hi], size)]
        chains = np.cumsum(size) - size
        owner = np.full(len(text), none)
        owner[ranges(chains, size - WINDOW + 1)] = np.repeat(docs[lo:hi], size - WINDOW + 1)
        sa = suffix_array(text)
        lcp = common_prefixes(text, sa, chains)
        first = np.flatnonzero(np.concatenate(([True], lcp[sa[1:]] < WINDOW)))
        least = np.minimum.reduceat(owner[sa], first)
        number = np.empty(len(text), np.int64)
        number[sa] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(sa))))
        real = least < none
        strings = None
        if len(cuts) > 2:
            keep = np.flatnonzero(real)
            padded = np.concatenate((text, np.zeros(WINDOW, np.uint8)))
            strings = np.ascontiguousarray(np.stack([padded[sa[first[keep]] + k] for k in range(WINDOW)], 1)).view(f"S{WINDOW}")[:, 0]
        parts.append((lo, hi, chains, owner < none, number, least, real, strings))
    if len(parts) > 1:  # merge: the sorted class strings of each shard are searched in those of all before
        keys, values = parts[0][7], parts[0][5][parts[0][6]]
        for *_, least, real, strings in parts[1:]:
            at = np.searchsorted(keys, strings)
            hit = keys[np.minimum(at, len(keys) - 1)] == strings
            np.minimum.at(values, at[hit], least[real][hit])
            keys, values = np.insert(keys, at[~hit], strings[~hit]), np.insert(values, at[~hit], least[real][~hit])
        for *_, least, real, strings in parts:
            least[real] = values[np.searchsorted(keys, strings)]
    windows, found = [], []
    for lo, hi, chains, inside, number, least, _, _ in parts:
        size = lengths[lo:hi]
        n = size - WINDOW + 1
        windows.append(ranges(starts[lo:hi], n))
        found.append(least[number[ranges(chains, n)]])
    return np.concatenate(windows), np.concatenate(found)


# ---- the distributed steps -------------------------------------------------------------------------------------------


class Shard:
    """A text shard: its documents in ascending order, concatenated."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        texts = [t for c in table.column("text").chunks for t in text_bytes(c)]
        ids = [i for i in table.column("doc_id").to_pylist()]
        # a null identifier is larger than all others
        order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.order = np.array([np.iinfo(np.int64).max if i is None else i for i in self.ids], np.int64)
        self.lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.texts), np.uint8)

    def keys(self):
        """Runs, the different keys ascending, and each run's key number."""
        start, size, key, doc = runs(self.flat, self.starts, self.lengths)
        known, number = np.unique(key, return_inverse=True)
        return start, size, doc, known, number


def _owner_cuts(known: np.ndarray, owners: int) -> np.ndarray:
    """Where each owner's slice of the ascending keys starts: owners have equal ranges of keys."""
    bounds = np.array([(k << KEY_BITS) // owners for k in range(owners + 1)], np.uint64)
    return np.searchsorted(known, bounds)


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(len(a.tobytes()).to_bytes(8, "little") + a.tobytes() for a in arrays))


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


def _planes(keys: np.ndarray) -> list[np.ndarray]:
    """48-bit keys as 16-bit planes: sorted keys compress well in the upper ones."""
    return [(keys >> np.uint64(s)).astype(np.uint16) for s in (32, 16, 0)]


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row.

    Removed is each byte covered by a 50-byte string that also starts in a document with a smaller identifier. Null texts
    are empty; rows with equal identifiers are not smaller than each other; a null identifier is
    larger than all. A text and its arrays (about 40 bytes per byte) must fit in a worker.
    """
    source = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))
    owners = max(4, int(plan_bytes(source) * 1.7 // SHARD_BYTES))
    texts = source.select(F.pmod(F.xxhash64("doc_id"), F.lit(owners)).cast("int").alias("shard"), "doc_id", "text")
    by_shard = texts.groupBy("shard")

    def send_keys(key, table):
        shard = Shard(table)
        _, _, doc, known, number = shard.keys()
        low, high = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), -1)
        np.minimum.at(low, number, shard.order[doc])
        np.maximum.at(high, number, shard.order[doc])
        cuts, several = _owner_cuts(known, owners), low != high
        rows = [(k, key[0].as_py(), _packed(*_planes(known[a:b]), np.packbits(several[a:b]))) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return _rows(rows, ["owner", "shard", "keys"], [pa.int32(), pa.int32(), pa.binary()])

    def answer(table):
        shards, every, flags = table.column("shard").to_pylist(), [], []
        for data in table.column("keys").to_pylist():
            a, b, c, several = _unpacked(data, np.uint16, np.uint16, np.uint16, np.uint8)
            every.append(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) << np.uint64(16) | c)
            flags.append(np.unpackbits(several, count=len(a)))
        keys, flag = np.concatenate(every), np.concatenate(flags)
        order = np.argsort(keys)
        new = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
        size = np.diff(np.append(new, len(keys)))
        repeated = (size > 1) | (np.add.reduceat(flag[order], new, dtype=np.int64) > 0)
        mask = np.empty(len(keys), bool)
        mask[order] = np.repeat(repeated, size)
        ends = np.cumsum([len(e) for e in every])
        rows = [(s, o, np.packbits(mask[b - len(e) : b]).tobytes()) for s, o, e, b in zip(shards, table.column("owner").to_pylist(), every, ends.tolist())]
        return _rows(rows, ["shard", "owner", "mask"], [pa.int32(), pa.int32(), pa.binary()])

    def send_contexts(key, left, right):
        names, kinds = ["owner", "shard", "contexts", "done"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        if not left.num_rows:
            return _rows([], names, kinds)
        shard, number_of = Shard(left), key[0].as_py()
        start, size, doc, known, number = shard.keys()
        cuts, mask = _owner_cuts(known, owners), np.zeros(len(known), bool)
        for owner, bits in zip(right.column("owner").to_pylist(), right.column("mask").to_pylist()):
            a, b = int(cuts[owner]), int(cuts[owner + 1])
            mask[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        live = np.flatnonzero(mask[number])
        start, size, doc, number = start[live], size[live], doc[live], number[live]
        # a context that an earlier document of this shard has too is settled here
        rep = equal_strings(shard.flat, start, size + WINDOW - 1)
        settled = shard.order[doc] > shard.order[doc[rep]]
        rows = [(number_of % owners, number_of, None, _packed(start[settled].astype(np.int64), size[settled].astype(np.int64)))]
        rest = np.flatnonzero(~settled)
        rest = rest[np.argsort(number[rest], kind="stable")]
        at = np.searchsorted(number[rest], cuts)
        for owner, (a, b) in enumerate(zip(at[:-1], at[1:])):
            if b > a:
                own = rest[a:b]
                body = shard.flat[ranges(start[own], size[own] + WINDOW - 1)]
                rows.append((owner, number_of, _packed(start[own].astype(np.int64), size[own].astype(np.int64), shard.order[doc[own]], body), None))
        return _rows(rows, names, kinds)

    def match(table):
        rows, held = [], []
        for shard, contexts, done in zip(table.column("shard").to_pylist(), table.column("contexts").to_pylist(), table.column("done").to_pylist()):
            if contexts is None:
                rows.append((shard, done))
            else:
                held.append((shard, *_unpacked(contexts, np.int64, np.int64, np.int64, np.uint8)))
        if held:
            start, size, order, flat = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4))
            length = size + WINDOW - 1
            place = np.cumsum(length) - length
            by = np.argsort(order, kind="stable")
            rep = np.empty(len(by), np.int64)
            rep[by] = by[equal_strings(flat, place[by], length[by])]  # of equal contexts, the one of the least document
            own = np.flatnonzero(rep == np.arange(len(rep)))
            # a context alone with its minimizer shares windows with its equals only, which are merged already
            _, kind, n_kind = np.unique(minimizers(flat)[place[own]], return_inverse=True, return_counts=True)
            shared = own[n_kind[kind] > 1]
            best = np.full(len(flat), np.iinfo(np.int64).max)
            best[ranges(place[own], size[own])] = np.repeat(order[own], size[own])
            if len(shared):
                shared = shared[np.argsort(order[shared], kind="stable")]
                window, least = least_documents(flat, place[shared], length[shared], order[shared])
                best[window] = least
            # every window of every context: is there a smaller document?
            at = ranges(place[rep], size)
            gone = best[at] < np.repeat(order, size)
            where = ranges(start, size)[gone]
            of = np.repeat(np.repeat([h[0] for h in held], [len(h[1]) for h in held]), size)[gone]
            cut = np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1] + 1) | (of[1:] != of[:-1])))[: len(where)])
            first, n, shards = where[cut], np.diff(np.append(cut, len(where))), of[cut]
            for s in np.unique(shards):
                mine = shards == s
                rows.append((int(s), _packed(first[mine].astype(np.int64), n[mine].astype(np.int64))))
        return _rows(rows, ["shard", "gone"], [pa.int32(), pa.binary()])

    def remove(left, right):
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        if not left.num_rows:
            return _rows([], names, kinds)
        shard = Shard(left)
        edge = np.zeros(len(shard.flat) + 1, np.int32)
        for data in right.column("gone").to_pylist():
            first, n = _unpacked(data, np.int64, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + n + WINDOW - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rows = []
        for i, (s, n, t) in enumerate(zip(shard.starts.tolist(), shard.lengths.tolist(), shard.texts)):
            own = gone[s : s + n]
            removed = int(own.sum())
            kept = np.frombuffer(t, np.uint8)[~own].tobytes() if removed else t
            spans = int((own[1:] & ~own[:-1]).sum()) + int(own[0]) if removed else 0
            rows.append((shard.ids[i], n, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        return _rows(rows, names, kinds)

    keys = by_shard.applyInArrow(send_keys, "owner int, shard int, keys binary")
    answers = keys.groupBy("owner").applyInArrow(answer, "shard int, owner int, mask binary")
    contexts = by_shard.cogroup(answers.groupBy("shard")).applyInArrow(send_contexts, "owner int, shard int, contexts binary, done binary")
    gone = contexts.groupBy("owner").applyInArrow(match, "shard int, gone binary")
    result = by_shard.cogroup(gone.groupBy("shard")).applyInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents."""
    return remove_repeats(read_documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
