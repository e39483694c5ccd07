"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.common import CHUNK_BYTES, chunks, read_documents, release_memory, text_bytes

ORDER = 5


def _no_letters() -> str:
    """What Python counts among the alphanumeric characters, but Unicode not among letters (superscripts, fractions, Roman numerals), as ranges."""
    found = [c for c in range(sys.maxunicode + 1) if chr(c).isalnum() and unicodedata.category(chr(c))[0] != "L" and not chr(c).isdecimal()]
    cuts = [k for k in range(len(found)) if not k or found[k] != found[k - 1] + 1] + [len(found)]
    return "".join(f"{re.escape(chr(found[a]))}-{re.escape(chr(found[b - 1]))}" for a, b in zip(cuts, cuts[1:]))


LETTERS, NO_LETTERS = re.compile(r"[^\W\d_]+"), re.compile(f"[{_no_letters()}]")


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    low = text.lower()
    return LETTERS.findall(low if low.isascii() else NO_LETTERS.sub(" ", low))
PAD, STOP = 0x110000, 0x110001
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Documents per language in the training sample, and their longest length in characters.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 20_000
#: Words whose scores a worker keeps between chunks.
KEEP_WORDS = 100_000


def _mix(h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    h = (h ^ symbols) * PRIME
    return h ^ (h >> np.uint64(29))


def _grams(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Hashes at every symbol (letters and end) of each word: grams[k] of k + 1 symbols, histories[k] of the k symbols
    before; and the number of symbols per word. A history never leaves its word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    wide = lengths + ORDER
    flat = np.full(int(wide.sum()), PAD, np.uint64)
    ends = np.cumsum(wide)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    starts = ends - wide + ORDER - 1
    place = np.arange(len(letters)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    flat[place] = letters
    flat[ends - 1] = STOP
    at = np.sort(np.concatenate((place, ends - 1)))
    with np.errstate(over="ignore"):
        grams, histories = [], []
        for k in range(ORDER):
            h = np.full(len(at), k + 1, np.uint64)
            for back in range(k, 0, -1):
                h = _mix(h, flat[at - back])
            histories.append(h)
            grams.append(_mix(h, flat[at] + np.uint64(1 << 32)))
    return grams, histories, lengths + 1


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted hash in a sorted array, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class KneserNeyModels:
    """Sorted hash arrays shared by all languages, with one column of log values per language."""

    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    log_p: list[np.ndarray] = field(default_factory=list)
    histories: list[np.ndarray] = field(default_factory=list)
    log_backoff: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray | None = None
    sharpness: float = 8.0
    usual: np.ndarray | None = None
    slack: np.ndarray | None = None
    spread: np.ndarray | None = None

    @classmethod
    def train(cls, words: dict[str, Counter]) -> KneserNeyModels:
        """words: per language, how often each word occurs."""
        model = cls(sorted(words))
        made = []
        for lang in model.langs:
            grams, histories, n = _grams(list(words[lang]))
            made.append((grams, histories, np.repeat(np.fromiter(words[lang].values(), np.float64, len(words[lang])), n)))
        below = None
        for k in range(ORDER):
            counts = []
            for grams, histories, weight in made:
                # the highest order counts occurrences, the others the different symbols before
                if k == ORDER - 1:
                    keys, first, inverse = np.unique(grams[k], return_index=True, return_inverse=True)
                    c = np.bincount(inverse, weight)
                else:
                    _, longer = np.unique(grams[k + 1], return_index=True)
                    keys, at, inverse = np.unique(grams[k][longer], return_index=True, return_inverse=True)
                    first, c = longer[at], np.bincount(inverse).astype(float)
                counts.append((keys, c, histories[k][first], grams[k - 1][first] if k else None))
            every, at = np.unique(np.concatenate([x[0] for x in counts] or [np.zeros(0, np.uint64)]), return_index=True)
            hist = np.concatenate([x[2] for x in counts])[at]
            known = np.unique(hist)
            where = np.searchsorted(known, hist)
            p = np.zeros((len(every), len(model.langs)))
            backoff = np.zeros((len(known), len(model.langs)))
            if k:
                shorter = np.concatenate([x[3] for x in counts])[at]
                lower = np.exp(below[_find(model.grams[-1], shorter)])
            else:
                lower = np.full(p.shape, 1.0 / (len(every) + 1))
            for j, (keys, c, h, _) in enumerate(counts):
                once, twice = (c == 1).sum(), (c == 2).sum()
                discount = min(0.95, max(0.1, once / max(1.0, once + 2.0 * twice)))
                i = np.searchsorted(known, h)
                total = np.bincount(i, c, len(known))
                kinds = np.bincount(i, minlength=len(known))
                gamma = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                mine = np.zeros(len(every))
                mine[np.searchsorted(every, keys)] = np.maximum(c - discount, 0) / total[i]
                p[:, j] = mine + gamma[where] * lower[:, j]
                backoff[:, j] = gamma
            below = np.log(p)
            if not k:
                model.floor = np.log(backoff[0] / (len(every) + 1)) if len(known) else np.zeros(len(model.langs))
            model.grams.append(every)
            model.log_p.append(below.astype(np.float32))
            model.histories.append(known)
            model.log_backoff.append(np.log(backoff).astype(np.float32))
        return model

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of each word per language (end symbol counted), and its symbols."""
        grams, histories, n = _grams(words)
        total = np.zeros((len(grams[0]), len(self.langs)), np.float32)
        open_ = np.arange(len(total))
        for k in range(ORDER - 1, -1, -1):
            at = _find(self.grams[k], grams[k][open_])
            hit = at >= 0
            total[open_[hit]] += self.log_p[k][at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            if k:
                h = _find(self.histories[k], histories[k][open_])
                total[open_[h >= 0]] += self.log_backoff[k][h[h >= 0]]
        total[open_] += self.floor.astype(np.float32)
        starts = np.cumsum(n) - n
        return np.add.reduceat(total, starts, axis=0) if len(words) else np.zeros((0, len(self.langs)), np.float32), n

    def entropies(self, texts: list[str], keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per text: cross-entropy in nats per symbol for each language, and the symbols (0: no letter)."""
        keep = keep if keep is not None else {}
        index: dict[str, int] = keep.setdefault("index", {})
        if len(index) > KEEP_WORDS:
            keep.clear()
            index = keep.setdefault("index", {})
        known = len(index)
        rows: list[int] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            ws = words_of(t)
            sizes[i] = len(ws)
            rows += [index.setdefault(w, len(index)) for w in ws]
        new = list(index)[known:]
        score, n = self.score_words(new)
        keep["score"] = score = np.concatenate((keep["score"], score)) if "score" in keep else score
        keep["n"] = n = np.concatenate((keep["n"], n)) if "n" in keep else n
        out, symbols = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            at = np.array(rows)
            starts = (np.cumsum(sizes) - sizes)[full]
            symbols[full] = np.add.reduceat(n[at], starts)
            out[full] = -np.add.reduceat(score[at].astype(np.float64), starts, axis=0) / symbols[full][:, None]
        return out, symbols

    def calibrate(self, texts: list[str], truth: list[str]) -> None:
        """Fit the sharpness of the score and, per language, what cross-entropy is still usual."""
        h, n = self.entropies(texts)
        y = np.array([self.langs.index(t) for t in truth], int)
        ok = n > 0
        h, n, y = h[ok], n[ok], y[ok]
        if len(y):
            loss = lambda t: -np.mean(np.log(_posterior(h, t)[np.arange(len(y)), y].clip(1e-12)))
            self.sharpness = float(min((2.0**k for k in range(8)), key=loss))
        size = len(self.langs)
        self.usual, self.slack, self.spread = np.full(size, 3.0), np.full(size, 1.0), np.full(size, 2.0)
        for j in range(size):
            own, m = h[y == j, j], n[y == j]
            if len(own) >= 8:
                self.usual[j] = np.median(own)
                self.slack[j] = 0.5 + 2.0 * max(0.0, np.quantile(own, 0.99) - self.usual[j])
                self.spread[j] = np.sqrt(np.mean((own - self.usual[j]) ** 2 * m))

    def predict(self, texts: list[str], keep: dict | None = None) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, rejected, cross-entropy) per text.

        Rejected: no letter, or the best model's cross-entropy is above what is usual in its language by more than the slack, plus
        six standard errors at the text's length.
        """
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool), np.zeros(len(texts))
        h, n = self.entropies(texts, keep)
        best = h.argmin(axis=1)
        least = h[np.arange(len(h)), best]
        sure = _posterior(h, self.sharpness)[np.arange(len(h)), best]
        over = (least - self.usual[best]) / (self.slack[best] + 6 * self.spread[best] / np.sqrt(np.maximum(n, 1)))
        empty = n == 0
        score = np.where(empty, 0.0, sure * np.exp(-np.maximum(over - 1, 0))).clip(0, 1)
        return ["und" if e else self.langs[b] for e, b in zip(empty, best)], score, empty | (over > 1), np.where(empty, 0.0, least)


def _posterior(h: np.ndarray, sharpness: float) -> np.ndarray:
    z = -h * sharpness
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def held_out(id_col: str, folds: int, fold: int):
    """crc32 of the identifier as text, modulo ``folds``, is ``fold`` (a null identifier counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def train_language_models(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
) -> KneserNeyModels:
    """Fit on a bounded sample: about ``sample_docs`` documents per language (those of the smallest identifier hashes, with at most
    ``sample_chars`` characters; of a language with longer ones only, a twentieth as many, whole), of which every fifth only
    calibrates. The caller leaves out held-out rows. Null texts and languages teach nothing; without rows no language is known."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("l is not null and t is not null")
    rows = rows.withColumn("long", F.length("t") > sample_chars)
    sizes: dict[str, list[int]] = {}
    for r in rows.groupBy("l", "long").count().collect():
        sizes.setdefault(r.l, [0, 0])[r.long] = r["count"]
    if not sizes:
        return KneserNeyModels([])
    chance = F.pmod(F.xxhash64("i"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    within = F.lit(False)
    for lang, (short, long) in sizes.items():
        within = within | ((F.col("l") == lang) & (F.col("long") == F.lit(not short)) & (chance < (min(1.0, sample_docs / short) if short else min(1.0, sample_docs / 20 / long))))
    # the limit holds where identifiers repeat: their rows have one hash
    got = rows.where(within).withColumn("h", chance).orderBy("h", "i", "t", "l").limit(2 * sample_docs * len(sizes)).select("i", "t", "l")
    sample = sorted(got.collect(), key=lambda r: (r.l, r.i is None, r.i, r.t))
    words: dict[str, Counter] = {}
    for k, r in enumerate(sample):
        if k % 5:
            words.setdefault(r.l, Counter()).update(words_of(r.t))
    for r in sample:  # a language of a few documents still is learned
        if not words.get(r.l):
            words[r.l] = Counter(words_of(r.t))
    words = {k: v for k, v in words.items() if v}
    model = KneserNeyModels.train(words) if words else KneserNeyModels([])
    if words:
        model.calibrate([r.t for k, r in enumerate(sample) if not k % 5 and r.l in words], [r.l for k, r in enumerate(sample) if not k % 5 and r.l in words])
    del sample, words
    release_memory()
    return model


def predict_language(docs: DataFrame, model: KneserNeyModels, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """(id, kept columns..., lang_pred, score, rejected, cross_entropy) per row; the only input of a prediction is the whole text.

    Null and letterless texts are ``und`` with score 0 and rejected; letters are those of Unicode's categories. Texts of any length are
    read in whole words, repeated rows get a row each, of equal languages the first by name is taken, an empty table gives none. The
    model, bounded by its sample, is broadcast. Columns to keep may not be called like those added (see ``unnamed``).
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    cols = [id_col, *keep]
    inside = text_col in cols
    source = docs.select(*cols) if inside else docs.select(*cols, text_col)
    place = cols.index(text_col) if inside else len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            texts = text_bytes(batch.column(place))
            for s in chunks(texts, CHUNK_BYTES // 2):
                lang, score, rejected, least = held.value.predict([t.decode("utf-8", "replace") for t in texts[s]], seen)
                own = [batch.column(k).slice(s.start, s.stop - s.start) for k in range(len(cols))]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), pa.array(least)],
                    [*cols, "lang_pred", "score", "rejected", "cross_entropy"],
                )
        seen.clear()
        release_memory()

    added = StructType.fromDDL("lang_pred string, score double, rejected boolean, cross_entropy double")
    return source.mapInArrow(run, StructType(source.schema.fields[: len(cols)] + added.fields))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents; trained on documents outside fold 0 of 5."""
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    model = train_language_models(docs.where(~held_out("doc_id", 5, 0)))
    found = predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")
