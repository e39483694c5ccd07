"""Personal data: fixed patterns plus spans found by a semi-Markov conditional random field."""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import integer_id, read_documents, text_bytes

KINDS = ("email", "ip", "card", "phone")
#: Longest entity, in tokens.
MAX_TOKENS = 24

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i & 1:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: a local part is the whole run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Matches of the fixed patterns per kind, failing ones dropped; code points, end exclusive.

    An IP match can only start where a run of digits starts, since any later start fails the same way.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found["phone"].append(m.span())
    return found


# ---- the semi-Markov model -------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
#: Where an entity may be near.
SEED = re.compile(r"[0-9]+|@|[\[(]at[\])]|\bat\b(?=\s+\S{1,40}\s+dot\b)")
NUMERIC = set("+().- /")
DOT, AT = re.compile(r"\s*[\[(]?\bdot\b[\])]?\s*|\[\.\]"), re.compile(r"\s*[\[(]at[\])]\s*|\s+at\s+")
PLAIN_EMAIL = re.compile(r"[a-z0-9._%+-]+@[a-z0-9-]+(\.[a-z0-9-]+)+")
#: Cue words before an entity, by kind.
CUES = {
    "email": {"email", "mail", "e", "contact", "write"},
    "ip": {"ip", "host", "server", "address", "from"},
    "card": {"card", "visa", "mastercard", "amex", "cc", "credit"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telephone", "cell", "number"},
}


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text, start, end)]


def candidates(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(first token, last token, kind) of the segments that may be entities, at most ``MAX_TOKENS`` long."""
    out = []
    for i, (a, first_end) in enumerate(spans):
        c = text[a]
        digit, numeric_start, word = "0" <= c <= "9", c in "+(0123456789", c.isalnum()
        numeric, digits, dots, ats = numeric_start, 0, 0, 0
        for j in range(i, min(i + MAX_TOKENS, len(spans))):
            s, e = spans[j]
            if j > i:
                gap = text[spans[j - 1][1] : s]
                if len(gap) > 1 or gap == "\n":
                    break
            own = text[s:e]
            if "0" <= own[0] <= "9":
                digits += e - s
            elif own == "@" or own.lower() == "at":
                ats += 1
            dots += own == "." or own.lower() == "dot"
            numeric = numeric and (own.isdigit() or own in NUMERIC or own in "[]")
            if not numeric and not word or ats > 1 or digits > 24:
                break
            if "0" <= own[0] <= "9" and numeric and digit | (c in "+("):
                if 7 <= digits <= 15:
                    out.append((i, j, "phone"))
                if digit and 12 <= digits <= 19:
                    out.append((i, j, "card"))
                if digit and dots == 3 and digits <= 12:
                    out.append((i, j, "ip"))
            if word and ats == 1 and dots and own.isalnum() and e - s <= 12 and j - i >= 4:
                out.append((i, j, "email"))
    return out


def span_features(text: str, a: int, b: int, kind: str) -> list[str]:
    """Features of the whole candidate span and its surroundings."""
    s = text[a:b]
    before = text[max(0, a - 24) : a]
    cue = re.findall(r"[a-z]+", before.lower())[-2:]
    left, right = before[-1:], text[b : b + 1]
    out = [kind, f"{kind} cue" if any(c in CUES[kind] for c in cue) else f"{kind} no cue"]
    if left and (left.isalnum() or left in "-_/.$=#+(@"):
        out.append(f"{kind} glued left")
    if right and (right.isalnum() or right in "-_/@)" or right in ".:," and text[b + 1 : b + 2].isdigit()):
        out.append(f"{kind} glued right")
    if kind == "email":
        plain = AT.sub("@", DOT.sub(".", s.lower()))
        m = PLAIN_EMAIL.fullmatch(plain)
        out.append(f"email shape {bool(m)}")
        if m:
            out.append(f"email ending {2 <= len(plain.rpartition('.')[2]) <= 6 and plain.rpartition('.')[2].isalpha()}")
        marks = bool(re.search(r"[\[(]at[\])]", s.lower())), bool(re.search(r"\bdot\b|\[\.\]", s.lower())), "@" in s
        out.append("email marks {} {} {}".format(*marks))
        return out
    groups = re.findall(r"[0-9]+", s)
    digits = "".join(groups)
    seps = "".join(sorted(set(re.sub(r"[0-9]", "", s))))
    out += [f"{kind} digits {len(digits)}", f"{kind} seps {seps}", f"{kind} groups {'-'.join(str(len(g)) for g in groups)[:16]}"]
    if kind == "card":
        out.append(f"card luhn {luhn(digits)}")
        out.append(f"card issuer {digits[:1] in '3456'}")
    if kind == "phone":
        out += [f"phone start {s[0] if s[0] in '+(' else 0 if s[0] == '0' else 9}", f"phone {len(groups)} groups"]
        if len(groups) == 3 and len(groups[0]) == 4 and len(groups[1]) == len(groups[2]) == 2:
            out.append("phone like a date")
    if kind == "ip":
        out.append(f"ip octets {len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    return out


class SemiMarkovCRF:
    """Segments a token window; a segment is one outside token (score 0) or a candidate entity.

    ``viterbi`` chooses boundaries and kinds jointly; the state carries the last kind for the transition features.
    """

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    @staticmethod
    def _lattice(text: str, spans, cands):
        by_end: list[list[tuple[int, str, list[str]]]] = [[] for _ in spans]
        for i, j, kind in cands:
            by_end[j].append((i, kind, span_features(text, spans[i][0], spans[j][1], kind)))
        return by_end

    def _score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def viterbi(self, text: str, spans, cands) -> list[tuple[int, int, str]]:
        by_end = self._lattice(text, spans, cands)
        best: list[dict[str, tuple[float, tuple | None]]] = [{"": (0.0, None)}]
        for j, segments in enumerate(by_end):
            top = max(best[j].items(), key=lambda x: x[1][0])
            here = {"": (top[1][0], (j, top[0], None))}
            for i, kind, features in segments:
                own = self._score(features)
                for was, (value, _) in best[i].items():
                    v = value + own + self.weights.get(f"{was}>{kind}", 0.0)
                    if v > here.get(kind, (-math.inf,))[0]:
                        here[kind] = (v, (i, was, (i, j, kind)))
            best.append(here)
        out, j = [], len(by_end)
        kind = max(best[j].items(), key=lambda x: x[1][0])[0]
        while j:
            i, was, segment = best[j][kind][1]
            if segment:
                out.append(segment)
            j, kind = i, was
        return out[::-1]

    def gradient(self, by_end, gold: set[tuple[int, int, str]]) -> tuple[float, dict[str, float]]:
        """Log likelihood of the gold segmentation and its gradient, by forward-backward over the lattice."""
        n = len(by_end)
        scored = [[(i, k, f, self._score(f)) for i, k, f in segments] for segments in by_end]
        names = ("", *KINDS)
        step = lambda was, kind: self.weights.get(f"{was}>{kind}", 0.0)
        forward: list[dict[str, float]] = [{"": 0.0}]
        for j in range(n):
            here = {"": _log_sum(forward[j].values())}
            for i, kind, _, s in scored[j]:
                here[kind] = _log_sum([here.get(kind, -math.inf), *(v + step(was, kind) + s for was, v in forward[i].items())])
            forward.append(here)
        backward: list[dict[str, float]] = [dict.fromkeys(names, -math.inf) for _ in range(n)] + [dict.fromkeys(names, 0.0)]
        ahead: list[list[tuple[int, str, list[str], float]]] = [[] for _ in range(n)]
        for j in range(n):
            for i, kind, f, s in scored[j]:
                ahead[i].append((j, kind, f, s))
        for i in range(n - 1, -1, -1):
            for was in names:
                backward[i][was] = _log_sum([backward[i + 1][""], *(s + step(was, kind) + backward[j + 1][kind] for j, kind, _, s in ahead[i])])
        z, value, slope = backward[0][""], 0.0, {}
        for i in range(n):
            for j, kind, f, s in ahead[i]:
                for was, v in forward[i].items():
                    p = math.exp(v + step(was, kind) + s + backward[j + 1][kind] - z)
                    for name in (*f, f"{was}>{kind}"):
                        slope[name] = slope.get(name, 0.0) - p
        kind_before = dict.fromkeys(range(n + 1), "")
        for i, j, kind in sorted(gold):
            kind_before[j + 1] = kind
            f = next((f for a, k, f in by_end[j] if (a, k) == (i, kind)), None)
            if f is not None:
                for name in (*f, f"{kind_before[i]}>{kind}"):
                    slope[name] = slope.get(name, 0.0) + 1
                    value += self.weights.get(name, 0.0)
        return value - z, slope

    def train(self, sentences: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 8, rate: float = 0.4, decay: float = 0.002) -> SemiMarkovCRF:
        """Stochastic gradient ascent with per-feature rates on (text, entity spans) pairs."""
        made = []
        for text, entities in sentences:
            spans = tokens(text, 0, len(text))
            start, end = {a: k for k, (a, _) in enumerate(spans)}, {b: k for k, (_, b) in enumerate(spans)}
            made.append((self._lattice(text, spans, candidates(text, spans)), {(start[a], end[b], kind) for a, b, kind in entities}))
        square: dict[str, float] = {}
        for _ in range(epochs):
            for by_end, gold in made:
                _, slope = self.gradient(by_end, gold)
                for name, g in slope.items():
                    g -= decay * self.weights.get(name, 0.0)
                    square[name] = square.get(name, 1e-3) + g * g
                    self.weights[name] = self.weights.get(name, 0.0) + rate * g / math.sqrt(square[name])
        return self


def _log_sum(xs) -> float:
    xs = list(xs)
    top = max(xs)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in xs))


def made_sentences(n: int = 320, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Labelled training sentences made by rule: entities in many written forms among words and look-alike numbers."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "re", "ou", "ti", "es", "or", "in")) for _ in range(r.randint(1, 4)))

    def card(k: int) -> str:
        body = r.choice("3456") + digits(k - 2)
        return body + next(d for d in "0123456789" if luhn(body + d))

    def entity() -> tuple[str, str]:
        kind = r.choice(KINDS)
        if kind == "email":
            at, dot = r.choice((("@", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("@", "[.]"), ("[at]", "[dot]")))
            return word() + r.choice(("", digits(2), "." + word())) + at + word() + dot + r.choice(("com", "org", "net", "io", "de")), kind
        if kind == "ip":
            return r.choice((".", "[.]")).join(str(r.randint(0, 255)) for _ in range(4)), kind
        if kind == "card":
            k = r.choice((13, 15, 16, 16, 19))
            d, sep = card(k), r.choice((" ", "-", ""))
            cut = (4, 10) if k == 15 else range(4, k, 4)
            return sep.join(d[i:j] for i, j in zip((0, *cut), (*cut, k))), kind
        a, b, c = r.randint(200, 989), digits(3), digits(4)
        return r.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 {a} {b} {c}", f"+49 {digits(3)} {digits(7)}", f"0{digits(3)} {digits(6)}", f"({a}) {b} {c}", f"{a}.{b}.{c}")), kind

    def other() -> str:
        return r.choice((
            lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"{digits(2)}:{digits(2)}:{digits(2)}", lambda: f"${digits(3)}.{digits(2)}",
            lambda: f"v{digits(1)}.{digits(1)}.{digits(2)}", lambda: digits(r.randint(1, 20)), lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((16, 32, 40)))),
            lambda: f'token = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}"', lambda: f"978-{digits(1)}-{digits(5)}-{digits(3)}-{digits(1)}", lambda: f"{digits(1)},{digits(3)},{digits(3)}",
            lambda: f"{r.randint(256, 999)}.{digits(3)}.{digits(3)}.{digits(3)}", lambda: f"{digits(3)} {digits(3)} {digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(4)} {digits(4)}", lambda: f"@{word()}",
            lambda: f"{digits(2)}-{digits(2)}-{digits(4)}", lambda: f"at {word()} {word()}.", lambda: f"{digits(4)}-{digits(4)}", lambda: f"#{digits(7)}", lambda: f"{digits(1)}.{digits(6)}",
        ))()

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(2, 5)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + " "
            if r.random() < 0.5:
                body, kind = entity()
                if r.random() < 0.3:
                    text += r.choice(sorted(CUES[kind])) + r.choice((": ", " "))
                spans.append((len(text), len(text) + len(body), kind))
                text += body + r.choice((" ", ", ", ". "))
            else:
                text += other() + r.choice((" ", ", ", ". "))
        out.append((text, spans))
    return out


@lru_cache(1)
def trained() -> SemiMarkovCRF:
    """The model fitted on the made sentences; the same in every run."""
    return SemiMarkovCRF().train(made_sentences())


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], model: SemiMarkovCRF) -> list[tuple[int, int, str]]:
    """Entities that the model sees outside the base spans.

    Only windows around digits, @ or a written-out at are segmented: all other tokens can only be outside, so
    the windows are independent and together give the best segmentation of the whole text. Base spans split the windows.
    """
    taken = sorted({s for spans in base.values() for s in spans})
    starts, ends, reach = [a for a, _ in taken], [], 0
    for _, b in taken:
        reach = max(reach, b)
        ends.append(reach)
    windows: list[list[int]] = []
    for m in SEED.finditer(text):
        k = bisect_right(starts, m.start()) - 1
        if k >= 0 and ends[k] >= m.end():
            continue
        a, b = max(0, m.start() - 48), min(len(text), m.end() + 48)
        while a and not text[a - 1].isspace() and m.start() - a < 96:
            a -= 1
        while b < len(text) and not text[b].isspace() and b - m.end() < 96:
            b += 1
        if windows and a <= windows[-1][1]:
            windows[-1][1] = max(b, windows[-1][1])
        else:
            windows.append([a, b])
    out = []
    for a, b in windows:
        cut = [a]
        for s, e in taken[max(0, bisect_right(starts, a) - 8) : bisect_right(starts, b)]:
            if e > a:
                cut += [max(s, a), min(e, b)]
        cut.append(b)
        for lo, hi in zip(cut[::2], cut[1::2]):
            if lo < hi:
                spans = tokens(text, lo, hi)
                if cands := candidates(text, spans):
                    out += [(spans[i][0], spans[j][1], kind) for i, j, kind in model.viterbi(text, spans, cands)]
    return [s for s in out if not _overlaps(s, starts, ends, taken)]


def _overlaps(span, starts, ends, taken) -> bool:
    k = bisect_right(starts, span[1] - 1) - 1
    return k >= 0 and ends[k] > span[0]


def find_pii(text: str, model: SemiMarkovCRF) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans per kind, and all spans (kind, start, end) by kind as listed, then start."""
    base = base_spans(text)
    every = [(k, a, b) for k in KINDS for a, b in base[k]]
    if SEED.search(text):
        every += [(kind, a, b) for a, b, kind in added_spans(text, base, model)]
    return base, sorted(every, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SemiMarkovCRF | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row; counts are of base spans.

    Null texts count as empty, repeated rows are answered each, and no state is kept between rows, so a lost
    task is simply run again. The model is a few hundred weights.
    """
    held = docs.sparkSession.sparkContext.broadcast((model or trained()).weights)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = SemiMarkovCRF(held.value)
        plain = re.compile(rb"[0-9@]|\bat\b")
        empty = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)
        for batch in batches:
            rows = []
            for t in text_bytes(batch.column(1)):
                if not plain.search(t):
                    rows.append(empty)
                    continue
                base, every = find_pii(t.decode("utf-8", "replace"), crf)
                listed = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
                n = [len(base[k]) for k in KINDS]
                rows.append((*n, hashlib.sha256(listed.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in every), len(every) - sum(n)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    source = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents."""
    return pii_spans(read_documents(spark, sf_dir))
