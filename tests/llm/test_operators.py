"""The ten operators and the pipeline against brute-force versions, round trips and odd inputs."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import context_mixing, decontaminate, differences, langid, mixing, pii, progressive_jpeg, simhash, sstable, suffix_dedup
from corpusloom.llm.common import index_words
from corpusloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "a", "ab", "The same line here, long enough to have shingles.\n" * 3, "x" * 700, "zero \x00 byte", "Ünïcödé 𝔘 text — 例"]


def words(r, n):
    return " ".join(r.choice(("the", "of", "river", "stone", "ending", "thered", "alpha", "houses", "quickly", "brown", "under", "seven")) + r.choice(("", "", "s", "ed")) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    texts = [words(r, r.randint(5, 120)) for _ in range(40)]
    texts += [texts[0], texts[1] + " extra", texts[2].upper(), texts[3], texts[3]] + ODD + ODD[3:6]
    return [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_index_words():
    texts = [b"A b a", b"", b"b\x0bc  A ", b"x" * 400 + b" y"]
    names, index, sizes = index_words(texts)
    assert [names[i] for i in index] == [w for t in texts for w in t.lower().split()] and sizes.tolist() == [3, 0, 3, 2]


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 130)] + [(None, 3), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jpeg_round_trip(docs, rows, empty):
    got = {r.doc_id: r for r in progressive_jpeg.media_digests(docs).collect()}
    for i, t, *_ in rows:
        data = (t or "").encode()
        payload = progressive_jpeg.padded(data)
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[0].feature == got[40].feature and got[0].media_sha256 == got[40].media_sha256
    assert progressive_jpeg.media_digests(empty).count() == 0
    files = progressive_jpeg.encode_media(docs.where("doc_id = 1"))
    one = progressive_jpeg.decode_media(files).first()
    assert len(one.rgb) == one.height * one.width * 3 and one.payload == progressive_jpeg.padded(rows[1][1].encode())


def test_jpeg_extreme_coefficients():
    r = random.Random(2)
    payloads = [bytes(r.randrange(256) for _ in range(576)), bytes([128]) * 1152, bytes(r.choice((127, 128, 129)) for _ in range(5760)), bytes([0]) * 576, bytes([255]) * 576]
    for p, (rgb, q) in zip(payloads, progressive_jpeg.decode_files(progressive_jpeg.encode_payloads(payloads))):
        assert p == q and rgb.ndim == 3
    with pytest.raises(ValueError):
        progressive_jpeg.parse(b"not a file")


def test_pii(docs, rows, empty):
    text = "mail a.b@c.de, x@y, ip 10.0.0.255 1.2.3.999 card 4111 1111 1111 1111 4111 1111 1111 1112 tel +1 (212) 555-0100 +1 2 (555) 123-4567"
    base = pii.base_spans(text)
    found = {k: [text[a:b] for a, b in v] for k, v in base.items()}
    assert found == {"email": ["a.b@c.de"], "ip": ["10.0.0.255"], "card": [], "phone": ["+1 (212) 555-0100", "+1 2 (555) 123-4567"]}
    assert pii.base_spans("4111-1111-1111-1111 ")["card"] == [(0, 19)] and pii.base_spans("a@b.c@d.e")["email"] == [(0, 5)]
    _, every = pii.find_pii("call (555) 123-4567 or write to john (at) site (dot) org", pii.trained())
    assert [k for k, *_ in every] == ["email", "phone"]
    out = pii.pii_spans(docs)
    assert out.count() == len(rows) and out.where("n_email + n_ip + n_card + n_phone > 0").count() == 0 and pii.pii_spans(empty).count() == 0


def test_pii_model_is_a_distribution():
    text = "call (555) 123-4567 or 4111 1111 1111 1111 now"
    spans = pii.tokens(text, 0, len(text))
    crf = pii.SemiMarkovCRF({"phone": 0.3, "card luhn True": 0.7, ">card": -0.2, "phone>card": 0.4})
    lattice = crf._lattice(text, spans, pii.candidates(text, spans))
    total = 0.0

    def paths(at, chosen):
        nonlocal total
        if at == len(spans):
            total += math.exp(crf.gradient(lattice, set(chosen))[0])
            return
        paths(at + 1, chosen)
        for j in range(at, len(spans)):
            for i, kind, _ in lattice[j]:
                if i == at:
                    paths(j + 1, [*chosen, (i, j, kind)])

    paths(0, [])
    assert total == pytest.approx(1.0)


def test_mixing(spark, docs, rows, empty):
    got = {r.doc_id: r for r in mixing.pareto_mix(docs).collect()}
    size = {i: len((t or "").split(" ")) and len([w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]) for i, t, *_ in rows}
    by = defaultdict(int)
    for i, _, _, s, _ in rows:
        by[s] += size[i]
    weights, left, target = dict(zip(["a", "b", None], (3, 1, 2))), 1.5 * sum(by.values()), {}
    while left > 1e-9 and len(target) < 3:
        w = sum(weights[s] for s in by if s not in target)
        over = [s for s in by if s not in target and left * weights[s] / w > 2 * by[s]]
        for s in over or [s for s in by if s not in target]:
            target[s] = 2 * by[s] if over else left * weights[s] / w
        left = 1.5 * sum(by.values()) - sum(target.values())
    for i, *_ in rows:
        assert got[i].size == size[i] and got[i].taken <= 2 * size[i]
    for s in by:
        own = [r for r in got.values() if r.source == s]
        assert own[0].target == pytest.approx(target[s]) and abs(sum(r.taken for r in own) - target[s]) <= 0.05 * target[s] + 10
    assert {i: r.taken for i, r in got.items()} == {r.doc_id: r.taken for r in mixing.pareto_mix(docs.repartition(5)).collect()}
    assert mixing.pareto_mix(empty).count() == 0


def test_language_model(docs, empty):
    r = random.Random(4)
    deck = {"a": [f"{x}{y}a" for x in "bdgkl" for y in "aeo"], "b": [f"{x}{y}z" for x in "mnprs" for y in "iuy"]}
    model = langid.KneserNeyModels.train({k: Counter(r.choices(v, k=400)) for k, v in deck.items()})
    model.calibrate([" ".join(r.choices(deck[k], k=30)) for k in deck for _ in range(20)], [k for k in deck for _ in range(20)])
    for j in range(2):  # probabilities of all next symbols add up to at most one
        total = sum(math.exp(float(model.score_words([c])[0][0, j])) for c in "abdgklmnprseiouyz")
        assert total <= 1.0
    lang, score, rejected, _ = model.predict(["baa doa gea", "miz nuz", "", "123 !", "ǅøøq"])
    assert lang[:2] == ["a", "b"] and lang[2:4] == ["und", "und"] and score[2] == 0 and rejected.tolist()[2:4] == [True, True] and ((0 <= score) & (score <= 1)).all()
    assert langid.predict_language(docs, model).count() == docs.count() and langid.predict_language(empty, model).count() == 0
    none = langid.train_language_models(empty)
    assert {x.lang_pred for x in langid.predict_language(docs, none).collect()} == {"und"}


def test_decontamination(spark, docs, empty):
    r = random.Random(9)
    item = " ".join(f"w{k}x" for k in r.sample(range(1000), 30))
    edited = " ".join(w if k % 7 else "changed" for k, w in enumerate(item.split()))
    texts = [words(r, 50) + " " + item + " " + words(r, 9), "before " + edited + " after", words(r, 80), None, "", item.upper().replace(" ", ", "), " ".join(item.split()[:6])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id long, text string")
    got = {x.doc_id: x for x in decontaminate.contaminated(frame, bench).collect()}
    assert set(got) == {0, 1, 5} and got[0].score == 1.0 and (got[0].first_word, got[0].last_word) == (50, 79) and 0.5 <= got[1].score < 1
    assert decontaminate.contaminated(docs, bench).count() == 0 and decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_alignment_against_plain_version():
    r = random.Random(3)
    for _ in range(30):
        a, b = [r.randrange(4) for _ in range(r.randint(4, 9))], [r.randrange(4) for _ in range(r.randint(4, 14))]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        score, first, last = decontaminate.align([np.array(a)], [np.array(b)])
        assert score[0] == max(map(max, h)) and (score[0] == 0 or 0 <= first[0] <= last[0] < len(b))


def test_suffix_arrays():
    r = np.random.default_rng(1)
    for kinds, n in ((1, 60), (2, 300), (256, 400)):
        t = r.integers(0, kinds, n).astype(np.uint8)
        b, sa = t.tobytes(), suffix_dedup.suffix_array(t)
        assert sa.tolist() == sorted(range(n), key=lambda i: b[i:])
        lcp = suffix_dedup.common_prefixes(t, sa, np.array([0, n // 3, n // 2]))
        for x, y in zip(sa, sa[1:]):
            k = 0
            while k < 50 and max(x, y) + k < n and b[x + k] == b[y + k]:
                k += 1
            assert lcp[y] == k


def test_suffix_merge(monkeypatch):
    r = random.Random(6)
    parts = [bytes(r.choice(b"ab") for _ in range(60)) for _ in range(20)]
    parts += [parts[3][5:] + b"q" * 9, b"z" + parts[4]]
    flat = np.frombuffer(b"".join(parts), np.uint8)
    size = np.array([len(p) for p in parts])
    args = (flat, np.cumsum(size) - size, size, np.arange(len(parts)))
    whole = suffix_dedup.least_documents(*args)
    monkeypatch.setattr(suffix_dedup, "SUFFIX_BYTES", 150)
    assert all((x == y).all() for x, y in zip(whole, suffix_dedup.least_documents(*args)))


def removed(rows):
    order = sorted(((math.inf if i is None else i), (t or "").encode()) for i, t, *_ in rows)
    first, out = {}, []
    for i, t in order:
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(i, first.get(t[p : p + 50], math.inf))
    for i, t in order:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((None if i == math.inf else i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup(spark, rows, empty):
    more = rows + [(None, rows[0][1], None, None, 0), (3, rows[4][1], None, None, 0)]
    frame = spark.createDataFrame(more, SCHEMA)
    got = sorted((tuple(r)[:5] for r in suffix_dedup.remove_repeats(frame).collect()), key=repr)
    assert got == removed(more) and suffix_dedup.remove_repeats(empty).count() == 0


def test_token_shards(spark, docs, rows, empty, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(sstable.default_tokenizer())
    shards = sstable.write_token_shards(docs, str(tmp_path / "s"))
    at, got = 0, {r.doc_id: r for r in sstable.read_token_shards(shards).collect()}
    for i, t, *_ in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    image = next(s.image for s in shards.collect() if s.first_id <= 7 <= s.last_id)
    assert len(sstable.SSTable(image).get(sstable.key_of(7))) == 1 and sstable.SSTable(image).get(sstable.key_of(10**12)) == []
    assert sstable.read_token_shards(sstable.write_token_shards(empty, str(tmp_path / "e"))).count() == 0


def test_sstable_format():
    table, r = sstable.SSTableWriter(), random.Random(1)
    keys = sorted(r.sample(range(-(10**6), 10**6), 3000))
    for k in keys:
        table.add(sstable.key_of(k), bytes(r.randrange(256) for _ in range(r.randrange(90))))
    reader = sstable.SSTable(table.finish())
    items = list(reader.items())
    assert [sstable.id_of(k) for k, _ in items] == keys and len(reader.blocks) > 1
    assert all(reader.get(k) == [v] for k, v in items[::97])
    missing = [sstable.key_of(k) for k in range(2 * 10**6, 2 * 10**6 + 2000)]
    assert sum(map(reader.may_hold, missing)) < 60
    with pytest.raises(ValueError):
        sstable.SSTable(b"x" + table.finish()[1:])


def test_encoder_keeps_special_strings_whole():
    encoder = sstable.WordCachedEncoder(sstable.default_tokenizer(), limit=5)
    texts = ["It's 3.14, isn't it?!", "a<|endoftext|>b C", "Été ÀB, naïve...", "“x”. y", "hello, hello. HELLO world"]
    for _ in range(2):
        packed = encoder.encode([t.encode() for t in texts])
        assert [np.frombuffer(p, encoder.dtype).tolist() for p in packed] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def plain_fingerprint(text, width):
    import xxhash

    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("wide", [30_000_000, 10])
def test_simhash(spark, docs, rows, empty, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE_ABOVE", wide)
    fps = {i: plain_fingerprint(t, 4) for i, t, *_ in rows}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", find(i)) for i in fps}
    assert simhash.simhash_components(empty).count() == 0


def test_covering_finds_all_pairs():
    r = random.Random(7)
    for blocks in (2, 3):
        cover = simhash.Covering(4, blocks)
        for _ in range(20):
            x = r.getrandbits(64)
            y = x
            for b in r.sample(range(64), 4):
                y ^= 1 << b
            keys = [set(np.concatenate([k for _, k in cover.anchors(np.array([v], np.uint64))]).tolist()) for v in (x, y)]
            assert keys[0] & keys[1]


def test_near_duplicates(spark):
    r = random.Random(12)
    vocabulary = [f"w{k}" for k in range(4000)]
    base = [r.choices(vocabulary, k=200) for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for b in base[:8]:
        c = list(b)
        for k in (40, 120):
            c[k] = "edited"
        texts.append(" ".join(c))
    texts += [texts[0], None, "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    assert got == {12 + k: k for k in range(8)} | {20: 0, 22: 21, 23: 21}


def test_near_duplicates_whose_original_does_not_come_first(spark):
    r = random.Random(21)
    vocabulary = [f"w{k}" for k in range(4000)]
    original = r.choices(vocabulary, k=200)
    texts = []
    for _ in range(60):
        c = list(original)
        for k in r.sample(range(5, 195), 4):
            c[k] = r.choice(vocabulary)
        texts.append(" ".join(c))
    texts.insert(30, " ".join(original))
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(196)) for t in texts]
    root = list(range(61))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(61):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    assert got == {k: find(k) for k in range(61) if find(k) != k}


@pytest.mark.parametrize("direct", [32, 3])
def test_near_duplicates_of_short_texts_in_large_groups(spark, monkeypatch, direct):
    """Groups of over a hundred edited short texts, and texts that share a common passage, against all pairs."""
    monkeypatch.setattr(differences, "DIRECT", direct)
    r = random.Random(24)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage, texts = r.choices(vocabulary, k=30), []
    for n in (25, 40, 60):
        base = r.choices(vocabulary, k=n)
        for _ in range(130):
            c = list(base)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(c))
                c[at : at + r.randint(0, 2)] = r.choices(vocabulary, k=r.randint(0, 2))
            texts.append(" ".join(c))
    texts += [" ".join(r.choices(vocabulary, k=r.randint(1, 40)) + passage + r.choices(vocabulary, k=r.randint(1, 10))) for _ in range(80)]
    cut = [t.split() for t in texts]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in cut]
    alike = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in alike:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert len(alike) > 1000 and got == {k: find(k) for k in range(len(texts)) if find(k) != k}


def test_near_duplicates_in_rounds(spark, monkeypatch):
    """Members taken a few at a time give what one round gives, and whole sets are shuffled by leader only."""
    r = random.Random(41)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(2000)}" for _ in range(150)]
        texts += [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(0, 150, 20)]
    frame, rounds = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), []

    def spied(both, least, f=simhash.with_far_groups):
        rounds.append(both._jdf.queryExecution().executedPlan().toString())
        return f(both, least)

    monkeypatch.setattr(simhash, "with_far_groups", spied)
    whole = sorted(simhash.near_duplicates(frame).collect())
    assert len(whole) > 50 and len(rounds) == 1 and "hashpartitioning(key" not in rounds[0]
    monkeypatch.setattr(simhash, "MEMBERS_AT_ONCE", 30)
    assert sorted(simhash.near_duplicates(frame).collect()) == whole and len(rounds) > 2


def test_fingerprint_pairs_are_direct(spark):
    r = random.Random(23)
    base = [r.getrandbits(63) for _ in range(3)]
    fps = sorted({b ^ (1 << r.randrange(60)) ^ (1 << r.randrange(60)) ^ (1 << r.randrange(60)) for b in base for _ in range(70)})
    rows = [(fp, lo := r.randrange(2), r.randrange(lo, 2)) for fp in fps]
    got = {(x.fp_a, x.fp_b) for x in simhash.fingerprint_pairs(spark.createDataFrame(rows, "fp long, lo long, hi long"), 4, len(rows)).collect()}
    assert got == {(a, b) for a, la, ha in rows for b, lb, hb in rows if a >= b and (a ^ b).bit_count() <= 4 and min(la, lb) != max(ha, hb)}


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_context_mixing(spark, docs, rows, empty, monkeypatch, limit):
    monkeypatch.setattr(context_mixing, "BROADCAST_WORDS", limit)
    train = [t for i, t, *_ in rows if i % 3]
    counts = Counter(w for t in train for w in (t or "").encode().lower().split())
    counts["end"] = len(train)
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in context_mixing.score_texts(docs, docs.where("doc_id % 3 > 0")).collect()}
    for i, t, *_ in rows:
        own = (t or "").encode().lower().split() + ["end"]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)) and got[i].score < 0
    if limit > 5:
        none = context_mixing.score_texts(docs, empty).first()
        assert none.train_tokens == 0 and none.n_known == 0 and none.base_score == 0


def test_context_mixing_learns():
    r = random.Random(2)
    train, test = ([words(r, 60).encode() for _ in range(n)] for n in (200, 20))
    ones, every = np.zeros((context_mixing.ORDERS, 1 << context_mixing.SLOT_BITS), np.uint32), np.zeros((context_mixing.ORDERS, 1 << context_mixing.SLOT_BITS), np.uint32)
    g, n = np.unique(context_mixing.grams(train)[0], return_counts=True)
    context_mixing.count_bits(ones, every, g, n.astype(float))
    weights = context_mixing.learn_weights(ones.astype(float), every.astype(float), train[:50])
    model = context_mixing.MixingModel(context_mixing.log_odds(ones.astype(float), (every - ones).astype(float)), weights)
    bits = model.bits(test)
    assert bits.sum() / sum(map(len, test)) < 1.5
    assert np.allclose(bits[:3], [model.bits([t])[0] for t in test[:3]], rtol=1e-4)  # no text depends on its batch


def test_slot_tables_grow_with_the_contexts(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "SLOT_BITS", 15)
    r = random.Random(41)
    texts = ["".join(chr(r.randrange(33, 127)) for _ in range(400)) for _ in range(100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = context_mixing.train_model(frame)
    g = np.unique(context_mixing.grams([t.encode() for t in texts])[0])
    for o in range(1, context_mixing.ORDERS + 1):
        nodes = sum(len({int(x) >> 8 - j for x in g & np.uint64((1 << 8 * (o + 1)) - 1)}) for j in range(8))
        assert len(model.odds[o - 1]) >= max(1 << 15, 1.6 * nodes)
    assert len(model.odds[3]) > len(model.odds[0])


def test_weights_come_from_all_texts_of_every_length(spark):
    r = random.Random(42)
    texts = [words(r, 900) for _ in range(4)] + [words(r, 20) for _ in range(20)]
    assert max(map(len, texts)) > 4000
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = context_mixing.train_model(frame)
    start = context_mixing.learn_weights(None, None, [])
    only_long = context_mixing.train_model(frame.where("doc_id < 4"))
    assert any(np.abs(a - b).max() > 0.1 for a, b in zip(only_long.weights, start))
    counts = context_mixing.gram_counts(frame)
    assert counts.agg({"n": "sum"}).first()[0] == sum(len(t.encode()) + 1 for t in texts)
    ones, every = context_mixing.bit_tables(counts, context_mixing.table_sizes(counts))
    local = context_mixing.learn_weights(ones, every, [t.encode() for t in texts])
    assert all(np.allclose(a, b, atol=0.01) for a, b in zip(model.weights, local))


def test_last_mixer_moves_in_short_blocks():
    x = np.zeros((1, 16), np.float32)
    x[:, :8] = 2.0
    w, long = np.full((1, 2, 8), 0.5, np.float32), 20_000
    context_mixing.MixingModel._mix(x, np.zeros(long, np.int64), np.array([0]), np.array([long]), w)
    once = np.full((1, 2, 8), 0.5, np.float32)
    for _ in range(0, long, 32):
        context_mixing.MixingModel._mix(x, np.zeros(32, np.int64), np.array([0]), np.array([32]), once)
    assert w[0, 0] == pytest.approx(once[0, 0], abs=0.01) and w[0, 0].min() > 2


def test_pipeline_stages(spark, rows, tmp_path):
    import corpus_pipeline

    r = random.Random(1)
    item = " ".join(f"w{k}x" for k in r.sample(range(1000), 30))
    texts = [words(r, 60) for _ in range(30)] + [None, "123"]
    texts += [texts[0], texts[5], words(r, 40) + " " + item]
    frame = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    where = str(tmp_path)
    spark.createDataFrame(frame, SCHEMA).write.parquet(where + "/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(where + "/benchmark.parquet")
    docs, kept = spark.read.parquet(where + "/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, where).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(sorted(x.doc_id for x in docs.select("doc_id").collect()))
    assert kept[0] == [i for i in range(35) if i not in (30, 31)] and kept[1] == [i for i in kept[0] if i not in (32, 33)] and kept[2] == [i for i in kept[1] if i != 34]
    assert set(kept[3]) <= set(kept[2]) and max(Counter(kept[3]).values()) <= 2
    assert corpus_pipeline.run(spark, where).count() == len(kept[3])


def test_stages_give_back_what_ended_queries_hold(spark, rows, tmp_path, monkeypatch):
    """Every stage begins so; shuffles of a query that nothing refers to are gone soon after."""
    import corpus_pipeline
    from corpusloom.llm import common

    begun = []
    monkeypatch.setattr(corpus_pipeline, "release_driver", begun.append)
    spark.createDataFrame([(1, "an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(k, words(random.Random(k), 30), "en", "s", 1) for k in range(20)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path))
    assert len(begun) == len(corpus_pipeline.STAGES)
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    shuffles = lambda: set(re.findall(r"\d+", tracker.shuffleStatuses().keySet().toString()))
    had = shuffles()
    spark.range(1000).repartition(7).write.format("noop").mode("overwrite").save()
    made = shuffles() - had
    for _ in range(20):
        common.release_driver(spark)
        if not made & shuffles():
            break
        time.sleep(0.5)
    assert made and not made & shuffles()


def test_bit_counts_and_scores_against_a_plain_version(spark):
    """Slots hold the counts of their contexts (few collide), and a text's score is that of a bit-by-bit loop over the same model."""
    r = random.Random(43)
    texts = [words(r, 40).encode() for _ in range(30)] + [b"", "é例x".encode()]
    frame = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    counts = context_mixing.gram_counts(frame)
    sizes = context_mixing.table_sizes(counts)
    ones, every = context_mixing.bit_tables(counts, sizes)
    want = [defaultdict(lambda: [0, 0]) for _ in range(context_mixing.ORDERS)]
    for t in texts:
        data = b"\0" * context_mixing.ORDERS + t + b"\0"
        for i in range(context_mixing.ORDERS, len(data)):
            for order in range(1, context_mixing.ORDERS + 1):
                for j in range(8):
                    cell = want[order - 1][data[i - order : i], data[i] >> (8 - j), j]
                    cell[0] += data[i] >> (7 - j) & 1
                    cell[1] += 1
    wrong = total = 0
    for order, cells in enumerate(want, 1):
        for (context, before, j), (one, n) in cells.items():
            g = np.array([int.from_bytes(context, "big") << 8 | before << (8 - j)], np.uint64)
            at = int(context_mixing.slots(g, order, sizes[order - 1])[j, 0])
            wrong += (ones[order - 1][at], every[order - 1][at]) != (one, n)
            total += 1
    assert wrong < 0.01 * total

    model = context_mixing.train_model(frame)
    for t in (texts[0], b"never seen 123", b"", texts[-1]):
        data, bits, w = b"\0" * context_mixing.ORDERS + t + b"\0", 0.0, np.full((2, 8), 0.5)
        symbols = range(context_mixing.ORDERS, len(data))
        for lo in range(0, len(symbols), context_mixing.MIX_BLOCK):
            block, slope = symbols[lo : lo + context_mixing.MIX_BLOCK], np.zeros((2, 8))
            for i in block:
                g = np.array([int.from_bytes(data[i - context_mixing.ORDERS : i + 1], "big")], np.uint64)
                x = [[float(model.odds[o][context_mixing.slots(g, o + 1, len(model.odds[o]))[j, 0]]) for o in range(context_mixing.ORDERS)] for j in range(8)]
                known = sum(v != 0 for v in x[0])
                sets = (context_mixing.BYTE_CLASS[data[i - 1]], known)
                for j in range(8):
                    z = [float(np.dot(model.weights[k][sets[k]][j], [*x[j], 1.0])) for k in range(2)]
                    sign = 2 * (data[i] >> (7 - j) & 1) - 1
                    p = 1 / (1 + math.exp(-sign * sum(w[k, j] * z[k] for k in range(2))))
                    bits -= math.log2(p)
                    slope[:, j] += [(1 - p) * sign * v for v in z]
            w += context_mixing.RATE * slope / len(block)
        assert model.bits([t])[0] == pytest.approx(bits, rel=1e-3)
