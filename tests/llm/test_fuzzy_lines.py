"""Line dedup against brute force: thresholds, chains, families of one leader, and odd inputs."""

import random
from collections import defaultdict

import pytest

from corpusloom.llm import differences, fuzzy_lines

LETTERS = "abcdefghijklmnopqrstuvwxyz "


def shingles(line):
    return frozenset(line[i : i + 8] for i in range(max(1, len(line) - 7)))


def components(nodes, pairs):
    root = {k: k for k in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in nodes}


def similar(sets, pairs):
    return [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]


def drawn(r, n):
    return "".join(r.choice(LETTERS) for _ in range(n))


def edited(r, line, n):
    for k in r.sample(range(8, len(line) - 8), n):
        line = line[:k] + r.choice(LETTERS) + line[k + 1 :]
    return line


def decisions(frame):
    return sorted(((x.doc_id, x.line_no, x.kept) for x in fuzzy_lines.line_decisions(frame).collect()), key=repr)


def frame_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.fixture(scope="module")
def families():
    """Edited copies, copies of copies, quoted passages, truncations and lines on both sides of 128 shingles."""
    r = random.Random(32)
    lines = []
    for _ in range(20):
        original = drawn(r, 130)
        copies = [edited(r, original, r.randint(1, 4)) for _ in range(7)]
        lines += [original, *copies, edited(r, copies[-1], 1), original[:110], original[:95], original + drawn(r, 6)]
    passage = drawn(r, 150)
    lines += [drawn(r, r.randint(1, 120)) + passage + drawn(r, r.randint(1, 90)) for _ in range(60)] + [passage + drawn(r, 30), passage]
    large = drawn(r, 200)
    return lines + [edited(r, large, r.randint(1, 6)) for _ in range(90)]


@pytest.mark.parametrize("direct", [32, 4])
def test_every_similar_pair_of_a_band_is_linked(spark, monkeypatch, families, direct):
    monkeypatch.setattr(differences, "DIRECT", direct)
    frame = fuzzy_lines.lines_of(frame_of(spark, families))
    text = {x.key: x.line for x in frame.collect()}
    sets, bands = {k: shingles(t) for k, t in text.items()}, defaultdict(list)
    for x in fuzzy_lines.band_keys(fuzzy_lines.signatures(frame)).collect():
        bands[x.band].append(x.key)
    want = components(text, similar(sets, ((a, b) for held in bands.values() for a in held for b in held if a < b)))
    got = {x.node: x.component for x in fuzzy_lines.similar_lines(frame).collect()}
    assert {k: got.get(k, k) for k in text} == want


def test_recall_of_bands(families):
    """With the affine plane's bands, lines of similarity 0.8 and more meet."""
    import numpy as np

    r = np.random.default_rng(3)
    for share, least in ((0.8, 0.987), (0.9, 0.9992)):
        same = r.random((100_000, 16)) < share
        assert np.any([same[:, rows].all(axis=1) for rows in fuzzy_lines._band_rows()], axis=0).mean() >= least


def test_lines_that_stay(spark, families):
    """Documents of several lines against brute force over all pairs; these lines are far from the limits of the bands."""
    r = random.Random(8)
    base = [drawn(r, 128 + k) for k in range(-4, 20)]
    near = [b + "tail" for b in base[:12]] + [b[:60] + "#" + b[61:] for b in base[12:18]]
    texts = ["\n".join(base[i : i + 3]) for i in range(0, 24, 3)] + ["\n".join(near), "\n\n", None, "", "short\nshort", "x" * 9000 + "\n" + "x" * 9001, "-" * 200 + "\r\n" + "-" * 220, near[0]]
    lines = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate((t or "").split("\n")) if line.strip()]
    sets = [shingles(line) for *_, line in lines]
    root = components(range(len(lines)), similar(sets, ((a, b) for a in range(len(lines)) for b in range(a))))
    assert decisions(frame_of(spark, texts)) == sorted(((i, n, root[k] == k) for k, (i, n, _) in enumerate(lines)), key=repr)


def test_repeated_rows_null_ids_and_other_columns(spark):
    one, two = drawn(random.Random(1), 90), drawn(random.Random(2), 90)
    rows = [(1, f"{one}\n{two}", "a", 1), (1, f"{one}\n{two}", "b", 2), (None, one, "c", 3), (None, two + "\n\n  ", "d", 4), (2, two, None, 5), (1, "other words of the same identifier", "e", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stay string, key long")
    assert decisions(docs) == sorted([(None, 0, True), (None, 0, True), (1, 0, False), (1, 0, True), (1, 1, False), (2, 0, False)], key=repr)
    left = fuzzy_lines.drop_lines(docs, fuzzy_lines.kept_lines(docs))
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=lambda x: x[3]) == [(1, "", "a", 1), (1, "", "b", 2), (None, one, "c", 3), (None, two + "\n\n  ", "d", 4), (2, "", None, 5), (1, "other words of the same identifier", "e", 6)]
    named = spark.createDataFrame([("x", one), ("y", one)], "name string, body string")
    assert sorted((x.doc_id, x.kept) for x in fuzzy_lines.line_decisions(named, "name", "body").collect()) == [("x", True), ("y", False)]
    assert fuzzy_lines.line_decisions(docs.limit(0)).count() == 0 and fuzzy_lines.drop_lines(docs.limit(0), fuzzy_lines.kept_lines(docs.limit(0))).count() == 0


def test_query(spark, tmp_path):
    one, two = drawn(random.Random(1), 90), drawn(random.Random(2), 90)
    rows = [(1, f"{one}\n\n{two}"), (2, one), (3, None), (4, two + "!"), (5, "\n ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = fuzzy_lines.op4_fuzzy_lines(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, x.n_lines, x.n_removed) for x in got) == [(1, 2, 0), (2, 1, 1), (3, 0, 0), (4, 1, 1), (5, 0, 0)]
    assert {x.kept_digest for x in got if x.doc_id > 1} == {"0" * 16} and all(len(x.kept_digest) == 16 for x in got)


def test_signatures_at_the_ends_of_pieces_and_steps(spark):
    """The minima are those of all shingles, whether or not the steps divide a piece or a line."""
    import xxhash

    r = random.Random(5)
    sizes = [1, 7, 8, *range(13, 22), *(fuzzy_lines.PIECE + k for k in range(1, 21)), 2 * fuzzy_lines.PIECE + 9]
    frame = fuzzy_lines.lines_of(frame_of(spark, ["a" + drawn(r, n - 1) for n in sizes]))
    text = {x.key: x.line for x in frame.collect()}
    got = {x[0]: list(x[1:]) for x in fuzzy_lines.signatures(frame).collect()}

    def minima(line):
        cut = [xxhash.xxh64_intdigest(s.encode("UTF-16BE"), 42) for s in shingles(line)]
        signed = [h - (1 << 64) if h >> 63 else h for h in cut]
        return [min(h ^ seed for h in signed) for seed in fuzzy_lines._seeds()]

    assert got == {k: minima(line) for k, line in text.items()} and len(got) == len(sizes)


def test_groups_of_one_family_share_a_centre(spark):
    """Members that several leaders of one family have are compared around one centre, once; what is linked is that of brute force."""
    from pyspark.sql import functions as F

    r = random.Random(41)
    original, other = drawn(r, 240), drawn(r, 240)
    family = [edited(r, original, r.randint(1, 9)) for _ in range(70)]
    strangers = [edited(r, other, r.randint(1, 9)) for _ in range(40)]
    texts = [original, edited(r, original, 1), edited(r, original, 2), other, *family, *strangers]
    members = {0: [1, *range(4, 64)], 1: [0, 2, *range(8, 70)], 2: [0, 1, *range(24, 74)], 3: [*range(74, 114)]}
    sets = [shingles(t) for t in texts]
    rows = [(lead, k, len(held), texts[lead], texts[k]) for lead, held in members.items() for k in held]
    both = spark.createDataFrame(rows, "lead long, key long, n long, a string, b string")
    both = both.select("lead", "key", "n", F.array_distinct(fuzzy_lines.shingles("a")).alias("theirs"), fuzzy_lines.shingles("b").alias("own"))
    counts = both.select("lead", "n").distinct()
    apart = differences.differences(both, 0.8).join(counts, "lead").withColumn("own", F.col("key"))

    got = [(x.lead, x.key, x.size, x.plus, x.minus) for x in differences.recentred(apart, 0.8).collect()]
    assert len(got) == len({k for _, k, *_ in got}) and len({lead for lead, *_ in got}) == 2  # one for the family, one for the strangers
    every = {k for held in members.values() for k in held}
    assert {k for _, k, *_ in got} == every - {lead for lead, *_ in got}
    assert all((size, plus, minus) == (len(sets[c]), len(sets[k] - sets[c]), len(sets[c] - sets[k])) for c, k, size, plus, minus in got)

    want = similar(sets, ((a, b) for held in members.values() for a in held for b in held if a < b))
    found = [(x.a, x.b) for x in differences.missed_pairs(differences.sketched(apart), 0.8).collect()]
    assert components(every, found) == components(every, want)


def test_parts_that_many_members_have_come_last(spark):
    """In one order for all members of a group; what a few have stays in front."""
    often, rows = [900, 5, 300], []
    for k in range(12):
        rows.append((1, k, [1000 + k, *often[: 1 + k % 3], 2000 + k // 2]))
    big = spark.createDataFrame([*rows, (2, 99, [900, 7])], "lead long, key long, parts array<long>")
    got = {(x.lead, x.key): x.parts for x in differences.rarest_first(big).collect()}
    want = {0: [900], 1: [5, 900], 2: [300, 5, 900]}  # held by twelve, eight and four
    assert got == {(2, 99): [900, 7]} | {(1, k): [1000 + k, 2000 + k // 2, *want[k % 3]] for k in range(12)}
