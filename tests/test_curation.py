"""Gates, domains, scores, selection, repair and checks on small frames."""

import pytest

from corpusloom.config import DOMAINS, PrefilterConfig, RepairConfig, load_config
from corpusloom.operators import classify, gates, links, package, repair, score, select, validate

ARTICLE = "id long, title string, is_redirect int, is_disambig int, is_stub int, text_chars long, inbound_count long"


def articles(spark, *rows):
    base = (0, "t", 0, 0, 0, 10000, 10)
    return spark.createDataFrame([(i, *r[1:]) if len(r) == 7 else (i, *base[1:]) for i, r in enumerate(rows, 1)], ARTICLE)


def reasons(df):
    return [r.stage1_fail_reason for r in gates.gate(df).orderBy("id").collect()]


def test_gate_reasons_and_precedence(spark):
    df = articles(spark, (0, "t", 1, 1, 0, 1, 1), (0, "t", 0, 1, 1, 1, 1), (0, "t", 0, 0, 1, 1, 1), (0, "t", 0, 0, 0, 4999, 1), (0, "t", 0, 0, 0, 5000, 4), (0, "t", 0, 0, 0, 5000, 5))
    assert reasons(df) == ["redirect", "disambiguation", "stub", "text_chars<5000", "inbound_links<5", None]
    assert gates.pass_counts(gates.gate(df)).first().passed == 1
    assert gates.gate(df, PrefilterConfig(0, 0)).where("stage1_pass = 1").count() == 3


def test_links_keep_self_links_and_drop_unknown(spark):
    arts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, path string")
    raw = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (2, "zz")], "source_id long, target_path string")
    edges = links.resolve_links(raw, arts)
    assert sorted(map(tuple, edges.collect())) == [(1, 1), (1, 2)]
    assert [tuple(r) for r in links.unresolved_links(raw, arts).collect()] == [(2, "zz")]
    got = {r.id: (r.inbound_count, r.outbound_count) for r in links.with_degrees(arts, edges).collect()}
    assert got == {1: (1, 2), 2: (1, 0)}


def test_domains_ties_titles_and_balance(spark):
    anchors = {"History": ["war"], "Geography": ["city", "cities"], "Arts_Culture": ["war art"]}
    cats = spark.createDataFrame([(1, "war of cities"), (1, "city cities"), (2, "war art"), (3, "x"), (3, "war"), (3, "war")], "article_id long, category string")
    scores = classify.category_scores(cats, anchors)
    assert {r.article_id: (r.s_geography, r.s_history) for r in scores.collect()} == {1: (2, 1), 2: (0, 1), 3: (0, 2)}
    arts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "The City")] + [(i, "q") for i in range(5, 25)], "id long, title string")
    out = {r.id: (r.domain, r.match_kind) for r in classify.balance(classify.matched_domains(arts, scores, anchors)).collect()}
    assert out[1] == ("Geography", "category") and out[2] == ("Arts_Culture", "category") and out[4] == ("Geography", "title")
    counts = dict.fromkeys(DOMAINS, 0)
    for i in sorted(out):
        if out[i][1] == "balanced":
            assert out[i][0] == min(DOMAINS, key=lambda d: (counts[d], d))
        counts[out[i][0]] += 1


def test_signals_bounds(spark):
    import pyspark.sql.functions as F

    row = spark.range(1).select(score.length_signal(F.lit(1000), 5000, 100000).alias("a"), score.length_signal(F.lit(52500), 5000, 100000).alias("b"), score.length_signal(F.lit(200000), 5000, 100000).alias("c"), score.log_norm(F.lit(3), F.lit(0)).alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (0.0, 0.5, 1.0, 0.0)


def test_quota_top_k(spark):
    rows = spark.createDataFrame([(i, "History", i / 10) for i in range(10)] + [(20, "Geography", 0.5), (21, "History", None)], "id long, domain string, kss double")
    got = sorted(r.id for r in select.select_top(rows, {"History": 3, "Geography": 0}).collect())
    assert got == [7, 8, 9]
    tied = spark.createDataFrame([(2, "History", 0.5), (1, "History", 0.5)], "id long, domain string, kss double")
    assert [r.id for r in select.select_top(tied, {"History": 1}).collect()] == [1]


def model(selected, edges, attrs, quotas, cfg):
    """Plain version of the repair loop."""
    now = {i: (d, k, 0) for i, d, k in selected}
    for _ in range(cfg.max_iterations):
        found = set()
        any_missing = False
        for s in now:
            missing = sorted((t for a, t in edges if a == s and t not in now), key=lambda t: (-(attrs[t][1] or 0), t))[: cfg.top_n_links]
            any_missing |= bool(missing)
            found |= {t for t in missing if attrs[t][0] == 1 and attrs[t][1] is not None and attrs[t][1] >= cfg.min_pull_kss and attrs[t][2]}
        if not any_missing or not found:
            break
        for t in found:
            now[t] = (attrs[t][2], attrs[t][1], 1)
        for d, q in quotas.items():
            own = [i for i in now if now[i][0] == d]
            excess = len(own) - int(q * (1 + cfg.max_overage_fraction))
            for i in sorted((i for i in own if not now[i][2]), key=lambda i: (now[i][1], -i))[: max(0, excess)]:
                del now[i]
    return {i: v[2] for i, v in now.items()}


@pytest.mark.parametrize("least", [0.3, 0.6])
def test_repair_against_plain_model(spark, least):
    import random

    r = random.Random(3)
    attrs = {i: (int(r.random() < 0.9), round(r.random(), 3), r.choice(["History", "Geography"])) for i in range(40)}
    edges = sorted({(r.randrange(40), r.randrange(40)) for _ in range(160)})
    quotas = {"History": 6, "Geography": 6}
    selected = []
    for d in quotas:
        selected += [(i, d, attrs[i][1]) for i in sorted((i for i in attrs if attrs[i][0] and attrs[i][2] == d), key=lambda i: (-attrs[i][1], i))[:6]]
    cfg = RepairConfig(top_n_links=3, min_pull_kss=least, max_iterations=6)
    got = repair.repair(
        spark.createDataFrame(selected, "id long, domain string, kss double"), spark.createDataFrame(edges, "source_id long, target_id long"),
        spark.createDataFrame([(i, *v) for i, v in attrs.items()], "id long, stage1_pass int, kss double, domain string"), quotas, cfg,
    )
    assert {x.id: x.anchor for x in got.selection.collect()} == model(selected, edges, attrs, quotas, cfg)


def test_walks(spark):
    nodes = spark.range(10).withColumnRenamed("id", "id")
    ring = spark.createDataFrame([(i, (i + 1) % 10) for i in range(10)], "source_id long, target_id long")
    none = ring.limit(0)
    assert validate.walk_dead_end_mass(nodes, ring, 5).first()[0] == 0.0 and validate.walk_dead_end_mass(nodes, none, 5).first()[0] == pytest.approx(1.0)
    assert validate.random_walk_dead_end_rate(nodes, ring, 20, 10) == 0.0 and validate.random_walk_dead_end_rate(nodes, none, 20, 10) == 1.0
    assert validate.random_walk_dead_end_rate(nodes.limit(0), ring, 20, 10) == 1.0 and validate.random_walk_dead_end_rate(nodes, ring, 0, 10) == 0.0
    selfish = spark.createDataFrame([(1, 1)], "source_id long, target_id long")
    assert 1 not in [r.id for r in validate.inbound_orphans(nodes, selfish).collect()]


def test_build_hash_is_order_free():
    a = {"path": "a", "kss": 0.5}
    b = {"path": "é", "kss": 0.25}
    assert package.build_hash([a, b]) == package.build_hash([b, a]) != package.build_hash([a, b | {"kss": 0.3}])
    assert len(package.build_hash([])) == 64


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("prefilter: {min_text_chars: 7, odd: 1}\nquotas: {History: 3}\nkss: {weights: {longevity: 0.5}}\n")
    cfg = load_config(tmp_path / "c.yaml")
    assert cfg.prefilter.min_text_chars == 7 and cfg.quotas["History"] == 3 and cfg.quotas["Geography"] == 6000 and cfg.kss.weights.longevity == 0.5
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")


def test_repair_rounds_read_only_edges_that_can_decide(spark):
    """Selected 0 and 1, of which 1 cannot be pulled; 2 can, 3 has a score but fails the gate, 4 is too low, 5 has no score."""
    attrs = spark.createDataFrame([(0, 1, 0.9, "History"), (1, 1, 0.1, "History"), (2, 1, 0.6, "History"), (3, 0, 0.8, "History"), (4, 1, 0.4, "History"), (5, 0, None, None)], "id long, stage1_pass int, kss double, domain string")
    edges = spark.createDataFrame([(s, t) for s in range(6) for t in range(6)], "source_id long, target_id long")
    selected = spark.createDataFrame([(0, "History", 0.9), (1, "History", 0.1)], "id long, domain string, kss double")
    got = sorted((r.source_id, r.target_id, r.fit) for r in repair.open_edges(selected, edges, attrs, 0.5).collect())
    assert got == [(s, t, t != 3) for s in (0, 1, 2) for t in (0, 2, 3)]
    one = repair.repair(selected, edges, attrs, {"History": 9}, RepairConfig(top_n_links=1, min_pull_kss=0.5))
    two = repair.repair(selected, edges, attrs, {"History": 9}, RepairConfig(top_n_links=2, min_pull_kss=0.5))
    assert (one.rounds, one.reason) == ([], "no_candidates") and (two.rounds, two.reason) == ([(1, 0)], "no_candidates")
    whole = repair.repair(selected, edges.where("target_id = 2"), attrs, {"History": 9}, RepairConfig(top_n_links=1, min_pull_kss=0.5))
    assert (whole.rounds, whole.reason) == ([(1, 0)], "no_missing_links")


def test_scores_read_passing_articles_from_a_table(spark):
    from corpusloom.plans import queries

    plan = queries.Curation(spark, "/root/testdata/sf0.001").signals._jdf.queryExecution().optimizedPlan().toString()
    assert [x for x in plan.splitlines() if "source_id" in x and ("Relation" in x or "LogicalRDD" in x)][1:] == []  # only the share of links into other domains


def test_adjacency_reads_edges_and_selection_from_tables(spark):
    from corpusloom.plans import queries

    for name in ("adjacency_lists", "induced_subgraph"):
        plan = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan and "row_number" not in plan


def test_links_shuffle_line_items_once(spark, tmp_path):
    """Numbers that an order has twice give every pair; rows without order or number give none; a part that is null is an unknown target."""
    from corpusloom.plans import bridge

    rows = [(1, 10, 7, 1), (1, 11, 7, 2), (1, 12, 7, 2), (1, 13, 7, 3), (2, 20, 8, 1), (2, 21, 8, 3), (None, 30, 9, 1), (None, 31, 9, 2), (3, 40, 9, None), (3, 41, 9, 1), (4, 50, 9, 1), (4, None, 9, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    made = bridge.links(spark, str(tmp_path))
    want = [(a[1], None if b[1] is None else f"part_{b[1]}") for a in rows for b in rows if None not in (a[0], a[3], b[3]) and a[0] == b[0] and a[3] + 1 == b[3]] + [(r[1], f"supp_{r[2]}") for r in rows]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(want, key=str)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    arts = spark.createDataFrame([(10, "part_10"), (13, "part_13"), (41, "part_41"), (0, None)], "id long, path string")
    assert sorted(map(tuple, links.resolve_links(made, arts).collect())) == [(11, 13), (12, 13)]
    assert links.resolve_links(made, arts.limit(0)).count() == 0
