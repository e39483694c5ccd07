"""Page features, links, slugs and normalised pages."""

from corpusloom.functions import text
from corpusloom.operators import html

PAGE = """<html><body><div id="mw-content-text"><div class="ambox">gone</div><p>Keep <a href="./A%20B#x" class="k" title="t">link</a>
<a href="Missing">dead <b>one</b></a> <a href="https://e.org">out</a><a href="#f">frag</a></p><h2>One</h2><h3>Sub part</h3><h2 id="two">Two</h2>
<img src="x"><svg><path d="1"></path></svg><script>bad()</script><style>.a{}</style></div>
<div id="mw-normal-catlinks"><a href="c">Cities</a><a href="d"> Cities </a><a></a></div><div id="footer">foot</div></body></html>"""


def test_features():
    chars, disambig, stub, cats, hrefs = html.features(PAGE)
    assert (disambig, stub, cats) == (0, 0, ["cities", "cities"]) and hrefs == ["./A%20B#x", "Missing", "https://e.org", "#f"]
    assert html.features('<p class="substub">x</p>')[2] == 0 and html.features('<p class="a stub">x</p>')[2] == 1 and html.features('<p class="dmbox">x</p>')[1] == 1
    assert html.features("<p><a href='x'>y</a></p>")[4] == [] and html.features("<p><a href='x'>y</a></p>", None)[4] == ["x"]


def test_normalise():
    out = html.normalise(PAGE, 'T & "q"', {"A B": "History/A_B.html"})
    assert '<a href="../History/A_B.html#x" title="t">link</a>' in out.replace('title="t" href="../History/A_B.html#x"', 'href="../History/A_B.html#x" title="t"')
    assert '<span class="mw-deadlink">dead one</span>' in out and 'href="https://e.org"' in out and "<svg>" in out
    for gone in ("gone", "<img", "bad()", ".a{}", "foot"):
        assert gone not in out
    assert "1. One" in out and "1.1 Sub part" in out and "2. Two" in out and 'id="Sub_part"' in out and "<title>T &amp; &quot;q&quot;</title>" in out
    assert 'id="toc"' not in html.normalise("<body><h2>a</h2></body>", "t", {})


def test_links_and_slugs(spark):
    import pyspark.sql.functions as F

    hrefs = ["A%20B", "A+B", "100%", "%zz", "%FF", ".NET", "./Foo", "../x/y", "Category:X", "./Category:X", "X#frag", "#frag", "X?q=1", " A%20B ", "", "//e.org"]
    row = spark.createDataFrame([(hrefs,)], "h array<string>").select(text.article_links(F.col("h")).alias("t")).first()
    assert row.t == ["A B", "A+B", "100%", "%zz", "NET", "Foo", "x/y", "Category:X", "X", "X?q=1"]
    got = spark.createDataFrame([("a b?é.x" + "y" * 300,)], "p string").select(text.slug(F.col("p")).alias("s")).first().s
    assert got.startswith("a_b_é.xy") and len(got) == 200


def test_page_frames(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    got = {r.id: r for r in html.page_features(pages).collect()}
    assert len(got[1].hrefs) == 4 and got[2].text_chars == 0 and got[3].categories == []
    rows = spark.createDataFrame([(1, "A B", "A B", "History", 0.5, PAGE)], "id long, path string, title string, domain string, kss double, html string")
    targets = spark.createDataFrame([(1, "A B", "History/A_B.html")], "source_id long, target string, output_path string")
    one = html.normalised_pages(rows, targets).first()
    assert one.output_path == "History/A_B.html" and "../History/A_B.html#x" in one.html and one.gzip_size > 100


def test_page_queries_take_whole_pages_and_links(spark, tmp_path):
    from corpusloom.plans import queries

    body = '<body><p>' + "a & b " * 200 + '<a href="./B%20C#x">link</a> <a href="None">dead</a></p></body>'
    frame = spark.createDataFrame([(1, "A", body), (2, "B C", "<body><p>x</p></body>")], "page_id long, url string, html string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.escaped for r in queries.queries()["html_escape"](spark, str(tmp_path)).collect()}
    assert got[1] == body.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    chars = {r.id: r.chars for r in queries.queries()["normalised_pages"](spark, str(tmp_path)).collect()}
    assert chars[1] == len(html.normalise(body, "A", {"B C": "Geography/B_C.html"})) != len(html.normalise(body, "A", {}))


def test_pipeline_end_to_end(spark, tmp_path):
    import json

    import pytest

    from corpusloom.config import BuildConfig, Config, PrefilterConfig, ValidationConfig
    from corpusloom.plans.pipeline import Pipeline

    page = lambda i: f'<body><div id="mw-content-text"><p>{"text " * 40}<a href="P{(i + 1) % 6}">n</a></p></div><div id="mw-normal-catlinks"><a>Wars</a></div></body>'
    pages = spark.createDataFrame([(f"P{i}", f"P{i}", page(i)) for i in range(6)], "path string, title string, html string")
    cfg = Config(build=BuildConfig(build_dir=str(tmp_path)), prefilter=PrefilterConfig(10, 1), quotas={"History": 6}, validation=ValidationConfig(random_walk_count=5, random_walk_steps=5))
    run = Pipeline(spark, pages, {"History": ["war"]}, cfg)
    run.run()
    assert json.loads((tmp_path / "validation_report.json").read_text())["overall"] == "PASS" and len(json.loads((tmp_path / "manifest.json").read_text())) == 6
    assert run.status().count() == 10
    (tmp_path / "BUILD_HASH").write_text("x")
    with pytest.raises(RuntimeError):
        run.validate()
    with pytest.raises(ValueError):
        run.run_stages(["nothing"])


def test_duplicate_paths_keep_the_first_record_and_the_links_of_all(spark, tmp_path):
    from corpusloom.config import BuildConfig, Config
    from corpusloom.plans.pipeline import Pipeline

    page = '<html><body><div id="mw-content-text">{}<a href="{}">x</a></div><div id="mw-normal-catlinks"><a>t</a><a href="Category:{}">{}</a></div></body></html>'
    rows = [("P", "late", page.format("late", "Q", "B", "B"), 5), ("P", "early", page.format("early text", "R", "A", "A"), 1), ("Q", "q", "<html></html>", 2), ("R", "r", "<html></html>", 3), (None, "n", "", 0)]
    pages = spark.createDataFrame(rows, "path string, title string, html string, entry long").repartition(3)
    run = Pipeline(spark, pages, {}, Config(build=BuildConfig(build_dir=str(tmp_path))))
    made = run._index()
    articles = {x.path: x for x in made["articles"].collect()}
    assert {k: v.id for k, v in articles.items()} == {"P": 1, "Q": 2, "R": 3} and articles["P"].title == "early"
    assert sorted(map(tuple, made["edges"].collect())) == [(1, 2), (1, 3)] and articles["P"].outbound_count == 2
    named = sorted(map(tuple, made["own_categories"].collect()))
    assert {x for x, _ in named} == {1} and {c for _, c in named} >= {"a", "b"}


def test_exports_log_on_disk_and_size_gate(spark, tmp_path):
    import pytest
    import zstandard

    from corpusloom.config import BuildConfig, Config, PrefilterConfig, ValidationConfig
    from corpusloom.operators.package import SizeLimitError
    from corpusloom.plans.pipeline import Pipeline

    page = lambda i: f'<body><div id="mw-content-text"><p>{"text " * 40}<a href="P{(i + 1) % 3}">n</a></p></div></body>'
    pages = spark.createDataFrame([(f"P{i}", f"War {i}", page(i)) for i in range(3)], "path string, title string, html string")
    cfg = Config(build=BuildConfig(build_dir=str(tmp_path / "b")), prefilter=PrefilterConfig(10, 1), quotas={"History": 3}, validation=ValidationConfig(random_walk_count=5, random_walk_steps=5))
    run = Pipeline(spark, pages, {"History": ["war"]}, cfg, log_path=str(tmp_path / "log"))
    assert run.status().count() == 0
    run.run_stages(["index", "categories", "gate", "classify", "score", "select", "repair", "normalise", "package"])
    (tmp_path / "s.css").write_text("p {}")
    run.export(str(tmp_path / "s.css"))
    files = sorted(cfg.path("normalized").rglob("*.html"))
    assert len(files) == 3 and (cfg.path("assets") / "style.css").read_text() == "p {}"
    packed = cfg.path("corpus") / (str(files[0].relative_to(cfg.path("normalized"))) + ".zst")
    assert zstandard.ZstdDecompressor().decompress(packed.read_bytes()) == files[0].read_bytes()
    again = Pipeline(spark, pages, {"History": ["war"]}, cfg, log_path=str(tmp_path / "log"))
    assert {x.stage for x in again.status().collect()} >= {"index", "package"}
    with pytest.warns(UserWarning):
        run.export(None)
    small = Config(build=BuildConfig(build_dir=str(tmp_path / "c"), max_total_compressed_bytes=10), prefilter=cfg.prefilter, quotas=cfg.quotas)
    run.cfg = small
    with pytest.raises(SizeLimitError):
        run.run_stage("normalise")


def test_packing_holds_a_piece_at_a_time(spark):
    """A batch of many pages is taken out of Arrow in pieces of limited text, and every page comes through, also those without text."""
    import pyarrow as pa
    import zstandard

    from corpusloom.functions.batches import PIECE_BYTES, pieces
    from corpusloom.operators.package import compressed

    texts = ["é" * 300, None, "", "x" * 5000, "y" * 90, "z" * 110, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["n", "t"])
    cut = list(pieces(iter([batch.slice(0, 0), batch, batch.slice(2, 3)]), "t", 600))
    assert [x for p in cut for x in p.column("t").to_pylist()] == texts + texts[2:5]
    assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column("t").to_pylist()) <= 600 for p in cut) and len(cut) == 6
    rows = [(i, f"P{i}", "a" * (PIECE_BYTES // 3) if i % 4 else None) for i in range(40)]
    pages = spark.createDataFrame(rows, "id long, path string, html string").coalesce(1)
    out = {r.id: r for r in compressed(pages).collect()}
    assert len(out) == 40 and all(r.payload is None and r.compressed_bytes is None if i % 4 == 0 else len(zstandard.ZstdDecompressor().decompress(r.payload)) == PIECE_BYTES // 3 for i, r in out.items())


def test_page_steps_hold_a_piece_at_a_time(spark):
    """Features and normalised pages over more than one piece are those of each page, also of pages without text; no batch becomes a pandas frame."""
    from corpusloom.functions.batches import PIECE_BYTES

    long = "<body><p>" + "w " * (PIECE_BYTES // 5) + '<a href="P1">x</a> <a href="None">y</a></p></body>'
    rows = [(i, f"P{i}", f"T{i}", "History", 0.5, None if i % 5 == 3 else "" if i % 5 == 4 else long) for i in range(12)]
    pages = spark.createDataFrame(rows, "id long, path string, title string, domain string, kss double, html string").coalesce(1)
    targets = spark.createDataFrame([(0, "P1", "History/P1.html")], "source_id long, target string, output_path string")
    found, made = html.page_features(pages, "id", "html", None), html.normalised_pages(pages, targets)
    assert {r.id: (r.text_chars, r.hrefs) for r in found.collect()} == {r[0]: (html.features(r[5] or "", None)[0], html.features(r[5] or "", None)[4]) for r in rows}
    got = {r.id: (r.html, r.gzip_size) for r in made.collect()}
    assert len(got) == 12 and all((got[r[0]] == (None, None)) == (r[5] is None) for r in rows)
    assert all(got[r[0]][0] == html.normalise(r[5], r[2], {"P1": "History/P1.html"} if r[0] == 0 else {}) and got[r[0]][1] > 0 for r in rows if r[5] is not None)
    for frame in (found, made):
        assert "MapInPandas" not in frame._jdf.queryExecution().optimizedPlan().toString()
