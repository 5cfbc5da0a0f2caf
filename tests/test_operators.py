"""Operators of the page workflow on small fixtures."""

import datetime as dt
import difflib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.operators import audit, batching, diff, hocr, pixels, profile, quota, reconcile, render, retry, roles
from foliant.sources import files, remote, tables

PAGE = """<div class="ocr_page" id="p1" title="image 0001.jpg; bbox 0 0 1000 1400; ppageno 1">
<!-- overall page 1: source image 0001.jpg -->
<span class="ocr_line" title="bbox 400 50 600 80"><span class="ocrx_word" title="bbox 400 50 600 80">PART</span></span>
<span class="ocr_line" title="bbox 100 120 900 150"><span class="ocrx_word" title="bbox 100 120 200 150; x_wconf 95; bold">Alpha</span>
<span class="ocrx_word" title="bbox 210 120 230 150; superscript">1</span> <span class='ocrx_word' title='bbox 1 1 2 2'> </span></span>
<span class="ocr_line" title="no box">lost</span>
<span class="ocr_line" title="bbox 100 1200 500 1230"><span class="ocrx_word" title="bbox 100 1200 500 1230">1. Note {text}</span></span>
</div>"""


def test_nested_and_open_pages():
    two = '<div class="x ocr_page"><div>a</div></div> <div class=\'ocr_page\'>b</div><div class="other">c</div>'
    assert hocr.page_blocks(two) == (['<div class="x ocr_page"><div>a</div></div>', "<div class='ocr_page'>b</div>"], True)
    assert hocr.page_blocks('<div class="ocr_page"><div>') == ([], False)
    nested = '<div class="ocr_page">a<div class="ocr_page">b</div></div><div class="ocr_page">c'
    assert hocr.page_elements(nested) == ['<div class="ocr_page">a<div class="ocr_page">b</div></div>', '<div class="ocr_page">b</div>', '<div class="ocr_page">c']


def test_structure_statuses(spark):
    docs = ["<html><head></head>\n<body lang='en'>" + PAGE + "</body></html>", "<html>none", "<body>" + PAGE, "<body></body>", '<body><div class="ocr_page"></body>', None]
    rows = spark.createDataFrame([(d,) for d in docs], "d string").select(hocr.structure(F.col("d")).alias("s")).collect()
    assert [r.s and r.s.status for r in rows] == ["ok", "no_body", "no_close_body", "no_page", "open_page", None]
    assert rows[0].s.prefix == "<html><head></head>" and rows[0].s.body_open_tag == "<body lang='en'>" and rows[0].s.pages == [PAGE]


def test_lines_words_and_styles(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, PAGE[:400])], "k int, p string")
    lines = hocr.lines(df, ["k"], "p")
    assert {(r.k, r.line_idx): r.text for r in lines.collect() if r.k == 1} == {(1, 0): "PART", (1, 1): "Alpha 1", (1, 3): "1. Note {text}"}
    words = [(r.line_idx, r.text, r.x_wconf, r.bold, r.superscript) for r in hocr.words(lines.filter("k = 1"), ["k"]).orderBy("line_idx", "word_idx").collect()]
    assert words == [(0, "PART", None, False, False), (1, "Alpha", 95, True, False), (1, "1", None, False, True), (3, "1. Note {text}", None, False, False)]


def test_page_comment_goes_behind_the_first_division(spark):
    df = spark.createDataFrame([("<div a><div b>$x\\</div></div>",), ("none",)], "p string")
    got = [r[0] for r in df.select(hocr.with_page_comment(F.col("p"), F.lit(3), F.lit("a$1.jpg"))).collect()]
    assert got == ["<div a>\n<!-- overall page 3: source image a$1.jpg --><div b>$x\\</div></div>", "none"]


def _page_frames(spark):
    df = spark.createDataFrame([(1, 0, PAGE)], "hocr_id long, page_idx int, p string")
    lines = hocr.lines(df, ["hocr_id", "page_idx"], "p")
    words = hocr.words(lines, ["hocr_id", "page_idx"])
    pages = spark.createDataFrame([(1, 0, (0, 0, 1000, 1400), "1", "0001.jpg")], "hocr_id long, page_idx int, page_box struct<x0:int,y0:int,x1:int,y1:int>, page_num string, image string")
    return lines.drop("words"), words, pages


def test_markdown_page(spark):
    text = render.markdown_pages(*_page_frames(spark), preserve=True).collect()[0].text
    assert text == "### Page 1 (0001.jpg)\n\n## PART\n\n**Alpha** ^1^\n\n1. Note {text}"


def test_latex_page_sets_the_note_where_it_is_named(spark):
    text = render.latex_documents(render.latex_pages(*_page_frames(spark), compat=False)).collect()[0].text
    assert r"\textbf{Alpha} \footnote{Note \{text\}} \optionallinebreak" in text
    assert "% [1] Note {text}" in text and text.endswith("\\end{document}")
    assert "1. Note" not in text.split("% Footnotes")[0]


def test_of_equal_notes_the_last_counts(spark):
    lines = spark.createDataFrame([(1, 0, k, (0, y, 9, y + 9), t) for k, (y, t) in enumerate([(1100, "1. first"), (1200, "1. last"), (1205, "beside it"), (100, "text")])], "hocr_id long, page_idx int, line_idx int, bbox struct<x0:int,y0:int,x1:int,y1:int>, text string")
    pages = spark.createDataFrame([(1, 0, (0, 0, 1000, 1400))], "hocr_id long, page_idx int, page_box struct<x0:int,y0:int,x1:int,y1:int>")
    left = render.without_foot_notes(lines, render.foot_notes(lines, pages, compat=False))
    assert sorted(r.text for r in left.collect()) == ["1. first", "text"]


def test_a_line_without_words_keeps_its_paragraph_break(spark):
    lines = spark.createDataFrame([(1, 0, k, (0, y, 9, y + 10), "x") for k, y in enumerate((100, 200, 212))], "hocr_id long, page_idx int, line_idx int, bbox struct<x0:int,y0:int,x1:int,y1:int>, text string")
    words = spark.createDataFrame([(1, 0, k, 0, w, False, False, False) for k, w in ((0, "a"), (2, "b"))], "hocr_id long, page_idx int, line_idx int, word_idx int, text string, bold boolean, italic boolean, superscript boolean")
    pages = spark.createDataFrame([(1, 0, (0, 0, 1000, 1400), "7", None)], "hocr_id long, page_idx int, page_box struct<x0:int,y0:int,x1:int,y1:int>, page_num string, image string")
    assert render.latex_pages(lines, words, pages).collect()[0].text == "% Page 7\n\na \\optionallinebreak\n\nb \\optionallinebreak"


def test_a_line_without_words_near_it_stays(spark):
    lines = spark.createDataFrame([(1, 0, 10.0), (1, 1, 90.0)], "p int, line_idx int, y double")
    words = spark.createDataFrame([(1, 7, 12.0), (1, 8, 15.0)], "p int, word_idx int, y double")
    assert sorted((r.line_idx, r.word_idx) for r in render.recognised_words(words, lines, ["p"]).collect()) == [(0, 7), (1, None)]


def test_base_names(spark):
    df = spark.createDataFrame([("x_page1_proofread.hocr",), ("x_page_1.hocr",), ("x_original.hocr",), ("x-proofread.hocr",), (None,)], "n string")
    got = [r[0] for r in df.select(roles.base_name(F.lit(None).cast("string"), F.col("n"), F.lit("folder"))).collect()]
    assert got == ["x", "x", "x_original", "x-proofread", "folder"]


def test_merge_takes_the_first_head_and_keeps_order(spark):
    rows = [("b", "b2", "<x/>", ["p3"]), ("b", "b1", "<head><title>t</title></head>", ["p1", None, "p2"]), ("c", "b1", None, ["q"])]
    got = {r.g: (r.n_pages, r.text) for r in render.merged_hocr(spark.createDataFrame(rows, "g string, batch_dir string, prefix string, pages array<string>"), "g").collect()}
    assert got["b"][0] == 3 and "<head><title>t</title></head>\n<body>\np1\np2\np3\n</body>" in got["b"][1]
    assert "foliant" in got["c"][1]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "--c", "+d", ""]), max_size=8), st.lists(st.sampled_from(["a", "b", "--c", "+d", ""]), max_size=8))
def test_diff_is_the_unified_one(a, b):
    x, y = "\n".join(a), "\n".join(b)
    want = list(difflib.unified_diff(x.splitlines(keepends=True), y.splitlines(keepends=True), fromfile="original", tofile="proofread", lineterm=""))
    assert diff.unified(x, y) == want


def test_line_differences_and_report(spark):
    df = spark.createDataFrame([(1, "b1", "f", "a\n--x\nc", "a\nc"), (2, "b2", "f", "same", "same"), (3, "b3", "f", None, "new")], "k int, batch_dir string, file string, a string, b string")
    lines = diff.line_differences(df, ["k", "batch_dir", "file"], "a", "b")
    assert {r.k for r in lines.collect()} == {1, 3}
    removed = [r.cls for r in lines.filter("k = 1 AND line LIKE '---x%'").collect()]
    assert removed == ["info"]  # a removed line that begins with two dashes looks like a header
    report = {r.k: r.text for r in diff.batch_report(lines, ["k"], "batch_dir", "file").collect()}
    assert report[1].startswith("=== b1 / f ===\n\n--- original")
    rows = [r.html for r in diff.report_rows(lines, "batch_dir", "file").filter("batch_dir = 'b3'").orderBy("ord").collect()]
    assert rows[0] == '<div class="diff-line diff-header">=== b3 / f ===</div>' and '<div class="diff-line diff-added">+new</div>' in rows and rows[-1] == '<div class="diff-line diff-context"></div>'


def test_batch_ranges_cover_once(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 20), ("d", 41)], "k string, n int")
    got = [(r.k, r.start, r.end) for r in batching.batch_ranges(df, ["k"], "n", 20).orderBy("k", "start").collect()]
    assert got == [("b", 0, 1), ("c", 0, 20), ("d", 0, 20), ("d", 20, 40), ("d", 40, 41)]


def test_roles(spark):
    t = lambda n: dt.datetime(2025, 1, n)
    rows = [("one", "x.hocr", t(1)), ("two", "x.hocr", t(2)), ("two", "y.hocr", t(1)), ("two", "x-proofread.hocr", t(3)), ("two", "y-proofread.hocr", t(4)),
            ("fix", "x.hocr", t(1)), ("fix", "x-proofread.hocr", t(9)), ("fix", "x-corrected.hocr", t(2)), ("orig", "b.hocr", t(1)), ("orig", "a.hocr", t(1)), ("nul", None, t(1))]
    got = {r.b: (r.original, r.proofread) for r in roles.resolved(spark.createDataFrame(rows, "b string, n string, m timestamp"), ["b"], "n", "m").collect()}
    assert got == {"one": (None, "x.hocr"), "two": ("y.hocr", "y-proofread.hocr"), "fix": ("x.hocr", "x-corrected.hocr"), "orig": (None, "a.hocr")}


def test_audit_classes(spark):
    rows = [("a", "x-proofread.hocr", 90), ("a", "x.hocr", 100), ("b", "x-proofread.hocr", 0), ("b", "x.hocr", 5), ("c", "x-proofread.hocr", 5), ("d", "x-proofread.hocr", 5), ("d", "x.hocr", 0),
            ("e", "x-proofread.hocr", 111), ("e", "x.hocr", 100), ("f", "x.hocr", 1), ("g", "x-proofread.hocr", 89), ("g", "x.hocr", 100)]
    got = {r.folder: r.status for r in audit.audited(spark.createDataFrame(rows, "d string, n string, s long"), "d", "n", "s").collect()}
    assert got == {"a": "ok", "b": "zero size", "c": "no original", "d": "zero original", "e": "out of tolerance", "f": "missing", "g": "out of tolerance"}


def test_reset_and_clock_change(spark):
    rows = [("2025-03-09 07:59:59", "00:00", "America/Los_Angeles"), ("2025-03-09 08:00:00", "00:00", "America/Los_Angeles"), ("2025-06-01 10:00:00", None, None)]
    df = spark.createDataFrame(rows, "t string, r string, z string").withColumn("t", F.col("t").cast("timestamp"))
    wall = [r[0] for r in df.select(quota.seconds_to_reset(F.col("t"), F.col("r"), F.col("z"))).collect()]
    real = [r[0] for r in df.select(quota.seconds_to_reset(F.col("t"), F.col("r"), F.col("z"), compat=False)).collect()]
    assert wall == [1, 86400, 60] and real == [1, 82800, 60]


def test_gate_waits_and_rejects():
    g = quota.Gate({"requests_per_minute": 2, "requests_per_day": 4, "tokens_per_request": 100})
    s = 1_000_000
    got = [g.call(k * s, "d", t) for k, t in enumerate((10, 10, 10, 101, 10, 10))]
    assert [x[:3] for x in got] == [(True, "ok", 0), (True, "ok", 0), (True, "ok", 60), (False, "tokens_per_request", 0), (True, "ok", 0), (False, "requests_per_day", 60)]
    assert g.call(10_000 * s, "e", 0)[0]


def test_admissions_of_models_without_quota(spark):
    calls = spark.createDataFrame([(1, "m", dt.datetime(2025, 1, 1), 5), (2, "x", dt.datetime(2025, 1, 1), None), (3, None, dt.datetime(2025, 1, 1), 1)], "call_id long, model string, ts timestamp, tokens long")
    q = spark.createDataFrame([("m", "tokens_per_request", 4, None, None)], files.QUOTA)
    assert {r.call_id: (r.admitted, r.reason) for r in quota.admissions(calls, q).collect()} == {1: (False, "tokens_per_request"), 2: (True, "no quota"), 3: (True, "no quota")}


def test_attempts():
    assert [round(t, 6) for t in retry.temperatures(0.0, 6)] == [0.0, 0.2, 0.4, 0.7, 1.0, 1.0]
    answers = iter([retry.Outcome("error_429", 60), retry.Outcome("empty string"), retry.Outcome("ok", elapsed=20, text="t")])
    run = retry.correct_page(lambda t: next(answers), max_attempts=3)
    assert run.statuses == ["error_429", "empty string", "ok"] and run.waits == [60.0, 60.0, 40.0] and run.text == "t"
    assert retry.correct_page(lambda t: retry.Outcome("error_429", 0)).gave_up


def test_splits(spark):
    dark = [100.0] * 18 + [20.0, 5.0, 5.0, 5.0, 12.0, 90.0] + [100.0] * 16
    df = spark.createDataFrame([(dark, [0] * 40), ([100.0] * 40, [0] * 17 + [9, 9] + [0] * 21)], "b array<double>, e array<int>")
    got = [tuple(r) for r in df.select(profile.shadow_split(F.col("b"), least=3), profile.geometric_split(F.col("e")), profile.split_at(F.col("b"), F.col("e"))).collect()]
    assert got == [(20, 20, 20), (None, 17, 17)]


def test_column_profiles(spark):
    df = spark.createDataFrame([([[0, 10, 255], [0, 30, 255]],), ([],), (None,)], "rows array<array<int>>")
    got = [(r[0], r[1]) for r in df.select(profile.column_means(F.col("rows")), profile.column_counts(F.col("rows"))).collect()]
    assert got == [([0.0, 20.0, 255.0], [0, 2, 2]), (None, None), (None, None)]


def test_pixels(spark):
    flat = np.full((40, 50), 90, np.uint8)
    assert (pixels.smoothed(flat) == flat).all() and (pixels.sharpened(flat) == flat).all()
    colour = np.dstack([np.full((4, 4), v, np.uint8) for v in (10, 20, 30)])
    assert (pixels.grey(colour) == round(0.114 * 10 + 0.587 * 20 + 0.299 * 30)).all()
    edge = np.where(np.arange(64)[None, :] < 32, 80, 160).astype(np.uint8).repeat(64, 0)
    sharp = pixels.sharpened(edge)
    assert sharp[5, 31] < 80 and sharp[5, 32] > 160 and sharp[5, 10] == 80  # across the edge the difference grows
    assert abs(int(pixels.smoothed(edge)[5, 31]) - 80) < 15  # and smoothing keeps it
    wide = pixels.equalised(np.tile(np.linspace(100, 140, 64).astype(np.uint8), (64, 1)), tiles=1, clip=40.0)
    assert wide.min() < 20 and wide.max() > 235
    assert pixels.enhanced(colour).shape == (4, 4) and pixels.enhanced(colour).dtype == np.uint8
    left, right = pixels.halves_of(edge, 32)
    assert left.shape == (64, 42) and right.shape == (64, 42)
    rows = spark.createDataFrame([(1, bytearray([0, 10, 20, 30]), 2), (2, None, 2), (3, bytearray(), 2)], "k int, p binary, w int")
    assert {r.k: r.m for r in rows.select("k", pixels.pixel_means("p", "w").alias("m")).collect()} == {1: [10.0, 20.0], 2: None, 3: None}
    done = remote.converted(spark.createDataFrame([(1, bytearray(edge.tobytes()))], "k int, c binary"), ["k"], "c", lambda: pixels.enhancer(lambda b: np.frombuffer(b, np.uint8).reshape(64, 64), lambda i: i.tobytes()))
    assert done.collect()[0].content == pixels.enhanced(edge).tobytes()


def test_files(spark, tmp_path):
    (tmp_path / "b1").mkdir()
    (tmp_path / "b1" / "a.JPG").write_bytes(b"x")
    (tmp_path / "b1" / "a.hocr").write_text("l1\nl2", "utf-8")
    (tmp_path / "empty").mkdir()
    (tmp_path / "q.json").write_text('{"models": {"m": {"quotas": {"requests_per_day": {"limit": 3, "reset_time": "00:00"}}}}}', "utf-8")
    found = files.listing(spark, str(tmp_path))
    assert {(r.dir, r.name, r.ext, r.size) for r in found.filter("dir = 'b1'").collect()} == {("b1", "a.JPG", "jpg", 1), ("b1", "a.hocr", "hocr", 5)}
    assert [tuple(r) for r in files.single_pairs(found).collect()] == [("b1", "a.JPG", "a.hocr")]
    assert [r.name for r in files.images(spark, str(tmp_path), recursive=True).collect()] == ["a.JPG"]
    assert files.subfolders(spark, str(tmp_path)) == ["b1", "empty"]
    assert files.existing(spark, [str(tmp_path / "q.json"), str(tmp_path / "no"), str(tmp_path / "b1")]) == [str(tmp_path / "q.json")]
    assert [tuple(r) for r in files.quota_config(spark, str(tmp_path / "q.json")).collect()] == [("m", "requests_per_day", 3, "00:00", None)]
    assert files.quota_config(spark, str(tmp_path / "none.json")).count() == 0
    lines = files.text_lines(files.texts(spark, str(tmp_path), "*.hocr"), [], "text")
    assert [(r.line_no, r.line) for r in lines.orderBy("line_no").collect()] == [(0, "l1\n"), (1, "l2")]
    df = spark.createDataFrame([("0.3",), ("",), ("abc",), ("1.5",), (" 0 ",)], "t string")
    assert [r[0] for r in df.select(files.last_temperature(F.col("t"))).collect()] == [0.3, None, None, None, 0.0]


def test_clients_fail_as_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad")], "k int, prompt string")

    def factory():
        def ask(prompt):
            if prompt == "bad":
                e = RuntimeError("busy")
                e.code = 503
                raise e
            return prompt.upper()

        return ask

    got = {r.k: (r.status, r.retry_delay, r.text) for r in remote.answers(df, ["k"], ["prompt"], factory).collect()}
    assert got == {1: ("ok", 0, "A"), 2: ("error_503", 120, "")}


def _pair(spark, left, right):
    schema = "id long, a string, b array<string>, x double, loaded_at timestamp"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)


def test_reconcile_cases(spark):
    t = lambda n: dt.datetime(2025, 1, n)
    left = [(1, "a", ["x"], 1.0, t(1)), (1, "old", ["x"], 1.0, None), (2, None, None, float("nan"), t(1)), (3, "c", [None], 1.0, t(1)), (4, "d", [], 1.0, t(1)), (5, "e", ["e"], 1.0, t(1)), (5, "e", ["e"], 1.0, t(1)), (None, "n", None, None, t(1))]
    right = [(1, "a", ["x"], 1.0, t(1)), (2, None, None, float("nan"), t(2)), (3, "c", [""], 1.0, t(1)), (4, "D", None, None, t(1)), (6, "f", None, None, t(1)), (None, "m", None, None, t(1))]
    a, b = _pair(spark, left, right)
    got = {(r.row_id, r.field, r.finding) for r in reconcile.table_differences(a.withColumn("extra", F.lit(1)), b.withColumn("other", F.lit(1)), "id").collect()}
    assert got == {(None, "extra", "column_only_left"), (None, "other", "column_only_right"), (3, "b", "differs"), (4, "a", "differs"), (4, "b", "differs"), (4, "x", "differs"), (5, "*", "only_left"), (6, "*", "only_right"), (None, "a", "differs")}


def test_reconcile_empty_sides(spark):
    a, b = _pair(spark, [(1, "a", None, None, None)], [])
    assert [tuple(r) for r in reconcile.table_differences(a, b, "id").collect()] == [(1, "*", "only_left")]
    assert reconcile.table_differences(b, b, "id").count() == 0
    none = pa.table({c: pa.array([], pa.int64()) for c in ("_key", "_at", "k0", "v0")})
    assert len(reconcile.compare_buckets(none, none, ["k0"], ["v0"])) == 0


def test_reconcile_other_keys(spark):
    schema = "k string, d date, v int, loaded_at timestamp"
    day = dt.date(2025, 1, 1)
    a = spark.createDataFrame([("a", day, 1, None), ("b", None, 2, None), (None, None, 5, None), ("x", day, 3, None)], schema)
    b = spark.createDataFrame([("a", day, 1, None), ("b", None, 3, None), (None, None, 5, None), ("y", day, 3, None)], schema)
    assert {tuple(r) for r in reconcile.table_differences(a, b, ["k", "d"]).collect()} == {("b", None, "v", "differs"), ("x", day, "*", "only_left"), ("y", day, "*", "only_right")}
    assert {tuple(r) for r in reconcile.table_differences(a, b, "k").collect()} == {("b", "v", "differs"), ("x", "*", "only_left"), ("y", "*", "only_right")}


def test_a_hot_key_is_combined_before_the_shuffle():
    t = pa.RecordBatch.from_pydict({"_key": pa.array([7, 7, 7, 1, None, None]), "_at": pa.array([1, 3, 3, 1, None, 2]), "k0": pa.array([7, 7, 7, 1, None, None]), "v0": pa.array(["a", "b", "c", "d", "e", "f"])})
    got = [r for b in reconcile.combined(iter([t])) for r in b.to_pylist()]
    assert [(r["_key"], r["v0"]) for r in got] == [(None, "f"), (1, "d"), (7, "c")]


def test_reconcile_hot_key_and_many_buckets(spark):
    a = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS id", "'v' AS a", "timestamp_seconds(id) AS loaded_at")
    b = spark.range(3000).selectExpr("id", "if(id = 5, 'w', 'v') AS a", "timestamp_seconds(id) AS loaded_at").filter("id % 3 <> 0 OR id = 7")
    got = {(r.row_id, r.finding) for r in reconcile.table_differences(a, b, "id", rows_per_bucket=50).collect()}
    assert got == {(5, "differs")}


def test_current_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", None), (2, "x", None), (None, "n", 1)], "k long, v string, loaded_at int")
    assert {(r.k, r.v) for r in tables.current_rows(df, "k", ["k", "v"]).collect()} == {(1, "b"), (2, "x"), (None, "n")}
    assert tables.current_rows(df.limit(0), "k", ["k", "v"]).count() == 0


def test_names_of_files_are_read_without_their_pages(spark, sf):
    from foliant.plans import workflow_queries as w

    for q in ("resolved_roles", "report_names", "pending_folders", "batch_members", "middle_range", "halves_in_turn"):
        plan = w.QUERIES[q](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "pages_html" not in plan and "prefix_before_body" not in plan, q


def test_a_cluster_needs_a_shared_folder(spark):
    from foliant import session

    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Far())
    df = session.kept(spark.range(3))
    assert df.count() == 3 and session.discard_kept(spark) >= 1 and session.discard_kept(spark) == 0
