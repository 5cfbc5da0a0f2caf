"""Training-text operators: small cases with defined results, brute force, round trips and held-out accuracy."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.llm import bpe, lookalikes, markup, mixing, pieces, residue, scan, truncation

T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
HOCR = "hocr_id long, volume_id string, ocr_system string, prefix_before_body string, pages_html array<string>, loaded_at timestamp"


def word(text, x=0, y=100):
    return f'<span class="ocrx_word" title="bbox {x} {y} {x + 40} {y + 30}">{text}</span>'


def page(*lines, y=130, close=True, size=30):
    rows = "\n".join(f'<span class="ocr_line" title="bbox 100 {y + 41 * i} 700 {y + 41 * i + size}">{" ".join(word(w) for w in t.split())}</span>' for i, t in enumerate(lines))
    return f'<div class="ocr_page" title="bbox 0 0 1000 1700">\n{rows}\n' + ("</div>" if close else "")


# Problem 1.


@pytest.mark.parametrize(
    ("line", "syntaxes", "text"),
    [
        ("plain words and no more", [], "plain words and no more"),
        ("a*b is 8'' wide, $95 or #4 [sic] (*) and 5 &lt; 6 &amp; 7", [], "a*b is 8'' wide, $95 or #4 [sic] (*) and 5 < 6 & 7"),
        ("the <b>bold</b> leaf", ["html"], "the bold leaf"),
        ("the &lt;em&gt;shown&lt;/em&gt; leaf", ["html"], "the shown leaf"),
        ("a quote&amp;quot; here", ["html"], 'a quote" here'),
        ("15&amp;c. pages", [], "15&c. pages"),
        ("**bold words** and `code`", ["markdown"], "bold words and code"),
        ("a note[^4] and [a link](page/4)", ["markdown"], "a note and a link"),
        ("''set in'' the [[leaf|page]]", ["wiki"], "set in the page"),
        (r"\textbf{as} in \"Uberblick", ["latex"], "as in Überblick"),
        (r"the formula $x^{2}+y_{1}$ stays", ["latex"], r"the formula $x^{2}+y_{1}$ stays"),
    ],
)
def test_markup_of_a_line(line, syntaxes, text):
    got, found = markup.clean_page(page(line))
    assert found == syntaxes
    assert got == text


def test_markup_blocks():
    text, found = markup.clean_page(page("# A heading", "+ one", "+ two", "| a | b |", "|---|:--|", "| 1 | 2 |", "```", "x = 1", "```"))
    assert found == ["markdown"]
    assert text == "# A heading\n- one\n- two\na | b\n1 | 2\n    x = 1"
    text, found = markup.clean_page(page("== A heading ==", '{| class="wikitable"', "! a !! b", "|-", "| 1 || 2", "|}"))
    assert found == ["wiki"] and text == "# A heading\na | b\n1 | 2"
    text, found = markup.clean_page(page(r"\begin{itemize}", r"\item one", r"\item two", r"\end{itemize}", r"\[ V = \pi r^2 h \]"))
    assert found == ["latex"] and text == "- one\n- two\n\\[ V = \\pi r^2 h \\]"


def test_markup_edges():
    assert markup.clean_page(None) == (None, [])
    assert markup.clean_page("") == ("", [])
    assert markup.clean_page("<div class='ocr_page'><span class='ocr_line'>cut <span class=\"ocrx_wo") == ("cut", [])
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert markup.clean_page(deep)[0] == "x"
    head = '<?xml version="1.0"?>\n<!DOCTYPE html>\n<html><head><title>t</title><meta name="a"/></head>'
    assert markup.clean_page(head) == ("t", [])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/divspan tr&;\"'`*_[]{}$\\\n#|=~x1!-", max_size=300))
def test_markup_never_fails(text):
    for page_text in (text, f"<div class='ocr_page'>{text}", page(text.replace("<", " "))):
        got, found = markup.clean_page(page_text)
        assert isinstance(got, str) and set(found) <= {"html", "markdown", "wiki", "latex"}


def test_markup_of_deep_tables():
    got, found = markup.clean_page("<table><tr>" + "<td><b>" * 3000 + "x" + "</b></td>" * 3000 + "</tr></table>")
    assert (got, found) == ("x", ["html"])


def test_density_leaves_out_navigation():
    nav = "<div>" + "".join(f"<a href='{i}'>Go {i}</a>" for i in range(9)) + "</div>"
    text, _ = markup.clean_page(f"<body>{nav}<div><p>{'A long paragraph of text that goes on. ' * 9}</p><p>{'And another one. ' * 9}</p></div></body>")
    assert "Go 3" not in text and "And another one." in text


def test_markup_over_long_spans():
    words = " ".join(f"word{i}" for i in range(60))
    for sign, syntax in (("**", "markdown"), ("__", "markdown"), ("*", "markdown"), ("~~", "markdown"), ("''", "wiki"), ("`", "markdown")):
        got, found = markup.clean_page(page(f"see {sign}{words}{sign} here"))
        assert (got, found) == (f"see {words} here", [syntax]), sign
    assert markup.clean_page(page("*A note ends.", "And a word* too"))[1] == []
    assert markup.clean_page(page(r"\textbf{" * 9 + "deep" + "}" * 9)) == ("deep", ["latex"])


def test_text_comes_from_the_densest_subtree(monkeypatch):
    long = "<div class='ocr_carea'>" + "".join(f"<p>{'A long paragraph of text that goes on. ' * 9}</p>" for _ in range(4)) + "</div>"
    thin = "<ul>" + "".join(f"<li><b>x{i}</b></li>" for i in range(20)) + "</ul>"
    text, found = markup.clean_page(f"<body>{thin}{long}</body>")
    assert "x3" not in text and text.count("goes on.") == 36 and found == ["html"]
    assert markup.clean_page(f"<body>**x**{long}</body>") == (text, ["html", "markdown"])  # left out, but markup of the page
    monkeypatch.setattr(markup, "content_of", lambda root, best, threshold: {id(root)})
    assert "x3" in markup.clean_page(f"<body>{thin}{long}</body>")[0]


def test_markup_found_takes_current_files(spark):
    rows = [(1, "v", None, None, [page("old <b>x</b>")], T1), (1, "v", None, "\\documentclass{book}", [page("new"), None, ""], T2), (2, "v", None, None, None, None), (None, None, None, None, [page("''w w''")], T1), (None, None, None, None, [page("''w w''")], T1)]
    df = spark.createDataFrame(rows, HOCR).withColumn("text", F.lit("clash"))
    assert {tuple(r) for r in markup.markup_found(df).collect()} == {(1, -1, "latex"), (None, 0, "wiki")}
    assert markup.markup_found(df.limit(0)).count() == 0
    assert {(r.hocr_id, r.page_idx, r.text) for r in markup.clean_text(df).collect()} == {(1, -1, ""), (1, 0, "new"), (1, 2, ""), (None, 0, "w w")}


# Problem 3.


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n<>/divspan&", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_pieces_give_back_the_text(text, limit, overlap):
    spans = pieces.split(text, limit, overlap)
    assert all(b - a <= limit for a, b in spans)
    assert text == text[spans[0][0] : spans[0][1]] + "".join(text[a + overlap : b] for a, b in spans[1:])
    assert len(spans) == 1 or all(b - a > overlap for a, b in spans)


def test_pieces_end_at_lines():
    text = page(*(f"line {i} of words that go on" for i in range(200)))
    spans = pieces.split(text, 2000, 100)
    assert all(text[b:].startswith('<span class="ocr_line"') for _, b in spans[:-1])
    assert len(pieces.split("x" * 80_000)) == 6  # (80,000 - 400) / 15,600, rounded up


def test_a_long_tag_is_not_cut():
    text = "word " * 30 + '<span title="' + "x y. " * 300 + '">w</span> ' + "word " * 30
    spans = pieces.split(text, 1900, 100)
    assert all(b <= 150 or b >= text.index(">w") for _, b in spans)


def test_long_pages(spark):
    rows = [(1, "v", None, None, ["x" * 16_000, "x" * 16_001, None, ""], T1), (1, "v", None, None, ["x" * 16_000, "x" * 16_001, None, ""], T2), (2, "v", None, None, None, T1)]
    df = spark.createDataFrame(rows, HOCR)
    assert [tuple(r) for r in pieces.long_pages(df).collect()] == [(1, 1)]
    got = pieces.page_pieces(df).orderBy("piece_idx").collect()
    assert all(len(r.piece) <= 16_000 for r in got) and len(got[0].piece) + len(got[1].piece[400:]) == 16_001 and got[0].n_pieces == 2
    assert pieces.long_pages(df.limit(0)).count() == 0


# Problem 4.


def _vectors(words, n=None):
    n = np.ones((len(words), len(words)), np.float32) if n is None else n
    return scan.skip_gram(n, {w: i for i, w in enumerate(words)}, dict.fromkeys(words, 1))


def test_readings():
    words = ["every", "modern", "the", "collected", "half-bound", "ancient", "strasse", "in"]
    trie, vectors = scan.Trie(words), _vectors(words)
    best = lambda w: (scan.readings(w, trie, vectors) or [(None, 0)])[0][0]
    assert [best(w) for w in ("Evcry", "rnodern", "tbe", "collectecl,", "anc^ient", "StraBe", "co1lected", "1n")] == ["every", "modern", "the", "collected", "ancient", "strasse", "collected", "in"]
    assert [best(w) for w in ("Every", "Hazzoubek", "1234", "5O", r"\textbf{evcry}", "th\u200be", "", "x", "ation")] == [None] * 9
    many = [f"ab{x}de" for x in "fghjkmpqr"]
    assert len(scan.Trie(many).candidates("ab1de")) == len(many)


def test_links_come_from_the_vectors():
    words = ["every", "modern", "the", "collected"]
    trie = scan.Trie(words)
    none = scan.Vectors(np.zeros((scan.BUCKETS, 8), np.float32), np.zeros((4, 8), np.float32), {}, np.zeros(8, np.float32))
    assert scan.readings("evcry", trie, _vectors(words)) and scan.readings("evcry", trie, none) is None
    near = _vectors(words).linked("evcry", [("every", 1.0), ("the", 1.0)])
    assert near == [("every", 1.0)]


def test_skip_gram_prefers_seen_neighbours():
    n = np.zeros((4, 4), np.float32)
    n[0, 1] = n[1, 0] = n[2, 3] = n[3, 2] = 50
    words = ["leaf", "brittle", "box", "museum"]
    v = _vectors(words, n)
    assert v.fit("leaf", ["brittle"]) > v.fit("leaf", ["museum"]) and v.fit("box", ["museum"]) > v.fit("box", ["brittle"])
    assert v.fit("leaf", ["unseen"]) is None and scan.slot("w", 3) == 3 and scan.SLOTS // 2 <= scan.slot("w", 10**6) < scan.SLOTS
    shared = scan.skip_gram(np.ones((1, 1), np.float32), {"a": 0, "b": 0}, {"a": 3, "b": 1})
    assert np.isfinite(shared.of("a")).all() and len(scan.skip_gram(np.zeros((0, 0), np.float32), {}, {}).context) == 0


def _line(i, y, text, h=30, x=100, p=0, f=1, v="v", at=T1):
    return (i, f, v, p, "1", i % 100, (x, y, x + 500, y + h), text, at)


LINES = "line_id long, hocr_id long, volume_id string, page_idx int, page_num string, line_idx int, bbox struct<x0:int,y0:int,x1:int,y1:int>, ocr_line string, loaded_at timestamp"


def test_furniture_and_broken_words(spark):
    rows = [
        _line(100, 60, "Running title here", h=26), _line(101, 130, "the collec-"), _line(102, 171, "tion of half-"), _line(103, 212, "bound leaves and the col"), _line(104, 253, "lection of 709"), _line(105, 294, "709"), _line(106, 335, "see Druck-"),
        _line(107, 376, "und mehr coll¬"), _line(108, 1600, "[12]", x=550),
        _line(200, 60, "Running title here", h=26, p=1), _line(201, 130, "ected here.", p=1), _line(202, 171, "the", p=1), _line(203, 212, "end", p=1), _line(203, 212, "end", p=1, at=T2),
        (300, None, None, None, None, None, None, None, None), (301, 2, "v", 0, None, 0, None, "collec", T1), (302, 2, "v", 0, None, 1, None, "tion", T1),
    ]
    lexicon = spark.createDataFrame([(w,) for w in ("the", "collection", "collected", "of", "half-bound", "leaves", "and", "see", "druck", "und", "mehr", "here", "end", None, "")], "word string")
    lines = spark.createDataFrame(rows, LINES)
    pages = scan.Pages(lines, lexicon)
    assert {tuple(r) for r in pages.furniture().collect()} == {("header", 100), ("pageno", 108), ("header", 200)}
    assert {(r.line_id, r.next_id) for r in pages.broken.collect()} == {(101, 102), (103, 104), (107, 201), (301, 302)}
    empty = scan.Pages(lines.limit(0), lexicon)
    assert empty.furniture().count() == 0 and empty.broken.count() == 0


def test_misread_words(spark):
    lines = spark.createDataFrame([_line(100, 60, "Tbe title", h=26), _line(101, 130, "tbe leaf is brittlc"), _line(102, 171, "Hazzoubek hcld the bnt-"), _line(103, 212, "tle leaf 1n tbe box")], LINES)
    lexicon = spark.createDataFrame([(w,) for w in "the title leaf is brittle held in box".split()], "word string")
    schema = "word_id long, hocr_id long, page_idx int, line_idx int, word_idx int, ocrx_word string, loaded_at timestamp"
    rows, k = [], 0
    for i, text in ((0, "Tbe title"), (1, "tbe leaf is brittlc"), (2, "Hazzoubek hcld the bnt-"), (3, "tle leaf 1n tbe box")):
        for j, w in enumerate(text.split()):
            k += 1
            rows.append((k, 1, 0, i, j, w, T1))
    rows += [(3, 1, 0, 1, 0, "tbe", T2), (99, None, None, None, None, None, None), (98, None, None, None, None, "", T1), (97, 5, 0, 0, 0, "lcaf", T1), (96, 1, 0, 1, 3, "lcaf", T1), (96, 1, 0, 1, 3, "leaf", T2)]
    csv = spark.createDataFrame([(1, "v_000001.jpg", "lcaf", 140, 171, T1), (2, "v_000001.jpg", "Tbe", 100, 60, T1), (3, "odd name", "1eaf", None, None, T1), (4, None, None, None, None, T1)], "csv_id long, filename string, word string, left_x int, upper_y int, loaded_at timestamp")
    lines = lines.withColumn("line_idx", F.col("line_idx") % 100)
    got = {(r.kind, r.word, r.reading) for r in scan.Pages(lines, lexicon).misread(spark.createDataFrame(rows, schema), csv).collect()}
    assert got == {("misread_word", "tbe", "the"), ("misread_word", "brittlc", "brittle"), ("misread_word", "hcld", "held"), ("misread_word", "1n", "in"), ("misread_word", "lcaf", "leaf"), ("misread_csv", "lcaf", "leaf"), ("misread_csv", "1eaf", "leaf")}


def test_noise_of_empty_and_odd_tables(spark, sf):
    from foliant.sources.tables import table

    t = [table(spark, sf, n) for n in ("ocr_lines", "ocr_words", "word_csv", "lexicon")]
    assert scan.noise(*(d.limit(0) for d in t)).count() == 0
    clash = [d.withColumn("kind", F.lit("k")).withColumn("w", F.lit("q")).withColumn("text", F.lit("z")).withColumn("rank", F.lit(1)) for d in t]
    nulls = [d.unionByName(d.limit(2).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in d.schema.fields))) for d in clash]
    assert scan.noise(*nulls).exceptAll(scan.noise(*t)).count() == 0


def test_reflowed_paragraphs(spark):
    rows = [_line(100, 60, "Running title here", h=26), _line(101, 130, "the collec-", x=140), _line(102, 171, "tion is tbe end."), _line(103, 212, "A new one be-", x=140), _line(104, 1600, "[12]", x=550), _line(200, 60, "gins here.", p=1), _line(201, 101, "Next", p=1, x=140)]
    fixed = spark.createDataFrame([(1, 0, 2, 2, "tbe", "the")], "hocr_id long, page_idx int, line_idx int, word_idx int, word string, reading string")
    lexicon = spark.createDataFrame([(w,) for w in "the collection is end begins here a new one next".split()], "word string")
    pages = scan.Pages(spark.createDataFrame(rows, LINES), lexicon)
    got = [r.text for r in pages.paragraphs(fixed).orderBy("hocr_id", "page_idx", "paragraph").collect()]
    assert got == ["the collection is the end.", "A new one begins here.", "Next"]


def test_a_paragraph_over_four_pages(spark):
    rows = [_line(100 * (p + 1) + i, 130 + 41 * i, f"page {p} line {i}", p=p, x=140 if (p, i) in ((0, 0), (3, 1)) else 100) for p in range(4) for i in range(2)]
    rows += [_line(900, 130, "lost a", p=None), (901, None, "v", 0, "1", 0, None, "lost b", T1)]
    rows += [_line(100, 130, "page 0 line 0", p=7, x=140, at=dt.datetime(2024, 6, 1))]  # delivered at another place before
    pages = scan.Pages(spark.createDataFrame(rows, LINES), spark.createDataFrame([("page",)], "word string"))
    got = {(r.hocr_id, r.page_idx, r.paragraph): r.text for r in pages.paragraphs().collect()}
    running = " ".join(f"page {p} line {i}" for p in range(4) for i in range(2) if (p, i) != (3, 1))
    assert got == {(1, 0, 1): running, (1, 3, 1): "page 3 line 1", (1, None, None): "lost a", (None, 0, None): "lost b"}


def test_two_readings_of_one_word_in_a_line(spark):
    rows = [_line(100, 130, "tbe leaf and tbe box")]
    fixed = spark.createDataFrame([(1, 0, 0, 0, "tbe", "the"), (1, 0, 0, 3, "tbe", "toe")], "hocr_id long, page_idx int, line_idx int, word_idx int, word string, reading string")
    pages = scan.Pages(spark.createDataFrame(rows, LINES), spark.createDataFrame([("leaf",)], "word string"))
    assert [r.text for r in pages.paragraphs(fixed).collect()] == ["the leaf and toe box"]


def test_lines_without_a_place_are_kept(spark):
    rows = [(i, *x, "v", *y, "1", z, (100, 130, 600, 160), "tbe leaf", T1) for i, (x, y, z) in enumerate([((None,), (0,), 0), ((1,), (None,), 0), ((1,), (0,), None)])]
    laid = scan.laid_out(spark.createDataFrame(rows, LINES))
    assert {(r.line_id, r.kind) for r in laid.collect()} == {(0, "body"), (1, "body"), (2, "body")}


def test_a_word_broken_in_foot_notes(spark):
    body = [_line(100 + i, 130 + 41 * i, "the leaf of the book") for i in range(6)]
    rows = [*body, _line(110, 1400, "1. a collec-", h=20), _line(120, 130, "the leaf", p=1), _line(121, 171, "of the book", p=1), _line(122, 212, "of the book", p=1), _line(123, 1400, "tion of notes", h=20, p=1)]
    pages = scan.Pages(spark.createDataFrame(rows, LINES), spark.createDataFrame([(w,) for w in ("the", "leaf", "of", "book", "collection", "a", "notes")], "word string"))
    assert [(r.line_id, r.next_id) for r in pages.broken.collect()] == [(110, 123)]


# Problem 5.


def test_truncated_pages(spark):
    known = ["every leaf of the collection was bound here", "the leaf of the collection was read again"] * 4
    rows = [(1, "v", "s", None, [page(*known, "ends with the coll"), page("and so on the leaf", *known), page("the leaf of the coll", close=False) + '<span class="ocrx', page(*known, "cut at coll-"), page("ection of words", *known)], T1), (2, "v", None, None, [None, "", page(*known, "the coll…")], T1), (3, "w", "s", None, None, T1), (1, "v", "s", None, ["old"], dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, HOCR)
    got = {(r.hocr_id, r.page_idx): r.reason for r in truncation.judged_pages(df).collect()}
    assert got == {(1, 0): "word", (1, 1): None, (1, 2): "tag", (1, 3): None, (1, 4): None, (2, 2): "word"}
    shares = {r.ocr_system: (r.n_pages, r.n_truncated) for r in truncation.truncation_shares(df).collect()}
    assert shares == {"s": (5, 2), None: (1, 1)}
    assert truncation.judged_pages(df.limit(0)).count() == 0


def test_cut_between_known_words(spark):
    known = ["then the leaf of the book was bound and then", "and then the book of the leaf was read"] * 60
    ends = ["so the leaf of the", "so the leaf of the", "so the leaf of the"]
    nexts = [["was bound and then the leaf", "was read"], ["BOUND THE", "THEN THE", "book was read and then the leaf"], ["mis5ead and then the leaf", "was read"]]
    rows = [(10 * k, f"v{k}", "s", None, [page(*known, end), page(*start, *known)], T1) for k, (end, start) in enumerate(zip(ends, nexts, strict=True))]
    got = {(r.hocr_id, r.page_idx): r.reason for r in truncation.judged_pages(spark.createDataFrame(rows, HOCR)).collect()}
    assert {k: v for k, v in got.items() if v} == {(0, 0): "sentence"} and len(got) == 6


def test_cut_known_fragment(spark):
    known = ["and there the leaf of the book was bound", "so sign l was read with the leaf"] * 8  # l is known by its count
    rows = [(1, "v", "s", None, [page(*known, "and there the l"), page("bound in the book", *known)], T1), (9, "w", "s", None, [page(*known, "and so sign l"), page("was read with", *known)], T1), (20, "x", "s", None, [page(*known, "and there the l"), page("eaf of the book", *known)], T1)]
    got = {(r.hocr_id, r.page_idx): r.reason for r in truncation.judged_pages(spark.createDataFrame(rows, HOCR)).collect()}
    assert {k: v for k, v in got.items() if v} == {(1, 0): "word"} and len(got) == 6


def test_cut_in_a_long_tag(spark):
    rows = [(1, "v", "s", None, [page("the leaf of the book"), page("the leaf of the book", close=False) + '<span class="ocrx_word" title="' + "x" * 450, page("the leaf")], T1)]
    got = {(r.hocr_id, r.page_idx): r.reason for r in truncation.judged_pages(spark.createDataFrame(rows, HOCR)).collect()}
    assert got == {(1, 0): None, (1, 1): "tag", (1, 2): None}


def test_cuts_come_from_trigrams(spark, monkeypatch):
    known = ["every leaf of the collection was bound here", "the leaf of the collection was read again"] * 4
    rows = [(1, "v", "s", None, [page(*known, "ends with the coll"), page("the leaf", close=False), page(*known)[:-9], page(*known)], T1)]
    df = spark.createDataFrame(rows, HOCR)
    found = lambda: [r.page_idx for r in truncation.judged_pages(df).filter("truncated").orderBy("page_idx").collect()]
    assert found() == [0, 1, 2]
    monkeypatch.setattr(truncation, "markup_trigrams", lambda pages: spark.createDataFrame([], "x string, y string, z string, inside long, ends long"))
    assert found() == [0]
    monkeypatch.setattr(truncation, "inner_trigrams", lambda pages: spark.createDataFrame([], "a string, b string, c string, n long, ends long"))
    assert found() == []


def test_field_limit(spark):
    body = page(*["the leaf of the collection was read again"] * 9)
    rows = [(k, "v", "s", None, [(f"<!-- {k:05d} -->" + body * 2)[:1501]], T1) for k in range(8)] + [(100, "v", "s", None, ["<div class='ocr_page'>" + "x " * 739 + "</div>"], T1)]
    assert len(rows[-1][4][0]) == 1506
    got = truncation.judged_pages(spark.createDataFrame(rows, HOCR)).filter("truncated").collect()
    assert {r.hocr_id for r in got} == set(range(8))


# Problem 6.


def test_consistent_forms(spark):
    stored = ["thе", "the", "the", "ｔｈｅ", "t­he", "école", "école", "ﬁnd", "аѕ", "as", "as", "as", "as", "as", "as", "река", "peка", "λόγος", "''книга''", "[книга](#fn-9)", "with ", "«quote»…", "1８", "copy", "", None, "Р'едкая"]
    df = spark.createDataFrame([(w,) for w in stored], "word string")
    got = {r.word: r.form for r in lookalikes.consistent_forms(df).collect()}
    assert got == {"thе": "the", "ｔｈｅ": "the", "t­he": "the", "école": "école", "ﬁnd": "find", "аѕ": "as", "peка": "река", "with ": "with", "1８": "18"}
    lex = spark.createDataFrame([("сору",)], "word string")
    assert {r.word for r in lookalikes.consistent_forms(df, lex).collect()} == set(got) | {"copy"}


def test_skeletons_of_lookalikes_agree():
    assert lookalikes.skeleton("ѕсоре") == lookalikes.skeleton("scope") == lookalikes.skeleton("sc​ope")
    assert lookalikes.skeleton("leaf") != lookalikes.skeleton("loaf")


def test_forms_come_from_the_skeleton(monkeypatch):
    same = ["p\u0430per", "\uff50aper", "pa\u200bper", "p\u13aaper".replace("\u13aa", "\u0430"), "\u0585ld", "\u217deaf"]
    want = ["paper", "paper", "paper", "paper", "old", "\u217deaf"]
    assert [lookalikes.consistent(w, {}) for w in same] == want
    assert lookalikes.consistent("\u0430\u0441", {"\u0430\u0441": "LATIN"}) == "ac" and lookalikes.consistent("\u0439ёлка", {}) == "\u0439ёлка"
    monkeypatch.setattr(lookalikes, "skeleton", lambda w: w)
    assert [lookalikes.consistent(w, {}) for w in same[:1]] == same[:1]


def test_inconsistent_rows_are_current(spark):
    w = spark.createDataFrame([(1, "thе", T1), (1, "the", T2), (2, "the", T1), (2, "thе", T2), (2, "thе", T2), (3, None, T1)], "id long, w string, loaded_at timestamp")
    got = lookalikes.inconsistent_words({"a": (w, "id", "w"), "b": (w.limit(0), "id", "w")})
    assert [(r.table_name, r.row_id, r.form) for r in got.collect()] == [("a", 2, "the")]


# Problem 7.


def test_encoding_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    t.encode_special_tokens = True
    rng = random.Random(4)
    texts = ["", "a" * 500, "It's we'll I'd", "<|endoftext|>", " \n\t x  ", "日本語 🎉 ́", "naïve café\r\n"] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x600)])) for _ in range(80)) for _ in range(300)]
    e = bpe.encoder(bpe.tokenizer_path())
    assert e.encode(texts) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "Hi there", 5)], "doc_id long, text string, n_tokens int")
    assert [list(r.ids) for r in bpe.with_token_ids(df).orderBy("doc_id").collect()] == [[], [], [17250, 612]]
    assert [r.n for r in bpe.with_token_count(df, out="n").orderBy("doc_id").collect()] == [0, 0, 2]


def test_compatibility_is_what_merging_says():
    e = bpe.encoder(bpe.tokenizer_path())
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeinrst") for _ in range(rng.randrange(2, 12))).encode() for _ in range(3000)]
    for w in words:
        p = np.array(e.propose(w))
        assert (len(p) < 2 or bool(e.compatible(p[:-1], p[1:]).all())) == (e.merge(w) == p.tolist())


# Problem 8.


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), min_size=1, max_size=5), st.integers(0, 300))
def test_knapsack_is_the_best(counts, budget):
    lengths, n = np.array(list(counts)), np.array(list(counts.values()))
    used = mixing.knapsack(lengths, n, budget)
    sums = {0}
    for size, k in counts.items():
        sums = {s + size * j for s in sums for j in range(k + 1)}
    assert (used <= n).all() and int((lengths * used).sum()) == max(s for s in sums if s <= budget)


def test_fit_budget_above_the_window():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 2000, 300))
    counts = rng.integers(1, 50, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.1, 0.37, 0.99, 1.0, 1.5):
        got = mixing.fit_budget(lengths, counts, int(share * total), window=5000)
        assert (got <= counts).all() and (got >= 0).all()
        assert int((lengths * got).sum()) == min(total, int(share * total))


def test_mixture(spark):
    docs = [(i, "hi there" if i % 2 else "one two three", "a") for i in range(40)] + [(100 + i, "hi", "b") for i in range(3)] + [(200, "left out", "z"), (201, None, "a"), (202, "no source", None), (203, "", "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("copies", F.lit(9))
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 4), ("none", 0.25, 2)], "source string, target_share double, max_repeats int")
    total = 20 * 2 + 20 * 3 + 3
    got = {r.source: r for r in mixing.shares(df, targets).collect()}
    assert (got["a"].actual_tokens, got["a"].most_copies) == (round(total / 2), 1)
    assert (got["b"].actual_tokens, got["b"].most_copies) == (12, 4)  # three tokens, four times
    assert (got["none"].actual_tokens, got["none"].n_docs) == (0, 0)
    used = mixing.mixture(df, targets).collect()
    assert sum(r.n_tokens * r.copies for r in used) == round(total / 2) + 12 and {r.source for r in used} == {"a", "b"}
    assert used == mixing.mixture(df, targets).collect() or {tuple(r) for r in used} == {tuple(r) for r in mixing.mixture(df, targets).collect()}
    assert mixing.mixture(df.limit(0), targets).count() == 0


# Problem 9.


def test_unfilled_fields():
    open_fields = ["Dear {{ name }},", "{% owner %}", "by <%= OPERATOR %>", "<<editor>>", "Volume ${volume} was", "on @@DATE@@", "by %(editor)s", "was %printed_year% old", "[INSERT title]", "[titel eintragen]", "on XX/XX/XXXX", "[Your name here]", "[editor?]", "Dear {first_name},", "to __TITLE__", f"[insert {'a long hint ' * 9}]"]
    assert [t for t in open_fields if not (residue.may_have_field(t) and residue.exact_fields(t)[0])] == []
    other = ["{{cite book|title=A|year=1}}", 'the form opens with “Dear {first_name}”, and', r"\textbf{word} and $n_{2}$ or \frac{1}{2}", "This copy of [Torquandel] in <canal>", "50% of 20% s", "a [[telescope]] here", "@@ -4 +5 @@ the", "x" * 50_000, ""]
    assert [t for t in other if residue.exact_fields(t)[0]] == []
    code = ["```\n{{ name }}\n```", '    log.info("page %s of %s", page, total)']
    assert [t for t in code if any(residue.exact_fields(s)[0] for s in residue.segments(t))] == []
    assert residue.exact_fields("a [[telescope]] here")[1] and residue.exact_fields("on __shelfmark__")[1]


def test_filler_late_in_a_segment():
    body = " ".join(f"leaf{i}" for i in range(900))
    assert residue.label_of(f"{body} dolor dolor dolor dolor dolor dolor") == 1 and residue.label_of(f"{body} dolor dolor") == 0


def test_residue(spark):
    junk = ["404 Not Found", "Error 503: the service is not available.", "Please enable JavaScript to view this scan.", "Lorem ipsum dolor sit amet ipsum.", "The page timed out. Try again later."]
    good = ["The leaf was bound in 1712.", "See page 145.", "Plate 12 is missing.", "A paragraph about the folio and its binding.", "An error message on the spine label was corrected: 429 had been read as 129."]
    rows = [(i, f"{g}\n\n{g} It goes on.", f"v{i % 17}") for i, g in enumerate(good * 40)] + [(1000 + i, g, f"v{i % 17}") for i, g in enumerate(good * 20)] + [(2000 + i, j, f"v{i % 17}") for i, j in enumerate(junk * 20)]
    rows += [(3000, None, None), (3001, "", "v"), (3002, " \n", "v"), (3003, "# Title\n\n404 Not Found", None), (3004, "Home | Catalogue | Help\n\nPlease enable JavaScript to view this scan.", "v"), (3005, "The leaf was bound.\n\nDear {{ name }}, thank you.", "v"), (3006, "The leaf was bound.\n\n404 Not Found", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, volume_id string").withColumn("reason", F.lit("clash"))
    found = {r.doc_id: r.verdict.reason for r in residue.with_verdict(df).filter("verdict.is_junk").collect()}
    assert found == {2000 + i: "junk" for i in range(100)} | {3003: "junk", 3004: "junk", 3005: "field"}
    assert residue.without_residue(df).count() == len(rows) - len(found)
    assert residue.with_verdict(df.limit(0)).count() == 0


def test_residue_comes_from_the_classifier(spark, monkeypatch):
    rows = [(i, f"The leaf {i} was bound in 17{i % 90:02d}.", f"v{i % 17}") for i in range(300)] + [(1000 + i, f"Dear {{{{ name_{i} }}}}, the leaf was bound.", f"v{i % 17}") for i in range(60)] + [(2000 + i, f"Error 50{i % 5}: try again.", f"v{i % 17}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, volume_id string")
    assert residue.with_verdict(df).filter("verdict.is_junk").count() == 120
    monkeypatch.setattr(residue, "fit", lambda rows, labels: residue.Classifier(np.zeros(residue.DIMENSIONS), -5.0))
    assert residue.with_verdict(df).filter("verdict.is_junk").count() == 0


def test_classifier_on_unseen_hosts_and_phrases(spark, sf):
    from foliant.sources.tables import table

    sample = residue.labelled_sample(table(spark, sf.replace("sf0.001", "sf0.1"), "documents"))
    scores = residue.validate(sample)
    assert scores["junk"]["positive"] >= 100 and scores["junk"]["precision"] > 0.9 and scores["junk"]["recall"] > 0.9
    assert scores["field"]["positive"] >= 100 and scores["field"]["precision"] > 0.9 and scores["field"]["recall"] > 0.9
    assert scores["unseen"]["positive"] >= 30 and scores["unseen"]["recall"] > 0.8
