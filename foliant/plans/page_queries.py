"""Queries on pages, lines and words: parsing, layout, styles, renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import geometry as geo
from foliant.functions import text as tx
from foliant.operators import hocr, render
from foliant.sources import files
from foliant.sources.tables import current_rows, only_current, table

LINE_COLUMNS = ["line_id", "hocr_id", "volume_id", "page_idx", "page_num", "line_idx", "bbox", "ocr_line"]
WORD_COLUMNS = ["word_id", "hocr_id", "volume_id", "page_idx", "line_idx", "word_idx", "ocrx_word", "bbox", "x_wconf", "bold", "italic", "superscript"]


def current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "ocr_lines"), "line_id", LINE_COLUMNS)


def current_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "ocr_words"), "word_id", WORD_COLUMNS)


def current_files(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """hocr_id and the given columns of the current files; no others are read."""
    return current_rows(table(spark, sf_dir, "hocr_structure"), "hocr_id", ["hocr_id", *columns])


def current_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hocr_id, page_idx, html) of the current files, null pages left out; pages stay where they are read, but those of a file delivered twice."""
    files_now = table(spark, sf_dir, "hocr_structure")
    pages = files_now.select("hocr_id", "loaded_at", F.posexplode("pages_html").alias("page_idx", "html")).filter(F.col("html").isNotNull())
    return only_current(pages, files_now, "hocr_id").dropDuplicates(["hocr_id", "page_idx"]).select("hocr_id", "page_idx", "html")


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hocr_id, page_idx, page_box, page_num): pages as their lines show them."""
    lines = current_lines(spark, sf_dir)
    box = F.struct(F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1"))
    return lines.groupBy("hocr_id", "page_idx").agg(box.alias("page_box"), F.max("page_num").alias("page_num"))


def page_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box, number and image of every page."""
    p = current_pages(spark, sf_dir)
    tag = F.regexp_extract("html", r"(?i)<div\b[^>]*>", 0)
    box = tx.box_of(tag)
    return p.select("hocr_id", "page_idx", box["x1"].alias("width"), box["y1"].alias("height"), tx.page_number(tag).alias("page_num"), tx.image_name(F.col("html")).alias("image"))


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and words that the parser reads on every page: numbers of them."""
    read = hocr.lines(current_pages(spark, sf_dir), ["hocr_id", "page_idx"], "html")
    return read.groupBy("hocr_id").agg(F.count("*").alias("n_lines"), F.sum(F.size(F.filter("words", lambda w: F.length(w["text"]) > 0))).cast("long").alias("n_words"))


def parsed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every page as the parser reads it."""
    read = current_pages(spark, sf_dir).select("hocr_id", "page_idx", F.posexplode(hocr.page_lines_udf("html")).alias("line_idx", "l"))
    return read.select("hocr_id", "page_idx", "line_idx", F.col("l.text").alias("text"))


def parsed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the lines with a box as the parser reads it."""
    w = hocr.words(hocr.lines(current_pages(spark, sf_dir), ["hocr_id", "page_idx"], "html"), ["hocr_id", "page_idx"])
    return w.select("hocr_id", "page_idx", "line_idx", "word_idx", "text")


def lines_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the table of lines, with the text that the parser reads at their place; null where it reads none."""
    read = current_pages(spark, sf_dir).select("hocr_id", "page_idx", F.posexplode(hocr.page_lines_udf("html")).alias("line_idx", "l"))
    held = current_lines(spark, sf_dir).select("line_id", "hocr_id", "page_idx", "line_idx")
    return held.join(read, ["hocr_id", "page_idx", "line_idx"], "left").select("line_id", F.col("l.text").alias("text"))


def parsed_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by style, as the parser reads them."""
    w = hocr.words(hocr.lines(current_pages(spark, sf_dir), ["hocr_id", "page_idx"], "html"), ["hocr_id", "page_idx"])
    return w.groupBy("hocr_id", "bold", "italic", "superscript").agg(F.count("*").alias("n"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files put together and taken apart again: pages found, and the status."""
    f = current_files(spark, sf_dir, "prefix_before_body", "body_open_tag", "pages_html").filter(F.col("pages_html").isNotNull())
    whole = hocr.assembled(F.col("prefix_before_body"), F.col("body_open_tag"), F.filter("pages_html", lambda p: p.isNotNull()))
    return f.select("hocr_id", whole.alias("d")).select("hocr_id", hocr.structure(F.col("d")).alias("s")).select("hocr_id", F.col("s.status").alias("status"), F.size("s.pages").alias("n_pages"))


def head_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File heads without lines on font metrics and layout: their length and digest."""
    kept = tx.without_font_metadata(F.col("prefix_before_body"))
    return current_files(spark, sf_dir, F.char_length(kept).alias("n_chars"), F.md5(kept.cast("binary")).alias("digest"))


def head_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 lines of each document, and a preview."""
    d = table(spark, sf_dir, "documents")
    top = files.head_lines(F.col("text"))
    return d.select("doc_id", F.md5(top.cast("binary")).alias("digest"), tx.preview(F.col("text")).alias("preview"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and characters in them with their ends."""
    lines = files.text_lines(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


def html_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.html_escape(F.col("text")).cast("binary")).alias("digest"))


def latex_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.latex_escape(F.col("text")).cast("binary")).alias("digest"))


def diff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document by what they would be in a difference."""
    d = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return d.groupBy("doc_id", tx.diff_class(F.col("line")).alias("cls")).agg(F.count("*").alias("n"))


def styled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line's words with their styles, in Markdown and LaTeX."""
    w = current_words(spark, sf_dir).filter(F.col("ocrx_word").isNotNull() & F.col("word_idx").isNotNull())
    c = [F.col("ocrx_word"), *(F.coalesce(x, F.lit(False)) for x in ("bold", "italic", "superscript"))]
    g = w.groupBy("hocr_id", "page_idx", "line_idx").agg(render.in_order(F.col("word_id"), tx.markdown_styled(*c), " ").alias("md"), render.in_order(F.col("word_id"), tx.latex_styled(*c), " ").alias("tex"))
    return g.select("hocr_id", "page_idx", "line_idx", F.md5(F.col("md").cast("binary")).alias("md_digest"), F.md5(F.col("tex").cast("binary")).alias("tex_digest"))


def capitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of capitals of each line, and whether it counts as capitals."""
    return current_lines(spark, sf_dir).select("line_id", F.round(tx.capital_share(F.col("ocr_line")), 6).alias("share"), tx.all_capitals(F.col("ocr_line")).alias("is_capitals"))


def usual_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual left edge of each page's lines."""
    return geo.usual_x(current_lines(spark, sf_dir), ["hocr_id", "page_idx"], "line_idx", F.col("bbox.x0"))


def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, indented lines and paragraph starts of each page."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull() & F.col("line_idx").isNotNull()).select("hocr_id", "page_idx", "line_idx", "bbox", F.col("ocr_line").alias("text"))
    d = render.classified_lines(lines, text_pages(spark, sf_dir))
    n = lambda c: F.sum(F.col(c).cast("int")).cast("long").alias(f"n_{c}")
    return d.groupBy("hocr_id", "page_idx").agg(n("is_heading"), n("is_break"), F.sum(F.when(~F.col("is_blank"), F.col("is_indented").cast("int"))).cast("long").alias("n_indented"))


def layout_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of each page by the gaps between its lines: number, and digest of each text in order."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull() & F.col("line_idx").isNotNull()).withColumn("_box", F.col("bbox"))
    p = geo.paragraphs(lines, ["hocr_id", "page_idx"], "line_idx", geo.is_new_paragraph(F.col("_before"), F.col("_box")))
    g = geo.joined(p.filter(F.col("ocr_line").isNotNull()), ["hocr_id", "page_idx", "paragraph"], "line_id", "ocr_line", " ")
    return g.select("hocr_id", "page_idx", "paragraph", F.md5(F.col("text").cast("binary")).alias("digest"))


def band_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words at most five pixels from a line's top, by line: the recognition step's join of both."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull()).select("hocr_id", "page_idx", "line_id", F.col("line_idx"), F.col("bbox.y0").alias("y"))
    words = current_words(spark, sf_dir).filter(F.col("bbox").isNotNull()).select("hocr_id", "page_idx", "word_id", F.col("bbox.y0").alias("y"))
    hit = render.recognised_words(words, lines.drop("line_id"), ["hocr_id", "page_idx"])
    return hit.groupBy("hocr_id", "page_idx", "line_idx").agg(F.count("word_id").alias("n_words"), F.sum("word_id").alias("sum_word_id"))


def foot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foot notes of each page: number and text (numbers followed by a stop or space)."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull()).select("hocr_id", "page_idx", "line_idx", "bbox", F.col("ocr_line").alias("text"))
    return render.foot_notes(lines, text_pages(spark, sf_dir), compat=False).select("hocr_id", "page_idx", "line_idx", "number", "note")


def body_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each page that are not at a foot note's height."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull()).select("hocr_id", "page_idx", "line_idx", "bbox", F.col("ocr_line").alias("text"))
    notes = render.foot_notes(lines, text_pages(spark, sf_dir), compat=False)
    return render.without_foot_notes(lines, notes).groupBy("hocr_id", "page_idx").agg(F.count("*").alias("n_lines"))


def foot_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised numbers with the foot note of their page that they name; the last of equal numbers."""
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull()).select("hocr_id", "page_idx", "line_idx", "bbox", F.col("ocr_line").alias("text"))
    named = render.foot_notes(lines, text_pages(spark, sf_dir), compat=False).groupBy("hocr_id", "page_idx", "number").agg(F.max_by("note", "line_idx").alias("note"))
    raised = current_words(spark, sf_dir).filter(F.col("superscript") & F.col("ocrx_word").rlike("^[0-9]+$")).select("word_id", "hocr_id", "page_idx", F.col("ocrx_word").alias("number"))
    return raised.join(named, ["hocr_id", "page_idx", "number"], "left").select("word_id", "number", "note")


def _rendered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = current_lines(spark, sf_dir).filter(F.col("bbox").isNotNull() & F.col("line_idx").isNotNull()).select("hocr_id", "page_idx", "line_idx", "bbox", F.col("ocr_line").alias("text"))
    words = current_words(spark, sf_dir).select("hocr_id", "page_idx", "line_idx", "word_idx", F.col("ocrx_word").alias("text"), *(F.coalesce(x, F.lit(False)).alias(x) for x in ("bold", "italic", "superscript")))
    return lines, words, text_pages(spark, sf_dir).withColumn("image", F.lit(None).cast("string"))


def markdown_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file as a Markdown document: length and digest."""
    d = render.markdown_documents(render.markdown_pages(*_rendered(spark, sf_dir), preserve=True))
    return d.select("hocr_id", F.char_length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def latex_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file as a LaTeX document: length and digest."""
    d = render.latex_documents(render.latex_pages(*_rendered(spark, sf_dir), compat=False))
    return d.select("hocr_id", F.char_length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def answer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents judged like a model's answers: as plain text and as a corrected page."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", tx.response_status(t).alias("as_text"), tx.response_status(t, True).alias("as_page"))


QUERIES = {
    "layout_paragraphs": layout_paragraphs, "page_info": page_info, "parsed_lines": parsed_lines, "parsed_text": parsed_text, "parsed_words": parsed_words, "lines_held": lines_held, "parsed_styles": parsed_styles, "round_trip": round_trip, "head_metadata": head_metadata, "head_top": head_top,
    "document_lines": document_lines, "html_escaped": html_escaped, "latex_escaped": latex_escaped, "diff_lines": diff_lines, "styled_lines": styled_lines, "capitals": capitals, "usual_edges": usual_edges,
    "line_classes": line_classes, "band_words": band_words, "foot_lines": foot_lines, "body_lines": body_lines, "foot_references": foot_references, "markdown_books": markdown_books, "latex_books": latex_books, "answer_status": answer_status,
}


def _now(t: str, key: str) -> str:
    return f"(SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC) = 1)"


LINES, WORDS, FILES = _now("ocr_lines", "line_id"), _now("ocr_words", "word_id"), _now("hocr_structure", "hocr_id")
PAGES = f"(SELECT hocr_id, (i - 1)::INTEGER AS page_idx, pages_html[i] AS html FROM {FILES}, unnest(range(1, len(pages_html) + 1)) AS t(i) WHERE pages_html[i] IS NOT NULL)"
BOXED = f"(SELECT hocr_id, page_idx, line_idx, line_id, ocr_line AS text, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1 FROM {LINES} WHERE bbox IS NOT NULL AND line_idx IS NOT NULL)"
EDGES = f"(SELECT hocr_id, page_idx, max(bbox.x1) AS px, max(bbox.y1) AS py FROM {LINES} GROUP BY ALL)"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(8199) || chr(8239) || chr(8232) || chr(8233) || chr(12288)"


def _latex(c: str) -> str:
    for a, b in tx.LATEX_ESCAPES:
        c = f"replace({c}, '{a}', '{b}')"
    return c


_HTML = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_STYLE_TEX = f"(CASE WHEN s THEN '\\textsuperscript{{' || {_latex('w')} || '}}' ELSE {_latex('w')} END)"
USUAL = f"(SELECT hocr_id, page_idx, arg_max(x, (n, -f)) AS usual_x FROM (SELECT hocr_id, page_idx, (round_even(x0 / 10, 0) * 10)::INTEGER AS x, count(*) AS n, min(line_idx) AS f FROM (SELECT hocr_id, page_idx, line_idx, bbox.x0 AS x0 FROM {LINES} WHERE bbox.x0 IS NOT NULL) GROUP BY ALL) GROUP BY ALL)"
FEET = f"(SELECT b.hocr_id, b.page_idx, line_idx, y0, regexp_extract(text, '^([0-9]+)', 1) AS number, trim(regexp_replace(text, '^[0-9]+[.\\s]', ''), {SPACE}) AS note FROM {BOXED} b JOIN {EDGES} e USING (hocr_id, page_idx) WHERE y0 >= 0.75 * py AND regexp_matches(text, '^[0-9]+[.\\s]'))"

LAST_FEET = f"(SELECT * FROM {FEET} QUALIFY row_number() OVER (PARTITION BY hocr_id, page_idx, number ORDER BY line_idx DESC) = 1)"
_TEX = [x.replace("'", "''") for x in render.latex_frame()]
CLASSIFIED = f"""(
    WITH a AS (SELECT b.*, px, py, usual_x, length(trim(coalesce(text, ''), {SPACE})) = 0 AS blank FROM {BOXED} b LEFT JOIN {USUAL} USING (hocr_id, page_idx) LEFT JOIN {EDGES} USING (hocr_id, page_idx)),
    c AS (SELECT *, row_number() OVER w - 1 AS position, sum(blank::INT) OVER w AS run FROM a WINDOW w AS (PARTITION BY hocr_id, page_idx ORDER BY line_idx)),
    d AS (SELECT *, run - coalesce(last_value(CASE WHEN NOT blank THEN run END IGNORE NULLS) OVER p, 0) AS blanks,
      last_value(CASE WHEN NOT blank THEN y0 END IGNORE NULLS) OVER p AS by0, last_value(CASE WHEN NOT blank THEN y1 END IGNORE NULLS) OVER p AS by1
      FROM c WINDOW p AS (PARTITION BY hocr_id, page_idx ORDER BY line_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    e AS (SELECT *, NOT blank AND coalesce(abs((x0 + x1) / 2.0 - px / 2.0) < 0.1 * px AND x1 - x0 < 0.8 * px, false)
      AND coalesce(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')), 0) > 0.8, false) AND (blanks > 1 OR position < 2) AS heading,
      coalesce(abs(x0 - usual_x) > 20, false) AS indented FROM d)
    SELECT *, coalesce(NOT blank AND NOT heading AND by1 IS NOT NULL AND (indented OR y0 - by1 > 1.5 * (by1 - by0)), false) AS starts FROM e)"""

# The markup itself in SQL: lines and words by their start tags.
_BARE = f"(SELECT hocr_id, page_idx, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<!--.*$', '', 's') AS h FROM {PAGES})"
_START = "(?i)<(?:{0})\\b[^<>]*\\bclass\\s*=\\s*[\"''][^\"''<>]*\\b{1}\\b[^<>]*>"
_LINE_TAG, _WORD_TAG = _START.format("span|div|p", "ocr_line"), _START.format("span", "ocrx_word")
_HAS_BOX = "regexp_matches(tag, 'bbox\\s+[0-9]+\\s+[0-9]+\\s+[0-9]+\\s+[0-9]+')"


def _said(c: str) -> str:
    c = f"regexp_replace(regexp_replace({c}, '<[^<>]*>', '', 'g'), '<[^<>]*$', '')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


MARKED_LINES = f"""(SELECT hocr_id, page_idx, (k - 2)::INTEGER AS line_idx, parts[k] AS part, tags[k - 1] AS tag
    FROM (SELECT hocr_id, page_idx, string_split_regex(h, '{_LINE_TAG}') AS parts, regexp_extract_all(h, '{_LINE_TAG}') AS tags FROM {_BARE}), unnest(range(2, len(parts) + 1)) AS t(k))"""
MARKED_WORDS = f"""(SELECT hocr_id, page_idx, line_idx, (k - 2)::INTEGER AS word_idx, wt[k - 1] AS tag, trim({_said("regexp_extract(ws[k], '(?is)^(.*?)(</span|$)', 1)")}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text
    FROM (SELECT *, string_split_regex(part, '{_WORD_TAG}') AS ws, regexp_extract_all(part, '{_WORD_TAG}') AS wt FROM {MARKED_LINES} WHERE {_HAS_BOX}), unnest(range(2, len(ws) + 1)) AS t(k))"""
SPOKEN_LINES = f"(SELECT hocr_id, page_idx, line_idx, trim(regexp_replace({_said('part')}, '[ \\t\\r\\n\\f\\v]+', ' ', 'g'), ' ') AS text FROM {MARKED_LINES})"


def _attribute(name: str) -> str:
    return f"coalesce(nullif(regexp_extract(tag, '(?i)\\b{name}\\s*=\\s*\"([^\"]*)\"', 1), ''), regexp_extract(tag, '(?i)\\b{name}\\s*=\\s*''([^'']*)''', 1), '')"


ORACLE = {
    "layout_paragraphs": f"""
        SELECT hocr_id, page_idx, paragraph, md5(string_agg(text, ' ' ORDER BY line_id)) AS digest FROM (
          SELECT *, sum(CASE WHEN y0 - py1 > 1.5 * (py1 - py0) THEN 1 ELSE 0 END) OVER (PARTITION BY hocr_id, page_idx ORDER BY line_idx ROWS UNBOUNDED PRECEDING)::BIGINT AS paragraph
          FROM (SELECT *, lag(y0) OVER w AS py0, lag(y1) OVER w AS py1 FROM {BOXED} WINDOW w AS (PARTITION BY hocr_id, page_idx ORDER BY line_idx)))
        WHERE text IS NOT NULL GROUP BY ALL""",
    "page_info": f"""
        SELECT hocr_id, page_idx, nullif(regexp_extract(tag, 'bbox\\s+[0-9]+\\s+[0-9]+\\s+([0-9]+)\\s+[0-9]+', 1), '')::INTEGER AS width,
          nullif(regexp_extract(tag, 'bbox\\s+[0-9]+\\s+[0-9]+\\s+[0-9]+\\s+([0-9]+)', 1), '')::INTEGER AS height, nullif(regexp_extract(tag, 'ppageno\\s+([0-9]+)', 1), '') AS page_num,
          nullif(regexp_extract(html, '(?is)<!--[^>]*?overall page[^>]*?image[:\\s]+([^\\s]+)', 1), '') AS image
        FROM (SELECT *, regexp_extract(html, '(?i)<div\\b[^>]*>') AS tag FROM {PAGES})""",
    "parsed_lines": f"""
        SELECT hocr_id, n_lines, coalesce(n_words, 0)::BIGINT AS n_words FROM (SELECT hocr_id, count(*) AS n_lines FROM {MARKED_LINES} WHERE {_HAS_BOX} GROUP BY 1)
        LEFT JOIN (SELECT hocr_id, count(*) AS n_words FROM {MARKED_WORDS} WHERE length(text) > 0 GROUP BY 1) USING (hocr_id)""",
    "parsed_text": f"SELECT hocr_id, page_idx, line_idx, text FROM {SPOKEN_LINES}",
    "lines_held": f"SELECT line_id, ocr_line AS text FROM {LINES}",
    "parsed_words": f"SELECT hocr_id, page_idx, line_idx, word_idx, text FROM {MARKED_WORDS} WHERE length(text) > 0",
    "parsed_styles": f"""
        SELECT hocr_id, lower(title) LIKE '%bold%' OR lower(style) LIKE '%bold%' AS bold, lower(title) LIKE '%italic%' OR lower(style) LIKE '%italic%' AS italic,
          regexp_matches(style, 'vertical-align\\s*:\\s*super') OR title LIKE '%superscript%' AS superscript, count(*) AS n
        FROM (SELECT hocr_id, {_attribute("title")} AS title, {_attribute("style")} AS style FROM {MARKED_WORDS} WHERE length(text) > 0) GROUP BY ALL""",
    "head_metadata": f"""
        SELECT hocr_id, length(k)::INTEGER AS n_chars, md5(k) AS digest FROM (SELECT hocr_id, array_to_string(list_filter(string_split(prefix_before_body, chr(10)),
          lambda x: NOT regexp_matches(x, '(?i)<meta\\s[^>]*name\\s*=\\s*["'']?(font-metrics|layout|layout-data-table)["''\\s/>]')), chr(10)) AS k FROM {FILES})""",
    "head_top": "SELECT doc_id, md5(array_to_string(string_split(text, chr(10))[1:25], chr(10))) AS digest, substr(text, 1, 100) AS preview FROM documents",
    "document_lines": "SELECT doc_id, (length(text) - length(replace(text, chr(10), '')) + CASE WHEN text LIKE '%' || chr(10) THEN 0 ELSE 1 END)::BIGINT AS n_lines, length(text)::BIGINT AS n_chars FROM documents WHERE length(text) > 0",
    "html_escaped": f"SELECT doc_id, md5({_HTML.format('text')}) AS digest FROM documents",
    "latex_escaped": f"SELECT doc_id, md5({_latex('text')}) AS digest FROM documents",
    "diff_lines": """
        SELECT doc_id, CASE WHEN x LIKE '===%' THEN 'header' WHEN x LIKE '+++%' OR x LIKE '---%' THEN 'info' WHEN x LIKE '+%' THEN 'added' WHEN x LIKE '-%' THEN 'removed' WHEN x LIKE '@@%' THEN 'info' ELSE 'context' END AS cls, count(*) AS n
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents WHERE text IS NOT NULL) GROUP BY ALL""",
    "styled_lines": f"""
        SELECT hocr_id, page_idx, line_idx,
          md5(string_agg(CASE WHEN b AND i THEN '***' || m || '***' WHEN b THEN '**' || m || '**' WHEN i THEN '*' || m || '*' ELSE m END, ' ' ORDER BY word_id)) AS md_digest,
          md5(string_agg(CASE WHEN b AND i THEN '\\textbf{{\\textit{{' || t || '}}}}' WHEN b THEN '\\textbf{{' || t || '}}' WHEN i THEN '\\textit{{' || t || '}}' ELSE t END, ' ' ORDER BY word_id)) AS tex_digest
        FROM (SELECT *, CASE WHEN s THEN '^' || w || '^' ELSE w END AS m, {_STYLE_TEX} AS t
          FROM (SELECT hocr_id, page_idx, line_idx, word_id, ocrx_word AS w, coalesce(bold, false) AS b, coalesce(italic, false) AS i, coalesce(superscript, false) AS s FROM {WORDS} WHERE ocrx_word IS NOT NULL AND word_idx IS NOT NULL)) GROUP BY ALL""",
    "capitals": f"""
        SELECT line_id, round(u / nullif(l, 0), 6) AS share, coalesce(u / nullif(l, 0) > 0.8, false) AS is_capitals FROM (
          SELECT line_id, length(regexp_replace(ocr_line, '[^\\p{{L}}]', '', 'g')) AS l, length(regexp_replace(ocr_line, '[^\\p{{Lu}}]', '', 'g')) AS u FROM {LINES})""",
    "usual_edges": USUAL[1:-1],
    "line_classes": f"""
        SELECT hocr_id, page_idx, sum(heading::INT)::BIGINT AS n_is_heading, sum(starts::INT)::BIGINT AS n_is_break, sum(CASE WHEN NOT blank THEN indented::INT END)::BIGINT AS n_indented FROM {CLASSIFIED} GROUP BY ALL""",
    "markdown_books": f"""
        SELECT hocr_id, length(text)::INTEGER AS n_chars, md5(text) AS digest FROM (
          SELECT hocr_id, string_agg('### Page' || coalesce(' ' || page_num, '') || coalesce(chr(10) || chr(10) || body, ''), chr(10) || chr(10) ORDER BY page_idx) AS text
          FROM (SELECT hocr_id, page_idx, max(page_num) AS page_num FROM {LINES} GROUP BY ALL) LEFT JOIN (
            SELECT hocr_id, page_idx, string_agg(CASE WHEN heading THEN '## ' || text || chr(10) ELSE CASE WHEN starts THEN chr(10) ELSE '' END || coalesce(words, '') END, chr(10) ORDER BY line_idx) AS body
            FROM {CLASSIFIED} LEFT JOIN (
              SELECT hocr_id, page_idx, line_idx, string_agg(CASE WHEN b AND i THEN '***' || m || '***' WHEN b THEN '**' || m || '**' WHEN i THEN '*' || m || '*' ELSE m END, ' ' ORDER BY word_idx) AS words
              FROM (SELECT *, CASE WHEN s THEN '^' || w || '^' ELSE w END AS m
                FROM (SELECT hocr_id, page_idx, line_idx, word_idx, ocrx_word AS w, coalesce(bold, false) AS b, coalesce(italic, false) AS i, coalesce(superscript, false) AS s FROM {WORDS} WHERE length(trim(ocrx_word, {SPACE})) > 0)) GROUP BY ALL) USING (hocr_id, page_idx, line_idx)
            WHERE NOT blank GROUP BY ALL) USING (hocr_id, page_idx) GROUP BY hocr_id)""",
    "latex_books": f"""
        WITH w AS (SELECT hocr_id, page_idx, line_idx, word_idx, ocrx_word AS w, coalesce(bold, false) AS b, coalesce(italic, false) AS i, coalesce(superscript, false) AS s FROM {WORDS} WHERE length(trim(ocrx_word, {SPACE})) > 0),
        n AS (SELECT hocr_id, page_idx, number, arg_max(note, line_idx) AS note FROM {FEET} GROUP BY ALL),
        t AS (SELECT w.*, note, {_STYLE_TEX} AS t FROM w LEFT JOIN n ON w.hocr_id = n.hocr_id AND w.page_idx = n.page_idx AND w.s AND regexp_matches(w.w, '^[0-9]+$') AND n.number = w.w),
        said AS (SELECT hocr_id, page_idx, line_idx, string_agg(CASE WHEN note IS NOT NULL THEN '\\footnote{{' || {_latex('note')} || '}}' WHEN b AND i THEN '\\textbf{{\\textit{{' || t || '}}}}' WHEN b THEN '\\textbf{{' || t || '}}' WHEN i THEN '\\textit{{' || t || '}}' ELSE t END, ' ' ORDER BY word_idx) AS words FROM t GROUP BY ALL),
        body AS (SELECT b.*, coalesce(y0 - lag(y1) OVER p > 1.5 * (lag(y1) OVER p - lag(y0) OVER p), false) AS brk FROM {BOXED} b
          WHERE NOT EXISTS (SELECT 1 FROM {LAST_FEET} f WHERE f.hocr_id = b.hocr_id AND f.page_idx = b.page_idx AND abs(f.y0 - b.y0) < 10) WINDOW p AS (PARTITION BY hocr_id, page_idx ORDER BY line_idx)),
        laid AS (SELECT hocr_id, page_idx, line_idx, CASE WHEN words IS NOT NULL THEN CASE WHEN brk THEN chr(10) ELSE '' END || words || ' \\optionallinebreak' WHEN brk THEN '' END AS x FROM body LEFT JOIN said USING (hocr_id, page_idx, line_idx)),
        pages AS (SELECT p.hocr_id, p.page_idx, concat_ws(chr(10), '% Page ' || page_num, '', set_lines, chr(10) || '% Footnotes for this page:' || chr(10) || notes) AS text FROM (SELECT hocr_id, page_idx, max(page_num) AS page_num FROM {LINES} GROUP BY ALL) p
          LEFT JOIN (SELECT hocr_id, page_idx, string_agg(x, chr(10) ORDER BY line_idx) AS set_lines FROM laid WHERE x IS NOT NULL GROUP BY ALL) USING (hocr_id, page_idx)
          LEFT JOIN (SELECT hocr_id, page_idx, string_agg('% [' || number || '] ' || note, chr(10) ORDER BY line_idx) AS notes FROM {FEET} GROUP BY ALL) USING (hocr_id, page_idx))
        SELECT hocr_id, length(d)::INTEGER AS n_chars, md5(d) AS digest FROM (SELECT hocr_id, '{_TEX[0]}' || string_agg(text, '{_TEX[1]}' ORDER BY page_idx) || '{_TEX[2]}' AS d FROM pages GROUP BY hocr_id)""",
    "band_words": f"""
        SELECT l.hocr_id, l.page_idx, l.line_idx, count(word_id) AS n_words, sum(word_id)::BIGINT AS sum_word_id
        FROM (SELECT hocr_id, page_idx, line_idx, bbox.y0 AS y FROM {LINES} WHERE bbox IS NOT NULL) l LEFT JOIN (SELECT hocr_id, page_idx, word_id, bbox.y0 AS y FROM {WORDS} WHERE bbox IS NOT NULL) w
          ON l.hocr_id = w.hocr_id AND l.page_idx = w.page_idx AND abs(l.y - w.y) < 5 GROUP BY ALL""",
    "foot_lines": f"SELECT hocr_id, page_idx, line_idx, number, note FROM {FEET}",
    "body_lines": f"SELECT hocr_id, page_idx, count(*) AS n_lines FROM {BOXED} b WHERE NOT EXISTS (SELECT 1 FROM {LAST_FEET} f WHERE f.hocr_id = b.hocr_id AND f.page_idx = b.page_idx AND abs(f.y0 - b.y0) < 10) GROUP BY ALL",
    "foot_references": f"""
        SELECT word_id, w.number, note FROM (SELECT word_id, hocr_id, page_idx, ocrx_word AS number FROM {WORDS} WHERE superscript AND regexp_matches(ocrx_word, '^[0-9]+$')) w
        LEFT JOIN (SELECT hocr_id, page_idx, number, arg_max(note, line_idx) AS note FROM {FEET} GROUP BY ALL) f ON w.hocr_id = f.hocr_id AND w.page_idx = f.page_idx AND w.number = f.number""",
    "answer_status": f"""
        SELECT doc_id, CASE WHEN text IS NULL THEN 'no text' WHEN b THEN 'empty string' ELSE 'ok' END AS as_text,
          CASE WHEN text IS NULL THEN 'no text' WHEN NOT rtrim(text, {SPACE}) LIKE '%</html>' THEN 'no closing </html> tag' WHEN b THEN 'empty string' ELSE 'ok' END AS as_page
        FROM (SELECT *, length(trim(text, {SPACE})) = 0 AS b FROM documents)""",
}
