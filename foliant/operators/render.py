"""Documents out of lines and words: Markdown, LaTeX, merged hOCR, OCR text, word CSV.

Each renderer takes rows and gives one text per page or document, joined in an explicit order; pages are
rendered where their words are, and only then joined to documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as geo
from foliant.functions import text as tx

PAGE = ["hocr_id", "page_idx"]


def in_order(order: Column, text: Column, by: str = "\n") -> Column:
    """Texts of a group joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"]), by)


def page_headers(pages: DataFrame) -> DataFrame:
    """Pages (hocr_id, page_idx, page_num, image) with their Markdown heading."""
    named = F.when(F.col("image").isNotNull(), F.concat(F.lit(" ("), F.col("image"), F.lit(")"))).otherwise("")
    return pages.select(*PAGE, F.concat(F.lit("### Page"), F.coalesce(F.concat(F.lit(" "), F.col("page_num")), F.lit("")), named).alias("heading"))


def classified_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Lines (hocr_id, page_idx, line_idx, bbox, text) of pages (page_box) with what they are on their page.

    Adds is_blank, blanks (blank lines since the last with text), is_heading (centred capitals after a gap of
    blank lines or at the page's start), is_indented, is_break (a new paragraph starts).
    """
    usual = geo.usual_x(lines, PAGE, "line_idx", F.col("bbox.x0"))
    d = lines.join(usual, PAGE, "left").join(pages.select(*PAGE, "page_box"), PAGE, "left")
    w = Window.partitionBy(*PAGE).orderBy("line_idx")
    d = d.withColumn("is_blank", F.length(tx.strip(F.coalesce("text", F.lit("")))) == 0).withColumn("position", F.row_number().over(w) - 1)
    run = F.sum(F.col("is_blank").cast("int")).over(w)
    at_last = F.last(F.when(~F.col("is_blank"), F.col("_blank_run")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_blank_run", run).withColumn("blanks", F.when(~F.col("is_blank"), F.col("_blank_run") - F.coalesce(at_last, F.lit(0))))
    heading = ~F.col("is_blank") & geo.is_centred(F.col("bbox"), F.col("page_box")) & tx.all_capitals(F.col("text")) & ((F.col("blanks") > 1) | (F.col("position") < 2))
    before = F.last(F.when(~F.col("is_blank"), F.col("bbox")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("is_heading", heading).withColumn("_before", before).withColumn("is_indented", geo.is_indented(F.col("bbox"), F.col("usual_x")))
    is_break = ~F.col("is_blank") & ~F.col("is_heading") & F.col("_before").isNotNull() & (F.col("is_indented") | geo.is_new_paragraph(F.col("_before"), F.col("bbox")))
    return d.withColumn("is_break", is_break).drop("_blank_run", "_before")


def markdown_pages(lines: DataFrame, words: DataFrame, pages: DataFrame, preserve: bool = False) -> DataFrame:
    """(hocr_id, page_idx, text): each page in Markdown. Words: hocr_id, page_idx, line_idx, word_idx, text, bold, italic, superscript."""
    styled = tx.markdown_styled(F.col("text"), F.col("bold"), F.col("italic"), F.col("superscript"), preserve)
    spoken = words.filter(F.length(tx.strip(F.coalesce("text", F.lit("")))) > 0).groupBy(*PAGE, "line_idx").agg(in_order(F.col("word_idx"), styled, " ").alias("words"))
    d = classified_lines(lines, pages).filter(~F.col("is_blank")).join(spoken, [*PAGE, "line_idx"], "left")
    shown = F.when(F.col("is_heading"), F.concat(F.lit("## "), F.col("text"), F.lit("\n"))).otherwise(F.concat(F.when(F.col("is_break"), "\n").otherwise(""), F.coalesce("words", F.lit(""))))
    body = d.groupBy(*PAGE).agg(in_order(F.col("line_idx"), shown).alias("body"))
    return page_headers(pages).join(body, PAGE, "left").select(*PAGE, F.concat_ws("\n\n", "heading", "body").alias("text"))


def foot_notes(lines: DataFrame, pages: DataFrame, compat: bool = True) -> DataFrame:
    """(hocr_id, page_idx, line_idx, number, note, bbox): lines in the lowest quarter that begin with a number.

    compat: words are run together before the number is looked for, as the workflow reads them, so that
    in effect only ``1.`` is one; else also a number followed by a space.
    """
    run = F.regexp_replace("text", r"\s+", "") if compat else F.col("text")
    d = lines.join(pages.select(*PAGE, "page_box"), PAGE).filter(geo.in_foot(F.col("bbox"), F.col("page_box"))).withColumn("_t", run)
    hit = d.filter(F.col("_t").rlike(r"^[0-9]+[.\s]"))
    return hit.select(*PAGE, "line_idx", F.regexp_extract("_t", r"^([0-9]+)", 1).alias("number"), tx.strip(F.regexp_replace("_t", r"^[0-9]+[.\s]", "")).alias("note"), "bbox")


def without_foot_notes(lines: DataFrame, notes: DataFrame, near: int = 10) -> DataFrame:
    """Lines that do not stand within ``near`` pixels of a foot note of their page; of notes of equal number the last counts."""
    last = notes.groupBy(*PAGE, "number").agg(F.max_by("bbox", "line_idx").alias("bbox"))
    n = last.select(F.col("hocr_id").alias("_h"), F.col("page_idx").alias("_p"), F.col("bbox.y0").alias("_y"))
    same = (lines["hocr_id"] == F.col("_h")) & (lines["page_idx"] == F.col("_p"))
    return lines.join(n, same & (F.abs(lines["bbox"]["y0"] - F.col("_y")) < near), "left_anti")


# The frame of a LaTeX document, line by line.
LATEX_PACKAGES = r"""\documentclass[10pt]{book}
\usepackage[utf8]{inputenc}
%\usepackage[T1]{fontenc}
\usepackage{geometry}
%\geometry{a5paper}
\geometry{letterpaper}
%\geometry{letterpaper, margin=1in}
\usepackage{parskip}

% Logic to optionally enable commands to retain page breaks and/or retain line breaks
\newbool{retainpagebreaks} % creates boolean variable and initializes it to `false`
\newbool{retainlinebreaks} % creates boolean variable and initializes it to `false`"""
LATEX_SWITCHES = r"""
\ifbool{retainpagebreaks}
    {\newcommand{\optionalpagebreak}{\clearpage}}
    {\newcommand{\optionalpagebreak}{}}

\ifbool{retainlinebreaks}
    {\newcommand{\optionallinebreak}{\newline}}
    {\newcommand{\optionallinebreak}{}}

\begin{document}
"""
LATEX_ON = r"\booltrue{%s} %% comment (i.e. add a leading %%) to NOT set it to `true`"
LATEX_OFF = r"%%\booltrue{%s} %% uncomment (i.e. delete the leading %%) to set it to `true`"


def latex_pages(lines: DataFrame, words: DataFrame, pages: DataFrame, compat: bool = True) -> DataFrame:
    """(hocr_id, page_idx, text): each page's LaTeX; raised numbers become the foot note they name, the last of equal numbers."""
    notes = foot_notes(lines, pages, compat)
    named = notes.groupBy(*PAGE, "number").agg(F.max_by("note", "line_idx").alias("note"))
    body = without_foot_notes(lines, notes)
    w = Window.partitionBy(*PAGE).orderBy("line_idx")
    body = body.withColumn("is_break", geo.is_new_paragraph(F.lag("bbox").over(w), F.col("bbox")))
    spoken = words.filter(F.length(tx.strip(F.coalesce("text", F.lit("")))) > 0).withColumn("number", F.when(F.col("superscript") & F.col("text").rlike("^[0-9]+$"), F.col("text")))
    spoken = spoken.join(named, [*PAGE, "number"], "left")
    shown = F.when(F.col("note").isNotNull(), F.concat(F.lit(r"\footnote{"), tx.latex_escape(F.col("note")), F.lit("}"))).otherwise(tx.latex_styled(F.col("text"), F.col("bold"), F.col("italic"), F.col("superscript")))
    said = spoken.groupBy(*PAGE, "line_idx").agg(in_order(F.col("word_idx"), shown, " ").alias("words"))
    # a paragraph's blank line stands even where its first line has no words
    parts = F.concat(F.when(F.col("is_break"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")), F.when(F.col("words").isNotNull(), F.array(F.concat("words", F.lit(r" \optionallinebreak")))).otherwise(F.array().cast("array<string>")))
    laid = body.join(said, [*PAGE, "line_idx"], "left").select(*PAGE, "line_idx", parts.alias("_p")).filter(F.size("_p") > 0)
    set_lines = laid.groupBy(*PAGE).agg(in_order(F.col("line_idx"), F.array_join("_p", "\n")).alias("body"))
    comments = notes.groupBy(*PAGE).agg(in_order(F.col("line_idx"), F.concat(F.lit("% ["), F.col("number"), F.lit("] "), F.col("note"))).alias("notes"))
    d = pages.join(set_lines, PAGE, "left").join(comments, PAGE, "left")
    head = F.concat(F.lit("% Page "), F.col("page_num"))
    tail = F.concat(F.lit("\n% Footnotes for this page:\n"), F.col("notes"))
    return d.select(*PAGE, F.concat_ws("\n", head, F.lit(""), "body", tail).alias("text"))


def latex_frame(page_breaks: bool = False) -> tuple[str, str, str]:
    """What stands before the first page of a LaTeX document, between two pages, and behind the last."""
    head = "\n".join((LATEX_PACKAGES, (LATEX_ON if page_breaks else LATEX_OFF) % "retainpagebreaks", LATEX_ON % "retainlinebreaks", LATEX_SWITCHES))
    return head + "\n", "\n\\optionalpagebreak\n\n", "\n\n\\end{document}"


def latex_documents(page_texts: DataFrame, page_breaks: bool = False) -> DataFrame:
    """(hocr_id, text): whole LaTeX documents."""
    head, between, tail = latex_frame(page_breaks)
    body = page_texts.groupBy("hocr_id").agg(in_order(F.col("page_idx"), F.col("text"), between).alias("_b"))
    return body.select("hocr_id", F.concat(F.lit(head), F.col("_b"), F.lit(tail)).alias("text"))


def markdown_documents(page_texts: DataFrame) -> DataFrame:
    """(hocr_id, text): whole Markdown documents, pages a blank line apart."""
    return page_texts.groupBy("hocr_id").agg(in_order(F.col("page_idx"), F.col("text"), "\n\n").alias("text"))


# The frame of a merged hOCR document.
MERGED_OPEN = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE html PUBLIC "-//W3C//DTD XHTML 1.0 Transitional//EN" "http://www.w3.org/TR/xhtml1/DTD/xhtml1-transitional.dtd">\n<html xmlns="http://www.w3.org/1999/xhtml" xml:lang="en" lang="en">\n'
PLAIN_HEAD = '<head>\n<title></title>\n<meta charset="utf-8"/>\n<meta name="ocr-system" content="foliant"/>\n</head>'
HEAD_LINES = 25


def merged_parts(files: DataFrame, group: str) -> DataFrame:
    """(group, batch_dir, part, text): files (group, batch_dir, prefix, pages) of a group as the parts of one document.

    Parts in order of (batch_dir, part) are the document: its head with part -1 and no batch, its pages by
    number, its end with a null batch and part 0 (nulls last). No group is gathered in one place, so a
    volume may hold any share of the pages. The head is that of the first file's first 25 lines that has one,
    else a plain one; null pages are left out.
    """
    top = F.array_join(F.slice(F.split("prefix", "\n"), 1, HEAD_LINES), "\n")
    head = files.select(group, "batch_dir", tx.head_of(top).alias("_head")).groupBy(group).agg(F.min(F.when(F.col("_head").isNotNull(), F.struct("batch_dir", "_head")))["_head"].alias("_head"))
    heads = head.select(group, F.lit("").alias("batch_dir"), F.lit(-1).alias("part"), F.concat(F.lit(MERGED_OPEN), F.coalesce("_head", F.lit(PLAIN_HEAD)), F.lit("\n<body>\n")).alias("text"))
    pages = files.select(group, "batch_dir", F.posexplode("pages").alias("part", "text")).filter(F.col("text").isNotNull()).withColumn("text", F.concat("text", F.lit("\n")))
    ends = head.select(group, F.lit(None).cast("string").alias("batch_dir"), F.lit(0).alias("part"), F.lit("</body>\n</html>\n").alias("text"))
    return heads.unionByName(pages).unionByName(ends)


def merged_hocr(files: DataFrame, group: str) -> DataFrame:
    """(group, n_pages, text): the parts of each group as one text, for documents that fit into one."""
    parts = F.array_sort(F.collect_list(F.struct(F.col("batch_dir").isNull().alias("end"), F.col("batch_dir"), F.col("part"), F.col("text"))))
    n = F.count(F.when((F.col("part") >= 0) & F.col("batch_dir").isNotNull(), 1))
    return merged_parts(files, group).groupBy(group).agg(n.alias("n_pages"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"))


# Output of the recognition step.


def recognised_words(words: DataFrame, lines: DataFrame, page: list[str], near: int = 5) -> DataFrame:
    """Lines with the words of their page whose top is less than ``near`` pixels from theirs; a word may join several, a line without any stays."""
    a = lines.select(*page, "line_idx", F.col("y").alias("_ly"))
    b = words.select(*(F.col(c).alias(f"_{c}") for c in page), *(c for c in words.columns if c not in page))
    same = F.lit(True)
    for c in page:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return a.join(b, same & (F.abs(F.col("_ly") - F.col("y")) < near), "left").drop("_ly", *(f"_{c}" for c in page))


def recognised_paragraphs(lines: DataFrame, page: list[str], gap: int = 20) -> DataFrame:
    """Lines (line_idx, y_top, y_bottom) with their paragraph: a new one where the top is over ``gap`` from the last bottom, up or down.

    Lines without a box stay in the paragraph and do not move the last bottom.
    """
    w = Window.partitionBy(*page).orderBy("line_idx")
    last = F.last("y_bottom", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.abs(F.col("y_top") - last) > gap, F.lit(False)).cast("int")
    return lines.withColumn("_s", starts).withColumn("paragraph", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def recognised_markdown(files: DataFrame, pages: DataFrame, paragraphs: DataFrame, dimensions: bool = False) -> DataFrame:
    """(path, page_no, part, text): the parts of one document over all files (path, filename), in order.

    A heading for each file, one for each page (path, page_no, width, height) of files with several, and the
    paragraphs (path, page_no, paragraph, text) in blank lines.
    """
    gap = F.lit("\n\n")
    heads = files.select("path", "filename").distinct().select("path", F.lit(0).alias("page_no"), F.lit(-2).cast("long").alias("part"), F.concat(F.lit("## Filename: "), "filename", gap).alias("text"))
    several = pages.groupBy("path").agg(F.count("*").alias("_n")).filter("_n > 1").select("path")
    of_pages = pages.join(several, "path", "left_semi").select("path", "page_no", F.lit(-2).cast("long").alias("part"), F.concat(F.lit("### Page "), F.col("page_no").cast("string"), gap).alias("text"))
    out = heads.unionByName(of_pages).unionByName(paragraphs.select("path", "page_no", F.col("paragraph").cast("long").alias("part"), F.concat("text", gap).alias("text")))
    if dimensions:
        size = F.concat(F.lit("*Page dimensions: "), F.col("width").cast("string"), F.lit(" x "), F.col("height").cast("string"), F.lit("*"), gap)
        out = out.unionByName(pages.select("path", "page_no", F.lit(-1).cast("long").alias("part"), size.alias("text")))
    return out


# The frame of a recognition's hOCR.
RECOGNISED_HEAD = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE html PUBLIC "-//W3C//DTD XHTML 1.0 Transitional//EN" "http://www.w3.org/TR/xhtml1/DTD/xhtml1-transitional.dtd">
<html xmlns="http://www.w3.org/1999/xhtml" xml:lang="en" lang="en">
<head>
<title>OCR Results</title>
<meta http-equiv="content-type" content="text/html; charset=utf-8" />
<meta name="ocr-system" content="foliant" />
<meta name="ocr-capabilities" content="ocr_page ocr_carea ocr_par ocr_line ocrx_word" />
</head>
<body>
"""
RECOGNISED_TAIL = "</body>\n</html>\n"


def recognised_hocr(pages: DataFrame, lines: DataFrame, words: DataFrame, compat: bool = True) -> DataFrame:
    """(path, page_no, text): each page's hOCR, with its area, its lines that have a box, and the words at their height.

    pages: path, page_no, filename, width, height. lines: path, page_no, line_idx, bbox, y. words: path,
    page_no, word_idx, content, bbox, y, confidence. compat leaves texts unescaped, as the step writes them.
    """
    page = ["path", "page_no"]
    no = F.col("page_no").cast("string")
    joined = recognised_words(words.filter("bbox IS NOT NULL").select(*page, "word_idx", "content", F.col("bbox").alias("word_box"), "confidence", "y"), lines.filter("bbox IS NOT NULL").select(*page, "line_idx", "y"), page)
    shown = F.coalesce("content", F.lit("")) if compat else tx.html_escape(F.coalesce("content", F.lit("")))
    box = lambda b: F.format_string("bbox %d %d %d %d", F.col(f"{b}.x0"), F.col(f"{b}.y0"), F.col(f"{b}.x1"), F.col(f"{b}.y1"))
    one = F.concat(F.lit('\t\t<span class="ocrx_word" id="word_'), no, F.lit("_"), F.col("line_idx").cast("string"), F.lit("_"), F.col("word_idx").cast("string"), F.lit('" title="'), box("word_box"), F.lit("; x_wconf "), tx.confidence_percent(F.col("confidence")).cast("string"), F.lit('">'), shown, F.lit("</span>\n"))
    said = joined.filter("word_idx IS NOT NULL").groupBy(*page, "line_idx").agg(in_order(F.col("word_idx"), one, "").alias("_words"))
    line = F.concat(F.lit('\t<span class="ocr_line" id="line_'), no, F.lit("_"), F.col("line_idx").cast("string"), F.lit('" title="'), box("bbox"), F.lit('">\n'), F.coalesce("_words", F.lit("")), F.lit("\t</span>\n\n"))
    body = lines.filter("bbox IS NOT NULL").join(said, [*page, "line_idx"], "left").groupBy(*page).agg(in_order(F.col("line_idx"), line, "").alias("_lines"))
    head = F.concat(
        F.lit('<div class="ocr_page" id="page_'), no, F.lit('" title="image '), F.col("filename"), F.lit("; bbox 0 0 "), F.col("width").cast("int").cast("string"), F.lit(" "), F.col("height").cast("int").cast("string"), F.lit("; ppageno "), no,
        F.lit('">\n\t<div class="ocr_carea" id="carea_'), no, F.lit('_1">\n'),
    )
    return pages.join(body, page, "left").select(*page, F.concat(head, F.coalesce("_lines", F.lit("")), F.lit("\t</div>\n</div>\n")).alias("text"))


def word_csv_rows(filename: Column, word: Column, confidence: Column, x: Column, y: Column) -> Column:
    """A row of the word export; only the word is quoted."""
    return F.concat_ws(",", filename, tx.csv_quoted(word), tx.confidence_text(confidence), x.cast("string"), y.cast("string"))
