"""hOCR documents as rows: structure, pages, lines, words, and back.

The tree is read with one tolerant parser (``html.parser``) over Arrow batches; everything after it is
column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as tx

DIV = re.compile(r"<(/?)div\b[^>]*>", re.I)
PAGE_CLASS = re.compile(r"class\s*=\s*(\"[^\"]*\bocr_page\b[^\"]*\"|'[^']*\bocr_page\b[^']*')", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source wbr".split())


def page_blocks(body: str) -> tuple[list[str], bool]:
    """Every outermost ``ocr_page`` division with all that it holds, and whether each was closed."""
    out, depth, start = [], 0, -1
    for m in DIV.finditer(body):
        if m[1]:
            if depth:
                depth -= 1
                if not depth:
                    out.append(body[start : m.end()])
        elif depth:
            depth += 1
        elif PAGE_CLASS.search(m[0]):
            depth, start = 1, m.start()
    return out, depth == 0


def page_elements(body: str) -> list[str]:
    """Every ``ocr_page`` division in the order of their start tags, also those within another; an open one goes to the end."""
    out: list[list[int]] = []
    stack: list[int | None] = []  # of each open division: its place in out, if it is a page
    for m in DIV.finditer(body):
        if not m[1]:
            page = PAGE_CLASS.search(m[0])
            stack.append(len(out) if page else None)
            if page:
                out.append([m.start(), len(body)])
        elif stack and (at := stack.pop()) is not None:
            out[at][1] = m.end()
    return [body[a:b] for a, b in out]


STRUCTURE = T.StructType([
    T.StructField("prefix", T.StringType()), T.StructField("body_open_tag", T.StringType()), T.StructField("pages", T.ArrayType(T.StringType())), T.StructField("status", T.StringType()),
])


@F.pandas_udf(T.StructType([T.StructField("pages", T.ArrayType(T.StringType())), T.StructField("closed", T.BooleanType())]))
def page_blocks_udf(bodies: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_blocks(b) if isinstance(b, str) else ([], True) for b in bodies], columns=["pages", "closed"])


def structure(document: Column) -> Column:
    """(prefix, body_open_tag, pages, status) of a whole hOCR document.

    status: ``ok``, ``no_body``, ``no_close_body``, ``no_page`` or ``open_page``; null for a null document.
    """
    tag = F.regexp_extract(document, r"(?i)<body\b[^>]*>", 0)
    at = F.instr(document, tag)
    inside = F.substring(document, at + F.length(tag), F.length(document))
    end = F.regexp_instr(F.lower(inside), F.lit("</body"))
    body = F.when(end > 0, F.substring(inside, F.lit(1), end - 1)).otherwise(inside)
    blocks = page_blocks_udf(F.when(F.length(tag) > 0, body))
    prefix = tx.without_font_metadata(F.regexp_replace(F.when(F.length(tag) > 0, F.substring(document, F.lit(1), at - 1)).otherwise(document), r"\s+$", ""))
    status = F.when(F.length(tag) == 0, "no_body").when(end == 0, "no_close_body").when(~blocks["closed"], "open_page").when(F.size(blocks["pages"]) == 0, "no_page").otherwise("ok")
    return F.when(document.isNotNull(), F.struct(prefix.alias("prefix"), F.nullif(tag, F.lit("")).alias("body_open_tag"), blocks["pages"].alias("pages"), status.alias("status")))


def assembled(prefix: Column, body_open_tag: Column, pages: Column) -> Column:
    """A whole document from its parts."""
    return F.concat(F.coalesce(prefix, F.lit("")), F.lit("\n"), F.coalesce(body_open_tag, F.lit("<body>")), F.lit("\n"), F.array_join(pages, "\n"), F.lit("\n</body>\n</html>\n"))


def with_page_comment(page: Column, overall: Column, image: Column) -> Column:
    """A page with the comment on its number and image behind its first division."""
    note = F.concat(F.lit("\n<!-- overall page "), overall.cast("string"), F.lit(": source image "), image, F.lit(" -->"))
    tag = F.regexp_extract(page, r"(?i)<div\b[^>]*>", 0)
    at = F.instr(page, tag) + F.length(tag)
    return F.when(F.length(tag) > 0, F.concat(F.substring(page, F.lit(1), at - 1), note, F.substring(page, at, F.length(page)))).otherwise(page)


class _Reader(HTMLParser):
    """Lines and words of a page in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []  # element and what it is: line, word or nothing
        self.lines: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            return
        at = dict(attrs)
        classes = (at.get("class") or "").split()
        what = "line" if "ocr_line" in classes else "word" if "ocrx_word" in classes else ""
        if what == "line":
            self.lines.append({"title": at.get("title") or "", "text": [], "words": []})
        elif what == "word" and self.lines and any(w == "line" for _, w in self.open):
            self.lines[-1]["words"].append({"title": at.get("title") or "", "style": at.get("style") or "", "text": []})
        self.open.append((tag, what))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        kinds = {w for _, w in self.open}
        if "line" in kinds:
            self.lines[-1]["text"].append(data)
            if "word" in kinds and self.lines[-1]["words"]:
                self.lines[-1]["words"][-1]["text"].append(data)


WORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("title", T.StringType()), T.StructField("style", T.StringType())])
LINE = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("words", T.ArrayType(WORD))])


CUT_TAG = re.compile(r"<[^<>]*\Z")
BLANKS = re.compile(r"[ \t\r\n\f\v]+")


def read_page(page: str) -> list[tuple]:
    """(title, text, words) of a page's lines; a tag that the page's end cuts off is left out."""
    reader = _Reader()
    reader.feed(CUT_TAG.sub("", page))
    reader.close()
    return [(x["title"], BLANKS.sub(" ", "".join(x["text"])).strip(" "), [("".join(w["text"]).strip(" \t\r\n\f\v"), w["title"], w["style"]) for w in x["words"]]) for x in reader.lines]


@F.pandas_udf(T.ArrayType(LINE))
def page_lines_udf(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in pages:
        yield pd.Series([read_page(p) if isinstance(p, str) else None for p in s], dtype=object)


def lines(pages: DataFrame, keys: list[str], page: str) -> DataFrame:
    """keys, line_idx, bbox, text and words (array of text, title, style) of each page's lines with a box.

    Null and empty pages have no lines; cut and unclosed markup is read as far as it goes.
    """
    read = pages.select(*keys, F.posexplode(page_lines_udf(F.col(page))).alias("line_idx", "_l"))
    boxed = read.select(*keys, "line_idx", tx.box_of(F.col("_l.title")).alias("bbox"), F.col("_l.text").alias("text"), F.col("_l.words").alias("words"))
    return boxed.filter(F.col("bbox").isNotNull())


def words(page_lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, line_idx, word_idx, text, bbox and style of the lines' words that hold text."""
    w = page_lines.select(*keys, "line_idx", F.posexplode("words").alias("word_idx", "_w")).filter(F.length("_w.text") > 0)
    flags = tx.style_flags(F.col("_w.title"), F.col("_w.style"))
    return w.select(*keys, "line_idx", "word_idx", F.col("_w.text").alias("text"), tx.box_of(F.col("_w.title")).alias("bbox"), tx.found(F.col("_w.title"), r"x_wconf\s+([0-9]+)").try_cast("int").alias("x_wconf"), flags.alias("s")).select("*", "s.*").drop("s")
