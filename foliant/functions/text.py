"""Text functions of hOCR and its renderings, as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which file name extensions each step of the workflow takes for page images.
IMAGE_EXTENSIONS = {
    "recognise": ("png", "jpg", "jpeg", "tif", "tiff", "jp2"),
    "batch": ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "gif", "webp", "jp2"),
    "report": ("png", "jpg", "jpeg", "tif", "tiff", "jp2"),
    "split": ("pdf", "jpg", "jpeg", "png", "tiff", "tif", "bmp", "jp2"),
}
# MIME types by extension.
MIME_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "tif": "image/tiff", "tiff": "image/tiff", "jp2": "image/jp2"}
# What LaTeX's special characters become, in the order of replacement (braces that an
# earlier replacement brought in are replaced again).
LATEX_ESCAPES = (("\\", r"\textbackslash{}"), ("{", r"\{"), ("}", r"\}"), ("$", r"\$"), ("&", r"\&"), ("%", r"\%"), ("#", r"\#"), ("_", r"\_"), ("~", r"\textasciitilde{}"), ("^", r"\textasciicircum{}"))
BOX = "struct<x0:int,y0:int,x1:int,y1:int>"


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where nothing matches."""
    got = F.regexp_extract(c, pattern, group)
    return F.when(c.rlike(pattern), got)


def strip(c: Column) -> Column:
    """White space of every script cut off at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def box_of(title: Column) -> Column:
    """The first ``bbox`` of a title as a struct; null without one."""
    four = F.split(F.regexp_extract(title, r"bbox\s+([0-9]+\s+[0-9]+\s+[0-9]+\s+[0-9]+)", 1), r"\s+")
    side = lambda i: F.get(four, F.lit(i)).try_cast("int")
    return F.when(title.rlike(r"bbox\s+[0-9]+\s+[0-9]+\s+[0-9]+\s+[0-9]+"), F.struct(side(0).alias("x0"), side(1).alias("y0"), side(2).alias("x1"), side(3).alias("y1")))


def page_number(title: Column) -> Column:
    return found(title, r"ppageno\s+([0-9]+)")


def image_name(page: Column) -> Column:
    """The image named in the comment about the overall page."""
    comment = F.regexp_extract(page, r"(?is)<!--((?:(?!-->).)*overall page(?:(?!-->).)*)-->", 1)
    return found(comment, r"image[:\s]+([^\s]+)")


def head_of(document: Column) -> Column:
    return found(document, r"(?is)(<head\b.*?</head>)")


def without_font_metadata(document: Column) -> Column:
    """Every line dropped that holds a meta element of font metrics or layout."""
    unwanted = r"(?i)<meta\s[^>]*name\s*=\s*[\"']?(font-metrics|layout|layout-data-table)[\"'\s/>]"
    return F.array_join(F.filter(F.split(document, "\n"), lambda x: ~x.rlike(unwanted)), "\n")


def html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def latex_escape(c: Column) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), LATEX_ESCAPES, c)


def csv_quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def style_flags(title: Column, style: Column) -> Column:
    """(bold, italic, superscript) of a word's title and style attributes."""
    t, s = F.coalesce(title, F.lit("")), F.coalesce(style, F.lit(""))
    has = lambda w: F.contains(F.lower(t), F.lit(w)) | F.contains(F.lower(s), F.lit(w))
    raised = s.rlike(r"vertical-align\s*:\s*super") | F.contains(t, F.lit("superscript"))
    return F.struct(has("bold").alias("bold"), has("italic").alias("italic"), raised.alias("superscript"))


def _wrapped(c: Column, before: str, after: str, when: Column) -> Column:
    return F.when(when, F.concat(F.lit(before), c, F.lit(after))).otherwise(c)


def latex_styled(text: Column, bold: Column, italic: Column, superscript: Column) -> Column:
    """Escaped and wrapped: superscript inside, italic within bold."""
    inner = _wrapped(latex_escape(text), r"\textsuperscript{", "}", superscript)
    return _wrapped(_wrapped(inner, r"\textit{", "}", italic), r"\textbf{", "}", bold)


def markdown_styled(text: Column, bold: Column, italic: Column, superscript: Column, preserve: bool = True) -> Column:
    if not preserve:
        return text
    inner = _wrapped(text, "^", "^", superscript)
    return F.when(bold & italic, F.concat(F.lit("***"), inner, F.lit("***"))).when(bold, F.concat(F.lit("**"), inner, F.lit("**"))).when(italic, F.concat(F.lit("*"), inner, F.lit("*"))).otherwise(inner)


def diff_class(line: Column) -> Column:
    """What a line of a diff is: header, info, added, removed or context; the first rule that fits."""
    x = F.regexp_replace(line, r"\s+$", "")
    return (
        F.when(x.startswith("==="), "header").when(x.startswith("+++") | x.startswith("---"), "info").when(x.startswith("+"), "added")
        .when(x.startswith("-"), "removed").when(x.startswith("@@"), "info").otherwise("context")
    )


def capital_share(c: Column) -> Column:
    """Share of capitals among the letters; null without letters."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(c, r"[^\p{Lu}]", "")) / letters)


def all_capitals(c: Column) -> Column:
    return F.coalesce(capital_share(c) > 0.8, F.lit(False))


def response_status(text: Column, proofread: Column | bool = False) -> Column:
    """Of a model's answer: ``ok``, ``empty string``, or for a corrected page ``no closing </html> tag``."""
    open_page = (F.lit(proofread) if isinstance(proofread, bool) else proofread) & ~F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+$", "").endswith("</html>")
    return F.when(text.isNull(), "no text").when(open_page, "no closing </html> tag").when(F.length(strip(text)) == 0, "empty string").otherwise("ok")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./\\]+)$", 1))


def mime_type(name: Column) -> Column:
    """MIME type of a file name's extension, else that of unknown bytes."""
    table = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension(name)), F.lit("application/octet-stream"))


def is_image(name: Column, step: str = "recognise") -> Column:
    return extension(name).isin(*IMAGE_EXTENSIONS[step])


def document_format(name: Column) -> Column:
    """markdown or hocr; any other extension is an error when the row is read."""
    kind = extension(name)
    return F.when(kind.isin("md", "markdown"), "markdown").when(kind == "hocr", "hocr").otherwise(F.raise_error(F.concat(F.lit("unknown document format: "), name)).cast("string"))


def batch_folder(start: Column, end: Column) -> Column:
    """Folder of a batch of pages ``start``..``end`` (1-based, inclusive)."""
    return F.when(start == end, F.format_string("batch_%03d", start)).otherwise(F.format_string("batch_%03d-%03d", start, end))


def batch_file(name: Column, start: Column, end: Column) -> Column:
    """Name of a batch's hOCR: the whole file's, without its mark for all pages, with the pages' numbers."""
    stem = F.regexp_replace(F.regexp_replace(name, r"(?i)\.hocr$", ""), r"(?i)[-_]all$", "")
    pages = F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))
    return F.concat(stem, F.lit("_"), pages, F.lit(".hocr"))


def original_name(name: Column) -> Column:
    """The name without its first ``-proofread``."""
    at = F.instr(name, "-proofread")
    return F.when(at > 0, F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + 10, F.length(name)))).otherwise(name)


def proofread_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\.hocr$", "-proofread.hocr")


def split_page_name(stem: Column, index: Column, total: Column, side: Column, ext: Column) -> Column:
    """Name of the left (1) or right (2) half of a scan, numbered with as many digits as the total has."""
    return F.concat(stem, F.lit("_split_"), F.lpad(index.cast("string"), F.length(total.cast("string")), "0"), F.lit("_"), side.cast("string"), ext)


def first_integer(name: Column) -> Column:
    return found(name, r"([0-9]+)").try_cast("int")


def box_text(polygon: Column) -> Column:
    """A polygon's points as text, as an overview prints them; ``N/A`` without one."""
    n = (F.size(polygon) / 2).cast("int")
    points = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("["), F.get(polygon, 2 * i).cast("string"), F.lit(", "), F.get(polygon, 2 * i + 1).cast("string"), F.lit("]")))
    return F.when(polygon.isNull() | (F.size(polygon) < 2), "N/A").otherwise(F.concat_ws(", ", points))


def preview(c: Column, size: int = 100) -> Column:
    return F.substring(c, 1, size)


def answer_name(at: Column, kind: str = "output", ext: str = "txt") -> Column:
    """File name of an answer or prompt, with the minute it was made; the extension is its document's."""
    return F.concat(F.lit(f"{kind}-"), F.date_format(at, "yyyy-MM-dd'T'HHmm"), F.lit(f".{ext}"))


def temperature_file(name: Column) -> Column:
    """Side file of an hOCR file that keeps the last temperature tried."""
    return F.regexp_replace(name, r"\.hocr$", "-proofread.lasttemp")


def failed_file(name: Column, at: Column, attempt: Column, kind: str = "hocr") -> Column:
    """Side file of a failed attempt: its answer (``hocr``) or its error (``err``)."""
    end = F.concat(F.lit(f"-proofread.{kind}."), F.date_format(at, "yyyy-MM-dd'T'HHmm"), F.lit("."), attempt.cast("string"), F.lit(".failed"))
    return F.concat(F.regexp_replace(name, r"\.hocr$", ""), end)


def result_name(at: Column, ext: str, prefix: str = "recognised") -> Column:
    """File name of a recognition's results, with the minute they were made; without colons, which some systems refuse."""
    return F.concat(F.lit(f"{prefix}-"), F.date_format(at, "yyyy-MM-dd'T'HH-mm"), F.lit(f".{ext}"))


def confidence_percent(c: Column) -> Column:
    """Whole percent, cut off; nothing gives 0."""
    return F.coalesce((c * 100).cast("int"), F.lit(0))


def confidence_text(c: Column) -> Column:
    return F.when(c.isNull() | (c == 0), "0.0000").otherwise(F.format_string("%.4f", c))


def polygon_box(p: Column) -> Column:
    """Box of a polygon's first and third corner, cut to whole pixels."""
    at = lambda i: F.get(p, F.lit(i)).cast("int")
    return F.when(F.size(p) >= 6, F.struct(at(0).alias("x0"), at(1).alias("y0"), at(4).alias("x1"), at(5).alias("y1")))


def proofread_prompt(draft: Column, form: str) -> Column:
    """The instruction for correcting a draft against its page image."""
    if form not in ("markdown", "hocr"):
        raise ValueError(f"unknown document format: {form}")
    what = "hOCR document: keep its elements and boxes, and correct only the words" if form == "hocr" else "Markdown document: keep its structure, and correct the text"
    return F.concat(F.lit(f"Compare the page image with this {what}. Answer with the whole corrected document and nothing else.\n\n"), draft)
