"""Splitting oversized items at natural boundaries.

Method: a recursive separator hierarchy. An item over the limit is split at sections (blocks of the
page), what is still too long at paragraphs (lines), sentences, words, and at last characters; the
parts are then packed greedily up to the limit, each piece after the first starting with the last
``overlap`` characters of the one before. The first piece followed by each later piece without its
overlap gives back the item exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.sources.tables import only_current

LIMIT, OVERLAP = 16_000, 400

#: A part ends at the end of a match; from coarse to fine. Texts without markup fall to the later alternatives.
SEPARATORS = (
    re.compile(r"</(?:div|p|table|ul|ol|pre|section|h[1-6])\s*>\s*|\n[ \t]*\n\s*", re.I),  # sections: blocks
    re.compile(r"(?=<(?:span|div|p)\b[^<>]*\bocr_line\b)|<br\s*/?>\s*|</(?:li|tr)\s*>\s*", re.I),  # the page's lines
    re.compile(r"\n+"),
    re.compile(r"(?P<tag><[^<>]*>)|(?<=[.!?。؟])[\"'”»)]*\s+"),  # sentences; what stands within a tag is passed over
    re.compile(r"</span\s*>\s*|(?P<tag><[^<>]*>)|\s+", re.I),  # words
    re.compile(r">(?=<)|(?<=>)|\s+"),  # tags, or blanks within one
)


def parts(text: str, start: int, end: int, room: int, level: int = 0) -> Iterator[int]:
    """Ends of the parts of text[start:end], none longer than ``room``: coarse separators first."""
    while level < len(SEPARATORS):
        cuts = [m.end() for m in SEPARATORS[level].finditer(text, start, end) if start < m.end() < end and m.lastgroup != "tag"]
        level += 1
        if cuts:
            break
    else:
        yield from range(start + room, end, room)
        yield end
        return
    at = start
    for cut in (*cuts, end):
        if cut - at > room:
            yield from parts(text, at, cut, room, level)
        elif cut > at:
            yield cut
        at = cut


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of each piece; start of a later piece lies ``overlap`` before the last piece's end."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    if len(text) <= limit:
        return [(0, len(text))]
    ends: list[int] = []
    begin, last = 0, 0  # of the open piece: where it starts with its overlap, where it ends so far
    for cut in parts(text, 0, len(text), limit - overlap):
        if cut - begin > limit:
            ends.append(last)
            begin = max(0, last - overlap)
        last = cut
    ends.append(last)
    starts = [0, *(max(0, e - overlap) for e in ends[:-1])]
    return list(zip(starts, ends, strict=True))


def split_items(df: DataFrame, column: str, keys: list[str], limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """keys, piece_idx, n_pieces, start, end[, piece] of every item longer than ``limit`` code points.

    Items within the limit, null and empty ones need no cut and give no row. Only oversized items
    leave the JVM. Repeated rows are split once each; other columns are left out.
    """
    fields = list(df.select(*keys).schema.fields)
    extra = [T.StructField("piece_idx", T.IntegerType()), T.StructField("n_pieces", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    schema = T.StructType([*fields, *extra, *([T.StructField("piece", T.StringType())] if with_text else [])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, at = [], []
            for k, text in enumerate(b["_item"]):
                found = split(text, limit, overlap)
                for i, (x, y) in enumerate(found):
                    at.append(k)
                    rows.append((i, len(found), x, y, *((text[x:y],) if with_text else ())))
            out = b[keys].iloc[at].reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame(rows, columns=[f.name for f in schema.fields[len(keys):]])], axis=1)

    long = df.select(*keys, F.col(column).alias("_item")).filter(F.char_length("_item") > limit)
    return long.mapInPandas(run, schema)


def page_pieces(hocr: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """(hocr_id, page_idx, piece_idx, n_pieces, start, end[, piece]) of the current files' long pages."""
    pages = hocr.select("hocr_id", "loaded_at", F.posexplode("pages_html").alias("page_idx", "html"))
    cut = split_items(pages, "html", ["hocr_id", "loaded_at", "page_idx"], limit, overlap, with_text)
    return only_current(cut, hocr, "hocr_id").drop("loaded_at").dropDuplicates(["hocr_id", "page_idx", "piece_idx"])


def long_pages(hocr: DataFrame) -> DataFrame:
    """(hocr_id, page_idx) of the current files' pages that had to be cut."""
    first = page_pieces(hocr, with_text=False).filter((F.col("piece_idx") == 0) & (F.col("n_pieces") > 1))
    return first.select("hocr_id", "page_idx")
