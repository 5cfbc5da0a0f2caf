"""Queries of the training-text operators; names begin with the number of their problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import bpe, lookalikes, markup, mixing, pieces, residue, scan, truncation
from foliant.sources.tables import only_current, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and file heads with markup, one row per syntax."""
    return markup.markup_found(table(spark, sf_dir, "hocr_structure"))


def p1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and file head as clean text."""
    return markup.clean_text(table(spark, sf_dir, "hocr_structure"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages over the limit."""
    return pieces.long_pages(table(spark, sf_dir, "hocr_structure"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every page over the limit."""
    return pieces.page_pieces(table(spark, sf_dir, "hocr_structure"))


def p3_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every page over the limit: whether its pieces keep the limit and give back the page."""
    hocr = table(spark, sf_dir, "hocr_structure")
    made = pieces.page_pieces(hocr).groupBy("hocr_id", "page_idx").agg(
        (F.max(F.char_length("piece")) <= pieces.LIMIT).alias("within"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_idx", "piece"))), lambda x: F.when(x["piece_idx"] == 0, x["piece"]).otherwise(F.substring(x["piece"], pieces.OVERLAP + 1, pieces.LIMIT))), "").alias("whole"),
    )  # a page's own pieces
    pages = only_current(hocr.select("hocr_id", "loaded_at", F.posexplode("pages_html").alias("page_idx", "html")), hocr, "hocr_id").dropDuplicates(["hocr_id", "page_idx"])
    return made.join(pages, ["hocr_id", "page_idx"]).select("hocr_id", "page_idx", "within", (F.col("whole") == F.col("html")).alias("rejoins"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running titles, page numbers, broken words and misread words."""
    return scan.noise(*(table(spark, sf_dir, t) for t in ("ocr_lines", "ocr_words", "word_csv", "lexicon")))


def p4_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every volume as repaired, continuous paragraphs."""
    return scan.continuous_text(*(table(spark, sf_dir, t) for t in ("ocr_lines", "ocr_words", "lexicon")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose end was cut off."""
    return truncation.judged_pages(table(spark, sf_dir, "hocr_structure")).filter("truncated").select("hocr_id", "page_idx")


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of truncated pages of each source."""
    return truncation.truncation_shares(table(spark, sf_dir, "hocr_structure"))


def _p6(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {"ocr_words": (table(spark, sf_dir, "ocr_words"), "word_id", "ocrx_word"), "word_csv": (table(spark, sf_dir, "word_csv"), "csv_id", "word")}
    return lookalikes.inconsistent_words(sources, table(spark, sf_dir, "lexicon").select("word"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored words that are not in the consistent form."""
    return _p6(spark, sf_dir).select("table_name", "row_id")


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of each such row's word."""
    return _p6(spark, sf_dir)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.with_token_ids(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture and how often each is used."""
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixing.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with unfilled fields or junk in place of content."""
    judged = residue.with_verdict(table(spark, sf_dir, "documents").select("doc_id", "text", "volume_id"))
    return judged.filter("verdict.is_junk").select("doc_id")


def p9_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay."""
    return residue.without_residue(table(spark, sf_dir, "documents").select("doc_id", "text", "volume_id")).select("doc_id")


def p5_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with whether and by what sign it was found cut off."""
    return truncation.judged_pages(table(spark, sf_dir, "hocr_structure"))


QUERIES = {"p1_found": p1_found, "p1_text": p1_text, "p3_found": p3_found, "p3_pieces": p3_pieces, "p3_rejoined": p3_rejoined, "p4_found": p4_found, "p4_text": p4_text, "p5_found": p5_found, "p5_reasons": p5_reasons, "p5_shares": p5_shares, "p6_found": p6_found, "p6_forms": p6_forms, "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_kept": p9_kept}

P3_SQL = """
SELECT hocr_id, (i - 1)::INTEGER AS page_idx
FROM (SELECT hocr_id, pages_html, row_number() OVER (PARTITION BY hocr_id ORDER BY loaded_at DESC) AS _r FROM hocr_structure), unnest(range(1, len(pages_html) + 1)) AS t(i)
WHERE _r = 1 AND length(pages_html[i]) > 16000
"""

ORACLE = {"p3_found": P3_SQL, "p3_rejoined": f"SELECT hocr_id, page_idx, true AS within, true AS rejoins FROM ({P3_SQL})"}
