"""Queries on files and their names: heads, comments, whole documents, prompts, side files, recognition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import hocr, profile, render
from foliant.plans.page_queries import FILES, LINES, PAGES, WORDS, current_files, current_lines, current_pages, current_words
from foliant.sources.tables import current_rows, table


def _digest(c):
    return F.md5(c.cast("binary")).alias("digest")


def file_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of each file, by its digest; null where it has none."""
    return current_files(spark, sf_dir, _digest(tx.head_of(F.col("prefix_before_body"))))


def commented_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a comment on their number and image behind the first division."""
    p = current_pages(spark, sf_dir)
    return p.select("hocr_id", "page_idx", _digest(hocr.with_page_comment(F.col("html"), F.col("page_idx") + 1, F.concat(F.lit("p$"), F.col("page_idx").cast("string"), F.lit(".png")))))


def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files put together from their parts."""
    pages = F.filter(F.coalesce("pages_html", F.array().cast("array<string>")), lambda p: p.isNotNull())
    return current_files(spark, sf_dir, _digest(hocr.assembled(F.col("prefix_before_body"), F.col("body_open_tag"), pages)))


def first_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first whole number in each file's name."""
    return current_files(spark, sf_dir, tx.first_integer(F.col("file_name")).alias("number"))


def boxes_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of each line's box as an overview prints them."""
    b = F.col("bbox")
    corners = F.array(*[(c + F.lit(0.5)).cast("double") for c in (b["x0"], b["y0"], b["x1"], b["y1"])])
    return current_lines(spark, sf_dir).select("line_id", tx.box_text(F.when(b.isNotNull(), corners)).alias("corners"))


def proofread_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruction for each page as a draft: its length, and how much of it is the draft."""
    p = current_pages(spark, sf_dir)
    prompt = tx.proofread_prompt(F.col("html"), "hocr")
    return p.select("hocr_id", "page_idx", prompt.endswith(F.col("html")).alias("ends_with_draft"), (F.char_length(prompt) > F.char_length("html")).alias("has_instruction"))


def side_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of what a run leaves beside each file: answers, temperatures, failed attempts, results."""
    at = F.col("mtime").cast("timestamp")
    name = F.coalesce("file_name", F.lit("none.hocr"))
    f = current_rows(table(spark, sf_dir, "hocr_structure"), "hocr_id", ["hocr_id", "file_name", "mtime"]).filter("mtime IS NOT NULL")
    return f.select("hocr_id", tx.answer_name(at).alias("answer"), tx.answer_name(at, "prompt").alias("prompt"), tx.proofread_name(name).alias("result"), tx.temperature_file(name).alias("temperature"), tx.failed_file(name, at, F.lit(2)).alias("failed"), tx.failed_file(name, at, F.lit(2), "err").alias("error"), tx.result_name(at, "md").alias("recognised"))


def gap_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of each page as the recognition step tells them: by the distance to the last bottom, up or down."""
    lines = current_lines(spark, sf_dir).filter(F.col("line_idx").isNotNull()).select("hocr_id", "page_idx", "line_idx", F.col("bbox.y0").alias("y_top"), F.col("bbox.y1").alias("y_bottom"))
    return render.recognised_paragraphs(lines, ["hocr_id", "page_idx"]).groupBy("hocr_id", "page_idx").agg((F.max("paragraph") + 1).alias("n_paragraphs"))


def column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean brightness of each column of two rows of pixels, made of an embedding and its reverse."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(F.abs(x) * 400).cast("int")).alias("p"))
    return v.select("vec_id", F.aggregate(profile.column_means(F.array("p", F.reverse("p"))), F.lit(0.0), lambda a, x: a + x).alias("total"))


def recognised_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's recognition output from its lines and words: how many lines and words it names."""
    lines = current_lines(spark, sf_dir).filter("line_idx IS NOT NULL AND hocr_id IS NOT NULL").select(F.col("hocr_id").alias("path"), F.col("page_idx").alias("page_no"), "line_idx", "bbox", F.col("bbox.y0").alias("y"))
    words = current_words(spark, sf_dir).filter("hocr_id IS NOT NULL").select(F.col("hocr_id").alias("path"), F.col("page_idx").alias("page_no"), F.col("word_id").alias("word_idx"), F.col("ocrx_word").alias("content"), "bbox", F.col("bbox.y0").alias("y"), (F.col("x_wconf") / 100).alias("confidence"))
    pages = lines.select("path", "page_no").distinct().select("*", F.lit("a.png").alias("filename"), F.lit(1000.0).alias("width"), F.lit(1400.0).alias("height"))
    count = lambda what: (F.size(F.split("text", what)) - 1).cast("long")
    return render.recognised_hocr(pages, lines, words).select(F.col("path").alias("hocr_id"), F.col("page_no").alias("page_idx"), count('class="ocr_line"').alias("n_lines"), count('class="ocrx_word"').alias("n_words"))


QUERIES = {"file_heads": file_heads, "commented_pages": commented_pages, "whole_files": whole_files, "first_numbers": first_numbers, "boxes_as_text": boxes_as_text, "proofread_prompts": proofread_prompts, "side_names": side_names, "gap_paragraphs": gap_paragraphs, "column_means": column_means, "recognised_pages": recognised_pages}

_STEM = "regexp_replace(coalesce(file_name, 'none.hocr'), '\\.hocr$', '')"
ORACLE = {
    "file_heads": f"SELECT hocr_id, md5(nullif(regexp_extract(prefix_before_body, '(?is)<head\\b.*?</head>'), '')) AS digest FROM {FILES}",
    "commented_pages": f"""
        SELECT hocr_id, page_idx, md5(CASE WHEN tag = '' THEN html ELSE substr(html, 1, strpos(html, tag) + length(tag) - 1) || chr(10) || '<!-- overall page ' || (page_idx + 1) || ': source image p$' || page_idx || '.png -->' || substr(html, strpos(html, tag) + length(tag)) END) AS digest
        FROM (SELECT *, regexp_extract(html, '(?i)<div\\b[^>]*>') AS tag FROM {PAGES})""",
    "whole_files": f"SELECT hocr_id, md5(coalesce(prefix_before_body, '') || chr(10) || coalesce(body_open_tag, '<body>') || chr(10) || coalesce(array_to_string(list_filter(pages_html, lambda p: p IS NOT NULL), chr(10)), '') || chr(10) || '</body>' || chr(10) || '</html>' || chr(10)) AS digest FROM {FILES}",
    "first_numbers": f"SELECT hocr_id, nullif(regexp_extract(file_name, '[0-9]+'), '')::INTEGER AS number FROM {FILES}",
    "boxes_as_text": f"SELECT line_id, CASE WHEN bbox IS NULL THEN 'N/A' ELSE '[' || (bbox.x0 + 0.5) || ', ' || (bbox.y0 + 0.5) || '], [' || (bbox.x1 + 0.5) || ', ' || (bbox.y1 + 0.5) || ']' END AS corners FROM {LINES}",
    "proofread_prompts": f"SELECT hocr_id, page_idx, true AS ends_with_draft, true AS has_instruction FROM {PAGES}",
    "side_names": f"""
        SELECT hocr_id, 'output-' || m || '.txt' AS answer, 'prompt-' || m || '.txt' AS prompt, s || '-proofread.hocr' AS result, s || '-proofread.lasttemp' AS temperature,
          s || '-proofread.hocr.' || m || '.2.failed' AS failed, s || '-proofread.err.' || m || '.2.failed' AS error, 'recognised-' || strftime(mtime, '%Y-%m-%dT%H-%M') || '.md' AS recognised
        FROM (SELECT *, {_STEM} AS s, strftime(mtime, '%Y-%m-%dT%H%M') AS m FROM {FILES} WHERE mtime IS NOT NULL)""",
    "gap_paragraphs": f"""
        SELECT hocr_id, page_idx, (sum(CASE WHEN abs(y0 - last) > 20 THEN 1 ELSE 0 END) + 1)::BIGINT AS n_paragraphs FROM (
          SELECT hocr_id, page_idx, bbox.y0 AS y0, last_value(bbox.y1 IGNORE NULLS) OVER (PARTITION BY hocr_id, page_idx ORDER BY line_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM {LINES} WHERE line_idx IS NOT NULL) GROUP BY ALL""",
    "column_means": "SELECT vec_id, list_sum(list_transform(embedding, lambda x: floor(abs(x) * 400)))::DOUBLE AS total FROM embeddings",
    "recognised_pages": f"""
        SELECT p.hocr_id, p.page_idx, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_words, 0)::BIGINT AS n_words FROM (SELECT DISTINCT hocr_id, page_idx FROM {LINES} WHERE line_idx IS NOT NULL AND hocr_id IS NOT NULL) p
        LEFT JOIN (SELECT hocr_id, page_idx, count(*) AS n_lines FROM {LINES} WHERE bbox IS NOT NULL AND line_idx IS NOT NULL GROUP BY ALL) USING (hocr_id, page_idx)
        LEFT JOIN (SELECT l.hocr_id, l.page_idx, count(*) AS n_words FROM {LINES} l JOIN {WORDS} w ON l.hocr_id = w.hocr_id AND l.page_idx = w.page_idx AND abs(l.bbox.y0 - w.bbox.y0) < 5 WHERE l.line_idx IS NOT NULL GROUP BY ALL) USING (hocr_id, page_idx)""",
}
