"""Queries of problem 2: what differs between the two systems' copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.reconcile import table_differences
from foliant.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every missing row and every differing column of the current rows of both tables."""
    parts = []
    for name, key, digests in (("hocr_structure", "hocr_id", ("pages_html", "prefix_before_body")), ("ocr_words", "word_id", ())):
        found = table_differences(table(spark, sf_dir, name), table(spark, sf_dir, f"{name}_copy"), key, digests=digests)
        parts.append(found.select(F.lit(name).alias("dataset"), "row_id", "field", "finding"))
    return parts[0].unionByName(parts[1])


def p2_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of findings of each dataset, field and kind."""
    return p2_found(spark, sf_dir).groupBy("dataset", "field", "finding").agg(F.count("*").alias("n"))


def _sql(name: str, key: str, fields: list[str]) -> str:
    side = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY loaded_at DESC) AS _r FROM {t}) WHERE _r = 1"
    a, b = side.format(k=key, t=name), side.format(k=key, t=f"{name}_copy")
    cells = " UNION ALL ".join(f"SELECT a.{key} AS row_id, '{f}' AS field, 'differs' AS finding FROM a JOIN b ON a.{key} = b.{key} WHERE a.{f} IS DISTINCT FROM b.{f}" for f in fields)
    return (
        f"SELECT '{name}' AS dataset, * FROM (WITH a AS ({a}), b AS ({b}) "
        f"SELECT {key} AS row_id, '*' AS field, 'only_left' AS finding FROM a WHERE {key} NOT IN (SELECT {key} FROM b) "
        f"UNION ALL SELECT {key}, '*', 'only_right' FROM b WHERE {key} NOT IN (SELECT {key} FROM a) UNION ALL {cells})"
    )


HOCR_FIELDS = ["volume_id", "batch_dir", "file_name", "role", "ocr_system", "prefix_before_body", "body_open_tag", "pages_html", "status", "mtime"]
WORD_FIELDS = ["hocr_id", "volume_id", "page_idx", "line_idx", "word_idx", "ocrx_word", "bbox", "x_wconf", "bold", "italic", "superscript"]

P2_SQL = f"{_sql('hocr_structure', 'hocr_id', HOCR_FIELDS)} UNION ALL {_sql('ocr_words', 'word_id', WORD_FIELDS)}"

QUERIES = {"p2_found": p2_found, "p2_summary": p2_summary}
ORACLE = {
    "p2_found": P2_SQL,
    "p2_summary": f"SELECT dataset, field, finding, count(*) AS n FROM ({P2_SQL}) GROUP BY dataset, field, finding",
}
