"""Page geometry as column expressions: boxes are structs of x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_centred(line: Column, page: Column, off: float = 0.1, wide: float = 0.8) -> Column:
    """Its middle within a tenth of the page's width from the page's middle, and narrower than four fifths."""
    width = page["x1"] - page["x0"]
    apart = F.abs((line["x0"] + line["x1"]) / 2 - (page["x0"] + page["x1"]) / 2)
    return F.coalesce((apart < off * width) & ((line["x1"] - line["x0"]) < wide * width), F.lit(False))


def is_new_paragraph(before: Column, line: Column, factor: float = 1.5) -> Column:
    """The gap to the line before is more than ``factor`` times that line's height; false without a box."""
    return F.coalesce((line["y0"] - before["y1"]) > factor * (before["y1"] - before["y0"]), F.lit(False))


def is_indented(line: Column, usual_x: Column, by: int = 20) -> Column:
    return F.coalesce(F.abs(line["x0"] - usual_x) > by, F.lit(False))


def in_foot(line: Column, page: Column, share: float = 0.75) -> Column:
    """In the lowest quarter of the page."""
    return F.coalesce(line["y0"] >= share * page["y1"], F.lit(False))


def usual_x(lines: DataFrame, page: list[str], order: str, x: Column) -> DataFrame:
    """(page, usual_x): the most frequent left edge, rounded half-even to ten pixels; of ties the first seen."""
    rounded = (F.bround(x / 10) * 10).cast("int")
    counts = lines.filter(x.isNotNull()).groupBy(*page, rounded.alias("usual_x")).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counts.groupBy(*page).agg(F.max_by("usual_x", F.struct(F.col("_n"), -F.col("_first"))).alias("usual_x"))


def paragraphs(lines: DataFrame, page: list[str], order: str, starts: Column) -> DataFrame:
    """Lines with the running number of their paragraph; ``starts`` may use the columns ``_box`` and ``_before``."""
    w = Window.partitionBy(*page).orderBy(order)
    return lines.withColumn("_before", F.lag("_box").over(w)).withColumn("paragraph", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_before")


def joined(df: DataFrame, keys: list[str], order: str, text: str, by: str, out: str = "text") -> DataFrame:
    """Texts of each group joined in order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*keys).agg(F.concat_ws(by, F.transform(parts, lambda p: p["t"])).alias(out))
