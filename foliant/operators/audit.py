"""Audit of corrected files: missing, empty or of implausible size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as tx


def size_class(proof: Column, original: Column, percent: int = 10) -> Column:
    """``zero size``, ``no original``, ``zero original``, ``out of tolerance`` or ``ok``."""
    if not 1 <= percent <= 49:
        raise ValueError("the tolerance is 1 to 49 percent")
    low = F.greatest((original * (1 - percent / 100)).cast("long"), F.lit(1))
    high = (original * (1 + percent / 100)).cast("long")
    return (
        F.when(proof == 0, "zero size").when(original.isNull(), "no original").when(original == 0, "zero original")
        .when((proof < low) | (proof > high), "out of tolerance").otherwise("ok")
    )


def audited(files: DataFrame, folder: str, name: str, size: str, percent: int = 10, pattern: str = r"-proofread\.hocr$") -> DataFrame:
    """folder, name, original_name, size, original_size, status of each corrected file; folders without one are ``missing``."""
    f = files.select(F.col(folder).alias("folder"), F.col(name).alias("name"), F.col(size).cast("long").alias("size"))
    matches = f.filter(F.col("name").rlike(pattern)).withColumn("original_name", tx.original_name(F.col("name")))
    originals = f.select("folder", F.col("name").alias("original_name"), F.col("size").alias("original_size")).dropDuplicates(["folder", "original_name"])
    held = matches.join(originals, ["folder", "original_name"], "left").withColumn("status", size_class(F.col("size"), F.col("original_size"), percent))
    none = f.select("folder").distinct().join(matches.select("folder").distinct(), "folder", "left_anti")
    missing = none.select("folder", F.lit(None).cast("string").alias("original_name"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("original_size"), F.lit("missing").alias("status"))
    return held.select(missing.columns).unionByName(missing)


def pending(files: DataFrame, folder: str, name: str) -> DataFrame:
    """Folders that still hold exactly one hOCR file: a finished one has two."""
    hocr = files.filter(F.col(name).endswith(".hocr"))
    return hocr.groupBy(folder).agg(F.count("*").alias("n"), F.min(name).alias(name)).filter("n = 1").drop("n")
