"""Which file of a batch is the original and which the corrected one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def role_of(name: Column) -> Column:
    """original, proofread or corrected by a file's name; null for other names."""
    low = F.lower(name)
    plain = low.endswith(".hocr") & ~low.contains("proofread") & ~low.contains("corrected")
    return F.when(plain, "original").when(low.endswith("-corrected.hocr"), "corrected").when(low.endswith("-proofread.hocr"), "proofread")


def resolved(files: DataFrame, batch: list[str], name: str, mtime: str, role: Column | None = None) -> DataFrame:
    """batch, original, proofread, n_files: the oldest original and the newest corrected, else proofread file.

    A batch of a single file, or with originals only, has that file as proofread and no original. Of equal
    times the first name counts. Null names are none.
    """
    role = role_of(F.col(name)) if role is None else role
    f = files.filter(F.col(name).isNotNull()).select(*batch, F.col(name).alias("_name"), F.col(mtime).alias("_at"), role.alias("_role"))
    of = lambda r, at: F.min(F.when(F.col("_role") == r, F.struct(at.alias("at"), F.col("_name").alias("name"))))["name"]
    time = F.unix_micros(F.col("_at").cast("timestamp"))
    g = f.groupBy(*batch).agg(
        F.count("*").alias("n_files"), F.min("_name").alias("_only"), of("original", time).alias("_o"), of("corrected", -time).alias("_c"), of("proofread", -time).alias("_p"),
    )
    later = F.coalesce("_c", "_p")
    single = F.col("n_files") == 1
    proofread = F.when(single, F.col("_only")).otherwise(F.coalesce(later, F.col("_o")))
    original = F.when(~single & later.isNotNull(), F.col("_o"))
    return g.select(*batch, original.alias("original"), proofread.alias("proofread"), "n_files")


def base_name(source: Column, proofread: Column, folder: Column) -> Column:
    """Name of a report: the source's stem, else the proofread file's without its role, else the folder's."""
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    plain = stem(proofread)
    for suffix in ("_proofread", "_corrected", "_edited", "_page1", "_page_1"):  # fixed values
        plain = F.replace(plain, F.lit(suffix), F.lit(""))
    return F.coalesce(stem(source), plain, folder)
