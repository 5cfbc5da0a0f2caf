"""Batches of pages, and pages paired with images by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.session import kept


def batch_of(position: Column, size: int) -> Column:
    """Number of the batch that a 1-based position falls into."""
    if size <= 0:
        raise ValueError("a batch holds at least one page")
    return F.floor((position - 1) / size).cast("int")


def numbered(df: DataFrame, group: list[str], order: list[str], out: str = "position") -> DataFrame:
    """Rows with their 1-based position within a group; the order should tell all rows of a group apart.

    A group may hold any share of the rows: rows are put into ranges of (group, order), numbered within
    their range, and raised by what the group has in the ranges before, of which there are few.
    """
    ranged = kept(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    within = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    sizes = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    raised = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_range").alias("_at"), before.alias("_before"))
    same = F.col("_range") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    full = ranged.withColumn("_within", within).join(raised, same)
    return full.withColumn(out, (F.col("_within") + F.col("_before")).cast("int")).select(*df.columns, out)


def batch_ranges(counts: DataFrame, keys: list[str], n: str, size: int) -> DataFrame:
    """keys, batch_idx, start, end (half-open, from 0): the ranges of ``size`` that cover 0..n; the last may be short."""
    if size <= 0:
        raise ValueError("a batch holds at least one page")
    starts = F.sequence(F.lit(0), F.col(n).cast("int") - 1, F.lit(size))
    made = counts.filter(F.col(n) > 0).select(*keys, n, F.posexplode(starts).alias("batch_idx", "start"))
    return made.select(*keys, "batch_idx", "start", F.least(F.col("start") + size, F.col(n)).cast("int").alias("end"))


def zipped(left: DataFrame, right: DataFrame, group: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of the left with the k-th of the right in each group; columns of both but the group must differ."""
    a = numbered(left, group, left_order, "position")
    b = numbered(right, group, right_order, "position")
    return a.join(b, [*group, "position"])


def count_mismatches(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """group, n_left, n_right of groups whose sides have different numbers of rows: they can't be zipped."""
    a = left.groupBy(*group).agg(F.count("*").alias("n_left"))
    b = right.groupBy(*group).agg(F.count("*").alias("n_right"))
    both = a.join(b, group, "full").na.fill(0, ["n_left", "n_right"])
    return both.filter(F.col("n_left") != F.col("n_right"))


def selected_range(df: DataFrame, group: list[str], order: list[str], first: int, last: int | None) -> DataFrame:
    """Rows at the 1-based positions first..last, both included; without a last one to the end."""
    at = F.col("position")
    return numbered(df, group, order).filter((at >= first) & (at <= last) if last is not None else at >= first)


def interleaved(df: DataFrame, order: str, left: str, right: str) -> DataFrame:
    """Left and right halves as rows of their own, left first: (order, side, value)."""
    return df.select(order, F.posexplode(F.array(left, right)).alias("side", "value"))


def batch_names(ranges: DataFrame, name: str) -> DataFrame:
    """Ranges with the folder and hOCR name of their batch."""
    first, last = F.col("start") + 1, F.col("end")
    return ranges.withColumn("folder", tx.batch_folder(first, last)).withColumn("file", tx.batch_file(F.col(name), first, last))
