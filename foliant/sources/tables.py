"""Reading the tables and picking the current row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table (file or folder) of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def newest(df: DataFrame, key: str, loaded: str = "loaded_at") -> DataFrame:
    """(key, newest load time): two narrow columns, combined before they are shuffled."""
    return df.groupBy(key).agg(F.max(loaded).alias(loaded))


def current_rows(df: DataFrame, key: str, columns: Sequence[str | Column], loaded: str = "loaded_at") -> DataFrame:
    """The current delivery of each key: greatest ``loaded``; of ties the greatest row value.

    Deliveries are combined on the map side, so one key with a third of all rows costs no more than
    one row per input partition. A null key counts as a key of its own; a null load time is older
    than any other. An empty table gives an empty result.
    """
    cols = [F.col(c).alias(c) if isinstance(c, str) else c for c in columns]
    packed = df.select(F.col(key).alias("_key"), F.struct(F.col(loaded).alias("_at"), *cols).alias("_row"))
    best = packed.groupBy("_key").agg(F.max("_row").alias("_row"))
    names = [c if isinstance(c, str) else None for c in columns]
    fields = [f.name for f in best.schema["_row"].dataType.fields if f.name != "_at"]
    assert all(n is None or n in fields for n in names)
    return best.select(F.col("_key").alias(key), *[F.col("_row")[f].alias(f) for f in fields if f != key])


def only_current(findings: DataFrame, source: DataFrame, key: str, loaded: str = "loaded_at") -> DataFrame:
    """Keep findings (key, loaded, ...) made on the current delivery of their key.

    The wide rows are worked on where they are read; only findings and two narrow columns move.
    """
    now = newest(source, key, loaded).withColumnRenamed(key, "_key").withColumnRenamed(loaded, "_at")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(loaded).eqNullSafe(F.col("_at"))
    return findings.join(now, same, "inner").drop("_key", "_at")
