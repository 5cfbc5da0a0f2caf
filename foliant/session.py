"""Session factory for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators expect (UTC, adaptive execution)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliant")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only in a local session, as in tests, one of its own stands in; a cluster without one is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.environ.get("FOLIANT_CHECKPOINT_DIR")
        if not found:
            found = tempfile.mkdtemp(prefix="foliant-")
            atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Tables kept by application, until they are discarded.
_KEPT: dict[str, list[str]] = {}


def kept(df: DataFrame) -> DataFrame:
    """The rows written once as a table in the shared folder, and read from there: cuts the lineage.

    Unlike a checkpoint the table is compressed, has statistics, and only the columns in use are read.
    Any executor may be lost afterwards. The table stays until ``discard_kept``, or until the folder is
    cleared, like a checkpoint's: a query's rows are read from it when they are used.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/foliant/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def discard_kept(spark: SparkSession) -> int:
    """Delete the tables that this application keeps, when the rows built on them have been used; gives their number."""
    paths = _KEPT.pop(spark.sparkContext.applicationId, [])
    context = spark.sparkContext
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)
