"""Files in folders as rows: listings, whole texts, lines, configuration, and what a run left behind."""

from __future__ import annotations

import fnmatch
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as tx

log = logging.getLogger("foliant")

QUOTA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("quota_type", T.StringType()), T.StructField("quota_limit", T.LongType()), T.StructField("reset_time", T.StringType()), T.StructField("reset_timezone", T.StringType()),
])


def listing(spark: SparkSession, folder: str, recursive: bool = True, pattern: str | None = None) -> DataFrame:
    """path, dir, name, ext, size, mtime of the files in a folder; contents are not read. Order by path where order counts."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    path = F.col("path")
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    folder_name = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return r.load(folder).select(path, folder_name.alias("dir"), name.alias("name"), tx.extension(name).alias("ext"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def images(spark: SparkSession, folder: str, step: str = "recognise", recursive: bool = False) -> DataFrame:
    """Page images that a step takes; a path of a file gives itself, whatever its extension."""
    found = listing(spark, folder, recursive)
    return found if Path(folder).is_file() else found.filter(tx.is_image(F.col("name"), step))


def matching(spark: SparkSession, pattern: str) -> DataFrame:
    """path, name, content of the files that a pattern names; ``**`` stands for any folders. Order by path where order counts.

    A pattern that nothing matches gives no rows. Files under the folder before the first wildcard are
    listed by the file system that its scheme names, and their contents read only where they match.
    """
    steps = pattern.split("/")
    first = next((k for k, x in enumerate(steps) if any(c in x for c in "*?[")), len(steps) - 1)
    root = "/".join(steps[:first]) or ("/" if pattern.startswith("/") else ".")
    rule = "".join("(?:[^/]+/)*" if x == "**" else fnmatch.translate(x)[len("(?s:") :].rsplit(")", 1)[0].replace(".*", "[^/]*").replace("(?>", "(?:") + ("/" if k < len(steps) - first - 1 else "") for k, x in enumerate(steps[first:]))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    try:
        every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException:  # no such folder
        return spark.createDataFrame([], "path string, name string, content binary")
    return every.filter(F.col("path").rlike("/" + rule + "$")).select("path", name.alias("name"), "content")


def single_pairs(files: DataFrame) -> DataFrame:
    """dir, image, hocr of folders that hold exactly one image and one hOCR file; others are left out."""
    image = F.when(tx.is_image(F.col("name")), F.col("name"))
    hocr = F.when(F.col("name").endswith(".hocr"), F.col("name"))
    g = files.groupBy("dir").agg(F.count(image).alias("_i"), F.count(hocr).alias("_h"), F.min(image).alias("image"), F.min(hocr).alias("hocr"))
    return g.filter("_i = 1 AND _h = 1").drop("_i", "_h")


def texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and whole text of UTF-8 files."""
    return spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def text_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, line_no, line: lines with their line end kept, counted from 0; an empty text has none."""
    t = F.regexp_replace(text, r"\n\z", "")
    parts = F.split(t, "\n")
    ended = F.col(text).endswith("\n")
    rows = df.filter(F.length(text) > 0).select(*keys, F.posexplode(parts).alias("line_no", "line"), F.size(parts).alias("_n"), ended.alias("_e"))
    return rows.select(*keys, "line_no", F.concat("line", F.when((F.col("line_no") < F.col("_n") - 1) | F.col("_e"), "\n").otherwise("")).alias("line"))


def head_lines(text: Column, n: int = 25, compat: bool = False) -> Column:
    """The first n lines; compat: a text of fewer is an error when the row is read."""
    parts = F.split(text, "\n")
    got = F.array_join(F.slice(parts, 1, n), "\n")
    return F.when(F.size(parts) < n, F.raise_error(F.lit(f"fewer than {n} lines")).cast("string")).otherwise(got) if compat else got


def quota_config(spark: SparkSession, path: str) -> DataFrame:
    """A quota configuration as rows; missing or broken files give none, and tracking is off."""
    try:
        text = spark.read.text(path, wholetext=True).first()[0]
        models = json.loads(text).get("models", {})
        rows = [(m, q, int(v["limit"]), v.get("reset_time"), v.get("reset_timezone")) for m, c in models.items() for q, v in (c.get("quotas") or {}).items()]
    except (AnalysisException, ValueError, AttributeError, KeyError, TypeError) as e:
        log.warning("no quotas from %s: %s", path, e)
        rows = []
    return spark.createDataFrame(rows, QUOTA)


def last_temperature(text: Column) -> Column:
    """Temperature that a page's side file keeps; null where it is empty, no number or outside 0..1."""
    t = tx.strip(text).try_cast("double")
    return F.when(t.between(0.0, 1.0), t)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the immediate subfolders, sorted; also of empty ones, which a listing of files does not show."""
    at, fs = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are files, in their order; others are left out with a warning."""
    out = []
    for p in paths:
        at, fs = _file_system(spark, p)
        if fs.exists(at) and fs.getFileStatus(at).isFile():
            out.append(p)
        else:
            log.warning("no file %s", p)
    return out


def export_texts(df: DataFrame, folder: str, name: str, text: str) -> None:
    """One file of each row's text in a folder that all executors share, written where the rows are."""

    def write(rows) -> None:
        for r in rows:
            p = Path(folder) / r[name]
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(r[text], "utf-8")

    df.select(name, text).foreachPartition(write)


def write_document(parts: DataFrame, path: str, order: list[str], text: str, head: str = "", tail: str = "", by: str = "") -> int:
    """One file of all rows' texts in order, part after part: never more than a partition of them in one place. Gives their number."""
    p, n = Path(path), 0
    p.parent.mkdir(parents=True, exist_ok=True)
    with p.open("w", encoding="utf-8") as out:
        out.write(head)
        for r in parts.filter(F.col(text).isNotNull()).orderBy(*order).select(text).toLocalIterator():
            out.write((by if n else "") + r[0])
            n += 1
        out.write(tail)
    return n
