"""Line differences between an original and its corrected version."""

from __future__ import annotations

import difflib
import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as tx


def unified(original: str, proofread: str, from_name: str = "original", to_name: str = "proofread", context: int = 3, keep_ends: bool = True) -> list[str]:
    """Lines of a unified difference; with ``keep_ends`` content lines keep their line ends."""
    a, b = original.splitlines(keepends=keep_ends), proofread.splitlines(keepends=keep_ends)
    return list(difflib.unified_diff(a, b, fromfile=from_name, tofile=to_name, lineterm="", n=context))


def line_differences(pairs: DataFrame, keys: list[str], original: str, proofread: str, context: int = 3, compat: bool = True) -> DataFrame:
    """keys, ord, line, cls: each line of the difference of two texts, with its class; equal texts have none.

    compat: content lines keep their line end, as the reports have them. Null texts count as empty.
    """
    schema = T.StructType([*pairs.select(*keys).schema.fields, T.StructField("ord", T.IntegerType()), T.StructField("line", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for values, x, y in zip(b[keys].itertuples(index=False, name=None), b["_a"], b["_b"], strict=True):
                rows += [(*values, i, t) for i, t in enumerate(unified(x or "", y or "", context=context, keep_ends=compat))]
            yield pd.DataFrame(rows, columns=schema.names)

    changed = pairs.select(*keys, F.coalesce(original, F.lit("")).alias("_a"), F.coalesce(proofread, F.lit("")).alias("_b")).filter("_a != _b")
    return changed.mapInPandas(run, schema).withColumn("cls", tx.diff_class(F.col("line")))


def batch_report(lines: DataFrame, keys: list[str], batch: str, file: str) -> DataFrame:
    """keys, text: the part of a master difference for each batch, under its header."""
    body = F.array_sort(F.collect_list(F.struct("ord", "line")))
    g = lines.groupBy(*keys, batch, file).agg(F.concat_ws("\n", F.transform(body, lambda x: x["line"])).alias("_t"))
    header = F.concat(F.lit("=== "), F.col(batch), F.lit(" / "), F.col(file), F.lit(" ===\n"))
    return g.select(*keys, batch, file, F.concat(header, F.lit("\n"), F.col("_t"), F.lit("\n")).alias("text"))


def html_rows(lines: DataFrame) -> DataFrame:
    """Lines of differences with their row of an HTML report."""
    shown = tx.html_escape(F.regexp_replace("line", r"\s+$", ""))
    return lines.withColumn("html", F.concat(F.lit('<div class="diff-line diff-'), F.col("cls"), F.lit('">'), shown, F.lit("</div>")))


def report_rows(lines: DataFrame, batch: str, file: str) -> DataFrame:
    """(batch, ord, html): rows of a report page over all batches, each under its header and with an empty row behind it."""
    rows = html_rows(lines).select(batch, "ord", "html")
    head = lines.select(batch, file).distinct().select(batch, F.lit(-1).alias("ord"), F.concat(F.lit("=== "), F.col(batch), F.lit(" / "), F.col(file), F.lit(" ===")).alias("line"), F.lit("header").alias("cls"))
    end = lines.groupBy(batch).agg((F.max("ord") + 1).alias("ord")).select(batch, "ord", F.lit("").alias("line"), F.lit("context").alias("cls"))
    return rows.unionByName(html_rows(head.unionByName(end)).select(batch, "ord", "html"))


#: Colours of a report's rows by class: text, ground.
COLOURS = {"header": ("#666", "#eee"), "added": ("#14532d", "#dcfce7"), "removed": ("#7f1d1d", "#fee2e2"), "context": ("#333", "#fff"), "info": ("#1e3a8a", "#dbeafe")}


def report_frame(title: str) -> tuple[str, str]:
    """What stands before and behind the rows of a report page: title, styles, a legend."""
    name = html.escape(title)
    styles = "\n".join(f".diff-{k} {{ color: {a}; background: {b}; }}" for k, (a, b) in COLOURS.items())
    legend = " ".join(f'<span class="diff-{k}">{k}</span>' for k in COLOURS)
    head = f"""<!DOCTYPE html>
<html>
<head>
<meta charset="utf-8">
<title>Diff Report: {name}</title>
<style>
body {{ font: 12px monospace; margin: 20px; }}
.diff-line {{ white-space: pre; padding: 2px 5px; }}
{styles}
</style>
</head>
<body>
<h1>Diff Report: {name}</h1>
<p>{legend}</p>
<div class="diff-container">
"""
    return head, "\n</div>\n</body>\n</html>\n"


def side_by_side(original: str, proofread: str) -> str:
    """Two texts beside each other as an HTML table."""
    return difflib.HtmlDiff().make_file(original.splitlines(), proofread.splitlines())
