"""Steps that need something outside: recognition services, language models, image codecs.

Each takes a factory that makes its client in the worker, so that tests and other services plug in; no
client, key or codec is part of this package. A failed row is an error row, not a failed job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ANSWER = T.StructType([T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), T.StructField("retry_delay", T.IntegerType()), T.StructField("text", T.StringType())])
RECOGNISED = T.StructType([
    T.StructField("page_idx", T.IntegerType()), T.StructField("width", T.DoubleType()), T.StructField("height", T.DoubleType()),
    T.StructField("lines", T.ArrayType(T.StructType([T.StructField("content", T.StringType()), T.StructField("polygon", T.ArrayType(T.DoubleType()))]))),
    T.StructField("words", T.ArrayType(T.StructType([T.StructField("content", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("polygon", T.ArrayType(T.DoubleType()))]))),
])
PROFILE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("brightness", T.ArrayType(T.DoubleType())), T.StructField("edges", T.ArrayType(T.IntegerType()))])


def _mapped(df: DataFrame, keys: list[str], inputs: list[str], schema: T.StructType, factory: Callable[[], Any], call: Callable[[Any, tuple], list[tuple]], failed: Callable[[Exception], tuple]) -> DataFrame:
    full = T.StructType([*df.select(*keys).schema.fields, *schema.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for b in batches:
            rows = []
            for key, row in zip(b[keys].itertuples(index=False, name=None), b[inputs].itertuples(index=False, name=None), strict=True):
                try:
                    got = call(client, row)
                except Exception as e:  # noqa: BLE001
                    got = [failed(e)]
                rows += [(*key, *r) for r in got]
            yield pd.DataFrame(rows, columns=full.names)

    return df.select(*keys, *[c for c in inputs if c not in keys]).mapInPandas(run, full)


def answers(df: DataFrame, keys: list[str], inputs: list[str], factory: Callable[[], Callable[..., str]]) -> DataFrame:
    """keys, status, error, retry_delay, text: a language model's answer to each row's inputs (prompt, images)."""
    return _mapped(df, keys, inputs, ANSWER, factory, lambda ask, row: [("ok", None, 0, ask(*row))], lambda e: ("error_429" if getattr(e, "code", None) == 429 else "error_503" if getattr(e, "code", None) == 503 else "error", str(e), 120 if getattr(e, "code", None) == 503 else 60 if getattr(e, "code", None) else 0, ""))


def recognised(df: DataFrame, keys: list[str], content: str, factory: Callable[[], Callable[[bytes], list[tuple]]]) -> DataFrame:
    """keys, page_idx, width, height, lines, words: what a recognition service reads on each image."""
    return _mapped(df, keys, [content], RECOGNISED, factory, lambda read, row: read(row[0]), lambda e: (None, None, None, None, None))


def profiles(df: DataFrame, keys: list[str], content: str, factory: Callable[[], Callable[[bytes], tuple]]) -> DataFrame:
    """keys, width, height, brightness, edges: column profiles of each scan, from an image reader."""
    return _mapped(df, keys, [content], PROFILE, factory, lambda read, row: [read(row[0])], lambda e: (None, None, None, None))


def converted(df: DataFrame, keys: list[str], content: str, factory: Callable[[], Callable[[bytes], bytes]]) -> DataFrame:
    """keys, content, error: images through a codec or filter (enhance, crop, convert, page of a PDF)."""
    schema = T.StructType([T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
    out = [k for k in keys if k != content]
    return _mapped(df, out, [content], schema, factory, lambda do, row: [(do(row[0]), None)], lambda e: (None, str(e)))
