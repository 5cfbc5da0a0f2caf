"""Differences between two copies of a table: missing rows and differing cells.

Method: both sides are hashed into buckets by key, each pair of buckets meets in one task as two Arrow
tables (cogroup), late deliveries of a key are dropped, keys are aligned with a sorted search, columns are
compared with vectorised masks that know nulls, and only masked cells are emitted. Each side is shuffled
once, into as many buckets as its rows need.

Wide columns (arrays, structs, long strings) travel as SHA-256 digests of an unambiguous encoding, so
the shuffle carries 32 bytes a cell instead of whole documents. So do keys that are no whole numbers, or
several columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one side that a bucket holds on average, and the most buckets (beyond, they grow); a bucket of each side is in memory at once.
ROWS_PER_BUCKET, MOST_BUCKETS = 25_000, 100_000

def encoded(column: Column, kind: T.DataType) -> Column:
    """A string that is equal for two values exactly if they are; null for null."""
    if isinstance(kind, T.ArrayType):
        parts = F.transform(column, lambda x: F.coalesce(F.concat(F.length(y := encoded(x, kind.elementType)).cast("string"), F.lit(":"), y), F.lit("n")))
        return F.when(column.isNotNull(), F.concat(F.lit("["), F.concat_ws(",", parts), F.lit("]")))
    if isinstance(kind, T.StructType):
        parts = [F.coalesce(F.concat(F.length(y := encoded(column[f.name], f.dataType)).cast("string"), F.lit(":"), y), F.lit("n")) for f in kind.fields]
        return F.when(column.isNotNull(), F.concat_ws(",", *parts))
    if isinstance(kind, T.MapType):
        pairs = F.array_sort(F.map_entries(column))
        return encoded(pairs, T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def comparable(name: str, kind: T.DataType, digest: bool) -> Column:
    """The column as it is shuffled: a digest where it is wide, else itself."""
    if digest or isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.unhex(F.sha2(encoded(F.col(name), kind), 256))
    return F.col(name)


def _null_aware_differ(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """True where two aligned columns differ; null equals null, NaN equals NaN."""
    if pa.types.is_floating(a.type):
        x, y = (v.to_numpy(zero_copy_only=False) for v in (a, b))
        nx, ny = (np.asarray(v.is_null()) for v in (a, b))
        same = (x == y) | (np.isnan(x) & np.isnan(y))
        return (nx != ny) | (~nx & ~ny & ~same)
    both = pc.fill_null(pc.not_equal(a, b), False)
    nulls = pc.xor(pc.is_null(a), pc.is_null(b))
    return np.asarray(pc.or_(both, nulls))


def latest(t: pa.Table) -> pa.Table:
    """The last delivery of each key, sorted by key, nulls first; of equal times the greatest row."""
    order = [(c, "ascending") for c in ("_key", "_at", *(c for c in t.column_names if c not in ("_key", "_at")))]
    t = t.take(pc.sort_indices(t, sort_keys=order, null_placement="at_start"))
    if len(t) < 2:
        return t
    a, b = t["_key"].slice(0, len(t) - 1), t["_key"].slice(1)
    last = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    return t.filter(pa.chunked_array([*last.chunks, pa.array([True])]))


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with one delivery of each key: a key with a third of all rows comes down to one row a batch before the shuffle."""
    for b in batches:
        if pc.count_distinct(b["_key"], mode="all").as_py() == len(b):
            yield b
        else:
            yield from latest(pa.Table.from_batches([b])).combine_chunks().to_batches()


def _searchable(keys: pa.ChunkedArray) -> np.ndarray:
    """Keys without nulls for a sorted search: numbers, or digests as bytes of one length."""
    if pa.types.is_integer(keys.type):
        return keys.to_numpy()
    return np.array(keys.to_pylist(), dtype="S32") if len(keys) else np.zeros(0, "S32")


def compare_buckets(left: pa.Table, right: pa.Table, keys: Sequence[str], fields: Sequence[str]) -> pa.Table:
    """Findings of one bucket: tables of ``_key``, ``_at``, columns of the key and of the fields; null is a key."""
    left, right = latest(left), latest(right)
    nl, nr = left["_key"].null_count, right["_key"].null_count  # none or one, and first
    lk, rk = _searchable(left["_key"].slice(nl)), _searchable(right["_key"].slice(nr))
    at = np.searchsorted(rk, lk)
    hit = np.zeros(len(lk), bool)
    inside = at < len(rk)
    hit[inside] = rk[at[inside]] == lk[inside]
    li, ri = np.flatnonzero(hit) + nl, at[hit] + nr
    lonely_l, taken = np.flatnonzero(~hit) + nl, np.zeros(len(rk), bool)
    taken[at[hit]] = True
    lonely_r = np.flatnonzero(~taken) + nr
    if nl and nr:  # a null key on both sides
        li, ri = np.append(0, li), np.append(0, ri)
    elif nl:
        lonely_l = np.append(0, lonely_l)
    elif nr:
        lonely_r = np.append(0, lonely_r)
    found: list[pa.Table] = []

    def emit(rows: pa.Table, field: str, finding: str) -> None:
        if len(rows):
            found.append(rows.select(list(keys)).append_column("field", pa.array([field] * len(rows), pa.string())).append_column("finding", pa.array([finding] * len(rows), pa.string())))

    emit(left.take(pa.array(lonely_l)), "*", "only_left")
    emit(right.take(pa.array(lonely_r)), "*", "only_right")
    a, b = left.take(pa.array(li)), right.take(pa.array(ri))
    for f in fields:
        mask = _null_aware_differ(a[f], b[f])
        if mask.any():
            emit(a.filter(pa.array(mask)), f, "differs")
    if found:
        return pa.concat_tables(found)
    return left.select(list(keys)).slice(0, 0).append_column("field", pa.array([], pa.string())).append_column("finding", pa.array([], pa.string()))


def bucketed_side(df: DataFrame, keys: Sequence[str], fields: Sequence[str], kinds: dict[str, T.DataType], loaded: str, digests: Sequence[str], buckets: int) -> DataFrame:
    """(_bucket, _key, _at, k0.., v0..): the rows in buckets of their key, every batch's deliveries of a key combined."""
    if len(keys) == 1 and isinstance(kinds[keys[0]], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        key = F.col(keys[0]).cast("long")
    else:
        own = F.col(keys[0]).isNull() if len(keys) == 1 else F.lit(False)  # a null in a key of several columns is a value
        key = F.when(~own, F.unhex(F.sha2(encoded(F.struct(*keys), T.StructType([T.StructField(k, kinds[k]) for k in keys])), 256)))
    cells = [comparable(f, kinds[f], f in digests) for f in fields]
    named = [*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), *(c.alias(f"v{i}") for i, c in enumerate(cells))]
    d = df.select(key.alias("_key"), F.col(loaded).alias("_at"), *named)
    d = d.select(F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("_bucket"), "*")
    return d.mapInArrow(combined, d.schema).repartition(buckets, "_bucket")


def table_differences(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    fields: Sequence[str] | None = None,
    loaded: str = "loaded_at",
    digests: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(row_id, field, finding) of the current rows of two copies of a table; of a key of several columns, these in place of row_id.

    finding is ``only_left`` or ``only_right`` with field ``*``, else ``differs`` with the column. Key
    columns may be of any type that both sides share. fields: the columns to compare; by default all that
    both sides have, but key and ``loaded``, and a column that one side lacks is itself a finding
    (``column_only_left``, ``column_only_right``) with a null key. The number of buckets follows the rows.

    Null equals only null; a null key is one key, and in a key of several columns null is a value. Of
    several deliveries the latest counts, of equal times the greatest row. An empty side makes every row
    of the other missing. Repeated rows give one finding.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = ["row_id"] if isinstance(key, str) else keys
    missing: list[tuple[str, str]] = []
    if fields is None:
        skip = {*keys, loaded}
        fields = [c for c in left.columns if c in set(right.columns) and c not in skip]
        missing = [(c, "column_only_left") for c in left.columns if c not in set(right.columns) | skip] + [(c, "column_only_right") for c in right.columns if c not in set(left.columns) | skip]
    fields = list(fields)
    kinds = {f.name: f.dataType for f in left.schema.fields}
    spark = left.sparkSession
    rows = max(left.count(), right.count())
    buckets = max(1, min(-(-rows // rows_per_bucket), MOST_BUCKETS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    a, b = (bucketed_side(d, keys, fields, kinds, loaded, digests, buckets) for d in (left, right))
    of_key = [f"k{i}" for i in range(len(keys))]
    shown = {f"v{i}": f for i, f in enumerate(fields)}
    result = T.StructType([*(T.StructField(n, kinds[k]) for n, k in zip(names, keys, strict=True)), T.StructField("field", T.StringType()), T.StructField("finding", T.StringType())])

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        found = compare_buckets(x, y, of_key, list(shown))
        renamed = pa.array([shown.get(f, f) for f in found["field"].to_pylist()], pa.string())
        return found.set_column(found.column_names.index("field"), "field", renamed).rename_columns(result.names)

    found = a.groupBy("_bucket").cogroup(b.groupBy("_bucket")).applyInArrow(compare, result)
    if missing:
        lacking = spark.createDataFrame([(*[None] * len(keys), c, f) for c, f in missing], result)
        found = found.unionByName(lacking)
    return found
