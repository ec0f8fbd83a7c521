"""Neighbour logic on ordered rows, safe for keys that hold a large part of all rows.

A plain window puts all rows of a key into one task. Rows of keys with more than `hot_rows`
rows are therefore dealt by ranges of key and full order, so that equal values of the first
order column spread too; the window runs per range, and what has to cross a border (the first
row of the next range, the number of rows before) comes from a table with one row per hot key
and range. Results are the same however many keys count as hot.

Finding hot keys takes a pass over the keys, so the input should be a stored table or a
checkpoint, not a costly plan.
"""

import json
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from gleanfield.session import cut_lineage, small_side

HOT_ROWS = 5_000_000
RANGE_ROWS = 10_000  # rows of hot keys in a range at least, however low the threshold
_SLICE = "_slice"


def _same(a: DataFrame, b: DataFrame, keys: list[str], prefix: str = "") -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in keys])


def _lookup(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that also matches NULL keys; `dim` is unique on `keys`."""
    dim = dim.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in dim.columns if c not in keys])
    joined = df.join(small_side(dim), _same(df, dim, keys, "_r_"), "left")
    return joined.drop(*[f"_r_{k}" for k in keys])


@dataclass
class _Sliced:
    df: DataFrame  # input plus `_slice`, -1 for keys that are not hot
    hot: DataFrame | None  # rows of hot keys with their slice, None when there are none
    keys: list[str]

    @property
    def parts(self) -> list[str]:
        """What a window over consecutive rows is partitioned by."""
        return self.keys if self.hot is None else [*self.keys, _SLICE]

    def hot_slices(self, *aggregates: Column) -> DataFrame:
        """One row per hot key and slice, worked out once."""
        return cut_lineage(self.hot.groupBy(*self.keys, _SLICE).agg(*aggregates))


def _cut_hot_keys(df: DataFrame, keys: list[str], order: list[str], hot_rows: int) -> _Sliced:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = cut_lineage(counts.where(F.col("_rows") > hot_rows))
    total = hot.agg(F.sum("_rows").alias("n")).first()["n"]
    if not total:
        return _Sliced(df.withColumn(_SLICE, F.lit(-1)), None, keys)
    named = small_side(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(shuffles, -(-total // max(hot_rows, RANGE_ROWS)))
    rows = df.join(named, _same(df, named, keys, "_h_"), "left_semi")
    # Kept, since what lies in which range must not change between two readings.
    rows = cut_lineage(
        rows.repartitionByRange(ranges, *keys, *order).withColumn(_SLICE, F.spark_partition_id())
    )
    rest = df.join(named, _same(df, named, keys, "_h_"), "left_anti").withColumn(_SLICE, F.lit(-1))
    return _Sliced(rest.unionByName(rows), rows, keys)


def pairwise(
    df: DataFrame, keys: list[str], order: list[str], column: str,
    out: str = "next", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """every row with its successor's value in `out`; `is_last` marks the row without one.

    `order` must make the rows of a key distinct.
    """
    cut = _cut_hot_keys(df, keys, order, hot_rows)
    within = Window.partitionBy(*cut.parts).orderBy(*order)
    boxed = F.struct(F.col(column).alias("v"))
    rows = cut.df.withColumn("_next", F.lead(boxed).over(within))
    if cut.hot is not None:
        slices = cut.hot_slices(F.min_by(boxed, F.struct(*order)).alias("_first"))
        across = Window.partitionBy(*keys).orderBy(_SLICE)
        follow = slices.select(*keys, _SLICE, F.lead("_first").over(across).alias("_follow"))
        rows = _lookup(rows, follow, [*keys, _SLICE]).withColumn(
            "_next", F.coalesce("_next", "_follow")
        )
    return rows.select(
        *df.columns, F.col("_next.v").alias(out), F.col("_next").isNull().alias("is_last")
    )


def remove_adjacent_dup(
    df: DataFrame, keys: list[str], order: list[str], column: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """keep the last row of each run of equal neighbours."""
    pairs = pairwise(df, keys, order, column, "_following", hot_rows)
    return pairs.where(
        F.col("is_last") | ~F.col(column).eqNullSafe(F.col("_following"))
    ).select(*df.columns)


def positions(
    df: DataFrame, keys: list[str], order: list[str], out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Zero-based place of each row within its key."""
    cut = _cut_hot_keys(df, keys, order, hot_rows)
    within = Window.partitionBy(*cut.parts).orderBy(*order)
    rows = cut.df.withColumn(out, F.row_number().over(within).cast("long") - 1)
    if cut.hot is not None:
        slices = cut.hot_slices(F.count(F.lit(1)).alias("_rows"))
        before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        offsets = slices.select(*keys, _SLICE, F.sum("_rows").over(before).alias("_before"))
        rows = _lookup(rows, offsets, [*keys, _SLICE]).withColumn(
            out, F.col(out) + F.coalesce("_before", F.lit(0))
        )
    return rows.select(*df.columns, out)


def chunks(
    df: DataFrame, keys: list[str], order: list[str], column: str, n: int,
    fill: Column | None = None, pad: bool = True, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """rows of a key to arrays of `n` values (`chunk`, `items`), the last one padded."""
    placed = positions(df, keys, order, "_pos", hot_rows)
    boxed = F.struct(F.col("_pos").alias("p"), F.col(column).alias("v"))
    grouped = placed.groupBy(*keys, F.expr(f"_pos div {n}").alias("chunk")).agg(
        F.sort_array(F.collect_list(boxed)).alias("_items")
    )
    items = F.transform("_items", lambda x: x["v"])
    if pad:
        filler = F.lit(None) if fill is None else fill
        filler = filler.cast(df.schema[column].dataType)
        items = F.concat(items, F.array_repeat(filler, n - F.size(items)))
    return grouped.select(*keys, "chunk", items.alias("items"))


def lot2dol(
    df: DataFrame, keys: list[str], value: str, order: list[str],
    piece: int | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`(key, value)` rows to the list of each key as rows `(key, ord, value)`, `ord` from 0.

    With `piece` the lists are arrays of up to that many values (`chunk`, `items`). The form
    is the caller's choice and never depends on the size of a key.
    """
    if piece is not None:
        return chunks(df, keys, order, value, piece, pad=False, hot_rows=hot_rows)
    placed = positions(df, keys, order, "_ord", hot_rows)
    return placed.select(*keys, F.col("_ord").alias("ord"), F.col(value).alias("value"))


def dol2lot(df: DataFrame, map_col: str) -> DataFrame:
    """map of arrays to `(key, value)` rows; a NULL value is one row, an empty array none."""
    keep = [c for c in df.columns if c != map_col]
    entries = df.select(*keep, F.explode(map_col).alias("key", "_values"))
    nothing = F.array_repeat(F.get("_values", F.lit(0)), 1)
    return entries.select(*keep, "key", F.explode(F.coalesce("_values", nothing)).alias("value"))


def _paths(document: str | None) -> tuple[list[dict] | None, str | None]:
    """Paths and values of a document, or why there are none. Numbers stay as written."""
    if document is None:
        return None, "no document"
    try:
        root = json.loads(document, parse_int=str, parse_float=str)
    except (ValueError, RecursionError) as error:
        return None, "nested too deep to read" if isinstance(error, RecursionError) else "not JSON"
    leaves, open_ = {}, [(None, root)]
    while open_:
        path, value = open_.pop()
        if isinstance(value, dict | list):
            inner = value.items() if isinstance(value, dict) else enumerate(value)
            below = [(str(k) if path is None else f"{path}_{k}", v) for k, v in inner]
            open_ += reversed(below)
        else:
            if value is not None and not isinstance(value, str):
                value = str(value).lower()
            leaves[path] = value
    return [{"path": p, "value": v} for p, v in leaves.items()], None


_LEAF = StructType([StructField("path", StringType()), StructField("value", StringType())])
_READ = StructType([StructField("leaves", ArrayType(_LEAF)), StructField("reason", StringType())])


@arrow_udf(_READ)
def _leaves(documents: pa.Array) -> pa.Array:
    leaf = pa.struct([("path", pa.string()), ("value", pa.string())])
    shape = pa.struct([("leaves", pa.list_(leaf)), ("reason", pa.string())])
    found = map(_paths, documents.to_pylist())
    return pa.array([{"leaves": rows, "reason": why} for rows, why in found], shape)


def flatten_json(df: DataFrame, column: str, reason: str = "reject_reason") -> DataFrame:
    """JSON text or VARIANT to rows `path`, `value` (text), keys joined by `_`.

    List positions are path parts and empty containers vanish; where two paths are the same,
    the later one in the document wins. A document that is NULL or cannot be read gives one
    row of NULLs that says why in `reason`. Depth is not limited.
    """
    keep = [F.col(c) for c in df.columns if c != column]
    text = F.col(column)
    if df.schema[column].dataType.typeName() != "string":
        text = F.to_json(text)
    read = df.select(*keep, _leaves.asNondeterministic()(text).alias("_read"))
    nothing = F.array(F.lit(None).cast(_LEAF))
    rows = F.when(F.col("_read.reason").isNotNull(), nothing).otherwise(F.col("_read.leaves"))
    names = [c for c in df.columns if c != column]
    return read.select(*names, F.explode(rows).alias("_leaf"), F.col("_read.reason").alias(reason)).select(
        *names, "_leaf.path", "_leaf.value", reason
    )
