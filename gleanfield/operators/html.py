"""Field extraction from page columns.

All fields of a source are answered in one Arrow UDF that receives the page text only
and returns a struct: the page is read once and the other columns stay in the JVM.
Filter and prune before, and drop the page text right after.
"""

import codecs
import re
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from gleanfield.functions.text import strip
from gleanfield.operators import markup
from gleanfield.operators.markup import Field, Rule

# From an attribute's name into its value; one in quotes may hold a ">".
VALUE = "\\s*=(?:[^>]*|\\s*\"[^\"]*|\\s*'[^']*)"


def _struct(fields: dict[str, Field]) -> StructType:
    return StructType([StructField(name, _type(field)) for name, field in fields.items()])


def _type(field: Field):
    if field.take == "rows":
        return ArrayType(_struct(field.sub))
    return ArrayType(StringType()) if field.take.startswith("all_") else StringType()


def fields_of(html: Column, fields: dict[str, Field]) -> Column:
    """One STRUCT column with a value per field; NULL where the page is NULL.

    The UDF is declared nondeterministic: a filter on a field then stays above it, where
    pushing it down would have the page read once for the filter and once for the fields.
    """
    result = _struct(fields)
    arrow_type = to_arrow_type(result)
    values_reader, arrow_structs = markup.values_reader, markup.arrow_structs
    made = []  # one reader for all batches of a task, as it remembers layouts and attributes

    @arrow_udf(result)
    def extract(pages: pa.Array) -> pa.Array:
        if not made:
            made.append(values_reader(fields))
        read = made[0]
        return arrow_structs([None if p is None else read(p) for p in pages.to_pylist()], arrow_type)

    return extract.asNondeterministic()(html)


# Bytes of a page that come to Python at once, and characters of the blocks these are cut from, which are copies.
SLICE, BLOCK = 128 << 10, 8 << 20


def _cut(df: DataFrame, value: Column, last: Column, size: int, name: str) -> DataFrame:
    """A row per `size` of `_page`, at least one, in order: their number as `name`, and whether they are the last."""
    parts = df.select("*", F.explode(F.sequence(F.lit(0), F.coalesce(last.cast("int"), F.lit(0)))).alias(name))
    part = F.when(last > 0, F.substring(value, F.col(name) * size + 1, F.lit(size))).otherwise(value)
    return parts.withColumns({"_page": part, f"{name}_last": F.col(name) == F.coalesce(last, F.lit(0))})


def _slices(df: DataFrame, names: list[str], page: Column) -> DataFrame:
    """`_page` in slices, in order, and whether one begins and ends it. No copy of a long page is made."""
    pages, text = df.select(*names, page.alias("_page")), F.col("_page")
    last = F.when(F.octet_length(text) <= BLOCK, F.lit(0)).otherwise(F.floor((F.length(text) - 1) / BLOCK))
    blocks = _cut(pages, text, last, BLOCK, "_block").withColumn("_page", text.cast("binary"))
    slices = _cut(blocks, text, F.floor((F.greatest(F.octet_length(text), F.lit(1)) - 1) / SLICE), SLICE, "_slice")
    return slices.select(
        *names, "_page", ((F.col("_block") == 0) & (F.col("_slice") == 0)).alias("_begins"),
        (F.col("_block_last") & F.col("_slice_last")).alias("_ends"),
    )


def read_pages(df: DataFrame, html_col: str, fields: dict[str, Field]) -> DataFrame:
    """The other columns and one per field, with the values `fields_of` gives.

    A long page comes to Python in slices. Where the fields allow (`markup.can_skim`) they are read as they come, so that
    a page of any length takes a slice and its values; for others it is put together again.
    """
    keep = [f for f in df.schema if f.name != html_col]
    names = [f.name for f in keep]
    result = _struct(fields)
    arrow_type = to_arrow_type(result)
    values_reader, arrow_structs, can_skim, skimmer = (
        markup.values_reader, markup.arrow_structs, markup.can_skim, markup.Skimmer
    )

    def read(batches):
        whole, skims = values_reader(fields), can_skim(fields)
        columns = [*names, *fields]
        page = text = None  # of a page in slices: the reader, or the slices; the decoder
        for batch in batches:
            kept = pa.RecordBatch.from_arrays([batch.column(n) for n in names], names)
            records, rows = [], []
            slices = zip(*[batch.column(n).to_pylist() for n in ("_page", "_begins", "_ends")])
            for row, (piece, first, last) in enumerate(slices):
                if first and last:
                    records.append(None if piece is None else whole(piece.decode()))
                    rows.append(row)
                elif skims:
                    if first:
                        page, text = skimmer(fields), codecs.getincrementaldecoder("utf-8")()
                        values = [[] for _ in fields]
                    page.feed(text.decode(piece, last), last)
                    for found, field, made in zip(page.found, fields.values(), values):
                        if field.take.startswith("all_"):
                            made.append(pa.array(found, pa.string()))
                            found.clear()
                    if last:
                        made = [
                            pa.ListArray.from_arrays(pa.array([0, sum(map(len, v))], pa.int32()), pa.concat_arrays(v), type=t.type)
                            if f.take.startswith("all_") else pa.array([found[0] if found else f.default], t.type)
                            for v, f, t, found in zip(values, fields.values(), arrow_type, page.found)
                        ]
                        page = values = None
                        yield pa.RecordBatch.from_arrays([*kept.slice(row, 1).columns, *made], columns)
                else:
                    page = [piece] if first else [*page, piece]
                    if last:
                        records.append(whole(b"".join(page).decode()))
                        rows.append(row)
                        page = None
            if rows:
                made = arrow_structs(records, arrow_type).flatten()
                yield pa.RecordBatch.from_arrays([*kept.take(pa.array(rows)).columns, *made], columns)

    pages = _slices(df, names, F.col(html_col))
    return pages.mapInArrow(read, StructType([*keep, *result]))


def may_hold(html: Column, path: tuple[Rule, ...]) -> Column:
    """False only for pages that cannot have a match, by patterns in the JVM.

    A class must stand in a class attribute and an attribute value after its name, unless
    letters are written as character references.
    """
    there = []
    for rule in path:
        some = [rule.any_class] if rule.any_class else []
        for words in [*some, *[(c,) for c in rule.all_class]]:
            there.append(f"(?i:class){VALUE}(?:{'|'.join(map(re.escape, words))})")
        if rule.attr:
            name, how, value = rule.attr
            after = "" if how == "exists" else VALUE + re.escape(value)
            there.append(f"(?i:{re.escape(name)}){after}")
    return reduce(and_, [html.rlike(p) for p in there], F.lit(True)) | html.contains("&#")


def extract_fields(df: DataFrame, html_col: str, fields: dict[str, Field]) -> DataFrame:
    """Add one column per field."""
    return df.withColumn("_fields", fields_of(F.col(html_col), fields)).select(
        *[F.col(c) for c in df.columns], "_fields.*"
    )


def split_entries(df: DataFrame, html_col: str, *path: Rule) -> DataFrame:
    """L1: one page to one row per matched element: `row_index`, `entry` (its markup)."""
    found = fields_of(F.col(html_col), {"e": Field(path, "all_html")})["e"]
    return _explode(df, html_col, found, "row_index", "entry")


def extract_entries(
    df: DataFrame, html_col: str, path: tuple[Rule, ...], fields: dict[str, Field]
) -> DataFrame:
    """L1 and field extraction of every entry with a single reading of the page."""
    found = fields_of(F.col(html_col), {"e": Field(path, "rows", sub=fields)})["e"]
    rows = _explode(df, html_col, found, "row_index", "_entry")
    return rows.select(*[c for c in rows.columns if c != "_entry"], "_entry.*")


def extract_links(df: DataFrame, html_col: str, *path: Rule) -> DataFrame:
    """L2: one page to one row per link: `pos`, `href`.

    Without a path every link of the page is wanted, which a regex in the JVM gives.
    """
    if path:
        found = fields_of(F.col(html_col), {"e": Field(path, "all_attr:href")})["e"]
    else:
        found = plain_links(F.col(html_col))
    return _explode(df, html_col, found, "pos", "href")


def plain_links(html: Column) -> Column:
    """Every double-quoted `href` of an `<a>` tag, as written."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s(?:[^>]*?\s)?href="([^"]*)"'), F.lit(1))


def _explode(df, html_col, found, index, name):
    keep = [F.col(c) for c in df.columns if c != html_col]
    return df.select(*keep, F.posexplode(found).alias(index, name))


def row_cells(df: DataFrame, html_col: str, row: tuple[Rule, ...], cell: Rule) -> DataFrame:
    """One row per table row: `cells` (stripped texts) and `links` (hrefs in it)."""
    fields = {
        "cells": Field((cell,), "rows", sub={"text": Field((Rule(),), "string")}),
        "links": Field((Rule("a"),), "all_attr:href"),
    }
    rows = extract_entries(df, html_col, row, fields)
    return rows.withColumn("cells", F.transform("cells", lambda c: strip(c["text"])))


def fragment_text(fragment: Column) -> Column:
    """Normalised text of a markup fragment, `''` when it is NULL or empty."""
    text = fields_of(
        F.when(fragment != "", fragment), {"t": Field((), "norm_text")}
    )["t"]
    return F.coalesce(text, F.lit(""))
