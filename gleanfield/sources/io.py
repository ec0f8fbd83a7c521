"""Captured pages, JSON and CSV documents in; event files out."""

import csv
import io
import re
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType, DataType, NullType, StringType, StructField, StructType, VariantType,
)

from gleanfield.schema import EVENT_COLUMNS
from gleanfield.session import cut_lineage


def page_source(
    spark: SparkSession, path: str, source: str | None = None, body: str = "html",
    columns: list[str] | None = None,
) -> DataFrame:
    """Captured pages as `source, url, body` (plus `columns`).

    Input with fewer splits than cores is spread evenly; larger input is read as it lies.
    """
    pages = spark.read.parquet(path)
    origin = F.col("source") if source is None and "source" in pages.columns else F.lit(source)
    pages = pages.select(
        origin.cast("string").alias("source"), "url", F.col(body).cast("string").alias("body"),
        *(columns or []),
    )
    return spread(pages)


def spread(df: DataFrame) -> DataFrame:
    """Repartition a plain scan whose few splits would leave cores idle."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _split_quoted(documents: pa.Array) -> pa.Array:
    """Records below line 1 of CSV documents; quotes may hold commas and newlines."""
    csv.field_size_limit(2**31 - 1)
    out = []
    for doc in documents.to_pylist():
        if doc is None:
            out.append(None)
            continue
        lines = io.StringIO(doc)
        lines.readline()
        try:
            out.append([row for row in csv.reader(lines) if row])
        except csv.Error:
            out.append(None)
    return pa.array(out, pa.list_(pa.list_(pa.string())))


_quoted_rows = arrow_udf(_split_quoted, ArrayType(ArrayType(StringType())))


def csv_body_rows(df: DataFrame, body_col: str, keep_missing: bool = False) -> DataFrame:
    """S3: a CSV document per row to one row per record: `row_no`, `rec`, `overflow`.

    Line 1 names the fields and is split at every comma, quotes or not. A short record has
    NULLs, a long one leaves its surplus in `overflow`. Only documents that hold quotes
    (or lone carriage returns) travel to Python. A document that is not CSV gives one row
    of NULLs, and so does a NULL document if `keep_missing`.
    """
    keep = [c for c in df.columns if c != body_col]
    body = F.col(body_col)
    missing = body.isNull()
    header = F.split(F.btrim(F.split_part(body, F.lit("\n"), F.lit(1)), F.lit(" \t\r\n")), ",")
    lines = F.transform(F.split(body, "\n"), lambda x: F.regexp_replace(x, "\r$", ""))
    plain = F.transform(
        F.filter(lines, lambda x, i: (i > 0) & (x != "")), lambda x: F.split(x, ",")
    )
    hard = body.contains('"') | body.rlike("\r(?!\n)")
    unreadable = F.array(F.lit(None).cast("array<string>"))
    quoted = F.coalesce(_quoted_rows(F.when(hard, body)), unreadable)
    rows = F.when(missing, unreadable).when(hard, quoted).otherwise(plain)
    # The document itself stays below the explode; its field names travel with each record.
    parsed = (df if keep_missing else df.where(~missing)).select(
        *keep, header.alias("_header"), rows.alias("_rows")
    )
    width = F.size("_header")
    # Of fields with the same name the last one counts.
    lasting = F.filter(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.array_position(F.reverse("_header"), F.get("_header", i)) == width - i,
    )
    parsed = parsed.select(
        *keep, "_rows", width.alias("_width"), lasting.alias("_at"),
        F.transform(lasting, lambda i: F.get("_header", i)).alias("_names"),
    )
    exploded = parsed.select(
        *keep, "_width", "_at", "_names", F.posexplode("_rows").alias("row_no", "_v")
    )
    record = F.map_from_arrays("_names", F.transform("_at", lambda i: F.get("_v", i)))
    read = F.col("_v").isNotNull()
    return exploded.select(
        *keep, F.when(read, F.col("row_no")).alias("row_no"), F.when(read, record).alias("rec"),
        F.when(
            F.size("_v") > F.col("_width"), F.slice("_v", F.col("_width") + 1, F.size("_v"))
        ).alias("overflow"),
    )


def json_list_rows(
    df: DataFrame, body_col: str, entry: StructType, keep_unreadable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents `{"message": [...], "list": [...]}` to one row per list entry, and one
    row per message. An unreadable document gives a message too; if `keep_unreadable`, it and
    a NULL document also give a row without `row_index`."""
    keep = [c for c in df.columns if c != body_col]
    shape = StructType(
        [
            StructField("message", ArrayType(StringType())),
            StructField("list", ArrayType(entry)),
            StructField("_bad", StringType()),
        ]
    )
    parsed = df.withColumn(
        "_doc", F.from_json(body_col, shape, {"columnNameOfCorruptRecord": "_bad"})
    )
    entries, place = F.col("_doc.list"), F.col("_i")
    if keep_unreadable:
        lost = F.col("_doc._bad").isNotNull() | F.col(body_col).isNull()
        entries = F.when(lost, F.array(F.lit(None).cast(entry))).otherwise(entries)
        place = F.when(~F.col("_lost"), place)
        parsed = parsed.withColumn("_lost", lost)
    rows = parsed.withColumn("_list", entries).select(
        "*", F.posexplode("_list").alias("_i", "_e")
    ).select(*keep, place.alias("row_index"), "_e")
    messages = F.concat(
        F.coalesce("_doc.message", F.array().cast("array<string>")),
        F.when(F.col("_doc._bad").isNotNull(), F.array(F.lit("unreadable document"))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    warnings = parsed.select(*keep, F.explode(messages).alias("message"))
    return rows.select(*keep, "row_index", "_e.*"), warnings


def json_list_rows_inferred(df: DataFrame, body_col: str) -> DataFrame:
    """S4 without a declared entry: `row_index` and `entry`, a struct whose fields all entries of `df` have told.

    One pass over the documents merges the schemas of their entries; a field that is a number here and a decimal there
    becomes the wider one, one that has no common type is given as text (of lists and objects: their JSON), and so is one that
    is always null. A field an entry lacks is NULL, an entry that is not an object gives an `entry` of NULLs, a
    document that cannot be read or has no list gives no row. Without any object `entry` has no fields.
    """
    keep = [c for c in df.columns if c != body_col]
    listed = F.try_variant_get(F.try_parse_json(F.col(body_col)), "$.list", "array<variant>")
    rows = df.select(*keep, F.posexplode(listed).alias("row_index", "_e"))
    objects = F.when(F.schema_of_variant("_e").startswith("OBJECT"), F.col("_e"))
    told = rows.agg(F.schema_of_variant_agg(objects)).first()[0]
    shape = DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", told)) if told.startswith("OBJECT<") else StructType()
    named = F.try_variant_get("_e", "$", "map<string, variant>")
    fields = []
    for name in shape.fieldNames():
        kind, value = shape[name].dataType, named[F.lit(name)]
        if isinstance(kind, VariantType):
            value = F.when(~F.is_variant_null(value), F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
        else:
            value = F.try_variant_get(value, "$", "string" if isinstance(kind, NullType) else kind.simpleString())
        fields.append(value.alias(name))
    entry = F.struct(*fields) if fields else F.lit(None).cast("struct<>")
    return rows.select(*keep, "row_index", entry.alias("entry"))


def time_tag() -> str:
    return datetime.now().strftime("%Y_%m_%d__%H_%M_%S")


# Quotes inside a value are doubled, and nothing is trimmed.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_events_csv(
    df: DataFrame, out_dir: str, tag: str | None = None, columns: list[str] | None = None
) -> list[str]:
    """One folder of CSV files per source and run, `file=SOURCE__TAG`.

    The header names the fields any record fills, in record order; an absent value is an
    empty cell. Unless `columns` names them, the records are checkpointed and looked at
    once. All partitions write in parallel, whatever the size of a source. A run written
    before under the same name is replaced; other runs in the folder stay.
    """
    if columns is None:
        df = cut_lineage(df)
        present = [c for c in EVENT_COLUMNS if c in df.columns]
        filled = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in present]).first()
        columns = [c for c in present if filled[c]]
    file = F.concat_ws("__", "source", F.lit(tag or time_tag()))
    (
        df.select(*columns, file.alias("file"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file")
        .options(**CSV_OPTIONS, emptyValue="", nullValue="")
        .csv(out_dir)
    )
    return columns


def merge_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name, columns in first-seen order, NULL where a frame has none."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header line, from one pass over all files (folders stand for the files in them)."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"
    )
    # A file's first block lies in one task, which reads it in order.
    first = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("line"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        line = row["line"].removeprefix("\ufeff").rstrip("\r")
        header = tuple(next(csv.reader([line]), ()))
        groups.setdefault(header, []).append(row["file"])
    return groups


def read_csv_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files with differing headers as one table of text columns.

    Files with equal headers are scanned together, so the plan grows with the number of
    headers, not of files. A row longer than its header fails the job.
    """
    frames = []
    for header, members in csv_headers(spark, paths).items():
        shape = StructType([StructField(c, StringType()) for c in [*header, "_overflow"]])
        rows = spark.read.options(**CSV_OPTIONS, multiLine="true").schema(shape).csv(members)
        long = F.col("_overflow").isNotNull()
        checked = F.when(long, F.raise_error(F.lit("row longer than its header"))).otherwise(
            F.col(f"`{header[0]}`")
        )
        frames.append(rows.select(checked.alias(header[0]), *[F.col(f"`{c}`") for c in header[1:]]))
    return merge_by_name(frames)


def merge_csvs(spark: SparkSession, paths: list[str], out: str) -> None:
    """Many CSV files to one folder of CSV files under the united header."""
    merged = read_csv_files(spark, paths)
    merged.write.mode("errorifexists").options(**CSV_OPTIONS, emptyValue="", nullValue="").csv(out)
