"""Resolving WARC revisit records of the not-modified profile.

A revisit has a 304 response and no body. It is resolved by the latest earlier full response of
its canonical URL, if their validators agree; the response's headers are then
updated by those of the 304 that may update a stored response.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanfield.llm.common import stored

# Header fields a 304 must not change (RFC 9110 and 9111).
KEPT_HEADERS = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authentication-info proxy-authorization proxy-connection set-cookie te trailer transfer-encoding upgrade"
).split()

# In order: pattern and replacement that make addresses of one page alike.
CANONICAL = [
    (r"^\s+|\s+$", ""),
    (r"#.*$", ""),
    (r"^[a-zA-Z][a-zA-Z0-9+.\-]*://", ""),
    (r"^([^/?]*):(80|443)(?=$|[/?])", "$1"),
    (r"^([^/?]+)($|\?)", "$1/$2"),
    (r"(?<=[?&])utm_[^&]*(&|$)", ""),
    (r"[?&]+$", ""),
]


def canonical_url(url: Column) -> Column:
    """Without scheme, default port, fragment and utm_ parameters; the host in lower case."""
    out = reduce(lambda c, p: F.regexp_replace(c, *p), CANONICAL, url)
    host = F.regexp_extract(out, "^[^/]*", 0)
    return F.concat(F.lower(host), F.substring(out, F.length(host) + 1, F.length(out)))


def header_map(block: Column) -> Column:
    """A block of header lines as a map of lower-case names; of a repeated name the last line counts.

    Lines without a colon are left out; a null block has no headers.
    """
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: x.rlike("^[^:\\s]+:"))
    pairs = F.transform(
        lines, lambda x: F.struct(F.lower(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v"))
    )
    last = F.filter(
        pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda y: y["k"] == x["k"])
    )
    return F.map_from_entries(last)


def opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def agree(revisit: Column, response: Column) -> Column:
    """Whether validators agree: entity tags if both have one, else the dates; null if they share neither."""
    tags, dates = [(m["etag"], m["last-modified"]) for m in (revisit, response)]
    return (
        F.when(tags[0].isNotNull() & dates[0].isNotNull(), opaque(tags[0]) == opaque(dates[0]))
        .when(tags[1].isNotNull() & dates[1].isNotNull(), tags[1] == dates[1])
    )


def merged(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by those the 304 may change."""
    changes = F.map_filter(revisit, lambda k, v: ~k.isin(KEPT_HEADERS))
    rest = F.map_filter(response, lambda k, v: ~F.map_contains_key(changes, k))
    return F.map_concat(rest, changes)


def latest_before(rows: DataFrame) -> DataFrame:
    """Each asking row of `rows` with `found`, the value of the latest earlier row of its key that has one.

    `rows` has key, at, id, asks (boolean) and value (null where a row has none). Rows
    are dealt by ranges of (key, at), so a hot key spreads over tasks; what
    a range inherits from those before it comes from a table of one row per range.
    """
    order = ["at", F.col("asks").desc(), "id"]  # at the same time a response is not earlier
    parts = stored(rows.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id()))
    within = Window.partitionBy("part", "key").orderBy(*order)
    seen = parts.withColumn("found", F.last("value", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    asked = seen.where("asks")
    # of each range: its first key asks, its last key hands on the last value it has
    ends = parts.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    last = F.max_by("value", F.struct("at", ~F.col("asks"), "id"))
    handed = (
        parts.where("value is not null").join(ends.select("part", F.col("last").alias("key")), ["part", "key"])
        .groupBy("part", "key").agg(last.alias("value"))
    )
    asking = ends.select("part", F.col("first").alias("key"), F.lit(True).alias("wants"))
    chain = handed.withColumn("wants", F.lit(False)).unionByName(asking.withColumn("value", F.lit(None).cast(rows.schema["value"].dataType)))
    earlier = Window.partitionBy("key").orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    inherited = chain.withColumn("inherited", F.last("value", ignorenulls=True).over(earlier)).where("wants and inherited is not null")
    out = asked.join(inherited.select("part", "key", "inherited"), ["part", "key"], "left")
    return out.withColumn("found", F.coalesce("found", "inherited")).drop("part", "inherited", "value", "asks")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of `records`: what it refers to, and its headers.

    `records` has record_id, url, captured (any ordered type), kind ("response"
    or "revisit"), status and headers (the block as text). Full responses are those of status
    200. Returns record_id, canonical_url, captured, refers_to, outcome and headers:

    - `resolved`: headers are merged, refers_to names the response
    - `changed`: validators disagree; `unproven`: there is no validator in common
    - `missing`: there is no earlier full response

    Only for `resolved` is headers more than the revisit's own. A row with a null
    url or time is never found and, as a revisit, is missing. Repeated
    revisits get a row each; of repeated responses any equal one is named; an
    empty table gives no rows. Bodies are not needed and not moved.
    """
    rows = records.select(
        canonical_url(F.col("url").cast("string")).alias("key"), F.col("captured").alias("at"),
        F.col("record_id").cast("string").alias("id"), (F.col("kind") == "revisit").alias("asks"),
        header_map(F.col("headers")).alias("headers"), "status",
    ).where("asks or status = 200")
    full = ~F.col("asks") & F.col("key").isNotNull() & F.col("at").isNotNull()
    value = F.when(full, F.struct("id", "headers"))
    known = F.col("key").isNotNull() & F.col("at").isNotNull()
    rows = rows.withColumn("value", value)
    asked = latest_before(rows.where(known).select("key", "at", "id", "asks", "value", F.when(F.col("asks"), F.col("headers")).alias("headers")))
    found = F.col("found")
    same = agree(F.col("headers"), found["headers"])
    outcome = F.when(found.isNull(), "missing").when(same, "resolved").when(~same, "changed").otherwise("unproven")
    done = asked.select(
        F.col("id").alias("record_id"), F.col("key").alias("canonical_url"), F.col("at").alias("captured"),
        found["id"].alias("refers_to"), outcome.alias("outcome"),
        F.when(outcome == "resolved", merged(found["headers"], F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )
    lost = rows.where(F.col("asks") & ~known).select(
        F.col("id").alias("record_id"), F.col("key").alias("canonical_url"), F.col("at").alias("captured"),
        F.lit(None).cast("string").alias("refers_to"), F.lit("missing").alias("outcome"), "headers",
    )
    return done.unionByName(lost)


def header_text(headers: Column) -> Column:
    """Headers as `name: value` lines in the order of their names."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
