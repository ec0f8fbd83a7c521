"""Pages that keep arriving in a folder, to event records, in append mode."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from gleanfield.operators.gazetteer import Gazetteer
from gleanfield.operators.html import fields_of, may_hold
from gleanfield.plans.harvest import harvest, link_fields, listed_links
from gleanfield.sources.sites import SITES, map_site

PAGE_SCHEMA = StructType([StructField("url", StringType()), StructField("body", StringType())])
CAPTURE_SCHEMA = StructType([*PAGE_SCHEMA, StructField("captured", TimestampType())])


def page_stream(
    spark: SparkSession, folder: str, schema: StructType = PAGE_SCHEMA, files_per_trigger: int = 1000
) -> DataFrame:
    """S1 as a stream of Parquet files."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def harvest_stream(
    name: str, pages: DataFrame, gazetteer: Gazetteer, out_dir: str, checkpoint: str,
) -> StreamingQuery:
    """Write a site's events (rejects included, with their reason) as Parquet, each page once.

    No operator of the chain keeps state. Most chains work per row and go through the file sink;
    where a mapping groups rows, each batch is mapped as a table and written to a folder of its
    own, which a batch that is run again replaces.
    """
    if SITES[name].by_batch:

        def write(batch: DataFrame, number: int) -> None:
            harvest(name, batch, gazetteer).write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

        batches = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return batches.trigger(availableNow=True).start()
    return write_stream(harvest(name, pages, gazetteer), out_dir, checkpoint)


def visited_once(pages: DataFrame, within: str, key: str = "url", time: str = "captured") -> DataFrame:
    """L5 on a stream: the first row of each URL to arrive, whatever batch or run of the query it comes in.

    A URL is remembered for `within` after the time of its first row, and so long a late row is waited for; a
    URL that comes again after that counts as new. Rows without a URL or time are not passed on.
    """
    known = pages.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return known.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def details_stream(
    name: str, pages: DataFrame, gazetteer: Gazetteer, listing: Column | None = None, within: str = "30 days"
) -> DataFrame:
    """E2 on a stream: events of the detail pages that listing pages name, whichever arrives first.

    `pages` (`url`, `body`, `captured`) is a stream of listing and detail pages. `listing` tells listing
    pages by their address, by default those below the site's own listing; as pages arrive in any order, no chain of next
    links is followed. What a listing page names and detail pages wait for each other up to `within`
    between their times, then they are forgotten; a page captured again meanwhile counts once. The state holds
    the bodies of detail pages that have not been named yet, so on a large stream it belongs in RocksDB
    (`spark.sql.streaming.stateStore.providerClass`).
    """
    site = SITES[name]
    if not site.links or site.by_batch:
        raise ValueError(f"{name} has no detail pages to wait for")
    if listing is None:
        listing = F.col("url").startswith(site.base_url + site.events_path)
    listing = F.coalesce(listing, F.lit(False))
    found = pages.where(listing & may_hold(F.col("body"), site.links))
    read = found.select("url", "captured", fields_of(F.col("body"), link_fields(site)).alias("_f")).select("url", "captured", "_f.*")
    links = visited_once(listed_links(site, read, "captured"), within)
    context = [k for k in site.beside if k]
    links = links.select(F.col("url").alias("_target"), F.col("captured").alias("_listed"), *[F.col(k).alias(f"_listing_{k}") for k in context])
    details = visited_once(pages.where(~listing), within)
    apart = F.expr(f"interval {within}")
    met = (
        (F.col("url") == F.col("_target")) & (F.col("captured") >= F.col("_listed") - apart) & (F.col("captured") <= F.col("_listed") + apart)
    )
    joined = details.join(links, met).select("url", "body", *[F.col(f"_listing_{k}").alias(k) for k in context])
    return site.stages(gazetteer)(map_site(name, joined, gazetteer))


def write_stream(events: DataFrame, out_dir: str, checkpoint: str) -> StreamingQuery:
    """What is there of a stream of events to Parquet; a query started again goes on where this one ended."""
    sink = events.writeStream.format("parquet").outputMode("append").option("path", out_dir)
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
