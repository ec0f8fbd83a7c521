"""Captured pages of a site to normalised event records."""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanfield.functions.collections import amap, first_link_with_prefix
from gleanfield.functions.urls import absolutise
from gleanfield.operators.gazetteer import Gazetteer
from gleanfield.operators.html import fields_of, may_hold, read_pages
from gleanfield.operators.listing import (
    attach_listing_context, calendar_seed, dedupe_requests, follow_pagination,
)
from gleanfield.operators.markup import Field, Rule
from gleanfield.session import cut_lineage, small_side
from gleanfield.sources.io import merge_by_name
from gleanfield.sources.sites import SITES, Site, map_site


# Bytes from which a page is long: it is read without a look by patterns first, and not shuffled unless it is wanted.
LONG = 4 << 20


def harvest(name: str, pages: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    """Pages (`url`, `body`) that hold the records themselves, to events.

    A listing page is read once: its entries' fields come out of the same pass that finds
    the entries. Other bodies are detail pages, JSON or CSV documents.
    """
    site = SITES[name]
    if site.entry:
        entries = fields_of(F.col("body"), {"e": Field(site.entry, "rows", sub=site.fields)})["e"]
        keep = [c for c in pages.columns if c != "body"]
        raw = pages.select(*keep, F.posexplode(entries).alias("row_index", "raw"))
        events = site.project(site, raw, gazetteer)
    else:
        events = map_site(name, pages, gazetteer)
    return site.stages(gazetteer)(events)


def next_of(site: Site) -> tuple[Field, Column]:
    """Where a listing page names the next one, and that value as an address."""
    attr, before = site.next_number or ("href", "")
    value = F.col("n")
    if before:
        return Field(site.next_page, f"attr:{attr}"), F.concat(F.lit(before), value)
    return Field(site.next_page, "attr:href"), _target(site.base_url, value)


def _target(base_url: str, href: Column) -> Column:
    return F.when(href.startswith("/"), absolutise(base_url, href)).otherwise(href)


def next_links(
    pages: DataFrame, path: tuple[Rule, ...], base_url: str = "", number: tuple[str, str] = ()
) -> DataFrame:
    """`url`, `next_url` of the pages that have a next one; others may be missing or NULL."""
    site = replace(SITES["events_calendar"], base_url=base_url, next_page=path, next_number=number)
    field, address = next_of(site)
    pages = pages.where(may_hold(F.col("body"), path))
    found = pages.select("url", fields_of(F.col("body"), {"n": field})["n"].alias("n"))
    return found.select("url", address.alias("next_url"))


def first_pages(site: Site, spark: SparkSession, today: Column | None = None) -> DataFrame:
    """`seed`: addresses of a site's first listing pages."""
    if not site.months:
        return spark.createDataFrame([(site.base_url + site.events_path,)], "seed string")
    start = F.current_date() if today is None else today
    one = spark.range(1)
    return calendar_seed(one, site.base_url, site.events_path, start, site.months).select(
        F.col("url").alias("seed")
    )


def link_fields(site: Site) -> dict[str, Field]:
    """The links of a listing page and the lists beside them."""
    return {"href": Field(site.links, "all_attr:href")} | {f"b_{k}": f for k, f in site.beside.items()}


def harvest_details(
    name: str, pages: DataFrame, gazetteer: Gazetteer, seeds: DataFrame | None = None,
    max_depth: int | None = None, today: Column | None = None,
) -> DataFrame:
    """Listing pages, their pagination and links, then the detail pages joined by URL.

    `pages` (`url`, `body`) holds listing and detail pages; `seeds` (`seed`) names the first
    listing pages, by default the site's own (a calendar begins with the month of `today`).
    A page captured more than once counts once, whichever capture that is.

    Bodies are scanned twice. The first scan reads those that look like a listing page, by
    patterns in the JVM, and keeps what they list, which is narrow; the second takes the
    detail pages that are wanted. Sites with records on the listing itself need the first only.
    Where the first meets a page above `LONG`, a third scan takes those of them that are wanted, if any.
    """
    site = SITES[name]
    seeds = first_pages(site, pages.sparkSession, today) if seeds is None else seeds
    fields = {}
    if site.next_page:
        fields["n"], next_url = next_of(site)
    if site.entry:
        fields["e"] = Field(site.entry, "rows", sub=site.fields)
    else:
        fields |= link_fields(site)
    listing_path = site.entry or site.links
    like_listing = may_hold(F.col("body"), listing_path)
    if site.next_page:
        like_listing |= may_hold(F.col("body"), site.next_page)
    long = F.coalesce(F.octet_length("body") > LONG, F.lit(False))
    first = small_side(seeds.select(F.col("seed").alias("url")).distinct().withColumn("_first", F.lit(True)))
    # Not deterministic, so it is not pushed below what makes the pages, which would make a copy of each or make it again.
    here = F.when(F.monotonically_increasing_id() >= 0, long | like_listing)
    candidates = pages.where(here).select("url", "body", long.alias("_long"))
    if not site.next_page:
        # of a long page that is no seed, the address alone
        candidates = candidates.join(first, "url", "left").where("_first or _long")
        candidates = candidates.select("url", F.when(F.col("_first"), F.col("body")).alias("body"), "_long", "_first")
    scanned = read_pages(candidates, "body", fields)
    if not site.next_page:
        # what a long page lists is sorted for the dedupe apart from the page
        scanned = scanned.repartition("url")
    scanned = cut_lineage(dedupe_requests(scanned))
    listing = scanned if site.next_page else scanned.where("_first")
    if site.next_page:
        reached = follow_pagination(
            scanned.select("url", next_url.alias("next_url")), seeds, max_depth, per_seed=False
        )
        listing = scanned.join(small_side(reached.select("url").distinct()), "url", "left_semi")
    if site.entry:
        raw = listing.select("url", F.posexplode("e").alias("row_index", "raw"))
        return site.stages(gazetteer)(site.project(site, raw, gazetteer))
    links = cut_lineage(listed_links(site, listing))
    wanted = links.select("url").distinct()
    there = scanned.where("_long").select("url")
    if there.isEmpty():
        details = pages.join(small_side(wanted), "url", "left_semi")
    else:
        details = pages.where(~long).join(small_side(wanted), "url", "left_semi")
        named = links.join(small_side(there), "url", "left_semi").select("url").distinct()
        if not named.isEmpty():
            details = details.unionByName(pages.where(long).join(small_side(named), "url", "left_semi"))
    details = dedupe_requests(details)
    context = [k for k in site.beside if k]
    if context:
        details = attach_listing_context(details, links, context, order=["_page", "_pos"])
    return site.stages(gazetteer)(map_site(name, details, gazetteer))


def listed_links(site: Site, listing: DataFrame, *also: str) -> DataFrame:
    """`_page`, `_pos`, `url` and what stands beside each link followed, and the columns `also` of its page.

    `listing` holds `href` and the lists beside it as `fields_of` reads them.
    """
    hrefs = F.col("href")
    if site.link_prefix:
        hrefs = F.array_compact(F.array(first_link_with_prefix(hrefs, site.link_prefix)))
    names = list(site.beside)
    lists = [F.transform(F.col(f"b_{k}"), lambda x: F.substring_index(x, ":", -1)) for k in names]
    # One list by another, cut to the shortest: surplus links are not followed.
    def pair(h, *more):
        beside = [m.alias(k or "_entry") for k, m in zip(names, more)]
        return F.struct(h.alias("href"), *beside)

    pairs = amap(pair, hrefs, *lists) if lists else hrefs
    found = listing.select(F.col("url").alias("_page"), *also, F.posexplode(pairs).alias("_pos", "_l"))
    return found.select(
        "_page", "_pos", *also, _target(site.base_url, F.col("_l.href" if lists else "_l")).alias("url"),
        *[F.col(f"_l.{k}") for k in names if k],
    )


def merge_sources(events: list[DataFrame]) -> DataFrame:
    """Event tables of several sources as one."""
    return merge_by_name(events)
