"""Listing and detail pages that arrive in any order, against the same pages read as tables."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanfield.operators.stages import accepted
from gleanfield.plans.catalog import ORACLES, QUERIES, sites
from gleanfield.sources.sites import SITES
from gleanfield.streaming.pages import CAPTURE_SCHEMA, details_stream, page_stream, visited_once, write_stream

SF = "/root/testdata/sf0.001"
LISTING = {
    "bia": "contains(url, '/list/')", "ibioic": "contains(url, '/list/')", "solebury_trout": "contains(url, '/list/')", "swiss_biotech": None,
    "ausbiotech": r"url rlike '[?]month=1[12]&year=2024$|year=2025$|[?]month=([1-9]|10)&year=2026$'",  # the months its seeds name
}
FLOWS = {"q_flow_bia": "bia", "q_flow_ibioic": "ibioic", "q_flow_solebury": "solebury_trout", "q_flow_swiss": "swiss_biotech", "q_flow_ausbiotech": "ausbiotech"}


def run(spark, name, gazetteer, folder, listing=None, within="30 days"):
    pages = page_stream(spark, str(folder / "pages"), CAPTURE_SCHEMA, files_per_trigger=1)
    events = details_stream(name, pages, gazetteer, listing and F.expr(listing), within)
    write_stream(events, str(folder / "events"), str(folder / "checkpoint")).awaitTermination()
    return spark.read.parquet(str(folder / "events"))


def add(pages, folder, minute):
    """One file of pages, captured in that minute."""
    at = F.lit(dt.datetime(2024, 11, 20, 10, minute))
    pages.select("url", "body", at.alias("captured")).coalesce(1).write.mode("append").parquet(str(folder / "pages"))


@pytest.mark.parametrize("query", FLOWS)
def test_flows_over_three_batches(spark, tmp_path, monkeypatch, query):
    """A third of all pages arrives in each batch, details before their listings and after."""
    name = FLOWS[query]

    def as_stream(site, listing, details, gazetteer, **_):
        assert site == name
        pages = listing.unionByName(details)
        for part in range(3):
            add(pages.where(F.pmod(F.xxhash64("url"), F.lit(3)) == part), tmp_path, part)
        return accepted(run(spark, name, gazetteer, tmp_path, LISTING[name])).withColumn("start_date", F.col("start"))

    monkeypatch.setattr(sites, "_flow", as_stream)
    got = QUERIES[query](spark, SF)
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    columns = sorted(got.columns)
    found = con.execute(ORACLES[query])
    names = [d[0] for d in found.description]
    want = sorted(repr(tuple(dict(zip(names, r))[c] for c in columns)) for r in found.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want and want


BIA = (
    "<h1>{}</h1><div class='content-wrapper'>Text</div><div class='after-heading-meta'><ul><li>3 Jun 25 - 4 Jun 25</li><li>Hall</li></ul>"
    "<ul><li>x</li></ul></div>"
)
ITEM = "<div class='widget-events-item'><div class='widget-events-item-img'><a href='/d/{}'>x</a></div></div>"


def bia(spark, pages):
    base = SITES["bia"].base_url
    rows = [(base + u, "<body>" + "".join(ITEM.format(i) for i in b) + "</body>" if isinstance(b, list) else BIA.format(b)) for u, b in pages]
    return spark.createDataFrame(rows, "url string, body string")


def test_a_restart_gives_no_second_event(spark, gazetteer, tmp_path):
    names = lambda df: sorted(r["name"] for r in df.collect())
    listing = LISTING["bia"]
    add(bia(spark, [("/list/1", [1, 2]), ("/d/1", "One"), ("/d/3", "Three"), ("/d/9", "Not named")]), tmp_path, 0)
    assert names(run(spark, "bia", gazetteer, tmp_path, listing)) == ["One"]
    add(bia(spark, [("/list/1", [1, 2]), ("/list/2", [1, 3]), ("/d/1", "One again"), ("/d/2", "Two")]), tmp_path, 5)
    assert names(run(spark, "bia", gazetteer, tmp_path, listing)) == ["One", "Three", "Two"]
    assert names(run(spark, "bia", gazetteer, tmp_path, listing)) == ["One", "Three", "Two"]


def test_pages_too_far_apart_do_not_meet(spark, gazetteer, tmp_path):
    add(bia(spark, [("/d/1", "One"), ("/d/2", "Two")]), tmp_path, 0)
    add(bia(spark, [("/list/1", [1]), ("/d/7", "Seven")]), tmp_path, 9)
    add(bia(spark, [("/list/2", [2, 7])]), tmp_path, 30)
    got = run(spark, "bia", gazetteer, tmp_path, LISTING["bia"], within="22 minutes")
    assert sorted(r["name"] for r in got.collect()) == ["One", "Seven"]


def test_a_url_is_visited_once_until_it_is_forgotten(spark, tmp_path):
    at = lambda m: dt.datetime(2025, 1, 1, 10, m)
    batches = [[("a", at(0)), ("a", at(1)), (None, at(1)), ("b", None)], [("a", at(3)), ("b", at(4))], [("c", at(40))], [("a", at(41)), ("c", at(42))]]
    seen = []
    for number, rows in enumerate(batches):  # one run of the query for each
        spark.createDataFrame(rows, "url string, captured timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        pages = spark.readStream.schema("url string, captured timestamp").parquet(str(tmp_path / "in"))
        write_stream(visited_once(pages, "10 minutes"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        rows = spark.read.schema("url string, captured timestamp").parquet(str(tmp_path / "out")).collect()
        seen.append(sorted(r["url"] for r in rows))
    assert seen == [["a"], ["a", "b"], ["a", "b", "c"], ["a", "a", "b", "c"]]


def test_sites_without_details_are_refused(spark, gazetteer):
    pages = spark.readStream.schema(CAPTURE_SCHEMA).parquet(SF + "/pages.parquet")
    with pytest.raises(ValueError):
        details_stream("bio", pages, gazetteer)
