"""Registered queries against their SQL, revisits, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest
from helpers import no_documents, odd_documents, table
from test_mix_and_pack import PATH, brute_targets
from test_search_and_links import brute_components

import corpus_pipeline
from gleanfield.llm import packing, revisits
from gleanfield.llm.common import stored
from gleanfield.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    want = sorted(repr(x) for x in want.select(*[f'"{c}"' for c in columns]).fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want and want


# -- revisits -------------------------------------------------------------------------------

RECORDS = "record_id string, url string, captured long, kind string, status int, headers string, found string"


def resolved(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], RECORDS)
    return {r["record_id"]: r for r in revisits.resolve(df).collect()}


def test_revisit_takes_the_latest_earlier_response(spark):
    tag = lambda x, more="": f'ETag: "{x}"\r\nContent-Type: text/html\r\nContent-Length: 9{more}'
    got = resolved(
        spark,
        [
            ("f1", "http://A.example:80/p#x", 1, "response", 200, tag("1")),
            ("f2", "https://a.example/p?utm_source=q", 5, "response", 200, tag("2", "\r\nX-Old: 1\r\nAge: 4\r\nage: 5")),
            ("f3", "http://a.example/p", 6, "response", 404, tag("3")),
            ("r0", "http://a.example/p", 1, "revisit", 304, tag("1")),  # a response at the same time is not earlier
            ("r1", "http://a.example/p", 4, "revisit", 304, tag("1")),
            ("r2", "http://a.example/p", 7, "revisit", 304, 'etag: W/"2"\nContent-Length: 0\nAge: 1\nDate: now: 5\nno header'),
            ("r3", "http://a.example/p", 8, "revisit", 304, tag("1")),
            ("r4", "http://a.example/P", 8, "revisit", 304, tag("1")),
            ("r5", "http://a.example/p", 9, "revisit", 304, None),
            ("r6", None, 9, "revisit", 304, None),
            ("r7", "http://a.example/p", None, "revisit", 304, ""),
            ("f4", None, 2, "response", 200, tag("1")),
            (None, "http://b.example", 3, "revisit", 304, "Last-Modified: m"),
            ("f5", "http://b.example/", 2, "response", 200, "Last-Modified: m\nETag: z"),
        ],
    )
    assert {k: (r["refers_to"], r["outcome"]) for k, r in got.items()} == {
        "r0": (None, "missing"), "r1": ("f1", "resolved"), "r2": ("f2", "resolved"), "r3": ("f2", "changed"),
        "r4": (None, "missing"), "r5": ("f2", "unproven"), "r6": (None, "missing"), "r7": (None, "missing"), None: ("f5", "resolved"),
    }
    assert got["r2"]["headers"] == {
        "etag": 'W/"2"', "content-type": "text/html", "content-length": "9", "x-old": "1", "age": "1", "date": "now: 5",
    }
    assert got["r3"]["headers"]["etag"] == '"1"' and got["r5"]["headers"] == {}
    assert resolved(spark, []) == {}


def test_hot_address_spreads_over_ranges(spark):
    """Half of all captures have one address; some ranges hold no response of it at all."""
    rows = [(f"f{i}", "http://hot.example/", 50 * i, "response", 200, f"ETag: {i}") for i in range(20)]
    rows += [(f"r{i}", "http://hot.example/", i, "revisit", 304, f"ETag: {i // 50}") for i in range(1, 1000) if i % 50]
    rows += [(f"q{i}", f"http://{i}.example/", 3, "revisit", 304, "ETag: 1") for i in range(1000)]
    rows += [(f"p{i}", f"http://{i}.example/", 2, "response", 200, "ETag: 1") for i in range(0, 1000, 2)]
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = resolved(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(got[f"r{i}"]["refers_to"] == f"f{i // 50}" for i in range(1, 1000) if i % 50)
    assert all(got[f"q{i}"]["refers_to"] == (f"p{i}" if i % 2 == 0 else None) for i in range(1000))


@pytest.mark.parametrize(
    "url, want",
    [("HTTP://WWW.A.Example:80/X?a=1&utm_x=2#f", "www.a.example/X?a=1"), ("https://a.example:443", "a.example/"), ("a.example?utm_a=1", "a.example/"),
     ("http://a.example:8080/?utm_a=1&b=2", "a.example:8080/?b=2"), ("", ""), (" ftp://h/p? ", "h/p")],
)
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisits.canonical_url(df["u"])).first()[0] == want


# -- pipeline -------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    outs = [docs]
    for _, stage in corpus_pipeline.STAGES:
        outs.append(stored(stage(spark, outs[-1], FOLDER)))
    for before, after in zip(outs[:-2], outs[1:-1]):
        assert after.dtypes == before.dtypes
    rows = [o.collect() for o in outs]
    good = {r["doc_id"] for r in rows[1]}
    right = [(i in good) == (q == 1) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)  # some 50 labels to learn from
    largest = {}
    for r in rows[1]:
        key = r["text"].encode().lower()
        largest[key] = max(largest.get(key, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(largest.values())
    links = brute_components([(r["doc_id"], r["text"]) for r in rows[2]], width=5)
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(i for i, (_, c) in links.items() if c == i)
    sizes, taken = {}, {}
    for r in rows[3]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    for r in rows[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.05 * target + 60
    assert {tuple(r) for r in rows[4]} <= {tuple(r) for r in rows[3]}
    assert sum(r["length"] for r in rows[5]) == sum(
        r["doc_tokens"] for r in packing.pack(outs[4], PATH).collect() if r["start"] == 0
    )
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda r: tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens"))
    assert sorted(map(key, whole)) == sorted(map(key, rows[5]))


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_stages_of_odd_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, FOLDER))
        assert after.dtypes == docs.dtypes, name
        docs = after
    corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
