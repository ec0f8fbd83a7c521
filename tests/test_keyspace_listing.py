from pyspark.sql import functions as F

from gleanfield.operators import listing
from gleanfield.operators.keyspace import refine_capped_queries, refine_to_end, string_combinations


def terms(spark, seed, **kw):
    df = spark.createDataFrame([(seed,)], "s string")
    return [r.term for r in string_combinations(df, "s", **kw).collect()]


def test_combinations(spark):
    go = lambda **kw: terms(spark, "a", alphabet="abc", min_length=2, **kw)
    assert go() == ["aa", "ab", "ac"]
    assert go(start="ab") == ["ab", "ac"]
    assert go(end="ab") == ["aa", "ab"]
    assert go(pattern="^a[bc]") == ["ab", "ac"]
    assert go(variants={"c": ["ch"]}) == ["aa", "ab", "ac", "ach"]
    assert len(terms(spark, "", min_length=2)) == 36**2
    deep = terms(spark, "", alphabet="abc", min_length=3, start="ab", end="bca")
    everything = [x + y + z for x in "abc" for y in "abc" for z in "abc"]
    assert deep == [t for t in everything if "ab" <= t[:2] and t[:3] <= "bca"]
    assert len(terms(spark, "abcde", min_length=6)) == 36
    assert terms(spark, "", min_length=5, start="aaaaa", end="aaaaa") == ["aaaaa"]


def test_combinations_from_index(spark):
    got = terms(
        spark, "hi", start="ho", end="hq", min_length=3, index=1, alphabet="nopqr",
        variants={"o": ["oh", "obuh"]},
    )
    expected = []
    for c in ["o", "oh", "obuh", "p", "q"]:
        if len("h" + c) >= 3:
            expected.append("h" + c)
        else:
            expected += ["h" + c + d for d in ["n", "o", "oh", "obuh", "p", "q", "r"]]
    assert sorted(got) == sorted(expected)


def test_refine(spark):
    df = spark.createDataFrame(
        [("http://x/s?q=a&p=1", True), ("http://x/s?q=a", False), ("http://x/s?p=1", True),
         ("http://x/s?q=abcd", True)],
        "url string, capped boolean",
    )
    got = refine_capped_queries(df, "url", F.col("capped"), "q", alphabet="ab").collect()
    assert sorted(r.new_url for r in got) == [
        "http://x/s?q=aa&p=1", "http://x/s?q=ab&p=1", "http://x/s?q=abcda", "http://x/s?q=abcdb",
    ]
    deeper = refine_capped_queries(df, "url", F.col("capped"), "q", min_length=3, alphabet="ab")
    assert sorted(r.term for r in deeper.collect()) == ["aaa", "aab", "aba", "abb", "abcda", "abcdb"]


def refined(spark, seeds, results, **kw):
    u = "http://x/s?q="
    seeds = spark.createDataFrame([(s if s is None else u + s,) for s in seeds], "url string")
    captured = spark.createDataFrame([(t if t is None else u + t, c, "x") for t, c in results], "url string, capped boolean, outcome string")
    got = refine_to_end(seeds, captured, "url", F.col("capped"), "q", **kw).collect()
    assert all(r.url == u + r.term for r in got) and len({r.url for r in got}) == len(got)
    return {r.term: (r.parent and r.parent.removeprefix(u), r.depth, r.outcome) for r in got}


def test_refine_to_the_end(spark):
    """Three levels; `bb` stays capped as long as terms may grow, `ab` was never captured."""
    results = [("a", True), ("b", True), ("aa", True), ("aaa", False), ("aab", True), ("ba", False), ("bb", True), ("bba", True), ("bbb", None)]
    assert refined(spark, ["a", "b", "a", None], [*results, (None, True)], alphabet="ab", max_length=3) == {
        "a": (None, 0, "refined"), "b": (None, 0, "refined"),
        "aa": ("a", 1, "refined"), "ab": ("a", 1, "missing"), "ba": ("b", 1, "complete"), "bb": ("b", 1, "refined"),
        "aaa": ("aa", 2, "complete"), "aab": ("aa", 2, "stuck"), "bba": ("bb", 2, "stuck"), "bbb": ("bb", 2, "complete"),
    }
    endless = refined(spark, ["a"], [("a" * n, True) for n in range(1, 6)], alphabet="a")
    assert endless["aaaaa"][2] == "refined" and endless["aaaaaa"] == ("aaaaa", 5, "missing")


def test_terms_that_come_up_again_are_asked_once(spark):
    """`ach` is a variant's child of `a` and a child of `ac`; the seed `ac` is asked as a seed."""
    results = [("a", True), ("ac", True), ("ac", False), ("ach", True), ("acc", False)]
    got = refined(spark, ["a", "ac"], results, alphabet="ch", variants={"c": ["ch"]}, max_length=3)
    assert got == {
        "a": (None, 0, "refined"), "ac": (None, 0, "refined"), "ah": ("a", 1, "missing"), "ach": ("a", 1, "stuck"),
        "acc": ("ac", 1, "complete"),
    }


def test_refinement_without_a_way_on(spark):
    assert refined(spark, ["a"], [("a", True)], alphabet="a", start="b") == {"a": (None, 0, "stuck")}
    assert refined(spark, [], [("a", True)]) == {} and refined(spark, ["a"], []) == {"a": (None, 0, "missing")}
    seeds = spark.createDataFrame([("http://x/s?p=1",)], "url string")
    got = refine_to_end(seeds, seeds, "url", F.lit(True), "q").collect()
    assert [tuple(r) for r in got] == [("http://x/s?p=1", None, None, 0, "stuck")]


def test_calendar(spark):
    df = spark.sql("select 1 id, date'2019-11-15' d")
    got = listing.calendar_seed(df, "http://x", "/c", F.col("d"), 3).collect()
    assert [(r.month, r.year, r.url) for r in got] == [
        (11, 2019, "http://x/c?month=11&year=2019"), (12, 2019, "http://x/c?month=12&year=2019"),
        (1, 2020, "http://x/c?month=1&year=2020"),
    ]
    assert listing.calendar_seed(df, "", "", F.col("d")).count() == 24


def test_pagination(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(37)] + [("c37", None)]
    ring = [(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)]
    links = spark.createDataFrame(chain + ring + [("s0", "c30")], "url string, next_url string")
    seeds = spark.createDataFrame([("c0",), ("r3",), ("s0",), ("gone",)], "seed string")
    got = {(r.seed, r.url, r.depth) for r in listing.follow_pagination(links, seeds).collect()}
    expected = {("c0", f"c{i}", i) for i in range(38)}
    expected |= {("r3", f"r{(3 + i) % 5}", i) for i in range(5)}
    expected |= {("s0", "s0", 0), ("gone", "gone", 0)} | {("s0", f"c{30 + i}", i + 1) for i in range(8)}
    assert got == expected
    short = listing.follow_pagination(links, seeds.where("seed = 'c0'"), max_depth=5)
    assert sorted(r.depth for r in short.collect()) == list(range(6))


def test_dedupe_and_context(spark):
    pages = spark.createDataFrame([("u", 2, "late"), ("u", 1, "first"), ("w", 5, None)], "url string, n int, t string")
    got = listing.dedupe_requests(pages, ["n"])
    assert sorted(map(tuple, got.collect())) == [("u", 1, "first"), ("w", 5, None)]
    detail = spark.createDataFrame([("u", None), ("w", "own"), ("z", None)], "url string, organizer string")
    entries = spark.createDataFrame(
        [("u", "listed", 1), ("u", "later", 2), ("w", "listed", 3)], "url string, organizer string, i int"
    )
    got = listing.attach_listing_context(detail, entries, ["organizer"], order=["i"])
    assert sorted(map(tuple, got.collect())) == [("u", "listed"), ("w", "own"), ("z", None)]


def test_estimated_size_does_not_grow_with_the_rounds_of_pagination(spark):
    links = spark.range(600).selectExpr("'p' || id url", "if(id < 599, 'p' || (id + 1), null) next_url")
    reached = listing.follow_pagination(links, spark.sql("select 'p0' seed"), per_seed=False)
    assert reached.count() == 600
    assert reached._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**64
