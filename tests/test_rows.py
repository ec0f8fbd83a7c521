import json
import random

import pytest
from pyspark.sql import functions as F

from gleanfield.functions import collections as c
from gleanfield.operators import rows


@pytest.fixture(scope="module")
def events(spark):
    """One key holds most rows, one is NULL, order values clump and repeat."""
    r = random.Random(7)
    data = []
    for i in range(3000):
        key = r.choice(["hot"] * 8 + ["a", "b", None])
        t = r.choice([r.randint(0, 10), r.randint(0, 10**6), 5])
        data.append((key, t, i, r.choice(["x", "x", "y", None])))
    return data, spark.createDataFrame(data, "k string, t long, i long, v string")


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda x: (x[1], x[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_neighbours(events, hot_rows):
    data, df = events
    groups = by_key(data)
    got = rows.pairwise(df, ["k"], ["t", "i"], "v", hot_rows=hot_rows).collect()
    expected = set()
    for g in groups.values():
        for a, b in zip(g, [*g[1:], None]):
            expected.add((*a, b and b[3], b is None))
    assert {tuple(x) for x in got} == expected and len(got) == len(data)

    got = rows.remove_adjacent_dup(df, ["k"], ["t", "i"], "v", hot_rows=hot_rows).collect()
    expected = {
        a for g in groups.values() for a, b in zip(g, [*g[1:], None]) if b is None or a[3] != b[3]
    }
    assert {tuple(x) for x in got} == expected and len(got) == len(expected)


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_chunks_and_lists(events, hot_rows):
    data, df = events
    got = rows.chunks(df, ["k"], ["t", "i"], "v", 7, F.lit("fill"), hot_rows=hot_rows).collect()
    expected = {}
    for k, g in by_key(data).items():
        values = [x[3] for x in g]
        for n in range(0, len(values), 7):
            part = values[n : n + 7]
            expected[k, n // 7] = part + ["fill"] * (7 - len(part))
    assert {(x.k, x.chunk): x["items"] for x in got} == expected
    whole = rows.lot2dol(df, ["k"], "i", ["t", "i"], piece=1000, hot_rows=hot_rows).collect()
    lists = {}
    for x in sorted(whole, key=lambda x: x.chunk):
        lists.setdefault(x.k, []).extend(x["items"])
    assert lists == {k: [x[2] for x in g] for k, g in by_key(data).items()}
    rows_of = {(x.k, x.ord): x.value for x in rows.lot2dol(df, ["k"], "i", ["t", "i"], hot_rows=hot_rows).collect()}
    assert rows_of == {(k, n): x[2] for k, g in by_key(data).items() for n, x in enumerate(g)}


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "double"])
@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_any_order_at_any_size(spark, kind, hot_rows):
    """The same rows whether a key counts as hot or not; NULLs come first."""
    days = [None if i % 7 == 0 else f"20{i % 13 + 10}-01-0{i % 9 + 1}" for i in range(200)]
    df = spark.createDataFrame([("a", d, i) for i, d in enumerate(days)], "k string, d string, i int")
    order = F.length("d") + F.col("i") % 5 if kind == "double" else F.col("d")
    df = df.withColumn("d", order.cast(kind))
    got = rows.pairwise(df, ["k"], ["d", "i"], "i", hot_rows=hot_rows).collect()
    placed = sorted(df.collect(), key=lambda r: (r.d is not None, r.d if r.d is not None else 0, r.i))
    after = {a.i: b.i for a, b in zip(placed, placed[1:])}
    assert {r.i: r.next for r in got} == {r.i: after.get(r.i) for r in placed}


def test_hot_key_with_ties_is_cut_evenly(spark):
    df = spark.range(100_000).selectExpr("'hot' k", "1 t", "id i")
    cut = rows._cut_hot_keys(df, ["k"], ["t", "i"], 10_000)
    sizes = [r["count"] for r in cut.df.groupBy("k", "_slice").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) >= 10 and max(sizes) < 2 * 100_000 / len(sizes)


def test_dol2lot(spark):
    df = spark.sql("select 1 id, map('k', array(1,2), 'n', null, 'e', array()) m")
    assert [tuple(x) for x in rows.dol2lot(df, "m").collect()] == [(1, "k", 1), (1, "k", 2), (1, "n", None)]
    df = df.withColumn("p", c.dol_pairs(F.col("m"))).withColumn("d", c.pairs_dol(F.col("p")))
    row = df.first()
    assert [tuple(p) for p in row.p] == [("k", 1), ("k", 2), ("n", None)]
    assert row.d == {"k": [1, 2], "n": [None]}


def flat(y):
    out = {}

    def go(x, path):
        if isinstance(x, dict):
            for k, v in x.items():
                go(v, [*path, k])
        elif isinstance(x, list):
            for i, v in enumerate(x):
                go(v, [*path, str(i)])
        else:
            out["_".join(path)] = x
    go(y, [])
    return out


def test_flatten_json(spark):
    docs = [
        {"a": {"b": [1, {"c": 2}]}, "e": []}, {"x": None, "y": "s", "z": {"": {"q": True}}}, [1, [2]],
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, j string")
    got = {(x.id, x.path): x.value for x in rows.flatten_json(df, "j").collect()}
    as_variant = rows.flatten_json(df.withColumn("j", F.parse_json("j")), "j").collect()
    assert {(x.id, x.path): x.value for x in as_variant} == got
    text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    assert got == {(i, k): text(v) for i, d in enumerate(docs) for k, v in flat(d).items()}
    deep = "[" * 3000 + "7" + "]" * 3000
    odd = [(0, '{"a_b": 1, "a": {"b": 2.50}}'), (1, '{"a": '), (2, None), (3, deep), (4, "5"), (5, "{}"), (6, "[" * 10**6)]
    got = {r.id: (r.path, r.value, r.reject_reason) for r in rows.flatten_json(spark.createDataFrame(odd, "id int, j string"), "j").collect()}
    assert got[0] == ("a_b", "2.50", None) and got[1][2] == "not JSON" and got[2][2] == "no document"
    assert got[3] == ("_".join("0" * 3000), "7", None) or got[3][2] == "nested too deep to read"
    assert got[4] == (None, "5", None) and 5 not in got and got[6][2]


def test_array_functions(spark):
    df = spark.sql(
        "select array('A','B','C','D','E','F','G') a, array('x','', null) s, array(1,2,3) n, array() e"
    ).select(
        c.chunk_array(F.col("a"), 3, F.lit("x")).alias("chunks"),
        c.chunk_array(F.col("s"), 3, F.lit("x")).alias("full"),
        F.size(c.chunk_array(F.col("e").cast("array<string>"), 3, F.lit("x"))).alias("none"),
        c.afilter(F.col("s")).alias("kept"),
        c.afilter(F.col("n"), lambda x: x > 1).alias("over"),
        c.amap(lambda x, y: F.concat(x, y.cast("string")), F.col("a"), F.col("n")).alias("two"),
        c.amap(lambda x, y, z: x + y + z, F.col("n"), F.col("n"), F.col("n")).alias("three"),
        c.zip_positional(F.col("a"), F.col("n")).alias("zip"),
        c.to_int_array(F.array(F.lit("3"), F.lit("x"))).alias("ints"),
        c.to_str_array(F.col("n")).alias("strs"),
        c.first_link_with_prefix(F.array(F.lit("/a"), F.lit("/b/1"), F.lit("/b/2")), "/b").alias("link"),
        c.map_values(F.create_map(F.lit("k"), F.lit(2)), lambda v: v * 2).alias("m"),
        c.flatten(F.array(F.col("n"), F.col("n"))).alias("flat"),
    )
    r = df.first()
    assert [list(x) for x in r.chunks] == [list("ABC"), list("DEF"), ["G", "x", "x"]]
    assert r.full == [["x", "", None]] and r.none == 0 and r.kept == ["x"] and r.over == [2, 3]
    assert r.two == ["A1", "B2", "C3"] and r.three == [3, 6, 9]
    assert [tuple(z) for z in r.zip] == [("A", 1), ("B", 2), ("C", 3)]
    assert r.ints == [3, None] and r.strs == ["1", "2", "3"] and r.link == "/b/1"
    assert r.m == {"k": 4} and r.flat == [1, 2, 3, 1, 2, 3]


@pytest.mark.parametrize(
    "records, modes, expected",
    [
        (['{"a":1,"b":{"x":1}}', '{"b":{"y":2}}'], ("update", "override"), {"a": 1, "b": {"x": 1, "y": 2}}),
        (['{"a":1,"b":{"x":1}}', '{"b":{"y":2}}'], ("override", "override"), {"a": 1, "b": {"y": 2}}),
        (['{"l":[1]}', '{"l":[1,2,2]}'], ("override", "set"), {"l": [1, 2, 2]}),
        (['{"l":[1]}', '{"l":[1,2,2]}'], ("override", "append"), {"l": [1, 1, 2, 2]}),
        (['{"l":[1]}', '{"l":[3]}'], ("override", "override"), {"l": [3]}),
        (['{"a":1}', '{"a":null}', '{"c":"s"}'], ("update", "set"), {"a": None, "c": "s"}),
        (['{"a":{"x":1}}', '{"a":[1]}'], ("update", "append"), {"a": [1]}),
    ],
)
def test_soft_update(spark, records, modes, expected):
    df = spark.createDataFrame([tuple(records)], ", ".join(f"r{i} string" for i in range(len(records))))
    maps = [F.from_json(f"r{i}", "map<string,variant>") for i in range(len(records))]
    out = df.select(F.to_json(c.soft_update(maps, *modes)).alias("j")).first().j
    assert json.loads(out) == expected


def test_a_low_threshold_makes_no_more_ranges(events, spark):
    _, df = events
    cut = rows._cut_hot_keys(df, ["k"], ["t", "i"], 1)
    assert cut.hot.count() == df.count()
    assert cut.hot.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
