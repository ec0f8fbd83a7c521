"""Nearest neighbours, near copies and exact copies against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from helpers import lower, no_documents, odd_documents, table, words

from gleanfield.llm import cuckoo, forest, vantage


# -- nearest neighbours ---------------------------------------------------------------------


def brute_nearest(rows, k=20):
    """{query: [(vec_id, score)]} of rows (vec_id, vector) by all inner products."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            scores = (x * q).sum(1)
            order = sorted((-s, j) for s, j in zip(scores, ids) if j != i)[:k]
            out[int(i)] = [(int(j), -s) for s, j in order]
    return out


def found_nearest(df):
    out = {}
    for r in sorted(df.collect()):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.fixture()
def small_shards(monkeypatch):
    monkeypatch.setattr(vantage, "SHARD_ROWS", 60)
    monkeypatch.setattr(vantage, "LEAF_ROWS", 8)


def test_factor_one_is_exact(spark, small_shards):
    vectors = table(spark, "embeddings", "/root/testdata/sf0.01")
    want = brute_nearest([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    got = found_nearest(vantage.nearest(vectors, "vec_id % 20 = 0", factor=1.0))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_default_factor_recalls_most(spark, small_shards):
    vectors = table(spark, "embeddings", "/root/testdata/sf0.01")
    want = brute_nearest([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    got = found_nearest(vantage.nearest(vectors, "vec_id % 20 = 0"))
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in x}) for q, x in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_copies_and_unusable_vectors(spark, small_shards):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], "a") for i in range(100)] + [(100 + i, [0.0, 1.0 + i], "b") for i in range(30)]
    bad = [(200, None, ""), (220, [0.0, 0.0], ""), (240, [nan, 1.0], ""), (260, [None, 1.0], ""), (280, [inf, 1.0], ""), (300, [1.0], ""), (320, [], ""), (None, [1.0, 1.0], "")]
    repeated = rows[:3]
    df = spark.createDataFrame(rows + bad + repeated, "vec_id long, embedding array<float>, class string")
    got = found_nearest(vantage.nearest(df, "vec_id % 20 = 0", factor=1.0))
    want = brute_nearest([(i, v) for i, v, _ in rows])
    assert got == {q: [(i, float(s)) for i, s in x] for q, x in want.items()}
    assert vantage.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0


def check_exact(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found_nearest(vantage.nearest(df, "vec_id % 20 = 0", factor=1.0, **how)) == brute_nearest(rows)


def test_ties_go_to_the_smaller_id_over_all_shards(spark, small_shards):
    """499 different vectors score 1 against (1, 0); integer vectors tie in any number."""
    rng = np.random.default_rng(5)
    order = rng.permutation(499).tolist()
    check_exact(spark, [(0, [1.0, 0.0])] + [(i + 1, [1.0, float(y)]) for i, y in enumerate(order)])
    check_exact(spark, [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-2, 3, (400, 4))) if v.any()])


def test_crowded_shards_are_searched_in_parts(spark, small_shards, monkeypatch):
    """Shards come from 12 of 900 vectors, most of which lie in one place."""
    monkeypatch.setattr(vantage, "SAMPLE_ROWS", 12)
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(size=(100, 3)), 1 + 1e-3 * rng.normal(size=(800, 3))])
    sizes, split = [], vantage.Tree.build

    def build(points, leaf_rows, seed=1):
        tree = split(points, leaf_rows, seed)
        sizes.append(len(tree.leaves))
        return tree

    monkeypatch.setattr(vantage.Tree, "build", build)
    rows = [(i, x.tolist()) for i, x in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found_nearest(vantage.nearest(df, "vec_id % 20 = 0", factor=1.0, shard_rows=40)), brute_nearest(rows)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert len(sizes) == 1 and sizes[0] <= 12  # the driver's only tree is the sample's


def test_tree_bounds_hold():
    points = np.random.default_rng(3).normal(size=(300, 5))
    tree = vantage.Tree.build(points, 10)
    queries = np.random.default_rng(4).normal(size=(20, 5))
    bounds, far = tree.bounds(queries), vantage.distances(queries, points)
    assert sorted(np.concatenate(tree.leaves)) == list(range(300))
    for leaf, rows in enumerate(tree.leaves):
        assert (bounds[:, leaf] <= far[:, rows].min(1) + 1e-9).all()


# -- near copies ----------------------------------------------------------------------------


def brute_components(rows, width=2, percent=80):
    """{doc_id: (n_shingles, component)} of rows (doc_id, text)."""
    sets = {}
    for i, text in rows:
        w = words(text)
        n = min(width, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def found_components(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_equal_brute_force(spark, width):
    docs = table(spark, "documents")
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], width)
    assert len({c for _, c in want.values()}) < len(want)
    assert found_components(forest.near_copies(docs, shingle=width)) == want


def planted(seed=5, families=12):
    """Families of edited texts around the limit: stars around a base, chains, and copies of copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, i = [], 0
    for family in range(families):
        base = [word() for _ in range(120)]
        text = base
        for _ in range(25):
            if family % 3 != 1:
                text = list(base)
            else:
                text = list(text)
            for _ in range(r.choice((2, 4, 6))):
                text[r.randrange(120)] = word()
            rows.append((i, " ".join(text)))
            i += 1
        rows.append((i, " ".join(base)))
        i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [(3000, 512), (10, 512), (3000, 8)])
def test_stars_and_chains(spark, monkeypatch, limits):
    """The same links whether clusters are verified in a task or by blocks, regions whole or cut."""
    monkeypatch.setattr(forest, "GIANT_ROWS", limits[0])
    monkeypatch.setattr(forest, "BLOCK_ROWS", 7)
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_components(forest.near_copies(docs, region=limits[1]))
    assert got == brute_components(rows)


def test_pairs_in_a_large_region_are_connected(spark):
    """Isolated pairs at 0.8 whose region is far above the limit at every depth: all values in the trees are the same."""
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 256, (20, forest.SKETCH), dtype=np.uint8)
    copies = sketches.copy()
    copies[:, rng.permutation(forest.SKETCH)[:12]] += 1
    names = rng.permutation(40).tolist()
    values = bytes(2 * forest.TREES * forest.VALUES)
    rows = [(n, values, x.tobytes()) for n, x in zip(names, np.concatenate([sketches, copies]))]
    classes = spark.createDataFrame(rows, "class long, values binary, sketch binary")
    got = {r["node"]: r["component"] for r in forest.connected(classes, 3, 8).collect()}
    assert got == {n: min(pair) for pair in zip(names[:20], names[20:]) for n in pair}


def test_near_copies_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = forest.near_copies(docs).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert got[1][1:] == (1, True) and got[2][1:] == (1, False)
    assert got[3] == (0, 3, True) and got[4] == (0, 4, True) and got[6] == (1, 6, True)
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    assert forest.near_copies(no_documents(spark)).count() == 0
    kept = forest.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert forest.drop_near_copies(no_documents(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i + 1, i) for i in range(100, 160)] + [(500 + i, 3) for i in range(50)] + [(3, 1), (7, 5), (9, 5), (9, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in forest.components(df).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[500 + i] for i in range(50)} == {1}
    assert got[9] == got[7] == got[5] == 5 and len(got) == 61 + 50 + 2 + 3


# -- exact copies ---------------------------------------------------------------------------


def brute_copies(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lower(text), []).append(i)
    out = []
    for i, text in rows:
        own = groups[lower(text)]
        best = max((x for x in own if x is not None), default=None)
        out.append((i, best, len(own), i == best, hashlib.sha256(lower(text).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("make", [odd_documents, lambda s: table(s, "documents"), no_documents])
def test_exact_copies_equal_brute_force(spark, make):
    docs = make(spark)
    got = [tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in cuckoo.dedup_exact(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_copies([(r["doc_id"], r["text"]) for r in docs.collect()])))


def test_drop_copies_keeps_one_row_per_text(spark):
    docs = odd_documents(spark)
    kept = cuckoo.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(lower(r["text"]) for r in rows) == sorted({lower(r["text"]) for r in docs.collect()})
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["2", "4", "5", "6", "7", "8", "9", "10", "None"])
    assert cuckoo.drop_copies(no_documents(spark)).count() == 0


def test_index_inserts_deletes_and_grows():
    index, live = cuckoo.CuckooIndex(buckets=2), {}
    r = random.Random(1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(4000)]
    for step in range(20_000):
        key = r.choice(keys)
        if r.random() < 0.6:
            index.insert(key, step)
            live[key] = step
        else:
            assert index.delete(key) == (live.pop(key, None) is not None)
    assert dict(index.items()) == live and len(index) == len(live) and index.resized > 5
    assert all((k in index) == (k in live) for k in keys)
    assert all(index.get(k) == v for k, v in live.items())
    # a mark shared by two keys is no hit: the content is looked at
    twin = keys[0][:12] + bytes(20)
    assert twin not in index




def test_a_text_that_shares_the_id_of_a_copy_stays(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (2, "another text altogether", "z"), (None, "a b c d e f g", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = forest.drop_near_copies(docs, shingle=5)
    assert got.columns == docs.columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3]]))
