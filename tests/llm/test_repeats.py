"""Removed windows against brute force over all words."""

import random

import numpy as np
import pytest
from helpers import no_documents, odd_documents, table
from pyspark.sql import functions as F

from gleanfield.llm import repeats

SCHEMA = "doc_id long, text string, places string, key int, likely boolean"


def brute(rows, window):
    first, texts = {}, [(i, (-(2**63) if i is None else i, key), (t or "").encode().split()) for i, t, key in rows]
    for _, doc, words in texts:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            first[w] = min(first.get(w, (doc, k)), (doc, k))
    for i, doc, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if (doc, k) > first[tuple(words[k : k + window])]:
                gone |= set(range(k, k + window))
        yield i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()


def check(docs, window=20, lengths=2):
    rows = repeats.drop_repeats(docs, window, lengths).collect()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in rows]
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text"))
    want = brute([tuple(r) for r in keyed.collect()], window)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert all(sum(s["past"] - s["first"] for s in r["spans"]) == r["n_removed"] for r in rows)
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, True) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_odd_documents(spark, make):
    check(make(spark))


@pytest.mark.parametrize("lengths", [2, 3])
def test_documents_of_the_table(spark, lengths):
    assert any(r["n_removed"] for r in check(table(spark, "documents"), lengths=lengths))


@pytest.mark.parametrize("window, lengths, seed", [(4, 2, 1), (4, 3, 2), (6, 2, 3), (8, 4, 4), (20, 2, 5), (20, 3, 6)])
def test_few_words_repeat_everywhere(spark, window, lengths, seed):
    """Two or three different words, so windows overlap their own copies and hashes tie."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(30)]), " ".join(rng.choices("ab" if i % 2 else "abc", k=rng.randrange(60)))) for i in range(80)]
    rows += [(5, "a " * 90), (5, "a " * 90), (3, "a " * 19), (2, "a " * 20), (None, None)]
    check(documents(spark, rows), window, lengths)


def test_half_windows_that_repeat_alone_stay(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:19]) + " x " + " ".join(words[21:])), (3, " ".join(words[5:25]))]
    got = {r["doc_id"]: r["n_removed"] for r in check(documents(spark, rows))}
    assert got == {1: 0, 2: 0, 3: 20}


def test_frequent_passage_over_many_batches(spark, monkeypatch):
    """A third of all rows hold one passage; batches of four rows, so that a task meets it again and again."""
    monkeypatch.setattr(repeats, "short_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4"))
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, f"{i} {passage} {i} tail" if i % 3 == 0 else f"only {i} " * 15) for i in range(600, 0, -1)]
    got = {r["doc_id"]: r["n_removed"] for r in check(documents(spark, rows))}
    assert got[3] == 0 and got[600] == 25
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def test_no_window_repeats(spark):
    got = check(documents(spark, [(1, " ".join(map(str, range(50)))), (2, "short"), (3, None)]))
    assert all(r["spans"] == [] for r in got)


def test_window_must_be_a_doubled_length(spark):
    with pytest.raises(ValueError):
        repeats.drop_repeats(no_documents(spark), window=10, lengths=3)


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 11, 16])
def test_leftmost_least(width):
    values = np.random.default_rng(width).integers(0, 4, 50).astype(np.uint64)
    want = [i + int(np.argmin(values[i : i + width])) for i in range(50 - width + 1)]
    assert repeats.leftmost_least(values, width).tolist() == want
