"""The manifest against a tree built on the driver."""

import hashlib
import zlib

import pytest
from helpers import lower, no_documents, odd_documents, table
from pyspark.sql import functions as F

from gleanfield.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tagged(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha("".join(map(tagged, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    placed = {
        x: sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), i) for i, r in enumerate(rows) if r["lang"] == x)
        for x in langs
    }
    trees = {x: levels([p[2] for p in placed[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs]) if langs else []
    for number, x in enumerate(langs):
        for rank, (named, doc_id, digest, i) in enumerate(placed[x]):
            text = rows[i]["text"]
            if named and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = lower(text)
            h, proof = leaf(rows[i], text), ""
            for tree, at in ((trees[x], rank), (top, number)):
                for level in tree[:-1]:
                    run, me = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:me] + run[me + 1 :])
                    h, at = sha("".join(run[:me] + [h] + run[me + 1 :])), at // 8
            root = top[-1][0]
            yield rows[i]["doc_id"], digest, trees[x][-1][0], root, sha(proof), h, h == root


def check(docs):
    got = [tuple(r) for r in merkle.audit(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(docs.collect())))
    return got


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_manifest_of_odd_documents(spark, make):
    check(make(spark))


def test_manifest_of_many_tiers(spark, monkeypatch):
    """Blocks of 8 leaves: 200 documents, most of one language, take three tiers."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    docs = table(spark, "documents").withColumn("lang", F.when(F.col("doc_id") % 9 > 0, "en").otherwise(F.col("lang")))
    got = check(docs)
    assert {r[-1] for r in got} == {True, False}


def test_sizes_around_the_levels(spark):
    rows = [(i, f"Text {i}", f"l{n}", "a", i, None, None, None, None) for n in (1, 8, 9, 64, 65, 513) for i in range(n)]
    check(spark.createDataFrame(rows, odd_documents(spark).schema))


def test_a_changed_leaf_does_not_prove(spark):
    rows = [("t", i, sha(str(i)), i) for i in range(100)]
    found = merkle.manifest(spark.createDataFrame(rows, "tree string, id long, digest string, load int"))
    changed = F.when(F.col("load") % 2 == 0, F.lit(sha("other"))).otherwise(F.col("digest"))
    got = found.select("load", (merkle.folded(changed, F.col("path")) == F.col("root")).alias("proves")).collect()
    assert len(got) == 100 and all(r["proves"] == (r["load"] % 2 == 1) for r in got)
