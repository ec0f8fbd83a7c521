"""Mixing and packing: sums, brute force and round trips."""

import random
import zlib
from collections import Counter, defaultdict
from unittest.mock import MagicMock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import no_documents, odd_documents, table, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanfield.llm import mixing, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


# -- mixing ---------------------------------------------------------------------------------


def brute_targets(sizes, share=1.5, weights=(3.0, 1.0, 2.0), most=2):
    """{source: target} of {source: size}: the excess of full sources goes to the others, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(docs, near):
    rows = mixing.mix(docs).collect()
    plain = [(r["doc_id"], len(words(r["text"])), r["source"]) for r in docs.collect()]
    assert sorted(map(repr, plain)) == sorted(repr((r["doc_id"], r["size"], r["source"])) for r in rows)
    sizes = Counter()
    for _, n, source in plain:
        sizes[source] += n
    target = brute_targets(dict(sizes)) if plain else {}
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) <= 1e-6 * (1 + r["target"])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source, wanted in target.items():
        smallest = min(n for _, n, s in plain if s == source)
        assert abs(taken[source] - wanted) <= near * wanted + smallest, (source, taken[source], wanted)
    return rows


def test_taken_words_come_near_targets(spark):
    rows = check_mix(table(spark, "documents", "/root/testdata/sf0.01"), 0.005)
    # rates are an exponential tilt of the sizes within each source, up to the bound
    tilt = defaultdict(list)
    for r in rows:
        if 1e-6 < r["rate"] < 2 - 1e-6 and r["size"]:
            tilt[r["source"]].append(np.log(r["rate"] / (2 - r["rate"])) / r["size"])
    assert any(len(x) > 5 for x in tilt.values())
    assert all(np.ptp(x) <= 1e-6 * abs(np.mean(x)) + 1e-12 for x in tilt.values())


def test_reruns_agree(spark):
    docs = table(spark, "documents")
    assert sorted(map(repr, mixing.mix(docs).collect())) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))


def test_mix_of_odd_documents(spark):
    check_mix(odd_documents(spark).where("doc_id is null or doc_id <> 7"), 0.6)
    assert mixing.mix(no_documents(spark)).count() == 0


def test_repeated_rows_follow_the_mix(spark):
    docs = odd_documents(spark).unionByName(table(spark, "documents").selectExpr("doc_id + 100 doc_id", "text", "lang", "source", "n_chars", "'x' class", "1 score", "'r' rate", "'q' row"))
    mixed = mixing.repeat_rows(docs)
    assert mixed.columns == docs.columns
    assert mixed.dtypes == docs.dtypes
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"]) for r in mixed.collect())
    assert got == +want
    assert mixing.repeat_rows(no_documents(spark)).count() == 0


def test_a_million_equal_rows(spark):
    """They are one entry of a bin, and their copies differ by one at most."""
    equal = spark.range(1_000_000).selectExpr("cast(null as bigint) doc_id", "'one two three' text", "'a' source")
    others = spark.range(500).selectExpr("id doc_id", "repeat('w ', cast(id % 40 as int)) text", "if(id % 2 = 0, 'a', 'b') source")
    docs = equal.unionByName(others)
    mixed = mixing.mix(docs)
    copies = {r["copies"]: r["count"] for r in mixed.where("doc_id is null").groupBy("copies").count().collect()}
    assert sum(copies.values()) == 1_000_000 and max(copies) - min(copies) <= 1
    sums = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(sums) == 2 and all(abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 40 for r in sums)
    taken = sum(r["copies"] for r in mixed.where("doc_id is not null").collect()) + sum(c * n for c, n in copies.items())
    assert mixing.repeat_rows(docs).count() == taken


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5}, {"a": 0, "b": 7}, {"x": 3}, {"a": 1, "b": 1, "c": 1, "d": 100}])
def test_targets_share_the_excess(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, 1.5, (3.0, 1.0, 2.0), 2).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 * (1 + want[s]) for s in want)


# -- packing --------------------------------------------------------------------------------


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check_pack(docs, size=4096):
    rows = packing.pack(docs, PATH, size).collect()
    tokenizer = Tokenizer.from_file(PATH)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for doc_id, lists in texts.items():
        got = Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[doc_id])
        want = Counter(
            (a, len(ids[a : a + size]), zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes()), len(ids))
            for ids in lists for a in range(0, len(ids), size)
        )
        assert got == want, doc_id
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    used = sum(r["length"] for r in rows)
    return used, len(by_sequence)


def test_every_id_lies_in_one_piece(spark):
    used, sequences = check_pack(table(spark, "documents"))
    assert used > 0.9 * 4096 * sequences


@pytest.mark.parametrize("size", [64, 4096])
def test_pack_of_odd_documents(spark, size):
    check_pack(odd_documents(spark), size)
    assert packing.pack(no_documents(spark), PATH).count() == 0


def test_words_forgotten_change_no_id(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    tokens = packing.WordTokens(PATH)
    texts = ["It's Ü don't, don't!? a.b. end...", "É é. x́. '... 's. 12.", "<|endoftext|>. <|ENDOFTEXT|> THE the", "", "a b c ,,, .", "don't,"] * 3
    for i in range(0, len(texts), 2):
        ids, ends = tokens.encode([t.encode() for t in texts[i : i + 2]])
        cuts = [0, *ends.tolist()]
        for t, a, b in zip(texts[i : i + 2], cuts, cuts[1:]):
            assert ids[a:b].tolist() == whole_ids(t)[:-1], t


def test_a_worker_tokenises_a_megabyte_at_once(spark, monkeypatch):
    taken = []

    class Tokens:
        def encode(self, texts):
            taken.append(sum(map(len, texts)))
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)

    monkeypatch.setitem(packing._tokens, "some", Tokens())
    monkeypatch.setattr(packing, "TaskContext", MagicMock())
    packing.TaskContext.get().partitionId.return_value = 0
    docs = MagicMock()
    packing.pieces(docs, "some", 4096, 2)
    cut = docs.select.return_value.mapInArrow.call_args[0][0]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": [b"x" * 100_000] * 30})
    assert sum(b.num_rows for b in cut(iter([batch]))) == 30
    assert sum(taken) == 3_000_000 and max(taken) <= 1 << 20


def test_patterns_hold_every_length():
    rng = np.random.default_rng(1)
    for most in (3, 50, 100):
        histogram = Counter(rng.integers(1, most + 1, 2000).tolist())
        patterns = packing.pack_patterns(dict(histogram), 100)
        held = Counter()
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= 100
            for n in lengths:
                held[n] += count
        assert held == histogram
        assert sum(c for c, _ in patterns) <= 1.02 * sum(n * c for n, c in histogram.items()) / 100 + 1
    assert packing.pack_patterns({}, 100) == []


ODD = "İ\u0307\u0301\u0338ıßŉΣςﬁ²½①\u00a0\u2009\u3000\u200b中文の한각\u1100\u1161ا١𝒜\U0001f600\U0001f1e9\u00ad\ufeff\x00\x1f\x85ЙйЙÅÅ\u1e9eǅ\u0345ᾳ\ua7dc\u0530Ա"


def test_ids_of_any_text_are_the_tokenizers():
    """Random texts of marks that join, letters that change in lower case, white space of all kinds and special tokens."""
    rng = random.Random(4)
    plain, tokens = Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    alphabet = [*ODD, *ODD, *"aAzZ'09.,;:!?-_|<>\"", *" \t\n", "'s", "'ll", "<|endoftext|>", "<|", "e\u0301", "é", "ö"]

    def char():
        while 0xD800 <= (c := rng.randrange(0x30000)) < 0xE000:
            pass
        return chr(c)

    def text(i):
        if i % 4 == 0:
            return "".join(char() if rng.random() < 0.5 else rng.choice(" .,a") for _ in range(rng.randrange(12)))
        return "".join(rng.choices(alphabet, k=rng.randrange(14)))

    texts = ["İ,", "foo İ, bar", "İstanbul,", "a\u0338.", "Σ. ΑΣ, Σ!", "", " ", "K,", *map(text, range(20_000))]
    for a in range(0, len(texts), 500):
        some = texts[a : a + 500]
        ids, ends = tokens.encode([t.encode() for t in some])
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == [x.ids for x in plain.encode_batch(some, add_special_tokens=False)]
