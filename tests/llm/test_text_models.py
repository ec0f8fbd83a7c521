"""Language identification, language model, quality classifier and main text."""

import html
import itertools
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import no_documents, odd_documents, table, words

from gleanfield.llm import gam, language, main_text, ngram_model
from gleanfield.llm.main_text import Weights, extract

SMALL = "/root/testdata/sf0.01"


def remainder(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


# -- language -------------------------------------------------------------------------------


def test_held_out_languages_are_told(spark):
    docs = table(spark, "documents", SMALL)
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.identify(docs).collect()
    assert len(rows) == len(lang)
    held_out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) for r in rows) and len(held_out) > 100
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held_out]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_documents(spark):
    docs = odd_documents(spark).drop("score")
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    for r, text in {r["doc_id"]: (r, t["text"]) for r in rows for t in docs.collect() if t["doc_id"] == r["doc_id"] and r["doc_id"]}.values():
        if any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] in ("en", "de", "fr"), r
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0), r
    assert language.identify(no_documents(spark)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def brute_ngrams(text):
    out = Counter()
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = f" {word} "
            for n in language.SIZES:
                out.update((n, padded[i : i + n]) for i in range(len(padded) - n + 1))
            word = ""
    return out


@pytest.mark.parametrize("texts", [["Aé b", "", "12", "ab-c\x00d"], ["x"], [""], ["İstanbul ŒUVRE"]])
def test_ngrams_are_those_of_words(texts):
    grams, owner, has = language.ngrams(texts)
    for i, text in enumerate(texts):
        want = brute_ngrams(text)
        assert sorted(Counter(grams[owner == i].tolist()).values()) == sorted(want.values())
        assert has[i] == any(c.isalpha() for c in text)


def test_filter_names_all_languages_and_corrects_counts():
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    languages = [f"l{i:02d}" for i in range(70)]
    which = rng.integers(0, 70, 5000)
    found = language.LanguageFilter.build(languages, grams, which, 0)
    masks = found.masks(grams)
    assert all((masks[i, w // 64] >> np.uint64(w % 64)) & np.uint64(1) for i, w in enumerate(which))
    others = found.masks(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    wrong = np.mean([(others[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(70)])
    assert abs(wrong - found.false_rates().mean()) < 1e-3


def test_long_texts_are_cut_beside_words():
    text = "ab cde " * 50
    pieces = [p for some in language.slices([text, "x", ""], 40) for p in some]
    assert "".join(p for i, p in pieces if i == 0) == text and (1, "x") in pieces and (2, "") in pieces
    whole = Counter(language.ngrams([text])[0].tolist())
    parts = Counter(g for i, p in pieces if i == 0 for g in language.ngrams([p])[0].tolist())
    assert whole == parts


# -- language model -------------------------------------------------------------------------


def check_base(docs):
    rows = ngram_model.score(docs).collect()
    plain = [(r["doc_id"], [*words(r["text"]), ""]) for r in docs.collect()]
    counts = Counter(itertools.chain.from_iterable(w for i, w in plain if remainder(i, 5) != 1))
    total, distinct = sum(counts.values()), len(counts)
    each = total + 0.5 * (distinct + 1)
    want = sorted((i is None, i or 0, remainder(i, 5) == 1, len(w), sum(x in counts for x in w), sum(math.log10((counts[x] + 0.5) / each) for x in w)) for i, w in plain)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["base_score"]) for r in rows)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) <= 1e-9 * abs(b[5]) for a, b in zip(got, want))
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in rows)
    return rows


@pytest.mark.parametrize("common", [1e-6, 1e-3])
def test_base_score_is_exact(spark, monkeypatch, common):
    """However many words are counted in the tasks and however many are joined."""
    monkeypatch.setattr(ngram_model, "COMMON", common)
    check_base(table(spark, "documents"))


def test_model_foretells_held_out_text_better(spark):
    rows = [r for r in check_base(table(spark, "documents", SMALL)) if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_scores_of_odd_documents(spark):
    docs = odd_documents(spark).drop("score")
    check_base(docs)
    assert ngram_model.score(no_documents(spark)).count() == 0


def test_filter_gives_levels_back():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    counts = np.maximum(1, rng.pareto(1.0, 20_000) * 3).astype(np.int64)
    held = ngram_model.LogFrequencyFilter.build(3.0, [(ngram_model.WORD, keys[counts >= 3], counts[counts >= 3])])
    found = held.counts(ngram_model.WORD, keys)
    enough = counts >= 3
    assert (found[enough] > counts[enough] / 1.5).all()
    assert np.mean(found[enough] < counts[enough] * 1.5) > 0.97
    assert np.mean(found[~enough] == 0) > 0.97


def formula(rows, spare=0.0):
    """Each text's score by exact counts, of the training rows of (doc_id, text)."""
    split = [(i, [*words(t), ""]) for i, t in rows]
    trained = [w for i, w in split if remainder(i, 5) != 1]
    count = Counter(itertools.chain.from_iterable(trained))
    pairs = Counter(p for w in trained for p in zip(["", *w], w))
    each, mu = sum(count.values()) + 0.5 * (len(count) + 1), ngram_model.MU
    chance = lambda v, w: (pairs[v, w] + mu * (count[w] + 0.5) / each) / (count[v] + mu)
    return [(i, len(w), sum(math.log10(chance(*p)) for p in zip(["", *w], w))) for i, w in split], chance, count


@pytest.mark.parametrize("common, top, hot", [(1e-6, 1e-4, 1e-5), (1e-3, 1e-2, 1e-3), (1e-4, 1e-4, 1e-4), (0.5, 0.5, 0.5)])
def test_scores_follow_the_formula(spark, monkeypatch, common, top, hot):
    """By exact counts, whatever is at hand and whatever is in shards; quantised counts are off by a twelfth at most."""
    for name, value in (("COMMON", common), ("TOP", top), ("HOT", hot)):
        monkeypatch.setattr(ngram_model, name, value)
    docs = table(spark, "documents")
    want, _, _ = formula([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r["score"] for r in ngram_model.score(docs).collect()}
    off = [(got[i] - x) / n for i, n, x in want]
    assert len(got) == len(want) and max(map(abs, off)) < 0.06 and abs(np.mean(off)) < 0.02


def test_probabilities_add_up():
    text = ("a b a c a b d " * 50).strip()
    _, chance, count = formula([(0, text)])
    for first in ("a", "b", "c", "", "unseen"):
        assert abs(sum(chance(first, w) for w in [*count, "unseen"]) - 1) < 1e-9


def test_a_rare_pair_counts_in_a_corpus_of_any_size(spark):
    """Two words that met twice are told from the same words the other way round, among two million tokens more than among a few thousand."""
    learned = [i for i in range(100) if remainder(i, 5) != 1]
    asked = [i for i in range(100) if remainder(i, 5) == 1]
    gains = []
    for n in (4, 2000):
        plain = spark.range(n).selectExpr(
            "1000 + id doc_id", "concat_ws(' ', transform(sequence(1, 1000), x -> concat('w', pmod(xxhash64(id, x), 50000)))) text"
        )
        some = [(learned[0], "zq xv"), (learned[1], "zq xv"), (asked[0], "zq xv"), (asked[1], "xv zq")]
        docs = plain.unionByName(spark.createDataFrame(some, "doc_id long, text string"))
        got = {r["doc_id"]: r["score"] for r in ngram_model.score(docs).where("doc_id < 100").collect()}
        gains.append(got[asked[0]] - got[asked[1]])
    assert gains[0] > 0.3 and gains[1] > 2


def test_a_frequent_pair_and_word_spread_over_shards(spark, monkeypatch):
    """A third of all tokens is one pair; the tasks know it, so no shard gets it."""
    docs = spark.range(3000).selectExpr("id doc_id", "concat('hot pair hot pair own', id, ' one', id % 7) text")
    want, _, _ = formula([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r["score"] for r in ngram_model.score(docs).collect()}
    assert max(abs(got[i] - x) / n for i, n, x in want) < 0.08  # a pair's and a word's count are off by half a step each
    assert [r["score"] for r in ngram_model.score(docs).orderBy("doc_id").collect()] == [got[i] for i in range(3000)]


# -- quality --------------------------------------------------------------------------------


def test_held_out_quality_is_told(spark):
    docs, labels = table(spark, "documents", SMALL), table(spark, "labels", SMALL)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = gam.quality(docs, labels).collect()
    assert len(rows) == docs.count()
    told = [r for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert np.mean([r["predicted"] == quality[r["doc_id"]] for r in told]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_bad_documents_go_and_good_ones_stay(spark):
    docs, labels = table(spark, "documents", SMALL), table(spark, "labels", SMALL)
    kept = gam.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    for r in labels.collect():
        assert (r["doc_id"] in ids) == (r["quality"] == 1), r


def test_quality_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (2, 0, 1), (None, 1, 1), (7, None, 0), (9, 5, 0)], "doc_id long, quality int, toxic int")
    rows = gam.quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = {r["doc_id"]: r["score"] for r in rows}
    assert same[3] == same[4]
    assert gam.quality(no_documents(spark), labels).count() == 0
    assert {r["score"] for r in gam.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert gam.keep_good(no_documents(spark), labels).count() == 0
    assert gam.keep_good(docs, labels).columns == docs.columns


def test_interactions_are_learned():
    rng = np.random.default_rng(6)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000], rounds=10)
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.95
    assert {frozenset(p[:2]) for p in model.pairs} >= {frozenset((0, 1))}
    single = gam.fit(x[:3000], y[:3000], rounds=10, pairs=0)
    assert np.mean((single.score(x[3000:]) >= 0.5) == y[3000:]) < 0.7


# -- main text ------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a></li><li><a>Other page</a></li></ul></nav>
<!-- <p>no</p> --><div class="ad">Buy this now please</div>
<article><h1>A title of   some words</h1><p><b>The first&nbsp;text &amp; more of it, with <a href="x">a link</a>.<br><p>Second
 paragraph has a few words too.</p><aside>See also this</aside><ul><li>One point of a list</li></ul>
<form><input name=q>Search here</form><p>Last one ends the text &lt;here&gt;.</p><div class="comments"><p>A reader says a lot of things here</p></div></article>
<div id="cookie-notice">We use cookies on this site</div><footer>&copy; A site with words in its footer</footer></body></html>"""
TEXT = [
    "A title of some words", "The first text & more of it, with a link.", "Second paragraph has a few words too.",
    "One point of a list", "Last one ends the text <here>.",
]


def test_page_gives_its_article():
    assert extract(PAGE, Weights()).split("\n\n") == TEXT
    assert extract(PAGE.replace("article>", "div>"), Weights()).split("\n\n") == TEXT


@pytest.mark.parametrize(
    "page, text",
    [("", ""), ("<p></p>", ""), ("just words", "just words"), ("<", "<"), ("a < b", "a < b"), ("<p>a<p", "a<p"), ("<script>x", ""),
     ("<p>a &#x41;&bogus;</p>", "a A&bogus;"), ("<p>one<p>two</div></p><p>three", "one\n\ntwo\n\nthree"), ('<a title="x>y">w</a>', "w")],
)
def test_broken_pages(page, text):
    assert extract(page, Weights()) == text


@pytest.mark.parametrize("box", ["<div class='advert'><p>{}</p></div>", "<aside><ul>{}</ul></aside>"])
@pytest.mark.parametrize("before, after", [(20, 200), (200, 20)])
def test_long_box_within_a_text_parts_nothing(box, before, after):
    lead, end = "lead " * before, "end " * after
    page = f"<nav><a>Home</a></nav><article><p>{lead}</p>{box.format('<li>buy this now</li>' * 60)}<p>{end}</p></article>"
    assert extract(page, Weights()).split("\n\n") == [lead.strip(), end.strip()]


def cut_by_hand(page):
    """The text of a page of the table: what stands between the tags of its article, as its template is known."""
    article = page.split("<article>")[1].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1|h2|ul|ol|li|div|blockquote)>", article.replace("<br>", " "))
    plain = [" ".join(html.unescape(re.sub(r"</?(?:b|i|a|em)\b[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in plain if b)


def test_pages_of_the_table(spark):
    pages = table(spark, "pages", SMALL)
    rows = {r["page_id"]: r for r in main_text.main_text(pages).collect()}
    for r in pages.collect():
        want = cut_by_hand(r["html"])
        assert rows[r["page_id"]]["text"] == want and rows[r["page_id"]]["n_chars"] == len(want)


ARTICLE = "<article><h1>A title</h1><p>" + "word " * 39 + "end.</p><p>" + "more " * 40 + "</p></article>"
WHOLE = ["A title", "word " * 39 + "end.", ("more " * 40).strip()]


@pytest.mark.parametrize("name", "no-sidebar has-sidebar comments-open nav-open text-navy with-banner page-menu menu comments".split())
def test_names_of_a_whole_page_say_nothing_of_its_text(name):
    page = f"<body class='{name}'><nav>x</nav><div class='sidebar'>out out out</div>{ARTICLE}<div class='share-buttons'>out</div></body>"
    assert extract(page, Weights()).split("\n\n") == WHOLE
    assert extract(page.replace("body", "div"), Weights()).split("\n\n") == WHOLE
    assert extract(page.replace("<article", f"<article class={name}-policy"), Weights()).split("\n\n") == WHOLE


@pytest.mark.parametrize("name", ["class=text-navy", "id=side-effects", "id=related-work", "class=no-ads"])
def test_names_of_a_block_that_only_sound_alike(name):
    assert extract(ARTICLE.replace("<p>", f"<p {name}>", 1), Weights()).split("\n\n") == WHOLE


@pytest.mark.parametrize("name", "ad site-footer cookie-bar main-nav share-buttons related-posts comment-list comments".split())
def test_names_of_boxes(name):
    box = f"<div class='{name}'><p>{'out ' * 30}</p></div>"
    page = f"<div>{ARTICLE.replace('article', 'div')}{box}<p>Last words.</p></div>{box}"
    assert extract(page, Weights()).split("\n\n") == [*WHOLE, "Last words."]


def test_a_name_learned_to_hold_texts_does(spark):
    """`promo` holds the articles of these pages, so its box of another page stays; `ad` was learned nowhere."""
    labelled = "<body><article><div class='promo'><p>{}</p></div></article></body>"
    weights = main_text.learn(spark.createDataFrame([(labelled.format("the text itself " * 20),)] * 3, "html string"))
    assert weights.inside == {"class=promo"}
    page = "<div><p>" + "a b " * 20 + "</p><p class='promo'>kept here</p><p class='ad'>gone here</p><p>the end</p></div>"
    assert "kept here" in extract(page, weights) and "gone" not in extract(page, weights)


@pytest.mark.parametrize("page", ["<div class='c'>{}</div>", "<div>{}</b>", "<p class='x'>{}</i>"])
def test_deep_pages_take_time_by_their_length(page):
    opened, _, closed = page.partition("{}")
    started = time.perf_counter()
    assert extract(opened * 20_000 + "text " * 50 + closed * 20_000, Weights()).count("text") >= 50
    assert time.perf_counter() - started < 10  # some 0.7 s; depth times length took minutes


def test_odd_pages(spark):
    df = spark.createDataFrame(
        [(1, "u", None, 1, "x"), (2, None, "", 2, None), (None, "u", PAGE, 3, "t"), (None, "u", PAGE, 3, "t"), (4, "u", "<p>" + "long text &amp; " * 200_000, 0, "")],
        "page_id long, url string, html string, n_chars int, text string",
    )
    rows = main_text.main_text(df).collect()
    assert len(rows) == 5
    by_id = {r["page_id"]: r for r in rows}
    assert by_id[1]["text"] == by_id[2]["text"] == "" and by_id[2]["url"] is None
    assert by_id[None]["text"] == "\n\n".join(TEXT) and by_id[4]["n_chars"] == len("long text & " * 200_000) - 1
    assert main_text.main_text(df.limit(0)).count() == 0


def test_weights_come_from_labelled_pages(spark):
    odd = "<body><div class='promoted'>{}</div><article><p>{}</p></article></body>"
    pages = spark.createDataFrame([(odd.format("some words of no use " * 5, "the text itself " * 20),)] * 30, "html string")
    weights = main_text.learn(pages)
    assert "class=promoted" in weights.outside
    assert main_text.learn(pages.selectExpr("replace(html, 'article', 'div') html")) == Weights()
    assert "no use" not in extract(odd.format("some words of no use " * 9, "the text itself " * 2).replace("article", "section"), weights)


def test_names_of_few_words_are_learned_in_a_large_table(spark):
    """A box name of three words among 600,000 counts as it does in a small table, and only for pages that use it."""
    labelled = "<body><p class='{}'>three box words</p><article><p>{}</p></article></body>"
    asking = "<body><section><p class='{}'>some words in a box</p><p>the text itself</p></section></body>"
    rows = [(1, labelled.format("zq", "text " * 50)), (2, labelled.format("big", "long text " * 300_000)), (3, asking.format("zq")), (4, asking.format("other")), (None, asking.format("zq"))]
    for rows in (rows, rows[:1] + rows[2:]):
        df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
        got = main_text.main_text(df).collect()
        assert len(got) == len(rows)
        texts = {r["page_id"]: r["text"] for r in got}
        assert texts[3] == texts[None] == "the text itself"
        assert texts[4] == "some words in a box\n\nthe text itself" and texts[1].strip() == ("text " * 50).strip()


def test_base_of_some_texts_equals_a_count_word_by_word():
    m = ngram_model
    exact = {m.END: 3, b"a": 5, b"b": 1}
    words = m.LogFrequencyFilter.build(1.0, [(m.WORD, np.arange(3, dtype=np.uint64), np.array(list(exact.values())))])
    cache = m.Model(words, exact, 9, 3).cache()
    texts = [b"a b A zz zz q", b"", b"q", b"a"]
    cache.of([b"unheard"])
    flat, sizes = m.tokens(texts)
    base, seen, rare = m.base_of(cache, cache.of(flat), sizes)
    ends = np.cumsum(sizes)
    for text, end, size, total, known, others in zip(texts, ends, sizes, base, seen, rare.to_pylist()):
        counted = Counter(flat[end - size : end])
        assert math.isclose(total, sum(n * math.log10(exact[w] + 0.5) for w, n in counted.items() if w in exact))
        assert known == sum(n for w, n in counted.items() if w in exact), text
        assert {r["token"]: r["n"] for r in others} == {w: n for w, n in counted.items() if w not in exact}


def test_sending_pairs_holds_one_short_slice(spark):
    """A worker's memory follows its slice, however much text its batch has."""
    texts = [" ".join(f"w{(i * 7919 + j * j) % 20_000}" for j in range(2_000)).encode() for i in range(700)]
    assert sum(map(len, texts)) > 8 << 20
    model, _ = ngram_model.learn(spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts[:20])], "doc_id long, text string"), (5, 1))
    cache, at = model.cache(), 0
    cache.of(ngram_model.tokens(texts)[0])
    tracemalloc.start()
    for number, some in enumerate(ngram_model.text_slices(texts)):
        ids, trained = pa.array(range(at, at + len(some))), np.ones(len(some), bool)
        sent = ngram_model.sent_rows(model, cache, ids, some, trained, ngram_model.TOP * model.tokens, number, 256)
        assert {0, 1, 2} >= set(sent.column(2).to_pylist())
        at += len(some)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert at == len(texts) and peak < 100 << 20
