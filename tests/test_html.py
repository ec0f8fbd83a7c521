import pyarrow as pa

from gleanfield.operators import html as h
from gleanfield.operators import markup
from gleanfield.operators.markup import TAG, Field, Page, Rule, reader
from pyspark.sql import functions as F

PAGE = """<!DOCTYPE html><html lang="en"><head><title>t</title><style>p{}</style>
<script>var t="</p><h1>no</h1>";</script></head><body><!-- <h1>hidden</h1> -->
<nav><ul><li><a href="/a?x=1&amp;y=2">A &amp; b</a></li><li><A HREF='/b'>B</A></ul></nav>
<p>one<p><b>two<br>x<!-- c -->y</p>
<table><tr onmouseover><td class=" a  b ">1<td>2<tr><td title="a > b">3</table>
<h1>ab<b>x</b>cd</h1><div class="event-dates">trap</div><div class="event-date x"> real
 text </div></body></html>"""


def take(path, what="first_text", default=None, page=PAGE):
    return reader(Field(path, what, default))(Page(page))


def test_rules():
    assert take((Rule("h1"),)) == "ab"
    assert take((Rule("h1"),), "norm_text") == "abxcd"
    assert take((Rule("h2"),)) is None and take((Rule("h2"),), default="-") == "-"
    assert take((Rule("h2"),), "norm_text") == ""
    assert take((Rule("a"),), "all_attr:href") == ["/a?x=1&y=2", "/b"]
    assert take((Rule("a", attr=("href", "prefix", "/b")),)) == "B"
    assert take((Rule("a", attr=("href", "contains", "y=2")),)) == "A & b"
    assert take((Rule("tr", attr=("onmouseover", "exists", "")), Rule("td", child=True)), "all_text") == ["1", "2"]
    assert take((Rule("td", all_class=("a", "b")),)) == "1"
    assert take((Rule("div", any_class=("event-date", "zz")),), "norm_text") == "real text"
    assert take((Rule("div", class_like="event-d"),)) == "trap"
    assert take((Rule("div", class_eq="event-dates"),)) == "trap"
    assert take((Rule("li", nth=2), Rule("a", child=True))) == "B"
    assert take((Rule("td", first=3),)) == "3"
    assert take((Rule("td", attr=("title", "equals", "a > b")),)) == "3"
    assert take((Rule("li", has=Rule("a", own_text="B")),), "html") == "<li><A HREF='/b'>B</A>"
    assert take((Rule("td", after=Rule("td", all_class=("a",))),)) == "2"
    assert take((Rule("p"),), "all_html") == ["<p>one", "<p><b>two<br>x<!-- c -->y</p>"]
    assert take((Rule("b", first=1),), "all_text") == ["two", "x", "y"]
    assert take((Rule("script"),), "string") == 'var t="</p><h1>no</h1>";'
    assert take((Rule("html"),), "attr:lang") == "en"


def test_lenient_reading():
    assert take((Rule("i"),), page='<i class="x>broken</i> <b>') is None
    assert take((Rule("b"),), page="<b>open") == "open"
    assert take((Rule("p"),), page="a</div><p>x</p>") == "x"
    assert take((Rule("p"),), page="") is None
    nested = "<table><tr><td><table><tr><td>in</table>out<td>two</table>"
    assert take((Rule("td"),), "all_text", page=nested) == ["out", "in", "two"]
    assert [e[TAG] for e in Page(nested).elements].count("td") == 3


def test_spark_operators(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>x")], "id int, html string")
    fields = {"t": Field((Rule("h1"),)), "links": Field((Rule("a"),), "all_attr:href")}
    got = {r.id: (r.t, r.links) for r in h.extract_fields(df, "html", fields).collect()}
    assert got == {1: ("ab", ["/a?x=1&y=2", "/b"]), 2: (None, None), 3: (None, [])}
    got = h.split_entries(df, "html", Rule("nav"), Rule("li")).collect()
    assert [(r.id, r.row_index) for r in got] == [(1, 0), (1, 1)] and got[1].entry.startswith("<li><A")
    got = h.extract_entries(df, "html", (Rule("li"),), {"a": Field((Rule("a"),))}).collect()
    assert [(r.row_index, r.a) for r in got] == [(0, "A & b"), (1, "B")]
    got = h.extract_links(df, "html", Rule("nav"), Rule("a")).collect()
    assert [(r.pos, r.href) for r in got] == [(0, "/a?x=1&y=2"), (1, "/b")]
    assert [r.href for r in h.extract_links(df, "html").collect()] == ["/a?x=1&amp;y=2"]
    got = h.row_cells(df, "html", (Rule("tr"),), Rule("td", child=True)).collect()
    assert [(r.id, r.cells) for r in got] == [(1, ["1", "2"]), (1, ["3"])]
    got = spark.createDataFrame([("<p> a <b>b</b>\n",), ("",), (None,)], "f string")
    assert [r.t for r in got.select(h.fragment_text(F.col("f")).alias("t")).collect()] == ["a b", "", ""]


def test_may_hold(spark):
    path = (Rule("a", attr=("rel", "equals", "next")), Rule("b", any_class=("x-y",)))
    pages = ["<a rel=next><b class='x-y'>", "<a rel=next>", "<a rel='&#110;ext'>", ""]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = df.select(h.may_hold(F.col("html"), path).alias("m")).collect()
    assert [r.m for r in got] == [True, False, True, False]
    assert df.where(h.may_hold(F.col("html"), (Rule("a"),))).count() == 4


def test_may_hold_reads_quoted_values_whole(spark):
    path = (Rule("b", any_class=("x-y",), attr=("title", "contains", "next")),)
    pages = ["<b class='a>b x-y' title=\"1 > next\">t</b>", "<b class=\"a>b x-y\" title='> next'>t</b>", "<b class='a' title='> x'>x-y next</b>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = df.select(h.may_hold(F.col("html"), path).alias("m")).collect()
    assert [r.m for r in got] == [True, True, False]
    assert [take(path, page=p) for p in pages] == ["t", "t", None]


def test_references_cut_short_stay_as_written():
    text = Page('<h1>a &amp b &ampx; &am &quot; &eacute;&#233 &#x41; &copy</h1>')
    link = Page('<a href="/?a=1&copy=2&amp;b&para">x</a>')
    assert reader(Field((Rule("h1"),)))(text) == 'a &amp b &ampx; &am " éé A &copy'
    assert reader(Field((Rule("a"),), "attr:href"))(link) == "/?a=1&copy=2&b&para"


def test_pages_of_one_layout_are_read_by_rules_once(monkeypatch):
    read_as_tree, trees = markup.Page, []
    monkeypatch.setattr(markup, "Page", lambda *a: trees.append(a) or read_as_tree(*a))
    label = lambda text: Rule("li", has=Rule("label", child=True, own_text=text))
    fields = {
        "name": Field((Rule("h1"),)), "href": Field((Rule("a", any_class=("w",)),), "attr:href"),
        "when": Field((label("Date & Time:"),), "string"), "markup": Field((Rule("ul"),), "html"),
        "rows": Field((Rule("li"),), "rows", sub={"t": Field((), "norm_text"), "l": Field((Rule("label"),), "all_text")}),
        "code": Field((Rule("script"),), "string"), "bare": Field((Rule("b", no_text=True, after=Rule("h1")),), "attr:id", "-"),
    }
    page = "<h1>{}</h1><a class='{}' href='{}'>x</a><ul><li><label>{}</label> {}<li>2</ul><script>{}</script><b id=q{}>{}</b>"
    read = markup.page_reader(fields)
    plain = lambda text: {k: reader(f)(read_as_tree(text)) for k, f in fields.items()}
    label_text = ["Date &amp; Time:", "Date & Time:", "Date &#38; Time:", "Other", "&amp;", ""]
    made = [
        page.format(name, css, f"/{n}?a=1&amp;b={n}", label_text[n % 6], n, code, n, bare)
        for n in range(12) for name in ("A &amp; b", f"n{n}", "") for css in ("w", "x w", "v") for code in ("a&amp;b", "") for bare in ("", "t")
    ]
    for text in made:
        assert read(text) == plain(text), text
    made_trees = len(trees)
    assert made_trees <= 4 * 2 * 2 * 2 * 2 * 2 and [read(text) for text in made] == [plain(text) for text in made]
    assert len(trees) == made_trees


def test_layouts_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(markup, "_LAYOUT_TOKENS", 40)
    layouts = markup._Layouts({"b": Field((Rule("b"),))})
    for n in range(30):
        text = "<b>" * n + "x"
        pieces = markup._TOKEN.split(text)
        layouts.of(text, pieces)
        assert layouts.tokens <= 42 + n and len(layouts.known) <= 40


def test_arrow_of_rows_within_rows():
    kind = pa.struct([("a", pa.string()), ("r", pa.list_(pa.struct([("t", pa.list_(pa.string())), ("s", pa.list_(pa.struct([("u", pa.string())])))])))])
    records = [["x", [[["1", None], [["p"], [None]]], [[], []]]], None, [None, []]]
    assert markup.arrow_structs(records, kind).to_pylist() == [
        {"a": "x", "r": [{"t": ["1", None], "s": [{"u": "p"}, {"u": None}]}, {"t": [], "s": []}]}, None, {"a": None, "r": []},
    ]
    assert markup.arrow_structs([], kind).to_pylist() == [] and markup.arrow_structs([None], kind).to_pylist() == [None]
