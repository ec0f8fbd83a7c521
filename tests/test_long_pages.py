import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from gleanfield.operators import html
from gleanfield.operators.markup import Field, Rule, Skimmer, can_skim, page_reader
from gleanfield.operators.stages import accepted
from gleanfield.plans import harvest as plan
from gleanfield.plans.harvest import harvest_details, link_fields
from gleanfield.sources.sites import SITES

LINKS = link_fields(SITES["ausbiotech"])
CELL = '<td class="eventsCalenderDayHasEvents"><a href="/e/{}">x</a></td>'


def skimmed(fields, text, size):
    skimmer = Skimmer(fields)
    for at in range(0, max(len(text), 1), size):
        skimmer.feed(text[at : at + size], at + size >= len(text))
    values = zip(fields.items(), skimmer.found)
    return {k: v if f.take.startswith("all_") else (v[0] if v else f.default) for (k, f), v in values}


def test_a_page_in_pieces_takes_no_memory_for_its_elements():
    skimmer, page = Skimmer(LINKS), "".join(map(CELL.format, range(20_000)))
    tracemalloc.start()
    for at in range(0, len(page), 4096):
        skimmer.feed(page[at : at + 4096], at + 4096 >= len(page))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert skimmer.found == [[f"/e/{i}" for i in range(20_000)]]
    assert peak < 4_000_000


def test_pages_in_pieces_have_the_values_of_whole_pages():
    parts = [
        '<td class="a">', '<td class="b x">', '<a href="/e/1">', "<a href=x>", "<a>", "</a>", "</td>", "<tr>", "</table>", "<p>", "x & y",
        '<div class="a b">', "</div>", "<li>", "<br>", '<!-- <td class="a"> -->', "<!--", "-->", "<script>", ' v="<a href=q>" ', "</script>",
        "< b", '"', "'", '<a"x y"z href=k>', "<", ">", "</", "<!", "é😀", "<a title='>' href='/q?a=1&amp;b=2'>", '<A HREF="U">',
    ]
    a = lambda **how: Rule("a", **how)
    asked = [
        {"h": Field((Rule("td", any_class=("a", "b")), a(child=True)), "all_attr:href")},
        {"k": Field((Rule(any_class=("a",)),), "all_attr:class"), "o": Field((a(attr=("href", "prefix", "/")),), "attr:href", default="-")},
        {"h": Field((Rule("td", nth=2), a(first=2)), "all_attr:href"), "g": Field((Rule(child=True), Rule(), a(nth=1)), "attr:href")},
    ]
    some = random.Random(5)
    for _ in range(500):
        page = "".join(some.choices(parts, k=some.randint(0, 50)))
        for fields in asked:
            assert can_skim(fields)
            assert skimmed(fields, page, some.choice((1, 3, 20, 10_000))) == page_reader(fields)(page), page
    assert not can_skim({"t": Field((a(),), "string")}) and not can_skim({"t": Field((a(own_text="x"),), "attr:href")})


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(html, "SLICE", 7)
    monkeypatch.setattr(html, "BLOCK", 50)
    monkeypatch.setattr(plan, "LONG", 300)


def test_sliced_pages_are_read_as_whole_ones(spark, small_slices):
    pages = [(1, "".join(map(CELL.format, "aé😀d"))), (2, ""), (3, None), (4, "<b>x</b>"), (5, CELL.format("é" * 60))]
    df = spark.createDataFrame(pages, "i int, body string")
    for fields in (LINKS, {"t": Field((Rule("b"),)), "l": Field((Rule("a"),), "all_attr:href")}):
        got = {r.i: r for r in html.read_pages(df, "body", fields).collect()}
        read = page_reader(fields)
        assert sorted(got) == [1, 2, 3, 4, 5]
        for i, body in pages:
            assert got[i].asDict() == {"i": i} | (dict.fromkeys(fields) if body is None else read(body))


def test_long_listing_and_detail_pages(spark, gazetteer, small_slices):
    site = SITES["ausbiotech"]
    month = site.base_url + site.events_path + "?month={}&year=2025"
    detail = (
        '<h3><span><strong>Ev {0}</strong></span></h3><div class="wysiwygcontent">{1}</div><div id="event-details"><ul>'
        "<li><label>Date:</label> Saturday 3 May 2025</li><li><label>Event Location:</label> Hall</li><li><label>Your Price:</label>"
        " AUD 5.00</li><li><label>Registrations Close:</label> 1 May 2025 1: 00 PM</li></ul></div>"
    )
    pages = [(month.format(1), "".join(map(CELL.format, range(6)))), (month.format(2), CELL.format(6))]
    pages += [("http://other/", "".join(map(CELL.format, range(7, 12))))]  # long, but no seed
    pages += [(f"{site.base_url}/e/{i}", detail.format(i, "long " * 100 if i == 3 else "")) for i in range(12)]
    df = spark.createDataFrame(pages * 2, "url string, body string").repartition(3)
    today = F.lit("2025-01-05").cast("date")
    out = accepted(harvest_details("ausbiotech", df, gazetteer, today=today)).collect()
    assert sorted(r["name"] for r in out) == [f"Ev {i}" for i in range(7)]
