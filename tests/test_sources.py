import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from gleanfield.__main__ import main
from gleanfield.operators.gazetteer import Gazetteer
from gleanfield.operators.stages import accepted, rejected
from gleanfield.plans.harvest import harvest, harvest_details, merge_sources
from gleanfield.schema import EVENT_COLUMNS, REJECT, conform
from gleanfield.sources import io as gio
from gleanfield.sources.sites import JSON_ENTRY, SITES, map_site
from gleanfield.streaming.pages import harvest_stream, page_stream

URL = "http://host/page?utm_source=x"


def events(spark, gazetteer, name, *bodies, **extra):
    """(accepted records without NULLs, reject reasons)"""
    columns = ", ".join(["url string", "body string", *[f"{k} string" for k in extra]])
    df = spark.createDataFrame([(URL, b, *extra.values()) for b in bodies], columns)
    out = conform(SITES[name].stages(gazetteer)(map_site(name, df, gazetteer))).cache()
    good = [
        {k: v for k, v in r.asDict().items() if v is not None} for r in accepted(out).collect()
    ]
    return good, [r[REJECT] for r in rejected(out).collect()]


def test_calendar(spark, gazetteer):
    page = """<h1 class="x tribe-events-single-event-title"> Bio Forum </h1>
    <div class="tribe-events-content"><p>About</p> us</div>
    <abbr class="tribe-events-start-datetime" title="2019-06-25"></abbr>
    <abbr class="tribe-events-end-date" title="2019-06-26"></abbr>
    <dd class="tribe-events-event-categories"><a>Meet Up </a></dd>
    <dd class="tribe-events-event-url"><a href="http://e.org/?utm_x=1">e</a></dd>
    <dd class="tribe-organizer"> Org </dd><dd class="tribe-organizer-url"><a href="http://o.org">o</a></dd>
    <dd class="tribe-venue"> Hall </dd><span class="tribe-locality">Basel</span>
    <abbr class="tribe-region" title="ma"></abbr><span class="tribe-country-name">us</span>
    <dd class="tribe-organizer-email">a@b.c</dd>"""
    good, bad = events(spark, gazetteer, "labiotech", page, page.replace("tribe-events-event-url", "no"),
                       page.replace("2019-06-26", "soon"), "<p>nothing</p>")
    record = dict(
        name="Bio Forum", id="bioforum__basel__2019-06-25", event_url="http://e.org/", description="About us",
        event_type="meet up", start="2019-06-25", end="2019-06-26", length_in_days=2.0,
        country="United States", state="Massachusetts", city="Basel", venue="Hall",
        contact_email="a@b.c", organizer="Org", organizer_url="http://o.org", source="Labiotech",
    )
    assert good == [record] and sorted(bad) == ["bad_end", "no_event_url", "no_name"]
    good, _ = events(spark, gazetteer, "bio_based_press", page)
    del record["venue"]
    assert good == [{**record, "city": "Hall", "id": "bioforum__hall__2019-06-25", "source": "Bio Based Press"}]


BIO_ROW = """<tr><td><a class="event-name" href="/e/1?utm_a=b"> BIO <b>Expo</b></a></td>
<td class="desc-cell"> text </td><td class="loc-cell">Boston, MA</td>
<td class="views-field-field-date">June 3 - 5, 2019</td></tr>"""


def test_bio_listing(spark, gazetteer):
    listing = ('<div class="event-search"><table><tbody>' + BIO_ROW
               + BIO_ROW.replace("June 3 - 5, 2019", "soon") + BIO_ROW.replace("Boston, MA", "a, b, c")
               + "</tbody></table></div>")
    record = dict(
        name="BIO Expo", id="bioexpo__boston__2019-06-03", event_url="https://www.bio.org/e/1",
        description="text", event_type="expo", start="2019-06-03", end="2019-06-05", length_in_days=3.0,
        country="United States", state="Massachusetts", city="Boston", source="BIO",
    )
    good, _ = events(spark, gazetteer, "bio", BIO_ROW)
    assert good == [record]
    out = harvest("bio", spark.createDataFrame([(URL, listing)], "url string, body string"), gazetteer)
    rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in accepted(out).collect()]
    assert rows == [record]
    assert sorted(r[REJECT] for r in rejected(out).collect()) == ["bad_date", "bad_location"]


def test_uk_biotech_database(spark, gazetteer):
    entry = """<div class="event"><div class="event_title"><h3>UK Summit</h3></div>
    <div class="event_date"><b>25 Jun 19-27 Jun 19</b></div>
    <div class="event_desc">Hall &amp; Co<br>London United Kingdom<br>-<br>About it<br></div>
    <div class="event_desc event_contact">J&ouml;rg<br><a href="mailto:a%40b.c">mail</a></div>
    <div class="event_web"><a href="http://w.org/">w</a></div></div>"""
    good, bad = events(spark, gazetteer, "uk_biotech_database", entry, entry.replace("<br>-<br>", ""),
                       entry.replace("-27", " 27"))
    assert good == [dict(
        name="UK Summit", id="uksummit__london__2019-06-25", event_url="http://w.org/", description="About it",
        event_type="summit", start="2019-06-25", end="2019-06-27", length_in_days=3.0,
        country="United Kingdom", city="London", venue="Hall & Co", contact_name="Jörg",
        contact_email="a@b.c", source="UK Biotech Database",
    )]
    assert sorted(bad) == ["bad_date", "bad_description"]


def grid(rows):
    cells = lambda r: "".join(f'<td align="left"><font>{c}</font></td>' for c in r)
    return '<table id="grdSQL">' + "".join(
        f"<tr onmouseover=\"x\"><td><a href=\"javascript:x('SysRowSelector${i}')\">s</a></td>{cells(r)}</tr>"
        for i, r in enumerate(rows)
    ) + "</table>"


def test_global_science_meetings(spark, gazetteer):
    row = ["Meet", "Congress", "Sep. 30 - Oct. 2, 2019", "Rome", "Italy",
           'It\nis. Contact Info: A B | a@b.c | 12 | <a href="http://e.org/">Event Website</a>']
    page = grid([row, ["Other", *row[1:5], "no contact"], *[["x"]] * 9, ["Far", *row[1:]]])
    good, _ = events(spark, gazetteer, "global_science_meetings", page, row_index="0")
    record = dict(
        name="Meet", id="meet__rome__2019-09-30", event_url="http://e.org/", description="It is.",
        event_type="congress", start="2019-09-30", end="2019-10-02", length_in_days=3.0, country="Italy",
        city="Rome", contact_name="A B", contact_email="a@b.c", contact_phone="12",
        source="Global Science Meetings",
    )
    assert good == [record]
    assert events(spark, gazetteer, "global_science_meetings", page, row_index="1") == ([], ["no_contact"])
    out = harvest("global_science_meetings", spark.createDataFrame([(URL, page)], "url string, body string"), gazetteer)
    assert sorted(r.name for r in accepted(out).collect()) == ["Far", "Meet"]
    assert rejected(out).count() == 10


def test_label_list(spark, gazetteer):
    page = """<h3><span><strong>Course A</strong></span></h3><div class="wysiwygcontent">All <i>about</i></div>
    <div id="event-details"><ul><li><label>Date:</label> 25 - 28 February 2020</li>
    <li><label>Event Location:</label> Level: 3 </li><li><label>Your Price:</label> from AUD 1,250.00 incl.</li>
    <li><label>Registrations Close:</label> 20 Feb 2020 1: 00 PM</li></ul></div>"""
    good, bad = events(spark, gazetteer, "ausbiotech", page, page.replace("Registrations Close:", "x"))
    record = dict(
        name="Course A", id="coursea____2020-02-25", event_url="http://host/page", description="All about",
        event_type="course", start="2020-02-25", end="2020-02-28", length_in_days=4.0,
        country="Australia", city="", venue="Level: 3", price="1,250.00", currency="AUD",
        ticket_deadline="2020-02-20", source="Ausbiotech",
    )
    assert good == [record] and bad == ["bad_deadline"]
    assert events(spark, gazetteer, "ibioic", page)[0] == [{**record, "source": "IBioIC"}]


def test_bio_partner(spark, gazetteer):
    entry = dict.fromkeys(JSON_ENTRY.names, None) | dict(
        title="T", webpage="", registration_link="http://r.org", introduction="<p>in <b>tro</b></p>",
        description="", other_information="o&amp;o", classification="Expo/Fair", start_date="2019-06-25",
        end_date=None, last_registration_date="25 May 2019", country="", location_country="gb",
        city="Bath", location="Hall", scientific_focus_text="f", external_contact_email="e@x",
    )
    doc = {"message": ["careful"], "list": [entry, {**entry, "last_registration_date": "x"}, {**entry, "start_date": None}]}
    good, bad = events(spark, gazetteer, "bio_partner", json.dumps(doc), "not json")
    assert good == [dict(
        name="T", id="t__bath__2019-06-25", event_url="http://r.org", description="in tro  o&o", focus="f",
        event_type="expo", start="2019-06-25", end="2019-06-25", length_in_days=1.0,
        country="United Kingdom", city="Bath", venue="Hall", ticket_deadline="2019-05-25",
        contact_email="e@x", source="Bio Partner",
    )]
    assert sorted(bad) == ["bad_deadline", "no_start", "unreadable_document"]
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "not json")], "id int, body string")
    _, warnings = gio.json_list_rows(df, "body", JSON_ENTRY)
    assert sorted(map(tuple, warnings.collect())) == [(1, "careful"), (2, "unreadable document")]


SWISS = """<h1 class="case27-primary-text x">Swiss Day</h1><a href="http://s.org"><i></i><span>Website</span></a>
<div><div class="pf-head"><h5></h5></div><div class="pf-body">About <b>it</b></div></div>
<div><div class="pf-head"><h5>Details</h5></div><div class="pf-body">
 <li><i class="fa fa-calendar"></i><span>June 25, 2019 @ 9:00</span></li>
 <li><i class="fa fa-arrow-right"></i><span>June 26, 2019</span></li>
 <li><i class="icon-location-pin-add-2"></i><span>Rue 1, 4000 Basel, Switzerland</span></li></div></div>
<div><div class="pf-head"><h5>Type of event</h5></div><div class="pf-body"><i class="bookmark_border"></i><span>Fair</span></div></div>
"""
HOST = """<div><div class="pf-head"><h5>Hosted by</h5></div><div class="pf-body"><div class="event-host">
<a href="http://h.org"><span class="host-name">Host</span></a></div></div></div>"""


def test_swiss_biotech(spark, gazetteer):
    record = dict(
        name="Swiss Day", id="swissday__4000basel__2019-06-25", event_url="http://s.org", description="About it",
        event_type="fair", start="2019-06-25", end="2019-06-26", length_in_days=2.0,
        country="Switzerland", city="4000 Basel", source="Swiss Biotech", organizer="Listed",
    )
    good, bad = events(spark, gazetteer, "swiss_biotech", SWISS, SWISS.replace("fa-calendar", "x"), organizer="Listed")
    assert good == [record] and bad == ["bad_start"]
    good, _ = events(spark, gazetteer, "swiss_biotech", SWISS + HOST, organizer="Listed")
    assert good == [{**record, "organizer": "Host", "organizer_url": "http://h.org"}]


def test_solebury_trout(spark, gazetteer):
    body = ('Event,Website,Description,Start,End,Location\r\n"A, Seminar",http://a.org,"l1\nl2",'
            '"June 25, 2019","June 26, 2019","Boston, MA, USA"\r\nB,,,soon,,X\n')
    good, bad = events(spark, gazetteer, "solebury_trout", body)
    assert good == [dict(
        name="A, Seminar", id="aseminar__boston__2019-06-25", event_url="http://a.org", description="l1\nl2",
        event_type="seminar", start="2019-06-25", end="2019-06-26", length_in_days=2.0,
        country="United States", state="Ma" if False else "Massachusetts", city="Boston", source="Solebury Trout",
    )]
    assert bad == ["bad_date"]


def test_european_biotechnology(spark, gazetteer):
    entry = """<article class="event"><div class="ce-inner-headline"><h2><span>Euro Congress</span></h2></div>
    <div><span class="event-date">25.06.2019</span><span class="event-date"> - 27.06.2019</span></div>
    <span class="event-location">Basel (CH)</span><div class="ce-inner-text"><p>About.
    Info: Green Power, Robert Wilson, Phone: +49-89 1, eMail: Info@a.de</p></div>
    <div class="ce-inner-url"><a href="http://e.org/">x</a></div></article>"""
    good, bad = events(spark, gazetteer, "european_biotechnology", entry, entry.replace("Phone: ", "Phone: a:"))
    assert good == [dict(
        name="Euro Congress", id="eurocongress__basel__2019-06-25", event_url="http://e.org/",
        description="About. Info:", event_type="congress", start="2019-06-25", end="2019-06-27",
        length_in_days=3.0, country="Switzerland", city="Basel", contact_name="Robert Wilson ".rstrip() ,
        contact_email="info@a.de", contact_phone="+49-891", organizer="Green Power",
        source="European Biotechnology",
    )]
    assert bad == ["bad_contact"]


def test_bia(spark, gazetteer):
    page = """<h1>BIA Workshop</h1><div class="content-wrapper">Come <b>in</b></div><div class="after-heading-meta">
    <ul><li>09:00-17:00, 25 Jun 19</li><li>Hall 1, London</li></ul><ul><li>Training</li></ul></div>"""
    good, bad = events(spark, gazetteer, "bia", page, page.replace("Hall 1, London", "a, b, c"))
    assert good == [dict(
        name="BIA Workshop", id="biaworkshop__london__2019-06-25", event_url="http://host/page",
        description="Come in", event_type="training", start="2019-06-25", end="2019-06-25", length_in_days=1.0,
        country="United Kingdom", city="London", venue="Hall 1", organizer="BIA",
        organizer_url="https://www.bioindustry.org", source="BIA",
    )]
    assert bad == ["bad_location"]


def test_listing_to_details(spark, gazetteer):
    entry = lambda h: f'<div class="type-tribe_events"><h2 class="tribe-events-list-event-title"><a href="{h}">x</a></h2></div>'
    detail = """<h1 class="tribe-events-single-event-title">{}</h1><abbr class="tribe-events-start-date" title="2019-06-25"></abbr>
    <dd class="tribe-events-event-url"><a href="http://e.org">e</a></dd>"""
    base = "https://www.labiotech.eu/events/list/"
    pages = [
        (base, entry("http://l/1") + entry("http://l/2") + f'<a rel="next" href="{base}2">n</a>'),
        (base + "2", entry("http://l/2") + entry("http://l/3")),
        ("http://l/1", detail.format("One")), ("http://l/2", detail.format("Two")), ("http://l/9", detail.format("No")),
    ]
    df = spark.createDataFrame(pages, "url string, body string")
    out = accepted(harvest_details("labiotech", df, gazetteer))
    assert sorted(r.name for r in out.collect()) == ["One", "Two"]

    item = '<div id="finderListings"><div class="grid-item"><div class="lf-item"><a href="http://s/1">x</a></div></div></div>'
    listing = item + '<ul class="details-list"><li><span>Host: Someone</span></li></ul>'
    first = "https://www.swissbiotech.org/events/"
    more = '<nav class="job-manager-pagination"><a data-page="1">1</a><a data-page="2">→</a></nav>'
    second = listing.replace("http://s/1", "http://s/2").replace("Someone", "Other")
    df = spark.createDataFrame(
        [(first, listing + more), (first + "?pg=2", second + listing), ("http://s/1", SWISS), ("http://s/2", SWISS)],
        "url string, body string",
    )
    out = accepted(harvest_details("swiss_biotech", df, gazetteer)).collect()
    assert sorted((r.name, r.organizer) for r in out) == [("Swiss Day", "Other"), ("Swiss Day", "Someone")]


def test_csv_bodies(spark):
    bodies = [
        'A,B\n"x, y",2\n"l1\nl2",3\n', "A,B\r\n1,2\r\n\r\n3\n4,5,6\n", "A,A\n1,2\n", "A,B", "", None,
        'A,"B"\n1,2\n', "A,B\nbad\rrow,1\n",
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    got = [
        (r.id, r.row_no, r.rec, r.overflow)
        for r in gio.csv_body_rows(df, "body").orderBy("id", "row_no").collect()
    ]
    expected = []
    for i, body in enumerate(bodies):
        if body is None:
            continue
        lines = io.StringIO(body)
        names = lines.readline().strip().split(",")
        try:
            rows = list(csv.DictReader(lines, fieldnames=names))
        except csv.Error:
            expected.append((i, None, None, None))
            continue
        for n, row in enumerate(rows):
            over = row.pop(None, None)
            expected.append((i, n, row, over))
    assert got == expected


def test_write_and_merge(spark, tmp_path):
    df = spark.createDataFrame(
        [("BIO", 'a "q", b', " x\ny ", None), ("BIA", "n", None, None)],
        "source string, name string, description string, city string",
    )
    columns = gio.write_events_csv(conform(df.withColumn("start", F.lit("2019-01-01"))), str(tmp_path / "out"), "tag")
    assert columns == ["name", "description", "start", "source"]
    files = list((tmp_path / "out" / "file=BIO__tag").glob("*.csv"))
    with files[0].open(newline="") as f:
        assert list(csv.DictReader(f)) == [
            {"name": 'a "q", b', "description": " x\ny ", "start": "2019-01-01", "source": "BIO"}
        ]
    inputs = {"a.csv": 'a,b\n1,"x\n""y"""\n,2\n', "b.csv": "b,c\n3,4\n", "c.csv": "a,b\n5\n"}
    for name, text in inputs.items():
        (tmp_path / name).write_text(text)
    paths = [str(tmp_path / n) for n in inputs]
    main(["merge_csvs", *paths, "-o", str(tmp_path / "merged")])
    rows, header = [], None
    for part in sorted((tmp_path / "merged").glob("*.csv")):
        with part.open(newline="") as f:
            reader = csv.DictReader(f)
            rows += list(reader)
            header = reader.fieldnames
    assert header == ["a", "b", "c"]
    assert sorted(map(tuple, (r.values() for r in rows))) == sorted(
        [("1", 'x\n"y"', ""), ("", "2", ""), ("", "3", "4"), ("5", "", "")]
    )
    (tmp_path / "long.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="longer than its header"):
        gio.read_csv_files(spark, [str(tmp_path / "long.csv")]).collect()


def test_merge_sources(spark):
    a, b = spark.sql("select 1 x, 2 y"), spark.sql("select 3 y, 4 z")
    out = merge_sources([a, b])
    assert out.columns == ["x", "y", "z"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, None), (None, 3, 4)]


def test_page_source_and_stream(spark, gazetteer, tmp_path):
    page = '<div class="event-search"><table><tbody>' + BIO_ROW + "</tbody></table></div>"
    df = spark.createDataFrame([(URL, page)] * 3, "url string, body string")
    df.write.parquet(str(tmp_path / "pages"))
    read = gio.page_source(spark, str(tmp_path / "pages"), "BIO", body="body")
    assert read.columns == ["source", "url", "body"] and read.count() == 3
    query = harvest_stream(
        "bio", page_stream(spark, str(tmp_path / "pages")), gazetteer,
        str(tmp_path / "events"), str(tmp_path / "cp"),
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "events"))
    assert [r.id for r in out.collect()] == ["bioexpo__boston__2019-06-03"] * 3
    assert set(out.columns) <= {*EVENT_COLUMNS, REJECT}


def test_stream_with_a_large_gazetteer(spark, gazetteer, tmp_path):
    """Thousands of written forms are searched by the same plan, so the stream keeps no state."""
    many = spark.range(3000).selectExpr(
        "cast(id as int) ord", "'Land' || id || 'x' name", "'C' || id || 'y' alpha_2"
    )
    entry = """<div class="event"><div class="event_title"><h3>A Summit</h3></div><div class="event_date"><b>25 Jun 19-26 Jun 19</b></div>
    <div class="event_desc">Hall<br>Town Land2999x<br>-<br>About<br></div><div class="event_web"><a href="http://w.org/">w</a></div></div>"""
    spark.createDataFrame([(URL, entry)], "url string, body string").write.parquet(str(tmp_path / "pages"))
    harvest_stream(
        "uk_biotech_database", page_stream(spark, str(tmp_path / "pages")), Gazetteer(many, gazetteer.subdivisions),
        str(tmp_path / "events"), str(tmp_path / "cp"),
    ).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "events")).first()
    assert (row.city.strip(), row.country) == ("Town", "Land2999x")


def test_a_rerun_replaces_and_headers_may_differ(spark, tmp_path):
    first = spark.sql("select 'BIO' source, 'a.b, c' name, 'x' city")
    out = str(tmp_path / "out")
    for _ in range(2):
        gio.write_events_csv(first, out, "t")
    gio.write_events_csv(spark.sql("select 'BIA' source, 'n' name"), out, "t")
    got = [r.asDict() for r in gio.read_csv_files(spark, [f"{out}/file=BIO__t"]).collect()]
    assert got == [{"source": "BIO", "name": "a.b, c", "city": "x"}]
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "1.csv").write_text('name,"the.city"\nn1,c1\n')
    (folder / "2.csv").write_text("the.city,name\r\nc2,n2\r\n")
    got = gio.read_csv_files(spark, [str(folder)])
    assert sorted((r["name"], r["the.city"]) for r in got.collect()) == [("n1", "c1"), ("n2", "c2")]


def test_size_check_gathers_sums_only(spark):
    """Nothing but one row of sums per partition meets in one task."""
    import contextlib
    import io as text

    from gleanfield.session import small_side

    seen = []
    kind = type(spark.range(1))
    real = kind.first
    kind.first = lambda self: (seen.append(self), real(self))[1]
    try:
        small_side(spark.range(1000).repartition(8))
    finally:
        kind.first = real
    out = text.StringIO()
    with contextlib.redirect_stdout(out):
        seen[0].explain("simple")
    plan = out.getvalue()
    before, after = plan.split("Exchange SinglePartition", 1)
    assert "Limit" not in plan and "partial_count" in after.split("\n")[1]


def test_json_lists_without_a_declared_entry(spark):
    docs = [
        (1, '{"list": [{"a": 1, "b": "x", "c\'d e": null}, {"a": 2.5, "b": 7, "z": {"k": [1, "t"]}}, 5, null, "text"]}'),
        (2, '{"message": ["m"], "list": []}'), (3, "{cut"), (4, None), (5, '{"list": [{"a": -3, "b": null}]}'), (6, '{"list": 9}'), (7, "[1]"),
    ]
    got = gio.json_list_rows_inferred(spark.createDataFrame(docs, "entry_id int, body string"), "body")
    assert [f.name for f in got.schema["entry"].dataType] == ["a", "b", "c'd e", "z"]
    rows = [(r.entry_id, r.row_index, *r.entry) for r in got.orderBy("entry_id", "row_index").collect()]
    assert [(i, n, a is not None and float(a), b, c) for i, n, a, b, c, _ in rows] == [
        (1, 0, 1.0, "x", None), (1, 1, 2.5, "7", None), (1, 2, False, None, None), (1, 3, False, None, None), (1, 4, False, None, None), (5, 0, -3.0, None, None),
    ]
    assert rows[1][5] is not None and rows[0][5] is None
    none = gio.json_list_rows_inferred(spark.createDataFrame(docs[1:4], "entry_id int, body string"), "body")
    assert none.count() == 0 and none.columns == ["entry_id", "row_index", "entry"]
