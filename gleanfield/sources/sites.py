"""The sites events come from: where their fields are and how they become event records.

Each site has the extraction of its `raw` fields and a projection of `raw` (and `url`) to
the event record. A record the projection cannot make sense of carries a `reject_reason`.
"""

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gleanfield.functions import dates, places, text
from gleanfield.functions.text import strip
from gleanfield.functions.urls import absolutise, mailto_address
from gleanfield.operators.gazetteer import Gazetteer, city_state_or_country, country_in_text
from gleanfield.operators.html import fields_of, fragment_text
from gleanfield.operators.markup import Field, Rule
from gleanfield.operators.stages import Stage, standard_stages
from gleanfield.schema import EVENT_COLUMNS, REJECT, event_columns
from gleanfield.session import cut_lineage
from gleanfield.sources.io import csv_body_rows, json_list_rows

Project = Callable[["Site", DataFrame, Gazetteer], DataFrame]


@dataclass(frozen=True)
class Site:
    source: str  # value of the record's `source`
    base_url: str
    events_path: str
    project: Project
    fields: dict[str, Field] = field(default_factory=dict)
    entry: tuple[Rule, ...] = ()  # records on the listing page itself
    links: tuple[Rule, ...] = ()  # links to detail pages
    link_prefix: str = ""  # of a page's links only the first that begins like this counts
    beside: dict[str, Field] = field(default_factory=dict)  # lists the links are zipped with
    months: int = 0  # the listing is a calendar of that many months from the current one
    next_page: tuple[Rule, ...] = ()  # link to the next listing page
    next_number: tuple[str, str] = ()  # its attribute with a page number, address before that
    keeps_newlines: bool = False
    constants: dict[str, str] = field(default_factory=dict)
    by_batch: bool = False  # the mapping groups rows, so a stream is mapped batch by batch

    def stages(self, gazetteer: Gazetteer) -> Stage:
        return standard_stages(self.source, gazetteer, newlines=not self.keeps_newlines)


def _raw(name: str) -> Column:
    return F.col("raw")[name]


def _bad(written: Column, read: Column) -> Column:
    """Text was there but could not be read."""
    return written.isNotNull() & read.isNull()


def _worked_out(df: DataFrame, **values: Column) -> tuple[DataFrame, *tuple[Column, ...]]:
    """`df` with helper columns, and those columns: each is used several times."""
    columns = {f"_{name}": value for name, value in values.items()}
    return df.withColumns(columns), *map(F.col, columns)


def _record(df: DataFrame, rejects: dict[str, Column], **values: Column) -> DataFrame:
    """Event columns and `reject_reason`; other columns of the input are kept in front."""
    keep = [c for c in df.columns if not c.startswith("_") and c not in
            ("raw", "body", "url", "place", "row_no", "row_index", *EVENT_COLUMNS)]
    reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(r)) for r, c in rejects.items()])
    return df.select(*keep, *event_columns(**values), reason.alias(REJECT))


# -- WordPress calendars --------------------------------------------------------------


def _tribe(tag: str, *classes: str) -> Rule:
    return Rule(tag, any_class=tuple(f"tribe-{c}" for c in classes))


_LINK = Rule("a", child=True)

CALENDAR_FIELDS = {
    "name": Field((_tribe("h1", "events-single-event-title"),)),
    "description": Field((_tribe("div", "events-content"),), "norm_text"),
    "start": Field((_tribe("abbr", "events-start-date", "events-start-datetime"),), "attr:title"),
    "end": Field((_tribe("abbr", "events-end-date", "events-end-datetime"),), "attr:title"),
    "event_type": Field((_tribe("dd", "events-event-categories"), _LINK), default=""),
    "event_url": Field((_tribe("dd", "events-event-url"), _LINK), "attr:href"),
    "organizer": Field((_tribe("dd", "organizer"),), default=""),
    "organizer_url": Field((_tribe("dd", "organizer-url"), _LINK), "attr:href", ""),
    "venue": Field((_tribe("dd", "venue"),), default=""),
    "city": Field((_tribe("span", "locality"),), default=""),
    "state": Field((_tribe("abbr", "region"),), "attr:title", ""),
    "country": Field((_tribe("span", "country-name"),), default=""),
    "contact_email": Field((_tribe("dd", "organizer-email"),), default=""),
}


def _calendar(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, start, end = _worked_out(
        df, start=dates.iso_date(_raw("start")), end=dates.iso_date(_raw("end"))
    )
    values = {k: strip(_raw(k)) for k in CALENDAR_FIELDS if k not in ("start", "end")}
    values["event_type"] = F.lower(values["event_type"])
    return _record(
        df,
        {
            "no_name": _raw("name").isNull(),
            "no_event_url": _raw("event_url").isNull(),
            "bad_start": _bad(_raw("start"), start),
            "bad_end": _bad(_raw("end"), end),
        },
        start=start, end=end, **values,
    )


def _calendar_venue_is_city(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    return _calendar(site, df, gazetteer).drop("city").withColumnRenamed("venue", "city")


CALENDAR = Site(
    "", "", "", _calendar, CALENDAR_FIELDS,
    links=(
        Rule("div", any_class=("type-tribe_events",)),
        Rule(any_class=("tribe-events-list-event-title",)),
        _LINK,
    ),
    next_page=(Rule("a", attr=("rel", "equals", "next")),),
    keeps_newlines=True,
)
LABIOTECH = replace(
    CALENDAR, source="Labiotech", base_url="https://www.labiotech.eu", events_path="/events/list/"
)
BIO_BASED_PRESS = replace(
    CALENDAR, source="Bio Based Press", base_url="https://www.biobasedpress.eu",
    events_path="/events/", project=_calendar_venue_is_city,
)

# -- table rows -----------------------------------------------------------------------


def _cell(*classes: str) -> Field:
    return Field((Rule("td", any_class=classes),))


def _bio(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, _, when = _worked_out(df, location=_raw("location"), when=dates.us_range(_raw("date")))
    placed = city_state_or_country(df, "_location", gazetteer)
    return _record(
        placed,
        {"bad_date": when.isNull(), "bad_location": F.col("place").isNull()},
        name=_raw("name"), event_url=absolutise(site.base_url, _raw("href")),
        description=_raw("description"), start=when["start"], end=when["end"],
        country=F.col("place.country"), state=F.col("place.state"), city=F.col("place.city"),
    )


BIO = Site(
    "BIO", "https://www.bio.org", "/events", _bio,
    {
        "name": Field((Rule("a", any_class=("event-name",)),), "norm_text"),
        "href": Field((Rule("a", any_class=("event-name",)),), "attr:href"),
        "description": _cell("desc-cell"),
        "location": _cell("loc-cell"),
        "date": _cell("views-field-field-date"),
    },
    entry=(
        Rule("div", any_class=("event-search",)), Rule("table"),
        Rule("tbody", child=True), Rule("tr", child=True),
    ),
)

_GRID = Rule("table", attr=("id", "equals", "grdSQL"))
_GRID_CELLS = Field(
    (Rule("td", attr=("align", "exists", "")),), "rows",
    sub={
        "text": Field((Rule("font"),), default=""),
        "href": Field((Rule("font"), _LINK), "attr:href"),
    },
)


def _global_science_meetings(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    cell = lambda i: strip(F.get(_raw("cells"), F.lit(i))["text"])
    df, when, contacts = _worked_out(
        df, when=dates.us_abbrev_range(cell(2)), contacts=text.contact_blocks(cell(5))
    )
    return _record(
        df,
        {
            "too_few_cells": F.size(_raw("cells")) < 6,
            "no_contact": ~contacts["ok"],
            "bad_date": when.isNull(),
        },
        name=cell(0), event_type=F.lower(cell(1)), start=when["start"], end=when["end"],
        city=cell(3), country=cell(4), event_url=F.get(_raw("cells"), F.lit(5))["href"],
        description=text.newlines_to_blank(contacts["description"]),
        contact_name=contacts["names"], contact_email=contacts["emails"],
        contact_phone=contacts["phones"],
    )


GLOBAL_SCIENCE_MEETINGS = Site(
    "Global Science Meetings", "http://www.globalsciencemeetings.com", "/Events.aspx",
    _global_science_meetings, {"cells": _GRID_CELLS},
    entry=(_GRID, Rule("tr", attr=("onmouseover", "exists", ""))),
    keeps_newlines=True,
)


def grid_row(body: Column, row_index: Column) -> Column:
    """Cells of the grid row whose links select `row_index`, as the `raw` struct."""
    rows = fields_of(
        body,
        {
            "rows": Field(
                (_GRID, Rule("tr")), "rows",
                sub={"links": Field((Rule("a"),), "all_attr:href"), "cells": _GRID_CELLS},
            )
        },
    )["rows"]
    mark = F.concat(F.lit("SysRowSelector$"), row_index.cast("string"))
    wanted = F.filter(rows, lambda r: F.exists(r["links"], lambda h: F.contains(h, mark)))
    return F.struct(F.flatten(F.transform(wanted, lambda r: r["cells"])).alias("cells"))


# -- entries separated by <br> ----------------------------------------------------------


def _uk_biotech_database(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, parts, contact, when = _worked_out(
        df,
        parts=text.br_parts(_raw("description")), contact=text.br_parts(_raw("contact")),
        when=dates.two_digit_year_pair(_raw("date")),
    )
    part = lambda i: F.get(parts, F.lit(i))
    # the lookup reads the rows twice, the pages behind them are read once
    located = cut_lineage(df.withColumn("_location", part(1)))
    placed = country_in_text(located, "_location", gazetteer)
    person = F.when(F.size(contact) > 1, text.after_last_tag(F.get(contact, F.lit(0)))).otherwise("")
    return _record(
        placed,
        {"bad_description": F.size(parts) < 4, "bad_date": when.isNull()},
        name=_raw("name"), event_url=_raw("event_url"), description=part(3),
        start=when["start"], end=when["end"],
        country=F.col("place.country"), city=F.col("place.city"),
        venue=text.html_unescape(text.after_last_tag(part(0))),
        contact_name=text.html_unescape(person),
        contact_email=mailto_address(_raw("contact_email")),
    )


_CONTACT = Rule("div", all_class=("event_desc", "event_contact"))
UK_BIOTECH_DATABASE = Site(
    "UK Biotech Database", "http://www.ukbiotech.com", "/uk/portal/events.php",
    _uk_biotech_database,
    {
        "name": Field((Rule("div", any_class=("event_title",)), Rule("h3", child=True))),
        "description": Field((Rule("div", any_class=("event_desc",)),), "html", "<br><br><br>"),
        "date": Field((Rule("div", any_class=("event_date",)), Rule("b", child=True)), default=""),
        "contact": Field((_CONTACT,), "html", "<br>"),
        "contact_email": Field((_CONTACT, _LINK), "attr:href", ""),
        "event_url": Field((Rule("div", any_class=("event_web",)), _LINK), "attr:href"),
    },
    entry=(Rule("div", any_class=("event",)),),
    by_batch=True,
)

# -- label lists ----------------------------------------------------------------------


def _label(label: str) -> Field:
    return Field(
        (
            Rule("div", attr=("id", "equals", "event-details")),
            Rule("ul", child=True),
            Rule("li", child=True, has=Rule("label", child=True, own_text=label)),
        ),
        "string",
    )


def _label_list(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, when, closes = _worked_out(
        df,
        when=dates.day_month_range(text.after_label(_raw("date"))),
        closes=dates.day_month_range(text.after_label(_raw("deadline"))),
    )
    return _record(
        df,
        {"bad_date": when.isNull(), "bad_deadline": closes.isNull()},
        name=_raw("name"), event_url=F.col("url"), description=_raw("description"),
        start=when["start"], end=when["end"], ticket_deadline=closes["end"],
        venue=text.after_label(_raw("venue")), price=text.price_text(text.after_label(_raw("price"))),
        **{k: F.lit(v) for k, v in site.constants.items()},
    )


AUSBIOTECH = Site(
    "Ausbiotech", "https://www.ausbiotech.org", "/events/calendar_month", _label_list,
    {
        "name": Field(
            (Rule("h3", first=1), Rule("span", child=True), Rule("strong", child=True))
        ),
        "description": Field((Rule("div", any_class=("wysiwygcontent",)),), "norm_text"),
        "venue": _label("Event Location:"),
        "deadline": _label("Registrations Close:"),
        "price": _label("Your Price:"),
        "date": _label("Date:"),
    },
    links=(Rule("td", any_class=("eventsCalenderDayHasEvents",)), _LINK),
    months=24,
    constants={"country": "Australia", "city": "", "currency": "AUD"},
)
# The Scottish site is labelled with the Australian country and currency; override
# `constants` with dataclasses.replace where that is not wanted.
IBIOIC = replace(
    AUSBIOTECH, source="IBioIC", base_url="http://www.ibioic.com",
    events_path="/news_and_events/events/d8/",
    links=(Rule("div", any_class=("item-feature-text", "item-list")), Rule("span"), _LINK),
    # One link per entry: surplus links of the page are not followed.
    beside={"": Field((Rule("div", any_class=("item-feature-text", "item-list")),), "all_attr:class")},
    months=0,
)

# -- JSON -----------------------------------------------------------------------------

# Fields of a JSON entry.
JSON_ENTRY = StructType(
    [
        StructField(name, StringType())
        for name in """
        title webpage registration_link introduction description other_information
        scientific_focus_text classification start_date end_date last_registration_date
        country location_country location_state city location_city location
        external_contact_name external_contact_email
        """.split()
    ]
)


def _either(first: str, second: str) -> Column:
    return F.coalesce(F.nullif(_raw(first), F.lit("")), _raw(second))


def _bio_partner(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, start, end, closes = _worked_out(
        df,
        start=dates.iso_date(_raw("start_date")), end=dates.iso_date(_raw("end_date")),
        closes=dates.deadline(_raw("last_registration_date")),
    )
    return _record(
        df,
        {
            "unreadable_document": F.col("raw").isNull(),
            "no_type": _raw("classification").isNull(),
            "bad_start": _bad(_raw("start_date"), start),
            "bad_end": _bad(_raw("end_date"), end),
            "bad_deadline": _bad(F.nullif(_raw("last_registration_date"), F.lit("")), closes),
        },
        name=_raw("title"), event_url=_either("webpage", "registration_link"),
        description=text.compose_description(
            *[fragment_text(_raw(k)) for k in ("introduction", "description", "other_information")]
        ),
        focus=_raw("scientific_focus_text"),
        event_type=F.split_part(_raw("classification"), F.lit("/"), F.lit(1)),
        start=start, end=end, ticket_deadline=closes,
        country=_either("country", "location_country"), state=_raw("location_state"),
        city=_either("city", "location_city"), venue=_raw("location"),
        contact_name=_raw("external_contact_name"), contact_email=_raw("external_contact_email"),
    )


BIO_PARTNER = Site(
    "Bio Partner", "http://www.biopartner.co.uk", "/events.php", _bio_partner
)

# -- info boxes -----------------------------------------------------------------------


def _box(title: str | None) -> Rule:
    heading = Rule("h5", own_text=title) if title else Rule("h5", no_text=True)
    return Rule("div", class_eq="pf-body", after=Rule("div", class_eq="pf-head", has=heading))


def _icon(box: str, icon: str, take: str = "first_text", default: str | None = None) -> Field:
    return Field((_box(box), Rule("span", after=Rule("i", any_class=(icon,)))), take, default)


def _swiss_biotech(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, start, end, place = _worked_out(
        df,
        start=dates.long_us_date(dates.before_hour(_raw("start"))),
        end=dates.long_us_date(_raw("end")),
        place=places.address_tail(F.get(_raw("location"), F.size(_raw("location")) - 1)),
    )
    listed = [F.col("organizer")] if "organizer" in df.columns else []
    return _record(
        df,
        {
            "bad_start": start.isNull(),
            "bad_end": _bad(_raw("end"), end),
            "no_location": F.size(_raw("location")) == 0,
        },
        name=_raw("name"), event_url=_raw("event_url"), description=_raw("description"),
        event_type=_raw("event_type"), start=start, end=end,
        country=place["country"], city=place["city"],
        organizer=F.coalesce(_raw("organizer"), *listed), organizer_url=_raw("organizer_url"),
    )


SWISS_BIOTECH = Site(
    "Swiss Biotech", "https://www.swissbiotech.org", "/events/", _swiss_biotech,
    {
        "name": Field((Rule("h1", class_like="-primary-text"),), default=""),
        "event_url": Field((Rule("a", has=Rule("span", own_text="Website")),), "attr:href", ""),
        "description": Field((_box(None),), "norm_text"),
        "start": _icon("Details", "fa-calendar"),
        "end": _icon("Details", "fa-arrow-right"),
        "location": _icon("Details", "icon-location-pin-add-2", "all_text"),
        "organizer": Field((_box("Hosted by"), Rule("span", any_class=("host-name",)))),
        "organizer_url": Field(
            (_box("Hosted by"), Rule("div", any_class=("event-host",)), _LINK), "attr:href"
        ),
        "event_type": _icon("Type of event", "bookmark_border", default=""),
    },
    links=(
        Rule("div", attr=("id", "equals", "finderListings")),
        Rule("div", any_class=("grid-item",)), Rule("div", any_class=("lf-item",)), Rule("a"),
    ),
    next_page=(
        Rule("nav", any_class=("job-manager-pagination",)),
        Rule("a", attr=("data-page", "exists", ""), own_text="\u2192"),
    ),
    next_number=("data-page", "https://www.swissbiotech.org/events/?pg="),
    # Host details may be missing on the detail page, so the listing's go along.
    beside={
        "organizer": Field((Rule("ul", any_class=("details-list",)), Rule("span")), "all_string")
    },
)

# -- CSV ------------------------------------------------------------------------------


def _solebury_trout(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, start, end, place = _worked_out(
        df,
        start=dates.month_d_y_tokens(_raw("Start")), end=dates.month_d_y_tokens(_raw("End")),
        place=places.city_state_country(_raw("Location")),
    )
    return _record(
        df,
        {
            "unreadable_document": F.col("raw").isNull(),
            "bad_date": start.isNull() | end.isNull(),
            "no_location": _raw("Location").isNull(),
        },
        name=_raw("Event"), event_url=_raw("Website"), description=_raw("Description"),
        start=start, end=end, country=place["country"], state=place["state"], city=place["city"],
    )


SOLEBURY_TROUT = Site(
    "Solebury Trout", "https://www.soleburytrout.com",
    "/lifesciences/calendar?qs_industry[]=life_sciences&keyword=&qs_time=4", _solebury_trout,
    links=(Rule("a", attr=("href", "prefix", "/events/csv")),),
    link_prefix="/events/csv",
    keeps_newlines=True,
)

# -- articles and meta lists ------------------------------------------------------------


def _european_biotechnology(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, start, end, contacts, info, place = _worked_out(
        df,
        start=dates.dotted_date(_raw("start")), end=dates.dotted_date(_raw("end")),
        contacts=text.labelled_contacts(_raw("description")),
        info=text.info_names(_raw("description")),
        place=places.city_paren_country(_raw("location")),
    )
    return _record(
        df,
        {
            "bad_start": _bad(_raw("start"), start),
            "bad_end": _bad(_raw("end"), end),
            "bad_contact": ~(contacts["ok"] & info["ok"]),
        },
        name=_raw("name"), event_url=_raw("event_url"), description=info["description"],
        start=start, end=end, country=place["country"], city=place["city"],
        contact_name=info["names"], contact_email=contacts["emails"],
        contact_phone=contacts["phones"], organizer=info["organizer"],
    )


EUROPEAN_BIOTECHNOLOGY = Site(
    "European Biotechnology", "https://european-biotechnology.com", "/events/",
    _european_biotechnology,
    {
        "name": Field((Rule("div", any_class=("ce-inner-headline",)), Rule("span"))),
        "description": Field(
            (Rule("div", any_class=("ce-inner-text",)), Rule("p", child=True)), "norm_text"
        ),
        "start": Field((Rule("span", any_class=("event-date",), nth=1),)),
        "end": Field((Rule("span", any_class=("event-date",), nth=2),)),
        "event_url": Field((Rule("div", any_class=("ce-inner-url",)), _LINK), "attr:href"),
        "location": Field((Rule("span", any_class=("event-location",)),), default=""),
    },
    entry=(Rule("article", any_class=("event",)),),
    next_page=(Rule("li", any_class=("next",)), _LINK),
    keeps_newlines=True,
)


def _meta_item(group: int, item: int, default: str | None = None) -> Field:
    return Field(
        (
            Rule("div", any_class=("after-heading-meta",)),
            Rule("ul", child=True, nth=group),
            Rule("li", child=True, nth=item),
        ),
        default=default,
    )


def _bia(site: Site, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    df, when, place = _worked_out(
        df,
        when=dates.uk_meeting_date(_raw("date")), place=places.venue_city(_raw("location")),
    )
    return _record(
        df,
        {"bad_date": when.isNull(), "bad_location": place.isNull()},
        name=_raw("name"), event_url=F.col("url"), description=_raw("description"),
        event_type=_raw("event_type"), start=when["start"], end=when["end"],
        city=place["city"], venue=place["venue"], organizer_url=F.lit(site.base_url),
        **{k: F.lit(v) for k, v in site.constants.items()},
    )


BIA = Site(
    "BIA", "https://www.bioindustry.org", "/events-listing.html", _bia,
    {
        "name": Field((Rule("h1"),)),
        "description": Field((Rule("div", any_class=("content-wrapper",)),), "norm_text"),
        "location": _meta_item(1, 2, ""),
        "date": _meta_item(1, 1, "-"),
        "event_type": _meta_item(2, 1),
    },
    links=(
        Rule("div", any_class=("widget-events-item",)),
        Rule("div", child=True, any_class=("widget-events-item-img",)), _LINK,
    ),
    constants={"country": "United Kingdom", "organizer": "BIA"},
)

SITES = {
    "events_calendar": CALENDAR,
    "labiotech": LABIOTECH,
    "bio_based_press": BIO_BASED_PRESS,
    "bio": BIO,
    "uk_biotech_database": UK_BIOTECH_DATABASE,
    "global_science_meetings": GLOBAL_SCIENCE_MEETINGS,
    "ausbiotech": AUSBIOTECH,
    "ibioic": IBIOIC,
    "bio_partner": BIO_PARTNER,
    "swiss_biotech": SWISS_BIOTECH,
    "solebury_trout": SOLEBURY_TROUT,
    "european_biotechnology": EUROPEAN_BIOTECHNOLOGY,
    "bia": BIA,
}


def map_site(name: str, df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    """Records in `body` (entry markup, detail page, JSON or CSV document) to events.

    `url` is the page's address; `organizer` (info boxes) and `row_index` (grid pages) may
    come along from the listing. A document that cannot be read gives one rejected record.
    """
    site = SITES[name]
    keep = [c for c in df.columns if c != "body"]
    if site is BIO_PARTNER:
        rows, _ = json_list_rows(df, "body", JSON_ENTRY, keep_unreadable=True)
        entry = F.when(F.col("row_index").isNotNull(), F.struct(*JSON_ENTRY.names))
        raw = rows.select(*keep, entry.alias("raw"))
    elif site is SOLEBURY_TROUT:
        raw = csv_body_rows(df, "body", keep_missing=True).withColumnRenamed("rec", "raw").drop("overflow")
    elif site is GLOBAL_SCIENCE_MEETINGS and "row_index" in df.columns:
        raw = df.withColumn("raw", grid_row(F.col("body"), F.col("row_index"))).drop("body")
    else:
        raw = df.withColumn("raw", fields_of(F.col("body"), site.fields)).drop("body")
    return site.project(site, raw, gazetteer)
