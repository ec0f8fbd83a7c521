"""Queries of the site mappings: bookings written out the way a site shows them, harvested back.

The expected rows are worked out from the bookings, not from the written form.
"""

from pyspark.sql import functions as F

from gleanfield.plans.catalog.registry import BOOKINGS, query
from gleanfield.plans.harvest import harvest, harvest_details, merge_sources
from gleanfield.schema import REJECT
from gleanfield.sources.sites import SITES, map_site

_WITH = "with " + BOOKINGS
_TYPE = "case when kind = 'meeting' then {other} when kind = 'expo and congress' then 'expo' else lower(kind) end"
_ID = "regexp_replace(lower({name}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') || '__' || regexp_replace(lower({city}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') || '__' || strftime(s, '%Y-%m-%d')"
_DATES = "strftime(s, '%Y-%m-%d') as start_date, strftime(e, '%Y-%m-%d') as end_date, cast(date_diff('day', s, e) + 1 as double) as length_in_days"


def _id(name, city):
    return _ID.format(name=name, city=city) + " as id"


def _type(other="null"):
    return _TYPE.format(other=other) + " as event_type"


def _events(df):
    """Rejected records keep their key and reason only."""
    out = df.withColumnRenamed("start", "start_date").withColumnRenamed("end", "end_date")
    good = F.col(REJECT).isNull()
    keys = ("k", "page", REJECT)
    return out.select(*[F.when(good, F.col(c)).alias(c) if c not in keys else F.col(c) for c in out.columns])


def _written(t, markup):
    """One page per booking."""
    url = F.expr("'http://site/' || k || '?utm_x=1&id=' || k")
    return t.bookings().select("k", url.alias("url"), F.expr(markup).alias("body"))


def _listing(t, markup, head, foot, size=20):
    """One page per `size` bookings."""
    from gleanfield.plans.catalog.tables import _paged

    pages = _paged(t.bookings(), "k", F.expr(markup), "page", size)
    body = F.concat(F.lit(head), "rows", F.lit(foot))
    return pages.select("page", F.lit("http://site/list").alias("url"), body.alias("body"))


def _calendar_page():
    return (
        "'<h1 class=\"x tribe-events-single-event-title\"> ' || who || ' ' || kind || '</h1><div class=\"tribe-events-content\"><p>About</p> '"
        " || seg || '</div><abbr class=\"tribe-events-start-datetime\" title=\"' || s || '\"></abbr>'"
        " || if(s = e, '', '<abbr class=\"tribe-events-end-date\" title=\"' || e || '\"></abbr>')"
        " || if(prio = '5-LOW', '', '<dd class=\"tribe-events-event-url\"><a href=\"http://e.org/' || k || '?utm_source=a&amp;id=' || k || '\">e</a></dd>')"
        " || '<dd class=\"tribe-organizer\"> Org ' || seg || '</dd><dd class=\"tribe-venue\">Hall ' || k || '</dd>'"
        " || '<span class=\"tribe-locality\">City ' || cn || '</span><span class=\"tribe-country-name\">' || chr(65 + cn) || 'q</span>'"
    )


_CALENDAR_SQL = """
select k, who || ' ' || kind as name, {id}, 'http://e.org/' || k || '?id=' || k as event_url,
  'About ' || seg as description, {type}, {dates}, country, '' as state, {place},
  '' as contact_email, 'Org ' || seg as organizer, '' as organizer_url, '{source}' as source, null::varchar as reject_reason
from bookings where prio <> '5-LOW'
union all select k, {nulls} 'no_event_url' from bookings where prio = '5-LOW'"""


@query(_WITH + _CALENDAR_SQL.format(
    id=_id("who || ' ' || kind", "'City ' || cn"), type=_type("''"), dates=_DATES,
    place="'City ' || cn as city, 'Hall ' || k as venue", source="Labiotech", nulls="null, " * 16))
def q_site_labiotech(t):
    """M1, M2"""
    pages = _written(t, _calendar_page())
    return _events(harvest("labiotech", pages, t.gazetteer()))


@query(_WITH + _CALENDAR_SQL.format(
    id=_id("who || ' ' || kind", "'Hall ' || k"), type=_type("''"), dates=_DATES,
    place="'Hall ' || k as city", source="Bio Based Press", nulls="null, " * 15))
def q_site_bio_based_press(t):
    """M3"""
    pages = _written(t, _calendar_page())
    return _events(harvest("bio_based_press", pages, t.gazetteer()))


_US = (
    "case when s = e then date_format(s, 'MMMM d, yyyy') when trunc(s, 'MM') = trunc(e, 'MM')"
    " then date_format(s, 'MMMM d') || ' - ' || date_format(e, 'd, yyyy')"
    " else date_format(s, 'MMMM d, yyyy') || ' - ' || date_format(e, 'MMMM d, yyyy') end"
)


@query(_WITH + f"""
select k // 20 as page, who || ' ' || kind as name, {_id("who || ' ' || kind", "seg")},
  'https://www.bio.org/e/' || k as event_url, 'About ' || seg as description, {_type()}, {_DATES}, country, null::varchar as state,
  seg as city, 'BIO' as source, null::varchar as reject_reason from bookings where prio <> '5-LOW'
union all select k // 20, {"null, " * 12} 'bad_location' from bookings where prio = '5-LOW'""")
def q_site_bio(t):
    """M4 from listing pages of 20 rows"""
    row = (
        "'<tr><td><a class=\"event-name\" href=\"/e/' || k || '?utm_a=b\"> ' || who || ' <b>' || kind || '</b></a></td>"
        "<td class=\"x desc-cell\"> About ' || seg || '</td><td class=\"loc-cell\">' || seg || ', ' || country"
        " || if(prio = '5-LOW', ', x', '') || '</td><td class=\"views-field-field-date\">' || " + _US + " || '</td></tr>'"
    )
    pages = _listing(t, row, '<div class="event-search"><table><tbody>', "</tbody></table></div>")
    return _events(harvest("bio", pages, t.gazetteer()))


@query(_WITH + f"""
select k // 20 as page, who || ' & ' || kind as name, {_id("who || ' & ' || kind", "seg")},
  'http://w.org/' || k as event_url, 'About ' || k as description, {_type()}, {_DATES},
  case when cn between 10 and 24 then country else country end as country, seg as city, 'Hall & ' || k as venue,
  'Zoë ' || seg as contact_name, k || '@x.org' as contact_email, 'UK Biotech Database' as source, null::varchar as reject_reason
from bookings""")
def q_site_uk_biotech_database(t):
    """M5"""
    entry = (
        "'<div class=\"event\"><div class=\"event_title\"><h3>' || who || ' &amp; ' || kind || '</h3></div><div class=\"event_date\"><b>'"
        " || date_format(s, 'd MMM yy') || '-' || date_format(e, 'd MMM yy') || '</b></div>"
        "<div class=\"event_desc\">Hall &amp; ' || k || '<br>' || seg || ' ' || country || '<br>-<br>About ' || k || '<br></div>"
        "<div class=\"event_desc event_contact\">Zo&euml; ' || seg || '<br><a href=\"mailto:' || k || '%40x.org\">m</a></div>"
        "<div class=\"event_web\"><a href=\"http://w.org/' || k || '\">w</a></div></div>'"
    )
    pages = _listing(t, entry, "<body>", "</body>")
    return _events(harvest("uk_biotech_database", pages, t.gazetteer()))


_ABBREV = _US.replace("MMMM", "MMM.")


@query(_WITH + f"""
select k // 20 as page, who as name, {_id("who", "seg")}, 'http://e.org/' || k as event_url,
  'About it ' || k || '.' as description, lower(kind) as event_type, {_DATES}, country, seg as city,
  'Ann ' || k as contact_name, k || '@x.org' as contact_email, '+1 ' || k as contact_phone,
  'Global Science Meetings' as source, null::varchar as reject_reason from bookings where prio <> '5-LOW'
union all select k // 20, {"null, " * 14} 'no_contact' from bookings where prio = '5-LOW'""")
def q_site_global_science_meetings(t):
    """M6"""
    cell = lambda x: f"'<td align=\"left\"><font>' || {x} || '</font></td>'"
    contact = (
        "'About\\nit ' || k || '. ' || if(prio = '5-LOW', '', 'Contact Info: Ann ' || k || ' | ' || k || '@x.org | +1 ' || k || ' | ')"
        " || '<a href=\"http://e.org/' || k || '\">Event Website</a>'"
    )
    row = "'<tr onmouseover=\"x\">' || " + " || ".join(
        cell(x) for x in ("who", "kind", _ABBREV, "seg", "country", contact)
    ) + " || '</tr>'"
    pages = _listing(t, row, '<table id="grdSQL">', "</table>")
    return _events(harvest("global_science_meetings", pages, t.gazetteer()))


def _label_page():
    return (
        "'<h3><span><strong>' || who || ' ' || kind || '</strong></span></h3><div class=\"wysiwygcontent\">All <i>about</i> ' || seg || '</div>"
        "<div id=\"event-details\"><ul><li><label>Date:</label> ' || if(s = e, date_format(s, 'EEEE d MMMM yyyy'),"
        " date_format(s, 'd MMM yyyy') || ' - ' || date_format(e, 'd MMMM yyyy')) || '</li><li><label>Event Location:</label> Level: ' || k"
        " || '</li><li><label>Your Price:</label> from AUD ' || format_string('%.2f', price) || ' incl.</li>'"
        " || if(prio = '5-LOW', '', '<li><label>Registrations Close:</label> ' || date_format(s - interval 5 days, 'd MMM yyyy') || ' 1: 00 PM</li>')"
        " || '</ul></div>'"
    )


_LABEL_SQL = """
select k, who || ' ' || kind as name, {id}, 'http://site/' || k || '?id=' || k as event_url, 'All about ' || seg as description,
  {type}, {dates}, 'Australia' as country, '' as city, 'Level: ' || k as venue, printf('%.2f', price) as price, 'AUD' as currency,
  strftime(s - 5, '%Y-%m-%d') as ticket_deadline, '{source}' as source, null::varchar as reject_reason
from bookings where prio <> '5-LOW'
union all select k, {nulls} 'bad_deadline' from bookings where prio = '5-LOW'"""
_LABEL_ARGS = dict(id=_id("who || ' ' || kind", "''"), type=_type(), dates=_DATES, nulls="null, " * 15)


@query(_WITH + _LABEL_SQL.format(source="Ausbiotech", **_LABEL_ARGS))
def q_site_ausbiotech(t):
    """M7"""
    return _events(harvest("ausbiotech", _written(t, _label_page()), t.gazetteer()))


@query(_WITH + _LABEL_SQL.format(source="IBioIC", **_LABEL_ARGS))
def q_site_ibioic(t):
    """M8"""
    return _events(harvest("ibioic", _written(t, _label_page()), t.gazetteer()))


@query(_WITH + f"""
select k, who as name, {_id("who", "seg")}, 'http://r.org/' || k as event_url, 'in ' || seg || '  o&o' as description,
  prio as focus, lower(kind) as event_type, {_DATES}, country, null::varchar as state, seg as city, 'Hall' as venue,
  case when k % 2 = 0 then strftime(s - 5, '%Y-%m-%d') end as ticket_deadline, null::varchar as contact_name,
  k || '@x.org' as contact_email, 'Bio Partner' as source, null::varchar as reject_reason from bookings where k % 50 >= 2
union all select k, {"null, " * 17} 'unreadable_document' from bookings where k % 50 < 2""")
def q_site_bio_partner(t):
    """M9, documents cut short or missing among them"""
    entry = (
        "to_json(named_struct('title', who, 'webpage', '', 'registration_link', 'http://r.org/' || k, 'introduction',"
        " '<p>in <b>' || seg || '</b></p>', 'description', '', 'other_information', 'o&amp;o', 'scientific_focus_text', prio,"
        " 'classification', kind || '/x', 'start_date', string(s), 'end_date', string(e), 'last_registration_date',"
        " if(k % 2 = 0, date_format(s - interval 5 days, 'd MMM yyyy'), ''), 'country', '', 'location_country',"
        " lower(chr(65 + cn) || 'Q'), 'city', seg, 'location_city', 'no', 'location', 'Hall', 'external_contact_email', k || '@x.org'))"
    )
    body = f"'{{\"message\": null, \"list\": [' || {entry} || ']}}'"
    body = f"case k % 50 when 0 then left({body}, 40) when 1 then null else {body} end"
    return _events(harvest("bio_partner", _written(t, body), t.gazetteer()))


@query(_WITH + f"""
select k, who || ' ' || kind as name, {_id("who || ' ' || kind", "seg")}, 'http://s.org/' || k as event_url, 'About ' || seg as description,
  lower(prio) as event_type, {_DATES}, country, seg as city, case when k % 2 = 0 then 'Host ' || k else 'Listed ' || k end as organizer,
  case when k % 2 = 0 then 'http://h.org/' || k end as organizer_url, 'Swiss Biotech' as source, null::varchar as reject_reason
from bookings""")
def q_site_swiss_biotech(t):
    """M10 with the organizer of the listing as fallback"""
    box = lambda title, inner: f"'<div><div class=\"pf-head\"><h5>{title}</h5></div><div class=\"pf-body\">' || {inner} || '</div></div>'"
    icon = lambda cls, x: f"'<li><i class=\"fa {cls}\"></i><span>' || {x} || '</span></li>'"
    details = " || ".join([
        icon("fa-calendar", "date_format(s, 'MMMM d, yyyy') || ' @ 9:00'"),
        "if(s = e, '', " + icon("fa-arrow-right", "date_format(e, 'MMMM d, yyyy')") + ")",
        icon("icon-location-pin-add-2", "'Rue 1, ' || seg || ', ' || country"),
    ])
    host = "'<div class=\"event-host\"><a href=\"http://h.org/' || k || '\"><span class=\"host-name\">Host ' || k || '</span></a></div>'"
    page = " || ".join([
        "'<h1 class=\"case27-primary-text\">' || who || ' ' || kind || '</h1><a href=\"http://s.org/' || k || '\"><span>Website</span></a>'",
        box("", "'About <b>' || seg || '</b>'"), box("Details", details), box("Type of event", icon("bookmark_border", "prio")),
        "if(k % 2 = 0, " + box("Hosted by", host) + ", '')",
    ])
    pages = _written(t, page).withColumn("organizer", F.concat(F.lit("Listed "), F.col("k")))
    return _events(harvest("swiss_biotech", pages, t.gazetteer()).drop("row_index"))


@query(_WITH + f"""
select who || ', ' || kind as name, {_id("who || ', ' || kind", "seg")}, 'http://a.org/' || k as event_url,
  'l' || k || chr(10) || 'two' as description, {_type()}, {_DATES}, country,
  case when k % 2 = 0 then 'State ' || cn end as state, seg as city, 'Solebury Trout' as source, null::varchar as reject_reason from bookings
where k // 50 % 5 <> 0
union all select distinct {"null, " * 12} 'unreadable_document' || k // 50 from bookings where k // 50 % 5 = 0""")
def q_site_solebury_trout(t):
    """CSV documents of 50 bookings, some missing"""
    line = (
        "'\"' || who || ', ' || kind || '\",http://a.org/' || k || ',\"l' || k || '\\ntwo\",\"' || date_format(s, 'MMMM d, yyyy') || '\",\"'"
        " || date_format(e, 'MMMM d, yyyy') || '\",\"' || seg || if(k % 2 = 0, ', State ' || cn, '') || ', ' || country || '\"'"
    )
    pages = _listing(t, line, "Event,Website,Description,Start,End,Location\n", "\n", size=50)
    pages = pages.withColumn("body", F.when(F.col("page") % 5 != 0, F.col("body")))
    out = _events(harvest("solebury_trout", pages, t.gazetteer()))
    return out.withColumn(REJECT, F.concat(REJECT, F.col("page").cast("string"))).drop("page")


@query(_WITH + f"""
select k // 20 as page, who || ' ' || kind as name, {_id("who || ' ' || kind", "seg")}, 'http://e.org/' || k as event_url,
  'About ' || seg || '. Info:' as description, {_type()}, {_DATES}, country, seg as city,
  'Rob ' || k as contact_name, k || '@x.org' as contact_email, '+49-' || k as contact_phone, 'Green ' || seg as organizer,
  'European Biotechnology' as source, null::varchar as reject_reason from bookings""")
def q_site_european_biotechnology(t):
    """M12"""
    entry = (
        "'<article class=\"event\"><div class=\"ce-inner-headline\"><span>' || who || ' ' || kind || '</span></div><div><span class=\"event-date\">'"
        " || date_format(s, 'dd.MM.yyyy') || '</span><span class=\"event-date\"> - ' || date_format(e, 'dd.MM.yyyy') || '</span></div>"
        "<span class=\"event-location\">' || seg || ' (' || chr(65 + cn) || 'Q)</span><div class=\"ce-inner-text\"><p>About ' || seg || '.\\nInfo: Green '"
        " || seg || ', Rob ' || k || ' Phone: +49 - ' || k || ', eMail: ' || k || '@X.org</p></div><div class=\"ce-inner-url\"><a href=\"http://e.org/'"
        " || k || '\">x</a></div></article>'"
    )
    pages = _listing(t, entry, "<body>", "</body>")
    return _events(harvest("european_biotechnology", pages, t.gazetteer()))


@query(_WITH + f"""
select k, who || ' ' || kind as name, {_id("who || ' ' || kind", "case when k % 2 = 0 then seg else '' end")},
  'http://site/' || k || '?id=' || k as event_url, 'Come in ' || seg as description, lower(prio) as event_type, {_DATES},
  'United Kingdom' as country, case when k % 2 = 0 then seg else '' end as city, 'Hall ' || k as venue,
  'BIA' as organizer, 'https://www.bioindustry.org' as organizer_url, 'BIA' as source, null::varchar as reject_reason from bookings""")
def q_site_bia(t):
    """M13"""
    page = (
        "'<h1>' || who || ' ' || kind || '</h1><div class=\"content-wrapper\">Come <b>in</b> ' || seg || '</div><div class=\"after-heading-meta\"><ul><li>'"
        " || if(s = e, '09:00-17:00, ' || date_format(s, 'd MMM yy'), date_format(s, 'd MMM yy') || ' - ' || date_format(e, 'd MMM yy'))"
        " || '</li><li>Hall ' || k || if(k % 2 = 0, ', ' || seg, '') || '</li></ul><ul><li>' || prio || '</li></ul></div>'"
    )
    return _events(harvest("bia", _written(t, page), t.gazetteer()))


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date, 'Labiotech' as source
from bookings where prio <> '5-LOW'""")
def q_listing_to_details(t):
    """Chained listing pages of 100 links, each detail page once, then the mapping"""
    from gleanfield.plans.catalog.tables import _paged
    from gleanfield.operators.stages import accepted

    site = SITES["labiotech"]
    first = site.base_url + site.events_path
    entry = F.expr(
        "'<div class=\"type-tribe_events\"><h2 class=\"tribe-events-list-event-title\"><a href=\"http://site/' || k || '\">x</a></h2></div>'"
    )
    pages = _paged(t.bookings(), "k", entry, "page", 100)
    last = pages.agg(F.max("page")).scalar()
    address = lambda n: F.when(n == 0, first).otherwise(F.concat(F.lit(first), n.cast("string")))
    more = F.when(
        F.col("page") < last,
        F.concat(F.lit('<a rel="next" href="'), address(F.col("page") + 1), F.lit('">next</a>')),
    )
    listing = pages.select(address(F.col("page")).alias("url"), F.concat("rows", F.coalesce(more, F.lit(""))).alias("body"))
    details = t.bookings().select(F.concat(F.lit("http://site/"), F.col("k")).alias("url"), F.expr(_calendar_page()).alias("body"))
    out = accepted(harvest_details("labiotech", listing.unionByName(details), t.gazetteer()))
    return out.select("name", F.col("start").alias("start_date"), "source")


# -- whole flows: what the listing reaches, and nothing else ---------------------------


def _flow(name, listing, details, gazetteer, **how):
    """Accepted events; every detail page was captured twice, and so was every listing."""
    from gleanfield.operators.stages import accepted

    # a body is written once for both captures
    pages = listing.unionByName(details).withColumn("capture", F.explode(F.array(F.lit(1), F.lit(2))))
    out = accepted(harvest_details(name, pages.drop("capture"), gazetteer, **how))
    return out.withColumn("start_date", F.col("start"))


def _details(t, base, path, markup):
    return t.bookings().select(F.concat(F.lit(base + path), F.col("k")).alias("url"), F.expr(markup).alias("body"))


def _listings(t, row, size, address, tail=""):
    """Listing pages of `size` bookings with their seeds."""
    from gleanfield.plans.catalog.tables import _paged

    pages = _paged(t.bookings(), "k", F.expr(row), "page", size)
    body = F.concat(F.lit("<body>"), "rows", F.expr(tail) if tail else F.lit(""), F.lit("</body>"))
    return pages.select(F.expr(address).alias("url"), body.alias("body"))


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date from bookings where prio <> '5-LOW' and k % 30 < 24""")
def q_flow_ausbiotech(t):
    """Thirty calendar pages, of which the seeds name the next 24 months"""
    site = SITES["ausbiotech"]
    month = F.expr("add_months(date '2024-11-20', cast(k % 30 as int))")
    # A page has a thirtieth of all cells, so a cell is its key alone until the page is written, and keys are gathered in
    # pieces first: a task's pieces go to disk where there are many.
    piece = F.shiftright(F.monotonically_increasing_id(), 16).alias("piece")
    pieces = t.bookings().select(month.alias("m"), "k", piece).groupBy("m", "piece").agg(F.collect_list("k").alias("ks"))
    days = pieces.groupBy("m").agg(F.flatten(F.collect_list("ks")).alias("ks"))
    head, tail, count = F.lit('<td class="eventsCalenderDayHasEvents"><a href="/e/'), F.lit('">x</a></td>'), F.size("ks")
    first, between, last = F.get("ks", F.lit(0)), F.slice("ks", F.lit(2), count - 2).cast("array<string>"), F.get("ks", count - 1)
    cells = F.concat_ws('">x</a></td><td class="eventsCalenderDayHasEvents"><a href="/e/', F.concat(head, first), between, F.concat(last, tail))
    body = F.when(count > 1, cells).when(count == 1, F.concat(head, first, tail)).otherwise("")
    address = F.format_string(site.base_url + site.events_path + "?month=%d&year=%d", F.month("m"), F.year("m"))
    details = _details(t, site.base_url, "/e/", _label_page())
    pages = days.select(address.alias("url"), "ks").unionByName(details, allowMissingColumns=True)
    # Not deterministic, so it stays above the union and a long body goes into no row, which would be one or two copies.
    written = F.when(F.monotonically_increasing_id() >= 0, F.when(F.col("ks").isNotNull(), body).otherwise(F.col("body")))
    pages = pages.select("url", written.alias("body"))
    today = F.lit("2024-11-20").cast("date")
    return _flow("ausbiotech", pages, pages.limit(0), t.gazetteer(), today=today).select("name", "start_date")


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date from bookings
where k // 20 = (select min(k // 20) from bookings) or k // 20 < (select max(k // 20) from bookings)""")
def q_flow_european(t):
    """L4 with records on the listing: each page names the next, but the last is not named"""
    site = SITES["european_biotechnology"]
    first, last = t.bookings().selectExpr("floor(k / 20) p").selectExpr("min(p) a", "max(p) b").first()
    entry = (
        "'<article class=\"event\"><div class=\"ce-inner-headline\"><span>' || who || ' ' || kind || '</span></div><span class=\"event-date\">'"
        " || date_format(s, 'dd.MM.yyyy') || '</span><span class=\"event-location\">' || seg || '</span><div class=\"ce-inner-url\">"
        "<a href=\"http://e.org/' || k || '\">x</a></div></article>'"
    )
    tail = f"if(page + 1 < {last}, '<ul><li class=\"next\"><a href=\"{site.events_path}?p=' || (page + 1) || '\">next</a></li></ul>', '')"
    address = f"'{site.base_url}{site.events_path}' || if(page = {first}, '', '?p=' || page)"
    listing = _listings(t, entry, 20, address, tail)
    out = _flow("european_biotechnology", listing, listing.limit(0), t.gazetteer())
    return out.select("name", "start_date")


@query(_WITH + """
select who as name, strftime(s, '%Y-%m-%d') as start_date from bookings where k % 2 = 0""")
def q_flow_solebury(t):
    """Of two documents named the first is read"""
    site = SITES["solebury_trout"]
    line = (
        "if(k % 2 = {}, who || ',http://a.org/' || k || ',about,\"' || date_format(s, 'MMMM d, yyyy') || '\",\"'"
        " || date_format(e, 'MMMM d, yyyy') || '\",\"' || seg || ', ' || country || '\"', '')"
    )
    row = "'<a href=\"/about\">a</a>'"
    tail = "'<a href=\"/events/csv?a=' || page || '\">c</a><a href=\"/events/csv?b=' || page || '\">c</a>'"
    listing = _listings(t, row, 50, f"'{site.base_url}/list/' || page", tail)
    head = "'Event,Website,Description,Start,End,Location\\n'"
    docs = [
        _listings(t, line.format(n), 50, f"'{site.base_url}/events/csv?{x}=' || page").select(
            "url", F.concat(F.expr(head), F.regexp_replace(F.regexp_extract("body", "(?s)<body>(.*)</body>", 1), "\n+", "\n")).alias("body")
        )
        for n, x in enumerate("ab")
    ]
    seeds = listing.select(F.col("url").alias("seed"))
    out = _flow("solebury_trout", listing, docs[0].unionByName(docs[1]), t.gazetteer(), seeds=seeds)
    return out.select("name", "start_date")


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date
from (select *, max(k) over (partition by k // 20) as top from bookings) where prio <> '5-LOW' and k < top""")
def q_flow_ibioic(t):
    """The first entry has a link too many, so the last link of a page is not followed"""
    site = SITES["ibioic"]
    entry = (
        "'<div class=\"item-feature-text item-list\"><span><a href=\"/n/' || k || '\">x</a></span>'"
        " || if(k = min(k) over (partition by floor(k / 20)), '<span><a href=\"/extra/' || k || '\">y</a></span>', '') || '</div>'"
    )
    rows = t.bookings().select("k", F.expr(entry).alias("row"))
    pages = rows.groupBy(F.floor(F.col("k") / 20).alias("page")).agg(F.sort_array(F.collect_list(F.struct("k", "row"))).alias("r"))
    listing = pages.select(
        F.concat(F.lit(site.base_url + "/list/"), "page").alias("url"), F.array_join(F.transform("r", lambda r: r["row"]), "").alias("body")
    )
    details = _details(t, site.base_url, "/n/", _label_page())
    seeds = listing.select(F.col("url").alias("seed"))
    return _flow("ibioic", listing, details, t.gazetteer(), seeds=seeds).select("name", "start_date")


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date, 'Host ' || k as organizer from bookings""")
def q_flow_swiss(t):
    """L4 by page number, L6 and L7: the organizer comes from the listing"""
    site = SITES["swiss_biotech"]
    first, last = t.bookings().selectExpr("floor(k / 100) p").selectExpr("min(p) a", "max(p) b").first()
    row = (
        "'<div id=\"finderListings\"><div class=\"grid-item\"><div class=\"lf-item\"><a href=\"http://s/' || k || '\">x</a></div></div></div>"
        "<ul class=\"details-list\"><li><span>Host: Host ' || k || '</span></li></ul>'"
    )
    tail = f"if(page < {last}, '<nav class=\"job-manager-pagination\"><a data-page=\"1\">1</a><a data-page=\"' || (page + 1) || '\">\u2192</a></nav>', '')"
    address = f"'{site.base_url}{site.events_path}' || if(page = {first}, '', '?pg=' || page)"
    listing = _listings(t, row, 100, address, tail)
    box = (
        "'<h1 class=\"x-primary-text\">' || who || ' ' || kind || '</h1><div><div class=\"pf-head\"><h5>Details</h5></div><div class=\"pf-body\"><li>"
        "<i class=\"fa-calendar\"></i><span>' || date_format(s, 'MMMM d, yyyy') || '</span></li><li><i class=\"icon-location-pin-add-2\"></i><span>Rue 1, '"
        " || seg || ', ' || country || '</span></li></div></div>'"
    )
    details = t.bookings().select(F.expr("'http://s/' || k").alias("url"), F.expr(box).alias("body"))
    return _flow("swiss_biotech", listing, details, t.gazetteer()).select("name", "start_date", "organizer")


@query(_WITH + """
select who || ' ' || kind as name, strftime(s, '%Y-%m-%d') as start_date from bookings where k % 3 <> 0""")
def q_flow_bia(t):
    """Only linked detail pages count"""
    site = SITES["bia"]
    item = "if(k % 3 = 0, '', '<div class=\"widget-events-item\"><div class=\"widget-events-item-img\"><a href=\"/d/' || k || '\">x</a></div></div>')"
    listing = _listings(t, item, 100, f"'{site.base_url}/list/' || page")
    page = (
        "'<h1>' || who || ' ' || kind || '</h1><div class=\"content-wrapper\">Text</div><div class=\"after-heading-meta\"><ul><li>'"
        " || date_format(s, 'd MMM yy') || ' - ' || date_format(e, 'd MMM yy') || '</li><li>Hall</li></ul><ul><li>x</li></ul></div>'"
    )
    seeds = listing.select(F.col("url").alias("seed"))
    return _flow("bia", listing, _details(t, site.base_url, "/d/", page), t.gazetteer(), seeds=seeds).select("name", "start_date")


@query(_WITH + """
select who || ' ' || kind as name, 'City ' || cn as city, 'Hall ' || k as venue, 'Labiotech' as source from bookings where prio <> '5-LOW'
union all select who || ' ' || kind, 'Hall ' || k, null, 'Bio Based Press' from bookings where prio <> '5-LOW'""")
def q_merge_sources(t):
    """E4"""
    from gleanfield.operators.stages import accepted

    gazetteer = t.gazetteer()
    pages = _written(t, _calendar_page())
    parts = [accepted(map_site(n, pages, gazetteer)).withColumn("source", F.lit(SITES[n].source))
             for n in ("labiotech", "bio_based_press")]
    return merge_sources(parts).select("name", "city", "venue", "source")
