"""Queries of the table operators."""

from pyspark.sql import functions as F

from gleanfield.functions import urls
from gleanfield.operators import html, keyspace, listing, rows, stages
from gleanfield.operators.gazetteer import Gazetteer, city_state_or_country, country_in_text, normalize_place
from gleanfield.operators.markup import Field, Rule
from gleanfield.plans.catalog.registry import query
from gleanfield.plans.harvest import next_links
from gleanfield.sources import io

# -- pages, links, listings -------------------------------------------------------------

_HREFS = """
hrefs as (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as hrefs from pages),
links as (select page_id, url, href, pos from hrefs,
  lateral (select unnest(hrefs) as href, unnest(range(len(hrefs))) as pos))
"""


@query("""
select 'captured' as source, url, length(html) as n_chars from pages""")
def q_page_source(t):
    """S1"""
    pages = io.page_source(t.spark, f"{t.folder}/pages.parquet", "captured")
    return pages.select("source", "url", F.length("body").cast("long").alias("n_chars"))


@query("with " + _HREFS + "select page_id, pos, href from links")
def q_links(t):
    """L2 by rule"""
    pages = t.bodies("pages").select("page_id", "html")
    out = html.extract_links(pages, "html", Rule("nav"), Rule("a"))
    return out.withColumn("pos", F.col("pos").cast("long"))


@query("with " + _HREFS + r"""
select page_id, pos, regexp_extract(url, '^[a-z]+://[^/?#]*') || href as target from links""")
def q_abs_url(t):
    """L3 on all plain links"""
    links = html.extract_links(t.pages.select("page_id", "url", "html"), "html")
    parts = urls.unpack_url(F.col("url"))
    base = F.concat(parts["scheme"], F.lit("://"), parts["netloc"])
    return links.select(
        "page_id", F.col("pos").cast("long").alias("pos"),
        urls.absolutise(base, F.col("href")).alias("target"),
    )


@query(r"""
select page_id, pos, items[pos + 1] as entry
from (select page_id, regexp_extract_all(html, '<li>.*?</li>') as items from pages),
  lateral (select unnest(range(len(items))) as pos)""")
def q_entries(t):
    """L1"""
    pages = t.bodies("pages").select("page_id", "html")
    out = html.split_entries(pages, "html", Rule("ul"), Rule("li", child=True))
    return out.select("page_id", F.col("row_index").cast("long").alias("pos"), "entry")


@query("""
select o_orderkey // 20 as page, row_number() over (partition by o_orderkey // 20 order by o_orderkey) - 1 as row_index,
  o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority as cells, '/o/' || o_orderkey as link from orders""")
def q_row_cells(t):
    """Tables of 20 orders per page"""
    row = F.expr(
        "'<tr><td>' || o_orderkey || '<td> ' || o_orderstatus || ' </td><td><b>' || o_orderpriority"
        " || '</b><a href=\"/o/' || o_orderkey || '\"></a>'"
    )
    pages = _paged(t.orders, "o_orderkey", row, "page")
    body = F.concat(F.lit("<table>"), "rows", F.lit("</table>"))
    pages = pages.select("page", body.alias("html"))
    out = html.row_cells(pages, "html", (Rule("table"), Rule("tr")), Rule("td", child=True))
    return out.select(
        "page", F.col("row_index").cast("long").alias("row_index"),
        F.array_join("cells", "|").alias("cells"), F.get("links", F.lit(0)).alias("link"),
    )


def _paged(df, key, row, page, size=20):
    """Rows of markup gathered to pages of `size` consecutive keys."""
    rows_ = df.select(F.col(key).alias("k"), row.alias("row"))
    boxed = F.sort_array(F.collect_list(F.struct("k", "row")))
    return rows_.groupBy(F.floor(F.col("k") / size).alias(page)).agg(
        F.array_join(F.transform(boxed, lambda r: r["row"]), "\n").alias("rows")
    )


@query("with " + _HREFS + """
select href as url, min(page_id * 1000 + pos) as first_seen from links group by 1""")
def q_dedupe(t):
    """Every link once, as first met"""
    links = html.extract_links(t.pages.select("page_id", "html"), "html")
    seen = links.select(F.col("href").alias("url"), (F.col("page_id") * 1000 + F.col("pos")).alias("first_seen"))
    return listing.dedupe_requests(seen, ["first_seen"])


@query("with " + _HREFS + """
, first as (select href, arg_min(page_id, page_id * 1000 + pos) as page_id from links group by 1),
details as (select distinct href, case when len(href) % 2 = 0 then href end as organizer from links)
select d.href as url, coalesce(d.organizer, 'page ' || f.page_id) as organizer
from details d left join first f on d.href = f.href""")
def q_context_join(t):
    """Linked pages take the organizer from the first page listing them, where they have none"""
    links = html.extract_links(t.pages.select("page_id", "html"), "html")
    found = links.select(
        F.col("href").alias("url"), F.concat(F.lit("page "), F.col("page_id")).alias("organizer"),
        (F.col("page_id") * 1000 + F.col("pos")).alias("seen"),
    )
    own = F.when(F.length("url") % 2 == 0, F.col("url"))
    details = found.select("url").distinct().withColumn("organizer", own)
    return listing.attach_listing_context(details, found, ["organizer"], order=["seen"])


@query(r"""
select first_value(url) over w as seed, url, row_number() over w - 1 as depth
from (select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host,
        'http://x.org/' || page_id as url from pages)
window w as (partition by host order by page_id rows between unbounded preceding and current row)""")
def q_pagination(t):
    """L4: the pages of a host, each linked to the next one"""
    pages = t.pages.select(
        "page_id", urls.unpack_url(F.col("url"))["netloc"].alias("host"),
        F.concat(F.lit("http://x.org/"), F.col("page_id")).alias("url"),
    )
    linked = rows.pairwise(pages, ["host"], ["page_id"], "url", "next_url")
    body = F.concat(F.lit('<p><a rel="next" href="'), "next_url", F.lit('">next</a>'))
    captured = linked.select("url", F.coalesce(body, F.lit("<p>end")).alias("body"))
    seeds = pages.groupBy("host").agg(F.min_by("url", "page_id").alias("seed")).select("seed")
    links = next_links(captured, (Rule("a", attr=("rel", "equals", "next")),))
    return listing.follow_pagination(links, seeds)


@query("""
select o_orderkey, month(d) as month, year(d) as year,
  'http://x.org/cal?month=' || month(d) || '&year=' || year(d) as url
from (select o_orderkey, unnest(range(date_trunc('month', cast(o_orderdate as date)),
  cast(date_trunc('month', cast(o_orderdate as date)) + interval 24 month as timestamp), interval 1 month)) as d from orders)""")
def q_calendar(t):
    """S2"""
    out = listing.calendar_seed(
        t.orders.select("o_orderkey", "o_orderdate"), "http://x.org", "/cal", F.to_date("o_orderdate")
    )
    return out.select("o_orderkey", F.col("month").cast("long"), F.col("year").cast("long"), "url")


# -- neighbours and lists ---------------------------------------------------------------


@query("""
select event_id, user_id, event_type, lead(event_type) over w as next, lead(event_id) over w is null as is_last
from events window w as (partition by user_id order by ts, event_id)""")
def q_pairs(t):
    """F2"""
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    out = rows.pairwise(events, ["user_id"], ["ts", "event_id"], "event_type")
    return out.drop("ts")


@query("""
select event_id, user_id, event_type from (
  select *, lead(event_type) over (partition by user_id order by ts, event_id) as following from events)
where following is null or following <> event_type""")
def q_adjacent(t):
    """F3"""
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    return rows.remove_adjacent_dup(events, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query("""
select user_id, pos // 7 as chunk, string_agg(event_type, '|' order by pos) || repeat('|none', 7 - count(*)) as items
from (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as pos from events)
group by 1, 2""")
def q_chunks(t):
    """F5"""
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    out = rows.chunks(events, ["user_id"], ["ts", "event_id"], "event_type", 7, F.lit("none"))
    return out.select("user_id", "chunk", F.array_join("items", "|").alias("items"))


@query("""
select event_id, user_id, event_type, lead(event_id) over w as following, lead(event_id) over w is null as is_last
from events window w as (partition by user_id order by event_type, event_id)""")
def q_pairs_text_order(t):
    """F2 in the order of a text column, most keys dealt by ranges"""
    events = t.events.select("event_id", "user_id", "event_type")
    return rows.pairwise(events, ["user_id"], ["event_type", "event_id"], "event_id", "following", hot_rows=20)


@query("""
select user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as ord, event_id as value from events""")
def q_lot2dol(t):
    """F12"""
    events = t.events.select("event_id", "user_id", "ts")
    return rows.lot2dol(events, ["user_id"], "event_id", ["ts", "event_id"])


@query("""
select event_id, 'type' as key, event_type as value from events
union all select event_id, 'ids', cast(user_id as varchar) from events
union all select event_id, 'ids', cast(event_id as varchar) from events
union all select event_id, 'none', null from events""")
def q_dol2lot(t):
    """F11"""
    lists = F.create_map(
        F.lit("type"), F.array("event_type"),
        F.lit("ids"), F.array(F.col("user_id").cast("string"), F.col("event_id").cast("string")),
        F.lit("none"), F.lit(None).cast("array<string>"),
        F.lit("empty"), F.array().cast("array<string>"),
    )
    return rows.dol2lot(t.events.select("event_id", lists.alias("m")), "m")


@query("""
select event_id, 'a_0_k' as path, json_extract_string(props, '$.k') as value from events
union all select event_id, 'a_1', event_type from events
union all select event_id, 'b_c_user', cast(user_id as varchar) from events
union all select event_id, 'b_n', null from events""")
def q_flatten_json(t):
    """the properties inside a deeper document"""
    doc = F.expr(
        "'{\"a\": [' || props || ', \"' || event_type || '\"], \"b\": {\"c\": {\"user\": ' || user_id"
        " || '}, \"n\": null, \"none\": [], \"e\": {}}}'"
    )
    out = rows.flatten_json(t.bodies("events").select("event_id", doc.alias("doc")), "doc")
    return out.drop("reject_reason")


@query("""
select event_id, case when event_type <> 'error' then repeat('a_', 20) || 'b' end as path,
  case when event_type <> 'error' then cast(user_id as varchar) end as value,
  case when event_type = 'error' then 'not JSON' end as reject_reason
from events""")
def q_flatten_json_deep(t):
    """twenty levels, a path met twice, documents cut short"""
    doc = F.expr(
        "repeat('{\"a\": ', 20) || '{\"b\": \"x\", \"b\": ' || user_id || '}' || repeat('}', 20)"
    )
    cut = F.when(F.col("event_type") == "error", F.left(doc, F.lit(40))).otherwise(doc)
    return rows.flatten_json(t.bodies("events").select("event_id", cut.alias("doc")), "doc")


# -- documents in a column ----------------------------------------------------------------


@query("""
select n_nationkey, row_number() over (partition by n_nationkey, s_suppkey // 100000 order by s_suppkey) - 1 as row_no,
  s_name || ', "' || s_suppkey || '"' as name, s_name || chr(10) || n_name as note, cast(s_suppkey as varchar) as number
from supplier join nation on s_nationkey = n_nationkey""")
def q_csv_rows(t):
    """S3: a CSV document per nation, with quotes, commas and line breaks inside values"""
    return _csv(t, "'\"' || s_name || ', \"\"' || s_suppkey || '\"\"\",\"' || s_name || '\\n' || n_name || '\",' || s_suppkey")


@query("""
select n_nationkey, row_number() over (partition by n_nationkey, s_suppkey // 100000 order by s_suppkey) - 1 as row_no,
  s_name as name, case when s_suppkey % 4 <> 0 then n_name end as note,
  case when s_suppkey % 4 <> 0 then cast(s_suppkey as varchar) end as number
from supplier join nation on s_nationkey = n_nationkey""")
def q_csv_plain_rows(t):
    """S3 without quotes, some records short"""
    return _csv(t, "s_name || if(s_suppkey % 4 <> 0, ',' || n_name || ',' || s_suppkey, '')")


def _csv(t, line):
    # A document holds the suppliers of a nation in one span of numbers, so it stays small.
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = joined.select("n_nationkey", "s_suppkey", F.expr(line).alias("line"))
    boxed = F.sort_array(F.collect_list(F.struct("s_suppkey", "line")))
    docs = lines.groupBy("n_nationkey", F.floor(F.col("s_suppkey") / 100_000).alias("span")).agg(
        F.concat(F.lit("name,note,number\n"), F.array_join(F.transform(boxed, lambda r: r["line"]), "\n")).alias("body")
    )
    out = io.csv_body_rows(docs, "body")
    return out.select(
        "n_nationkey", F.col("row_no").cast("long").alias("row_no"), F.col("rec")["name"].alias("name"),
        F.col("rec")["note"].alias("note"), F.col("rec")["number"].alias("number"),
    )


@query("""
select event_id, 0::bigint as row_index, event_type as title, json_extract_string(props, '$.k') as k from events
union all select event_id, 1, cast(user_id as varchar), null from events""")
def q_json_rows(t):
    """The entries"""
    return _json(t)[0].select("event_id", F.col("row_index").cast("long").alias("row_index"), "title", "k")


@query("""
select event_id, 0::bigint row_index, event_type title, cast(user_id as double) n, event_type as tag, '[1,2]' mixed from events
union all select event_id, 1, cast(user_id as varchar), user_id + 0.5, null, '{"a":"b"}' from events""")
def q_json_rows_inferred(t):
    """S4 with entries that nothing is declared of, of mixed types"""
    doc = F.expr(
        """concat('{"message": [], "list": [{"title": "', event_type, '", "n": ', user_id, ', "tags": ["x", "', event_type, '"], "mixed": [1, 2]}, """
        """{"title": ', user_id, ', "n": ', user_id, '.5, "mixed": {"a": "b"}}]}')"""
    )
    rows = io.json_list_rows_inferred(t.bodies("events").select("event_id", doc.alias("body")), "body")
    return rows.select(
        "event_id", F.col("row_index").cast("long").alias("row_index"), "entry.title", F.col("entry.n").cast("double").alias("n"),
        F.get("entry.tags", F.lit(1)).alias("tag"), "entry.mixed",
    )


@query("""
select event_id, case when event_type = 'error' then 'unreadable document' else event_type end as message
from (select event_id, event_type from events)""")
def q_json_warnings(t):
    """The messages, documents cut short among them"""
    return _json(t, broken=True)[1].select("event_id", "message")


def _json(t, broken=False):
    from pyspark.sql.types import StringType, StructField, StructType

    doc = F.expr(
        "'{\"message\": [\"' || event_type || '\"], \"list\": [{\"title\": \"' || event_type || '\", \"k\": '"
        " || get_json_object(props, '$.k') || '}, {\"title\": ' || user_id || '}]}'"
    )
    if broken:
        doc = F.when(F.col("event_type") == "error", F.left(doc, F.lit(20))).otherwise(doc)
    entry = StructType([StructField("title", StringType()), StructField("k", StringType())])
    return io.json_list_rows(t.bodies("events").select("event_id", doc.alias("body")), "body", entry)


@query("""
select n_nationkey, n_name, n_regionkey, null::int as r_regionkey, null::varchar as r_name, null::bigint as s_suppkey from nation
union all select null, null, null, r_regionkey, r_name, null from region
union all select s_nationkey, null, null, null, null, s_suppkey from supplier""")
def q_merge(t):
    """S6"""
    supplier = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return io.merge_by_name([t.nation, t.region, supplier])


@query("""
select 'BIO' as source, c_name || ', "x"' as name, c_mktsegment || chr(10) || ' ' as description, null::varchar as city
from customer
union all select 'BIA', s_name, null, 'n' || s_nationkey from supplier""")
def q_csv_files(t):
    """Events written per source, read back and merged by header"""
    customers = t.customer.selectExpr(
        "'BIO' source", "c_name || ', \"x\"' name", "c_mktsegment || '\\n ' description"
    )
    suppliers = t.supplier.selectExpr("'BIA' source", "s_name name", "'n' || s_nationkey city")
    folder = t.out_folder()
    io.write_events_csv(customers, folder, "run")
    io.write_events_csv(suppliers, folder, "run")
    merged = io.read_csv_files(t.spark, [f"{folder}/file=BIO__run", f"{folder}/file=BIA__run"])
    return merged.select("source", "name", "description", "city")


# -- gazetteer --------------------------------------------------------------------------


@query("""
select c_custkey, case c_custkey % 4 when 0 then n_name when 1 then n_name when 2 then 'Zz' else 'Elsewhere' end as country,
  case c_custkey % 4 when 0 then r_name || ' of ' || n_name when 1 then r_name || ' of ' || n_name
    when 2 then upper(left(r_name, 1)) || lower(substr(r_name, 2, 1)) else r_name end as state
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def q_country_lookup(t):
    """Codes of nations and their regions"""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    raw = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey",
        "case c_custkey % 4 when 0 then lower(chr(65 + n_nationkey) || 'Q') when 1 then chr(65 + n_nationkey) || 'QX'"
        " when 2 then 'ZZ' else 'Elsewhere' end country",
        "case c_custkey % 4 when 1 then chr(65 + n_nationkey) || 'Q-' || left(r_name, 2)"
        " when 3 then r_name else left(r_name, 2) end state",
    )
    return normalize_place(raw, t.gazetteer())


@query("""
select c_custkey, case when m < 2 then c_mktsegment when m = 2 then n_name end as city,
  case when m = 0 then r_name || ' of ' || n_name end as state, case when m < 3 then n_name end as country
from (select *, c_custkey % 4 as m from customer join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey)""")
def q_state_lookup(t):
    """P2"""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    raw = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey",
        "case c_custkey % 4 when 0 then c_mktsegment || ', ' || r_name || ' of ' || n_name"
        " when 1 then c_mktsegment || ', ' || n_name when 2 then n_name else 'a, b, c' end loc",
    )
    return city_state_or_country(raw, "loc", t.gazetteer()).select("c_custkey", "place.*")


@query("""
with texts as (select c_custkey, c_name || ' ' || n_name as loc from customer join nation on c_nationkey = n_nationkey),
tokens as (select n_nationkey as ord, n_name as name, unnest([n_name, chr(65 + n_nationkey) || 'Q', chr(65 + n_nationkey) || 'QX']) as token from nation),
last as (select loc, arg_max(name, ord) as country from (select distinct loc from texts) x join tokens on contains(loc, token) group by 1)
select c_custkey, string_split(t.loc, country)[1] as city, country
from texts t left join last on t.loc = last.loc""")
def q_country_in_text(t):
    """NATION_1 also occurs in NATION_10, the last one counts"""
    raw = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat("c_name", F.lit(" "), "n_name").alias("loc")
    )
    return country_in_text(raw, "loc", t.gazetteer()).select("c_custkey", "place.*")


PORTS = "'Port ' || cast({k} as varchar(20)) || chr(cast(65 + {k} % 26 as int))"


@query(f"""
with texts as (select c_custkey, c_mktsegment || ', ' || {PORTS.format(k='c_custkey * 3')} || case when c_custkey % 5 = 0 then ' or P' || cast(c_custkey as varchar) || '.' else '' end loc from customer),
places as (select o_orderkey ord, {PORTS.format(k='o_orderkey')} name, 'P' || cast(o_orderkey as varchar) || '.' alpha_2 from orders),
last as (select loc, arg_max(name, ord) country from texts join (select ord, name, unnest([name, alpha_2]) token from places) on contains(loc, token) group by loc)
select c_custkey, string_split(t.loc, country)[1] city, country from texts t left join last on t.loc = last.loc""")
def q_country_many_forms(t):
    """P3 with two written forms for every order: a gazetteer that grows with the data"""
    places = t.orders.selectExpr(
        "o_orderkey ord", PORTS.format(k="o_orderkey") + " name", "'P' || cast(o_orderkey as string) || '.' alpha_2"
    )
    subdivisions = t.gazetteer().subdivisions
    texts = t.customer.selectExpr(
        "c_custkey", f"c_mktsegment || ', ' || {PORTS.format(k='c_custkey * 3')} || "
        "if(c_custkey % 5 = 0, ' or P' || cast(c_custkey as string) || '.', '') loc",
    )
    return country_in_text(texts, "loc", Gazetteer(places, subdivisions)).select("c_custkey", "place.*")


# -- key space --------------------------------------------------------------------------


@query("""
with steps as (select unnest(['a', 'b', 'c', 'ch']) as s),
one as (select s_suppkey, chr(cast(97 + s_suppkey % 5 as int)) || s as t from supplier, steps)
select s_suppkey, t as term from one where length(t) >= 3 and left(t, 2) between 'bb' and 'dc'
union all select s_suppkey, t || s from one, steps where length(t) < 3 and left(t, 2) between 'bb' and 'dc'""")
def q_combinations(t):
    """K1: terms of at least three letters between two prefixes"""
    seeds = t.supplier.select("s_suppkey", F.expr("chr(97 + s_suppkey % 5)").alias("seed"))
    out = keyspace.string_combinations(
        seeds, "seed", min_length=3, start="bb", end="dc", alphabet="abc", variants={"c": ["ch"]}
    )
    return out.select("s_suppkey", "term")


@query("""
with steps as (select unnest(string_split('abcdefghijklmnopqrstuvwxyz0123456789', '')) as s)
select s_suppkey, lower(s_name) || s as term from supplier, steps""")
def q_combinations_long_seed(t):
    """K1: one character more than a long seed has"""
    seeds = t.supplier.select("s_suppkey", F.lower("s_name").alias("seed"))
    length = seeds.agg(F.max(F.length("seed"))).first()[0] or 0
    return keyspace.string_combinations(seeds, "seed", min_length=length + 1).select("s_suppkey", "term")


@query(r"""
with steps as (select unnest(['p', 'q', 'r']) as s),
capped as (select page_id, url, regexp_extract(url, '[?&](page|ref)=([^&#]*)', 2) as old from pages
  where regexp_matches(url, '[?&]page=2(&|#|$)'))
select page_id, '2' || s as term, regexp_replace(url, 'page=2', 'page=2' || s) as new_url from capped, steps""")
def q_refine(t):
    """K2: pages asked for with `page=2` count as capped"""
    capped = F.col("url").rlike(r"[?&]page=2(&|#|$)")
    out = keyspace.refine_capped_queries(
        t.pages.select("page_id", "url"), "url", capped, "page", alphabet="pqr"
    )
    return out.select("page_id", "term", "new_url")


# Searches by the beginning of a customer's code, cut off above twelve hits. A seventh of the codes are
# the same, so that those searches never end; results of some terms have not been captured.
CODES = """
select case when c_custkey % 7 = 0 then '0000' else rpad(reverse(cast(c_custkey as varchar(20))), 4, '5') end code
from customer"""
SEARCHES = f"""
select substr(code, 1, n) term, 'https://find.example/list?q=' || substr(code, 1, n) || '&p=1' url, count(*) hits
from ({CODES}) cross join (select 1 n union all select 2 union all select 3 union all select 4) lengths
group by substr(code, 1, n) having substr(code, 1, n) not like '_9'"""


@query(f"""
with recursive searches as ({SEARCHES}),
walk as (
  select cast(d as varchar) term, null::varchar parent, 0 depth from range(10) r(d)
  union all
  select w.term || d, s.url, w.depth + 1 from walk w join searches s using (term), range(10) r(d)
  where s.hits > 12 and length(w.term) < 3)
select 'https://find.example/list?q=' || w.term || '&p=1' url, w.term, w.parent, w.depth,
  case when s.hits is null then 'missing' when s.hits <= 12 then 'complete' when length(w.term) < 3 then 'refined' else 'stuck' end outcome
from walk w left join searches s using (term)""")
def q_refine_to_end(t):
    """K2 until no search is capped, not captured, or cannot be made longer"""
    t.customer.createOrReplaceTempView("customer")
    searches = t.spark.sql(SEARCHES)
    seeds = t.spark.range(10).selectExpr("'https://find.example/list?q=' || id || '&p=1' url")
    return keyspace.refine_to_end(
        seeds, searches, "url", F.col("hits") > 12, "q", max_length=3, alphabet="0123456789"
    )


# -- stages -----------------------------------------------------------------------------


@query("""
select p_partkey, trim(p_name) || '!?' as name from part""")
def q_compose(t):
    """Stages by priority, one twice, one off"""
    mark = lambda df: df.withColumn("name", F.concat("name", F.lit("!")))
    ask = lambda df: df.withColumn("name", F.concat("name", F.lit("?")))
    chain = stages.compose(
        {ask: 30, mark: [10, 20.5], stages.strip_strings: 5, (lambda df: df.withColumn("name", F.rtrim("name", F.lit("!")))): 15,
         stages.blank_newlines: None}
    )
    return chain(t.part.select("p_partkey", F.concat(F.lit(" "), "p_name", F.lit("\n")).alias("name")))


@query(f"""
with e as (select page_id, url,
    replace(replace(translate(trim(regexp_extract(html, '<h1>([^<]*)', 1), ' ' || chr(10)), chr(10) || chr(13), '  '), '&quot;', '"'), '&amp;', '&') as name,
    replace(replace(trim(regexp_replace(regexp_replace(regexp_extract(html, '<article>(?s:(.*?))</article>', 1), '<[^>]*>', '', 'g'), '[ \\t\\r\\n]+', ' ', 'g'), ' ' || chr(10)), '&quot;', '"'), '&amp;', '&') as description,
    regexp_extract(html, 'lang="([^"]*)"', 1) as country_, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as city,
    strftime(date '2019-06-03' + cast(page_id % 400 as int), '%Y-%m-%d') as day,
    regexp_extract(url, '^([^?#]*)', 1) as base,
    [p for p in string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&') if regexp_matches(p, '^[^=]*=.') and not starts_with(p, 'utm')] as kept,
    regexp_extract(url, '#(.*)$', 1) as fragment
  from pages)
select page_id, name, regexp_replace(lower(name), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') || '__' || regexp_replace(lower(city), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') || '__' || day as id,
  base || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end
    || case when fragment <> '' then '#' || fragment else '' end as event_url,
  description, case {" ".join(f"when contains(lower(name), '{k}') then '{k}'" for k in stages.EVENT_TYPES)}
    {" ".join(f"when contains(description, '{k}') then '{k}'" for k in stages.EVENT_TYPES)} end as event_type,
  day as start_date, day as end_date, 1.0::double as length_in_days,
  case when length(country_) <= 3 then upper(left(country_, 1)) || lower(substr(country_, 2)) else country_ end as country, city,
  'Captured' as source, null::varchar as reject_reason
from e""")
def q_pages_to_events(t):
    """The whole chain over the captured pages"""
    fields = {
        "name": Field((Rule("article"), Rule("h1"))),
        "description": Field((Rule("article"),), "norm_text"),
        "country": Field((Rule("html"),), "attr:lang"),
    }
    pages = t.bodies("pages").select("page_id", "url", "html")
    found = pages.select("page_id", F.col("url").alias("event_url"), html.fields_of(F.col("html"), fields).alias("f"))
    start = F.expr("date_add(date '2019-06-03', cast(page_id % 400 as int))")
    events = found.select("page_id", "event_url", "f.*").withColumns(
        {"start": start, "city": urls.unpack_url(F.col("event_url"))["netloc"]}
    )
    out = stages.standard_stages("Captured", t.gazetteer())(events)
    return out.withColumnRenamed("start", "start_date").withColumnRenamed("end", "end_date")
