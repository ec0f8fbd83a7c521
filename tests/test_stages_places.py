from datetime import date

import pytest
from pyspark.sql import functions as F

from gleanfield.operators import gazetteer as g
from gleanfield.operators import stages
from gleanfield.schema import EVENT_COLUMNS, EVENT_SCHEMA, REJECT
from gleanfield.session import small_side


def event(**values):
    return tuple(values.get(c) for c in EVENT_COLUMNS)


def test_default_gazetteer(spark, gazetteer):
    countries = {r.alpha_2: r for r in gazetteer.countries.collect()}
    assert len(countries) > 240 and countries["GB"].name == "United Kingdom"
    assert countries["KR"].name == "Korea, Republic of" and countries["KR"].common_name == "South Korea"
    assert countries["AW"].ord == 0  # ABW is the first three-letter code
    assert gazetteer.subdivisions.where("code = 'US-MA'").first().name == "Massachusetts"


def test_normalize_place(spark, gazetteer):
    rows = [("gb", None), ("xyz", None), ("Germany", "MA"), ("us", "ma"), ("US", "zz"),
            (None, "us-ma"), ("", "ma"), ("USA", "Massachusetts"), (None, "ab-cd")]
    df = spark.createDataFrame(rows, "country string, state string").withColumn("i", F.monotonically_increasing_id())
    got = [(r.country, r.state) for r in g.normalize_place(df, gazetteer).orderBy("i").collect()]
    assert got == [
        ("United Kingdom", None), ("Xyz", None), ("Germany", "Ma"), ("United States", "Massachusetts"),
        ("United States", "Zz"), (None, "Massachusetts"), ("", "Ma"),
        ("United States", "Massachusetts"), (None, "Ab-cd"),
    ]


def test_city_state_or_country(spark, gazetteer):
    rows = [("Boston, MA",), ("Paris, France",), ("Singapore",), ("a, b, c",), ("Perth, WA",), (None,), ("Ontario",)]
    df = spark.createDataFrame(rows, "loc string")
    got = {r.loc: r.place and tuple(r.place) for r in g.city_state_or_country(df, "loc", gazetteer).collect()}
    assert got == {
        "Boston, MA": ("Boston", "Massachusetts", "United States"),
        "Paris, France": ("Paris", None, "France"), "Singapore": ("Singapore", None, "Singapore"),
        "a, b, c": None, None: None,
        "Perth, WA": ("Perth", "Western Australia", "Australia"),  # AU-WA comes before US-WA
        "Ontario": ("Ontario", "Ontario", "Canada"),
    }


def test_country_in_text_against_brute_force(spark, gazetteer):
    nations = [(i, f"NATION_{i}", f"N{i}") for i in range(25)]
    small = g.Gazetteer(
        spark.createDataFrame(nations, "ord int, name string, alpha_2 string"), gazetteer.subdivisions
    )
    texts = ["c NATION_10", "NATION_1", "x N2 NATION_3 y", "nothing", "", "NATION_24NATION_2", None]

    def brute(text, entries):
        country = None
        for _, name, *codes in entries:
            if any(t and t in text for t in [name, *codes]):
                country = name
        return (text.split(country)[0] if country else text, country)

    df = spark.createDataFrame([(t,) for t in texts], "loc string")
    expected = {t: None if t is None else brute(t, nations) for t in texts}
    got = g.country_in_text(df, "loc", small).collect()
    assert {r.loc: r.place and tuple(r.place) for r in got} == expected
    real = sorted(gazetteer.countries.collect(), key=lambda r: r.ord)
    real = [(r.ord, r.name, r.alpha_2, r.alpha_3, r.common_name, r.numeric) for r in real]
    texts = ["Lyon France", "London United Kingdom", "Seoul South Korea", "USA IN"]
    df = spark.createDataFrame([(t,) for t in texts], "loc string")
    got = {r.loc: tuple(r.place) for r in g.country_in_text(df, "loc", gazetteer).collect()}
    assert got == {t: brute(t, real) for t in texts}


def test_country_in_text_of_many_forms(spark, gazetteer):
    """50,000 forms of one to seven characters, some of them inside others; the plan holds none of them."""
    forms = [(i, f"L{i}", f"{i:x}", "é" if i == 7 else None) for i in range(25_000)]
    many = g.Gazetteer(
        spark.createDataFrame(forms, "ord int, name string, alpha_2 string, sign string"), gazetteer.subdivisions
    )
    texts = ["Hall, L24999", "L2", "x 61a7 L3", "only é", "none", "", None, "None?", "L1 L2 L3", "ffff" * 500, "L1 L2 L3"]

    def brute(text):
        hits = [(i, name) for i, *names in forms for name in names[:1] if any(t and t in text for t in names)]
        country = max(hits)[1] if hits else None
        return (text.split(country)[0] if country else text, country)

    got = g.country_in_text(spark.createDataFrame([(t, "y") for t in texts], "loc string, name string"), "loc", many)
    assert "L24998" not in got._jdf.queryExecution().toString()
    rows = got.collect()
    assert len(rows) == len(texts) and {r.name for r in rows} == {"y"}
    assert {r.loc: r.place and tuple(r.place) for r in rows} == {t: None if t is None else brute(t) for t in texts}


def test_numeric_codes_and_further_subdivisions(spark, gazetteer):
    rows = [("250", None), ("036", "nsw"), ("IT", "25"), ("FR", "FR-IDF"), ("NL", "nh"), ("US", "NH"), ("ES", "MD"), ("999", "x")]
    df = spark.createDataFrame(rows, "country string, state string")
    got = [(r.country, r.state) for r in g.normalize_place(df, gazetteer).collect()]
    assert got[:3] == [("France", None), ("Australia", "nsw"), ("Italy", "Lombardia")]
    assert got[3:] == [("France", "FR-IDF"), ("Netherlands", "Noord-Holland"), ("United States", "New Hampshire"), ("Spain", "Madrid, Comunidad de"), ("999", "x")]
    places = spark.createDataFrame([("Atlanta, GA",), ("Milano, Lombardia",), ("Linz, Oberösterreich",)], "loc string")
    found = [tuple(r.place) for r in g.city_state_or_country(places, "loc", gazetteer).collect()]
    assert found == [("Atlanta", "Georgia", "United States"), ("Milano", "Lombardia", "Italy"), ("Linz", "Oberösterreich", "Austria")]


def test_gazetteer_of_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text('ord,code,name,alpha_2\n1,JP-13,"Tokyo, To",JP\n2,IN-KA,Karnataka,IN\n')
    read = g.Gazetteer.read(spark, str(tmp_path / "s.csv"))
    df = spark.createDataFrame([("JPN", "13"), ("IN", "ka")], "country string, state string")
    assert [tuple(r) for r in g.normalize_place(df, read).collect()] == [("Japan", "Tokyo, To"), ("India", "Karnataka")]


def test_event_type(spark):
    rows = [("Expo", "Any", None), (None, "Forum and Conference", None), ("", "Day", "A Workshop"),
            (None, "Day", "of course"), (None, "SUMMIT", None)]
    df = spark.createDataFrame(rows, "t string, n string, d string")
    got = [r.o for r in df.select(stages.event_type_of(F.col("t"), F.col("n"), F.col("d")).alias("o")).collect()]
    assert got == ["expo", "conference", "", "course", "summit"]


def test_chain(spark, gazetteer):
    rows = [
        event(name=" BIO: Expo, 2019", city="San José\n", country="us", state="ca", start=date(2019, 6, 3),
              event_url="http://x.org/a?utm_source=f&page=2", description="a\r\nb  c "),
        event(name="no start", city=""), event(name="no city", start=date(2019, 6, 3)),
        event(city="no name", start=date(2019, 6, 3)),
    ]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    out = stages.standard_stages("Here", gazetteer)(df)
    good = stages.accepted(out).collect()
    assert [c for c in out.columns if c != REJECT] == EVENT_COLUMNS
    assert len(good) == 1
    e = good[0].asDict()
    assert {k: v for k, v in e.items() if v is not None} == dict(
        name="BIO: Expo, 2019", id="bioexpo2019__sanjosé__2019-06-03", event_url="http://x.org/a?page=2",
        description="a  b  c", event_type="expo", start="2019-06-03", end="2019-06-03", length_in_days=1.0,
        country="United States", state="California", city="San José", source="Here",
    )
    assert {(r.name, r[REJECT]) for r in stages.rejected(out).collect()} == {
        ("no start", "no_start"), ("no city", "no_city"), (None, "no_name")
    }
    kept = stages.accepted(stages.standard_stages("Here", gazetteer, newlines=False)(df)).first()
    assert kept.description == "a\r\nb  c"


def test_text_dates_are_left_alone(spark):
    df = spark.sql("select 'n' name, '2019' start, cast(null as string) end")
    assert stages.normalize_dates(df).first().start == "2019"


def test_compose(spark):
    step = lambda tag: lambda df: df.withColumn("s", F.concat("s", F.lit(tag)))
    df = spark.sql("select '' s")
    a, b, c = step("a"), step("b"), step("c")
    assert stages.compose({b: [2, 0.5], a: 1, c: None})(df).first().s == "bab"
    with pytest.raises(TypeError):
        stages.compose({a: "1"})


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_side_not_proven_small_is_not_broadcast(spark):
    side = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastExchange" not in _joins(spark.range(1000).join(small_side(side, max_rows=10), F.col("id") == F.col("k")))
    assert "BroadcastExchange" in _joins(spark.range(1000).join(small_side(side), F.col("id") == F.col("k")))


def test_texts_looked_through_for_countries_are_not_broadcast(spark):
    forms = spark.range(200_001).selectExpr("cast(id as int) ord", "'Port ' || id || 'X' name", "'P' || id || '.' alpha_2")
    texts = spark.range(5).selectExpr("element_at(array('a Port 7X b', 'Port 17X or P9.', 'P9', '', null), cast(id + 1 as int)) loc")
    found = g.country_in_text(texts, "loc", g.Gazetteer(forms, forms.limit(0)))
    small = _joins(found).split("BroadcastExchange")[1:]
    assert len(small) <= 1 and all("_lengths" in plan for plan in small)
    places = {r.loc: r.place and tuple(r.place) for r in found.collect()}
    assert places == {
        "a Port 7X b": ("a ", "Port 7X"), "Port 17X or P9.": ("", "Port 17X"), "P9": ("P9", None), "": ("", None), None: None,
    }
