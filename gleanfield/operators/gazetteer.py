"""Lookups of countries and subdivisions.

A gazetteer is a pair of tables the caller may bring along. Their `ord` column decides
which entry wins where several match. Lookup sides are reduced to one row per code before
the join and broadcast only when small.
"""

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanfield.functions.text import capitalize, strip
from gleanfield.session import cut_lineage, small_side

GRAM = 3  # characters at the beginning of written forms by which they are looked up in texts

# ISO short names that differ from the English display names of the JVM.
ISO_NAMES = """
AG Antigua and Barbuda|BA Bosnia and Herzegovina|BL Saint Barthélemy|BN Brunei Darussalam
BO Bolivia, Plurinational State of|BQ Bonaire, Sint Eustatius and Saba|CD Congo, The Democratic Republic of the
CG Congo|CI Côte d'Ivoire|CV Cabo Verde|FK Falkland Islands (Malvinas)|FM Micronesia, Federated States of
GS South Georgia and the South Sandwich Islands|HK Hong Kong|HM Heard Island and McDonald Islands
IR Iran, Islamic Republic of|KN Saint Kitts and Nevis|KP Korea, Democratic People's Republic of
KR Korea, Republic of|LA Lao People's Democratic Republic|LC Saint Lucia|MD Moldova, Republic of
MF Saint Martin (French part)|MM Myanmar|MO Macao|PM Saint Pierre and Miquelon|PN Pitcairn
PS Palestine, State of|RU Russian Federation|SH Saint Helena, Ascension and Tristan da Cunha
SJ Svalbard and Jan Mayen|ST Sao Tome and Principe|SX Sint Maarten (Dutch part)|SY Syrian Arab Republic
TC Turks and Caicos Islands|TT Trinidad and Tobago|TW Taiwan, Province of China
TZ Tanzania, United Republic of|UM United States Minor Outlying Islands
VA Holy See (Vatican City State)|VC Saint Vincent and the Grenadines
VE Venezuela, Bolivarian Republic of|VG Virgin Islands, British|VI Virgin Islands, U.S.|VN Viet Nam
"""

# ISO subdivision codes and names of the countries most listings name.
ISO_SUBDIVISIONS = """
AU: ACT Australian Capital Territory|NSW New South Wales|NT Northern Territory|QLD Queensland
AU: SA South Australia|TAS Tasmania|VIC Victoria|WA Western Australia
CA: AB Alberta|BC British Columbia|MB Manitoba|NB New Brunswick|NL Newfoundland and Labrador|NS Nova Scotia
CA: NT Northwest Territories|NU Nunavut|ON Ontario|PE Prince Edward Island|QC Quebec|SK Saskatchewan|YT Yukon
CH: AG Aargau|AI Appenzell Innerrhoden|AR Appenzell Ausserrhoden|BE Bern|BL Basel-Landschaft
CH: BS Basel-Stadt|FR Fribourg|GE Genève|GL Glarus|GR Graubünden|JU Jura|LU Luzern|NE Neuchâtel
CH: NW Nidwalden|OW Obwalden|SG Sankt Gallen|SH Schaffhausen|SO Solothurn|SZ Schwyz|TG Thurgau
CH: TI Ticino|UR Uri|VD Vaud|VS Valais|ZG Zug|ZH Zürich
DE: BB Brandenburg|BE Berlin|BW Baden-Württemberg|BY Bayern|HB Bremen|HE Hessen|HH Hamburg
DE: MV Mecklenburg-Vorpommern|NI Niedersachsen|NW Nordrhein-Westfalen|RP Rheinland-Pfalz
DE: SH Schleswig-Holstein|SL Saarland|SN Sachsen|ST Sachsen-Anhalt|TH Thüringen
GB: ENG England|NIR Northern Ireland|SCT Scotland|WLS Wales
US: AK Alaska|AL Alabama|AR Arkansas|AZ Arizona|CA California|CO Colorado|CT Connecticut
US: DC District of Columbia|DE Delaware|FL Florida|GA Georgia|HI Hawaii|IA Iowa|ID Idaho|IL Illinois
US: IN Indiana|KS Kansas|KY Kentucky|LA Louisiana|MA Massachusetts|MD Maryland|ME Maine|MI Michigan
US: MN Minnesota|MO Missouri|MS Mississippi|MT Montana|NC North Carolina|ND North Dakota|NE Nebraska
US: NH New Hampshire|NJ New Jersey|NM New Mexico|NV Nevada|NY New York|OH Ohio|OK Oklahoma|OR Oregon
US: PA Pennsylvania|RI Rhode Island|SC South Carolina|SD South Dakota|TN Tennessee|TX Texas|UT Utah
US: VA Virginia|VT Vermont|WA Washington|WI Wisconsin|WV West Virginia|WY Wyoming
"""


# The same of further European countries. They come after the others, so that a code that
# several countries have (`GA`, `MD`) stands for what most listings mean by it.
MORE_SUBDIVISIONS = """
AT: 1 Burgenland|2 Kärnten|3 Niederösterreich|4 Oberösterreich|5 Salzburg|6 Steiermark|7 Tirol|8 Vorarlberg|9 Wien
BE: BRU Brussels Hoofdstedelijk Gewest|VLG Vlaams Gewest|WAL Wallonne, Région
ES: AN Andalucía|AR Aragón|AS Asturias, Principado de|CB Cantabria|CL Castilla y León|CM Castilla-La Mancha
ES: CN Canarias|CT Catalunya|EX Extremadura|GA Galicia|IB Illes Balears|MC Murcia, Región de|MD Madrid, Comunidad de
ES: NC Navarra, Comunidad Foral de|PV País Vasco|RI La Rioja|VC Valenciana, Comunidad
FR: ARA Auvergne-Rhône-Alpes|BFC Bourgogne-Franche-Comté|BRE Bretagne|CVL Centre-Val de Loire|GES Grand-Est
FR: HDF Hauts-de-France|IDF Île-de-France|NAQ Nouvelle-Aquitaine|NOR Normandie|OCC Occitanie
FR: PAC Provence-Alpes-Côte-d'Azur|PDL Pays-de-la-Loire
IE: C Connaught|L Leinster|M Munster|U Ulster
IT: 21 Piemonte|23 Valle d'Aosta|25 Lombardia|32 Trentino-Alto Adige|34 Veneto|36 Friuli Venezia Giulia
IT: 42 Liguria|45 Emilia-Romagna|52 Toscana|55 Umbria|57 Marche|62 Lazio|65 Abruzzo|67 Molise|72 Campania
IT: 75 Puglia|77 Basilicata|78 Calabria|82 Sicilia|88 Sardegna
NL: DR Drenthe|FL Flevoland|FR Fryslân|GE Gelderland|GR Groningen|LI Limburg|NB Noord-Brabant|NH Noord-Holland
NL: OV Overijssel|UT Utrecht|ZE Zeeland|ZH Zuid-Holland
"""


def default_countries(spark: SparkSession) -> DataFrame:
    """ISO countries as the JVM knows them, in the order of their three-letter codes, with their numeric codes."""
    locale, region = spark._jvm.java.util.Locale, spark._jvm.com.ibm.icu.util.Region
    names = dict(
        entry.split(" ", 1) for line in ISO_NAMES.strip().splitlines() for entry in line.split("|")
    )
    rows = []
    for alpha_2 in locale.getISOCountries():
        place = locale("", alpha_2)
        display = place.getDisplayCountry(locale.ENGLISH)
        name = names.get(alpha_2, display)
        numeric = region.getInstance(alpha_2).getNumericCode()
        rows.append(
            (place.getISO3Country(), alpha_2, f"{numeric:03}" if numeric > 0 else None, name, display if display != name else None)
        )
    rows = [(i, *row) for i, row in enumerate(sorted(rows))]
    return spark.createDataFrame(
        rows, "ord int, alpha_3 string, alpha_2 string, numeric string, name string, common_name string"
    )


def default_subdivisions(spark: SparkSession) -> DataFrame:
    rows = []
    for table in (ISO_SUBDIVISIONS, MORE_SUBDIVISIONS):
        listed = []
        for line in table.strip().splitlines():
            country, entries = line.split(": ", 1)
            for entry in entries.split("|"):
                suffix, name = entry.split(" ", 1)
                listed.append((f"{country}-{suffix}", name, country))
        rows += sorted(listed)
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "ord int, code string, name string, alpha_2 string",
    )


@dataclass
class Gazetteer:
    """`countries(ord, name, alpha_2, ...)` and `subdivisions(ord, code, name, alpha_2)`.

    Every further string column of `countries` is one more way to write the country.
    """

    countries: DataFrame
    subdivisions: DataFrame

    @classmethod
    def default(cls, spark: SparkSession) -> "Gazetteer":
        return cls(default_countries(spark), default_subdivisions(spark))

    @classmethod
    def read(cls, spark: SparkSession, subdivisions: str, countries: str | None = None) -> "Gazetteer":
        """Tables of one's own from CSV files with a header, whole lists of ISO 3166 say.

        `subdivisions` has ord, code, name and alpha_2, `countries` (by default the JVM's) has ord, name, alpha_2 and
        whatever else a country is written as.
        """

        def table(path: str) -> DataFrame:
            found = spark.read.csv(path, header=True, quote='"', escape='"')
            return found.withColumn("ord", F.col("ord").cast("int"))

        return cls(table(countries) if countries else default_countries(spark), table(subdivisions))

    def country_tokens(self) -> DataFrame:
        """Every written form: `token`, `name`, `alpha_2`, `ord`."""
        forms = [c for c, t in self.countries.dtypes if t == "string"]
        return self.countries.select(
            F.explode(F.array(*forms)).alias("token"), "name", "alpha_2", "ord"
        ).where(F.col("token") != "")

    @cached_property
    def _country_codes(self) -> DataFrame:
        tokens = self.country_tokens().where(F.length("token") <= 3)
        return small_side(_first(tokens, F.lower("token"), "name", "alpha_2"))

    @cached_property
    def _state_codes(self) -> DataFrame:
        codes = self.subdivisions.groupBy(F.lower("code").alias("_code"))
        return small_side(codes.agg(F.min_by("name", "ord").alias("_state")))

    @cached_property
    def _state_tokens(self) -> DataFrame:
        """Name and code suffix of each subdivision with its country."""
        country = self.countries.select("alpha_2", F.col("name").alias("country"))
        tokens = self.subdivisions.join(small_side(country), "alpha_2").select(
            F.explode(F.array("name", F.element_at(F.split("code", "-"), -1))).alias("token"),
            F.col("name").alias("state"), "country", "ord",
        )
        return small_side(
            _first(tokens.where(F.col("token") != ""), F.col("token"), "state", "country")
        )

    @cached_property
    def _last_forms(self) -> DataFrame:
        """Each written form with the last country it stands for."""
        last = self.country_tokens().groupBy(F.col("token").alias("_token")).agg(
            F.max(F.struct(F.col("ord").alias("_ord"), F.col("name").alias("_name"))).alias("_last")
        )
        return small_side(cut_lineage(last.select("_token", "_last.*")))

    @cached_property
    def _form_lengths(self) -> DataFrame:
        """The lengths of the written forms that begin with the same `GRAM` characters; shorter forms begin with themselves."""
        lengths = self._last_forms.groupBy(F.left("_token", F.lit(GRAM)).alias("_gram")).agg(
            F.collect_set(F.length("_token")).alias("_lengths")
        )
        return small_side(cut_lineage(lengths))

    @cached_property
    def _gram_lengths(self) -> list[int]:
        """The lengths of beginnings in use, `GRAM` of them at most."""
        found = self._form_lengths.select(F.length("_gram").alias("n")).distinct().collect()
        return sorted(r["n"] for r in found)


def _first(tokens: DataFrame, key: Column, *values: str) -> DataFrame:
    """One row per key: the entry that comes first in the gazetteer."""
    return tokens.groupBy(key.alias("_token")).agg(
        F.min_by(F.struct(*values), "ord").alias("_hit")
    )


def normalize_place(df: DataFrame, gazetteer: Gazetteer) -> DataFrame:
    """Country and state codes to names.

    Countries of up to three characters are looked up in any written form, states of two
    characters (within the country found) or `CC-SS` by code; what is not found is
    capitalised. Longer values stay.
    """
    country = F.col("country")
    short = F.length(country).between(1, 3)
    found = df.join(
        gazetteer._country_codes, F.when(short, F.lower(country)) == F.col("_token"), "left"
    )
    named = F.when(short, F.coalesce("_hit.name", capitalize(country))).otherwise(country)
    if "state" not in df.columns:
        return found.withColumn("country", named).select(*df.columns)
    state = F.lower("state")
    query = F.when(
        (F.length(state) == 2) & F.col("_hit").isNotNull() & ~state.contains("-"),
        F.concat(F.lower("_hit.alpha_2"), F.lit("-"), state),
    ).when((F.length(state) == 2) | ((F.length(state) == 5) & state.contains("-")), state)
    found = found.withColumn("_query", query)
    found = found.join(gazetteer._state_codes, F.col("_query") == F.col("_code"), "left")
    stated = F.when(
        F.col("_query").isNotNull(), F.coalesce("_state", capitalize(F.col("state")))
    ).otherwise(F.col("state"))
    return found.withColumns({"country": named, "state": stated}).select(*df.columns)


def city_state_or_country(df: DataFrame, column: str, gazetteer: Gazetteer) -> DataFrame:
    """`City, X` or `X`; X is a state when it is the name or code suffix of one.

    Adds `place STRUCT<city, state, country>`, NULL for text with more than one comma.
    """
    parts = F.split(column, ",")
    one = F.size(parts) == 1
    where = F.when(one, F.col(column)).when(F.size(parts) == 2, strip(F.get(parts, F.lit(1))))
    city = F.when(one, F.col(column)).otherwise(strip(F.get(parts, F.lit(0))))
    found = df.withColumn("_where", where).join(
        gazetteer._state_tokens, F.col("_where") == F.col("_token"), "left"
    )
    place = F.struct(
        city.alias("city"), F.col("_hit.state").alias("state"),
        F.coalesce("_hit.country", "_where").alias("country"),
    )
    return found.select(*df.columns, F.when(F.col("_where").isNotNull(), place).alias("place"))


def country_in_text(df: DataFrame, column: str, gazetteer: Gazetteer) -> DataFrame:
    """The last country of which any written form occurs in the text (case-sensitive).

    Adds `place STRUCT<city, country>`; the city is the text before the country's name. Each
    distinct text is looked through place by place: the three characters there (or the fewer of a
    shorter form) say how long the forms are that begin so, and the runs of those lengths are
    joined to the forms. So a text asks for few runs, however many forms there are, and each meets
    one form at most. The result is joined back to the rows. The grouping per text needs a whole
    table: a stream takes it batch by batch (see `streaming.pages`).
    """
    text = df.select(F.col(column).alias("_text")).where(F.col(column) != "").distinct()
    grams = reduce(
        F.concat, [_grams(F.col("_text"), n) for n in gazetteer._gram_lengths], F.array().cast(_GRAMS)
    )
    begun = text.select("_text", F.explode(grams).alias("_g")).select("_text", "_g.*")
    asked = begun.join(gazetteer._form_lengths, "_gram").select("_text", "_at", F.explode("_lengths").alias("_n"))
    runs = asked.select("_text", F.expr("substring(_text, _at, _n)").alias("_token"))
    hits = runs.join(gazetteer._last_forms, "_token")
    last = hits.groupBy("_text").agg(F.max(F.struct("_ord", "_name"))["_name"].alias("_country"))
    # as many rows as there are texts: the driver does not broadcast them
    found = df.join(last.hint("merge"), F.col(column) == F.col("_text"), "left")
    named = F.split_part(F.col(column), F.col("_country"), F.lit(1))
    place = F.struct(
        F.coalesce(named, F.col(column)).alias("city"), F.col("_country").alias("country")
    )
    return found.select(*df.columns, F.when(F.col(column).isNotNull(), place).alias("place"))


_GRAMS = "array<struct<_at:int,_gram:string>>"


def _grams(text: Column, n: int) -> Column:
    """All runs of `n` characters with their places, from 1."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1))
    found = F.transform(starts, lambda i: F.struct(i.alias("_at"), F.substring(text, i, F.lit(n)).alias("_gram")))
    return F.coalesce(found, F.array()).cast(_GRAMS)
