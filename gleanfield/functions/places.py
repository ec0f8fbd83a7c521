"""Place strings that need no gazetteer."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanfield.functions.binding import let
from gleanfield.functions.text import strip


def address_tail(text: Column) -> Column:
    """Last comma part is the country, the one before it the city."""
    return let(
        F.split(text, ","),
        lambda parts: F.when(
            parts.isNotNull(),
            F.struct(
                F.coalesce(F.get(parts, F.size(parts) - 2), F.lit("")).alias("city"),
                F.element_at(parts, -1).alias("country"),
            ),
        ),
    )


def city_state_country(text: Column) -> Column:
    """P5: `City, State, Country` or `City, Country`."""
    return let(
        F.split(text, ", "),
        lambda parts: F.when(
            parts.isNotNull(),
            F.struct(
                F.get(parts, F.lit(0)).alias("city"),
                F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).alias("state"),
                F.element_at(parts, -1).alias("country"),
            ),
        ),
    )


def city_paren_country(text: Column) -> Column:
    """`Basel (CH)` gives city and country code, `Basel` the city only."""
    pattern = r"(?s)^([^(]*)\(([^)]*)\)"
    paren = text.rlike(pattern)
    return F.when(
        text.isNotNull(),
        F.struct(
            F.when(paren, strip(F.regexp_extract(text, pattern, 1))).otherwise(text).alias("city"),
            F.when(paren, strip(F.regexp_extract(text, pattern, 2))).alias("country"),
        ),
    )


def venue_city(text: Column) -> Column:
    """`Venue, City` or `Venue`; NULL with more than one comma."""
    one = lambda parts: F.struct(
        F.get(parts, F.lit(0)).alias("venue"), F.lit("").alias("city")
    )
    two = lambda parts: F.struct(
        strip(F.get(parts, F.lit(0))).alias("venue"), strip(F.get(parts, F.lit(1))).alias("city")
    )
    return let(
        F.split(text, ","),
        lambda parts: F.when(F.size(parts) == 1, one(parts)).when(F.size(parts) == 2, two(parts)),
    )
