"""The normalising stages every source ends with, and their composition.

A stage is a function from DataFrame to DataFrame. A record that cannot be normalised is
kept with a `reject_reason`; `accepted` and `rejected` split the two.
"""

from collections.abc import Callable
from functools import reduce
from numbers import Number

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanfield.functions import text
from gleanfield.functions.dates import duration_days, format_date
from gleanfield.functions.urls import clean_url
from gleanfield.operators.gazetteer import Gazetteer, normalize_place
from gleanfield.schema import DATE_COLUMNS, REJECT, field_or_null

Stage = Callable[[DataFrame], DataFrame]

# Kinds of event, in the order they are looked for.
EVENT_TYPES = "conference summit forum symposium expo congress seminar workshop course".split()


def reject(df: DataFrame, reason: str, when: Column) -> DataFrame:
    """Mark rows, keeping the first reason given."""
    before = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast("string")
    return df.withColumn(REJECT, F.coalesce(before, F.when(when, F.lit(reason))))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REJECT).isNull()).drop(REJECT)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REJECT).isNotNull())


def event_type_of(
    event_type: Column, name: Column, description: Column, types: list[str] = EVENT_TYPES
) -> Column:
    """Own type lower-cased, else the first kind in the lower-cased name, else the first
    in the description as written, else unchanged."""
    kinds = lambda where: F.coalesce(*[F.when(where.contains(t), F.lit(t)) for t in types])
    own = F.lower(F.nullif(event_type, F.lit("")))
    return F.coalesce(own, kinds(F.lower(name)), kinds(description), event_type)


def guess_event_type(df: DataFrame, types: list[str] = EVENT_TYPES) -> DataFrame:
    """N1. A record without a name is rejected."""
    kind = event_type_of(
        field_or_null(df, "event_type"), F.col("name"), field_or_null(df, "description"), types
    )
    return reject(df.withColumn("event_type", kind), "no_name", F.col("name").isNull())


def normalize_location(gazetteer: Gazetteer) -> Stage:
    """N2."""
    return lambda df: normalize_place(df, gazetteer)


def normalize_dates(df: DataFrame) -> DataFrame:
    """End defaults to start, dates become ISO text, the inclusive length is added.

    Dates that already are text are left alone; a record without start is rejected.
    """
    kinds = dict(df.dtypes)
    dated = [c for c in DATE_COLUMNS if kinds.get(c) in ("date", "timestamp")]
    out = reject(df, "no_start", F.col("start").isNull())
    if "start" in dated and kinds.get("end") != "string":
        end = F.coalesce(field_or_null(df, "end"), F.col("start"))
        out = out.withColumn("end", end).withColumn(
            "length_in_days", duration_days(F.col("start"), F.col("end"))
        )
        dated = list(dict.fromkeys([*dated, "end"]))
    return out.withColumns({c: format_date(F.col(c)) for c in dated})


def add_metadata(source: str) -> Stage:
    """`source` and `id` where absent; a record without city has no id and is rejected."""

    def stage(df: DataFrame) -> DataFrame:
        made = text.event_id(F.col("name"), F.col("city"), F.col("start"))
        out = df.withColumns(
            {
                "source": F.coalesce(field_or_null(df, "source"), F.lit(source)),
                "id": F.coalesce(field_or_null(df, "id"), made),
            }
        )
        return reject(out, "no_city", F.col("id").isNull())

    return stage


def _texts(df: DataFrame, columns: list[str] | None) -> list[str]:
    return columns or [c for c, t in df.dtypes if t == "string" and c != REJECT]


def clean_urls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """N6 on all text columns."""
    return df.withColumns({c: clean_url(c) for c in _texts(df, columns)})


def strip_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """N7 on all text columns."""
    return df.withColumns({c: text.strip(F.col(c)) for c in _texts(df, columns)})


def blank_newlines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """N8 on all text columns."""
    return df.withColumns({c: text.blank_newlines(F.col(c)) for c in _texts(df, columns)})


def compose(stages: dict[Stage, Number | list[Number] | None]) -> Stage:
    """Run stages by ascending priority; several priorities run a stage several times,
    None switches it off."""
    placed = []
    for stage, priorities in stages.items():
        for priority in priorities if isinstance(priorities, list) else [priorities]:
            if priority is None:
                continue
            if isinstance(priority, bool) or not isinstance(priority, Number):
                raise TypeError(f"priority of {stage} is not a number: {priority!r}")
            placed.append((priority, stage))
    ordered = [stage for _, stage in sorted(placed, key=lambda p: p[0])]
    return lambda df: reduce(DataFrame.transform, ordered, df)


def standard_stages(source: str, gazetteer: Gazetteer, newlines: bool = True) -> Stage:
    """The chain in its usual order; `newlines` is off for sources that keep line breaks."""
    return compose(
        {
            guess_event_type: 401,
            normalize_location(gazetteer): 402,
            normalize_dates: 403,
            clean_urls: 404,
            add_metadata(source): 405,
            strip_strings: 406,
            blank_newlines: 407 if newlines else None,
        }
    )
