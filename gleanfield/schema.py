"""The event record every source is mapped to.

A source sets some of the fields; stages work on those, and `conform` adds the others as
NULL. Dates are DATE until the date stage
(`operators.stages.normalize_dates`) writes them as ISO text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

# Names and order of the record's fields.
EVENT_COLUMNS = """
name id event_url description focus event_type
start end length_in_days
country state city venue
price currency
stand abstract talk
ticket_deadline stand_deadline talk_deadline
contact_name contact_email contact_phone
organizer organizer_url
newsletter twitter facebook linkedin instagram
hashtags relevant_to_bio relevant_to_ind_bio
ignore source notes
""".split()

DATE_COLUMNS = ["start", "end", "ticket_deadline", "stand_deadline", "talk_deadline"]

REJECT = "reject_reason"


def _type(name):
    if name in DATE_COLUMNS:
        return DateType()
    return DoubleType() if name == "length_in_days" else StringType()


EVENT_SCHEMA = StructType([StructField(c, _type(c)) for c in EVENT_COLUMNS])


def event_columns(**values: Column) -> list[Column]:
    """The given fields, typed and in record order."""
    unknown = set(values) - set(EVENT_COLUMNS)
    if unknown:
        raise ValueError(f"not event fields: {sorted(unknown)}")
    return [
        values[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA if f.name in values
    ]


def field_or_null(df: DataFrame, name: str) -> Column:
    """A field a source may not set."""
    return F.col(name) if name in df.columns else F.lit(None).cast(_type(name))


def conform(df: DataFrame) -> DataFrame:
    """All 37 fields in record order, those not set as NULL; other columns follow."""
    rest = [F.col(c) for c in df.columns if c not in EVENT_COLUMNS]
    kinds = dict(df.dtypes)
    text_dates = kinds.get("start") == "string"
    fields = [
        field_or_null(df, c).cast("string" if c in DATE_COLUMNS and text_dates else _type(c)).alias(c)
        for c in EVENT_COLUMNS
    ]
    return df.select(*fields, *rest)
