"""Readers for the written forms of dates. Unreadable text gives NULL.

Each form is one pattern whose groups are filled in from each other and handed to
`try_to_date`; ranges give `STRUCT<start DATE, end DATE>`.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanfield.functions.binding import let
from gleanfield.functions.text import strip

_SEP = "\x01"


def _tidy(text: Column) -> Column:
    return F.regexp_replace(strip(text), r"(?U)\s+", " ")


def _groups(text: Column, pattern: str, count: int, body) -> Column:
    """`body` of the groups of a whole-text match, each NULL when absent.

    One regex pass per value: the groups are written side by side and split again.
    """
    marks = _SEP.join(f"${i}" for i in range(1, count + 1))
    found = let(
        F.split(F.regexp_replace(text, f"^{pattern}$", marks), _SEP),
        lambda parts: F.when(F.size(parts) == count, parts),
    )
    return let(
        F.transform(found, lambda g: F.nullif(g, F.lit(""))),
        lambda groups: F.when(
            groups.isNotNull(), body(*[F.get(groups, F.lit(i)) for i in range(count)])
        ),
    )


def _date(fmt: str, *parts: Column) -> Column:
    return F.try_to_date(F.concat_ws(" ", *parts), fmt)


def _pivot(date: Column) -> Column:
    """Two-digit years 69-99 belong to the last century."""
    return let(
        date,
        lambda d: F.when(F.year(d) >= 2069, F.add_months(d, -1200).cast("date")).otherwise(d),
    )


def _range(start: Column, end: Column) -> Column:
    return let(
        F.struct(start.alias("start"), end.alias("end")),
        lambda r: F.when(r["start"].isNotNull() & r["end"].isNotNull(), r),
    )


def iso_date(text: Column) -> Column:
    """`2019-06-25`."""
    return F.try_to_date(strip(text), "yyyy-M-d")


def us_range(text: Column) -> Column:
    """`June 3, 2019`, `June 3 - 5, 2019`, `June 30 - July 2, 2019`, both full."""
    return _month_first(text, r"([A-Za-z]+)", "MMMM d yyyy")


def us_abbrev_range(text: Column) -> Column:
    """T4: the forms of T2 with dotted short months, `Sep. 5 - 7, 2019`."""
    return _month_first(text, r"([A-Za-z]+\.)", "MMM. d yyyy")


def _month_first(text, month, fmt):
    def span(m1, d1, y1, m2, d2, y2):
        start = _date(fmt, m1, d1, F.coalesce(y1, y2, F.lit("")))
        end = _date(fmt, F.coalesce(m2, m1), F.coalesce(d2, d1), F.coalesce(y2, y1, F.lit("")))
        return _range(start, end)

    return _groups(
        _tidy(text),
        rf"{month} (\d{{1,2}})(?:, (\d{{4}}))?(?: ?- ?(?:{month} )?(\d{{1,2}}), (\d{{4}}))?",
        6, span,
    )


def two_digit_year(text: Column) -> Column:
    """`25 Jun 19`."""
    return _pivot(F.try_to_date(_tidy(text), "d MMM yy"))


def two_digit_year_pair(text: Column) -> Column:
    """T3 for `25 Jun 19-27 Jun 19`: exactly one dash."""
    return _sides(text, lambda n: n == 2)


def _sides(text: Column, count_ok) -> Column:
    return let(
        F.split(text, "-"),
        lambda sides: F.when(
            count_ok(F.size(sides)),
            _range(two_digit_year(F.get(sides, F.lit(0))), two_digit_year(F.element_at(sides, -1))),
        ),
    )


def day_month_range(text: Column) -> Column:
    """T5: `25 Jun 2019 1: 00 PM`, `Wednesday 26 June 2019`, `25 - 28 February 2020`.

    A weekday in front and everything from the hour on are cut off first. The
    first day of a shortened range takes month and year from its end.
    """
    cut = F.regexp_replace(
        F.regexp_replace(_tidy(text), r"^\p{L}\S* ", ""), r"(?s) [^ :]*:.*$", ""
    )
    full = lambda day: F.try_to_date(day, "d MMMM yyyy")
    short = lambda day: F.try_to_date(day, "d MMM yyyy")

    # A failed attempt costs more than all else, and of three letters no full name but May is read.
    def read(day, month, year):
        return let(
            F.concat_ws(" ", day, month, year),
            lambda text: F.when(F.length(month) == 3, short(text)).otherwise(F.coalesce(full(text), short(text))),
        )

    def span(d1, m1, y1, d2, m2, y2):
        start = read(d1, F.coalesce(m1, m2), F.coalesce(y1, y2))
        end = read(F.coalesce(d2, d1), F.coalesce(m2, m1), F.coalesce(y2, y1))
        return _range(start, end)

    return _groups(
        cut,
        r"(\d{1,2})(?: (\p{L}+) (\d{4}))?(?: ?- ?(\d{1,2}) (\p{L}+) (\d{4}))?",
        6, span,
    )


def long_us_date(text: Column) -> Column:
    """`June 25, 2019`."""
    return F.try_to_date(_tidy(text), "MMMM d, yyyy")


def before_hour(text: Column) -> Column:
    """Text in front of the first `@`."""
    return F.split_part(text, F.lit("@"), F.lit(1))


def month_d_y_tokens(text: Column) -> Column:
    """`June 25, 2019`, commas anywhere."""
    return F.try_to_date(_tidy(F.replace(text, F.lit(","), F.lit(""))), "MMMM d yyyy")


def dotted_date(text: Column) -> Column:
    """`25.06.2019`, stray dashes ignored."""
    return F.try_to_date(strip(F.replace(text, F.lit("-"), F.lit(""))), "d.M.yyyy")


def uk_meeting_date(text: Column) -> Column:
    """`09:00-17:00, 25 Jun 19`, `25 Jun 19`, `25 Jun 19 - 27 Jun 19`."""
    return _sides(F.substring_index(text, ",", -1), lambda n: n <= 2)


def deadline(text: Column) -> Column:
    """`25 Jun 2019`, empty is NULL."""
    return F.try_to_date(_tidy(F.nullif(text, F.lit(""))), "d MMM yyyy")


def format_date(date: Column) -> Column:
    """T11."""
    return F.date_format(date, "yyyy-MM-dd")


def duration_days(start: Column, end: Column) -> Column:
    """Inclusive number of days."""
    return (F.datediff(end, start) + 1).cast("double")
