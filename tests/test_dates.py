from datetime import date

import pytest

from gleanfield.functions import dates


def iso(value):
    if value is None:
        return None
    if isinstance(value, date):
        return value.isoformat()
    return tuple(v.isoformat() for v in value)


SINGLE = [
    (dates.iso_date, "2019-06-25", "2019-06-25"),
    (dates.iso_date, " 2019-6-5 ", "2019-06-05"),
    (dates.two_digit_year, "25 Jun 19", "2019-06-25"),
    (dates.two_digit_year, " 25  Jun 75", "1975-06-25"),
    (dates.two_digit_year, "1 Jan 68", "2068-01-01"),
    (dates.two_digit_year, "1 Jan 69", "1969-01-01"),
    (dates.long_us_date, "June 25, 2019", "2019-06-25"),
    (lambda c: dates.long_us_date(dates.before_hour(c)), "June 25, 2019 @ 9:00", "2019-06-25"),
    (dates.month_d_y_tokens, "June 25, 2019", "2019-06-25"),
    (dates.month_d_y_tokens, "June, 25 2019", "2019-06-25"),
    (dates.dotted_date, "- 25.06.2019", "2019-06-25"),
    (dates.deadline, "25 Jun 2019", "2019-06-25"),
    (dates.deadline, "", None),
    (dates.deadline, "30 Feb 2019", None),
]
RANGES = [
    (dates.us_range, "June 3, 2019", ("2019-06-03", "2019-06-03")),
    (dates.us_range, "June 3 - 5, 2019", ("2019-06-03", "2019-06-05")),
    (dates.us_range, "June 3-5, 2019", ("2019-06-03", "2019-06-05")),
    (dates.us_range, "June 30 - July 2, 2019", ("2019-06-30", "2019-07-02")),
    (dates.us_range, "December 30, 2019 - January 2, 2020", ("2019-12-30", "2020-01-02")),
    (dates.us_range, "June 3 - 5", None),
    (dates.us_range, "June 3 - 5 - 7, 2019", None),
    (dates.us_abbrev_range, "Sep. 5 - 7, 2019", ("2019-09-05", "2019-09-07")),
    (dates.us_abbrev_range, "Sep. 5, 2019", ("2019-09-05", "2019-09-05")),
    (dates.us_abbrev_range, "Sep. 30 - Oct. 2, 2019", ("2019-09-30", "2019-10-02")),
    (dates.us_abbrev_range, "Sep 5, 2019", None),
    (dates.day_month_range, "25 Jun 2019 1: 00 PM", ("2019-06-25", "2019-06-25")),
    (dates.day_month_range, "25 Jun 2019 10:30", ("2019-06-25", "2019-06-25")),
    (dates.day_month_range, "Wednesday 26 June 2019", ("2019-06-26", "2019-06-26")),
    (dates.day_month_range, "25 - 28 February 2020", ("2020-02-25", "2020-02-28")),
    (dates.day_month_range, "25-28 February 2020", ("2020-02-25", "2020-02-28")),
    (dates.day_month_range, "30 Jan 2020 - 2 February 2020", ("2020-01-30", "2020-02-02")),
    (dates.day_month_range, "", None),
    (dates.uk_meeting_date, "09:00-17:00, 25 Jun 19", ("2019-06-25", "2019-06-25")),
    (dates.uk_meeting_date, "25 Jun 19", ("2019-06-25", "2019-06-25")),
    (dates.uk_meeting_date, "25 Jun 19 - 27 Jun 19", ("2019-06-25", "2019-06-27")),
    (dates.uk_meeting_date, "25 Jun 2019", None),
    (dates.two_digit_year_pair, "25 Jun 19-27 Jun 19", ("2019-06-25", "2019-06-27")),
    (dates.two_digit_year_pair, "25 Jun 19", None),
]


@pytest.mark.parametrize("fn, written, expected", SINGLE + RANGES)
def test_forms(column, fn, written, expected):
    assert [iso(v) for v in column(fn, [written, "soon", None])] == [expected, None, None]


def test_duration(spark):
    row = spark.sql("select date'2020-02-25' a, date'2020-02-28' b")
    out = row.select(dates.duration_days(row.a, row.b).alias("d"), dates.format_date(row.a).alias("f"))
    assert tuple(out.first()) == (4.0, "2020-02-25")
