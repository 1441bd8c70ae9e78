"""Arabic publish dates to naive timestamps, and calendar parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from presslake.schema import MONTH_NUMBERS


def clean_date(col: Column | str) -> Column:
    """``السبت، 28 مارس 2026 10:45 م`` -> ``28 03 2026 10:45 PM``."""
    text = F.regexp_replace(col, r"\A[^\n]*،(?U)\s*", "")
    text = reduce(
        lambda acc, month: F.replace(acc, F.lit(month[0]), F.lit(month[1])),
        MONTH_NUMBERS.items(),
        text,
    )
    text = F.regexp_replace(text, r"(?U)\sص\z", " AM")
    return F.regexp_replace(text, r"(?U)\sم\z", " PM")


def parse_clean_date(clean: Column) -> Column:
    """Cleaned date text to TIMESTAMP_NTZ; NULL when it is not a valid date.

    The text is read as UTC and rebuilt from epoch seconds, so the session time
    zone (and its daylight-saving gaps) cannot shift the wall-clock value.
    """
    instant = F.try_to_timestamp(F.concat(clean, F.lit(" +0000")), F.lit("d M yyyy h:m a xx"))
    seconds = F.make_dt_interval(secs=F.unix_seconds(instant))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + seconds


def parse_date(col: Column | str) -> Column:
    return parse_clean_date(clean_date(col))


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def before_year(ts: Column, year: int) -> Column:
    """``year(ts) < year`` written as a range, so that it reaches the scan."""
    return ts < F.expr(f"timestamp_ntz'{year:04d}-01-01 00:00:00'")
