import datetime as dt

import pytest
from pyspark.sql import functions as F

from presslake.functions.dates import before_year, clean_date, iso_weekday, parse_date

CASES = {
    "السبت، 28 مارس 2026 10:45 م": dt.datetime(2026, 3, 28, 22, 45),
    "الأحد، 1 يناير 2015 09:05 ص": dt.datetime(2015, 1, 1, 9, 5),
    "1 يناير 2015 12:05 ص": dt.datetime(2015, 1, 1, 0, 5),
    "1 يناير 2015 12:05 م": dt.datetime(2015, 1, 1, 12, 5),
    "أ، ب، 7 أغسطس 2020 01:00 م": dt.datetime(2020, 8, 7, 13, 0),
    "31 فبراير 2015 10:00 ص": None,
    "28 مارس 2026 13:45 م": None,
    "28 مارس 2026 10:45 م ": None,
    "28 مارس 2026 10:45": None,
    "garbage": None,
    "": None,
}
# Clocks went forward at 02:00 on this day in New York: 02:30 did not exist there.
GAP = "9 مارس 2025 02:30 ص"


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, d string")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Africa/Cairo"])
def test_parse_date_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [*CASES, GAP, None]
        df = frame(spark, values).select("i", parse_date("d").alias("ts"))
        assert df.schema["ts"].dataType.typeName() == "timestamp_ntz"
        got = [row.ts for row in df.orderBy("i").collect()]
        assert got == [*CASES.values(), dt.datetime(2025, 3, 9, 2, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clean_date(spark):
    values = ["السبت، 28 مارس 2026 10:45 م", "x\nالسبت، 1 مايو 2020 01:00 ص", "ص"]
    got = [row.c for row in frame(spark, values).select("i", clean_date("d").alias("c")).orderBy("i").collect()]
    assert got == ["28 03 2026 10:45 PM", "x\nالسبت، 1 05 2020 01:00 AM", "ص"]


def test_weekday_and_year_range(spark):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=n) for n in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    assert [r.w for r in df.select(iso_weekday("ts").alias("w")).collect()] == [d.isoweekday() for d in days]
    edge = spark.createDataFrame(
        [(dt.datetime(2015, 12, 31, 23, 59, 59, 999999),), (dt.datetime(2016, 1, 1),), (None,)], "ts timestamp_ntz"
    )
    assert edge.filter(before_year(F.col("ts"), 2016)).count() == 1
