"""Field decoding and partition transforms."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelake.functions import as_type, percent, start_of_month, start_of_week, transform
from tidelake.schemas import CLOCK, DAY, MONEY, TEXT, WHOLE


def decoded(spark, kind, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(as_type(F.col("t"), kind)).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_times_decode_alike_in_every_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = dt.datetime(2018, 1, 15, 14, 30)
        assert decoded(spark, CLOCK, "1516026600000000", "2018-01-15T14:30:00.000Z", "2018-01-15 14:30:00") == [moment] * 3
        day = dt.date(2018, 1, 25)
        assert decoded(spark, DAY, "17556", "2018-01-25") == [day] * 2
        # 14:30 UTC is still the 15th west of UTC; local clocks must not shift it.
        assert decoded(spark, DAY, "0", "-1") == [dt.date(1970, 1, 1), dt.date(1969, 12, 31)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_microseconds_and_times_before_1970(spark):
    assert decoded(spark, CLOCK, "1516026600123456", "-1", "0") == [
        dt.datetime(2018, 1, 15, 14, 30, 0, 123456), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
    ]


def test_unfit_fields_become_null(spark):
    assert decoded(spark, CLOCK, "soon", "", None, "99999999999999999999", "9000000000000000000", "2018-13-45") == [None] * 6
    assert decoded(spark, DAY, "soon", "", None, "99999999999", "2018-02-30") == [None] * 5
    assert decoded(spark, WHOLE, "12", "x", "99999999999", None) == [12, None, None, None]
    assert decoded(spark, MONEY, "99.90", "99.9", "1.234567899E7", "x", "123456789.00") == [
        Decimal("99.90"), Decimal("99.90"), Decimal("12345678.99"), None, None,
    ]
    assert decoded(spark, TEXT, "x", "", None) == ["x", "", None]


def test_partition_transforms(spark):
    rows = spark.sql("SELECT timestamp_ntz'2018-03-31 23:59:59' AS t, 'SP' AS s").select(
        transform("day", F.col("t")), transform("month", F.col("t")), transform("identity", F.col("s")), transform("bucket", F.col("s")),
    )
    day, month, same, bucket = rows.first()
    assert (day, month, same) == (dt.date(2018, 3, 31), dt.date(2018, 3, 1), "SP") and 0 <= bucket < 8
    with pytest.raises(ValueError):
        transform("hour", F.col("t"))


def test_weeks_start_on_monday_and_ratios_guard_zero(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-07 23:59:59' AS t, 0 AS none, 3 AS three, 7 AS seven").select(
        start_of_week(F.col("t")), start_of_month(F.col("t")), percent(F.col("three"), F.col("none")), percent(F.col("three"), F.col("seven")),
    ).first()
    assert tuple(row) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), None, 42.86)
