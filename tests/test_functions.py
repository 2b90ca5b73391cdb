from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import functions as fn

UTC_FREE_ZONES = ["UTC", "America/New_York", "Asia/Kolkata"]


@pytest.fixture(params=UTC_FREE_ZONES)
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def evaluate(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()])
    return [r.asDict() for r in df.collect()]


def test_time_functions_do_not_depend_on_the_zone(spark, zone):
    # 02:30 on this day does not exist in New York.
    moments = [datetime(2024, 3, 10, 2, 30, 59, 900000), datetime(2024, 1, 1), datetime(2023, 12, 31, 23, 59), None]
    ts = F.col("ts")
    found = evaluate(
        spark,
        [(m,) for m in moments],
        "ts timestamp_ntz",
        midnight=fn.midnight(ts),
        week=fn.period_start(ts, "week"),
        month=fn.period_day(ts, "month"),
        year=fn.period_day(ts, "year"),
        dow=fn.iso_dow(ts),
        clock=fn.clock(ts),
        before=fn.last_midnight_before(ts),
    )
    assert found[0] == {
        "midnight": datetime(2024, 3, 10),
        "week": datetime(2024, 3, 4),
        "month": date(2024, 3, 1),
        "year": date(2024, 1, 1),
        "dow": 7,
        "clock": "02:30",
        "before": date(2024, 3, 10),
    }
    assert found[1]["week"] == datetime(2024, 1, 1) and found[1]["dow"] == 1
    assert found[1]["before"] == date(2023, 12, 31)
    assert found[2]["week"] == datetime(2023, 12, 25) and found[2]["clock"] == "23:59"
    assert all(v is None for v in found[3].values())


@pytest.mark.parametrize(
    "later, earlier, seconds, days",
    [
        (datetime(2024, 3, 10, 4), datetime(2024, 3, 10, 1), 10800, 0),
        (datetime(2024, 3, 10, 1), datetime(2024, 3, 10, 4), -10800, 0),
        (datetime(2024, 1, 1, 0, 0, 1, 999999), datetime(2024, 1, 1), 1, 0),
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 999999), -1, 0),
        (datetime(2024, 1, 3), datetime(2024, 1, 1), 172800, 2),
        (datetime(2024, 1, 1, 1), datetime(2024, 1, 3), -169200, -1),
        (datetime(2024, 1, 1), datetime(2024, 1, 3), -172800, -2),
    ],
)
def test_elapsed_time_truncates_toward_zero(spark, later, earlier, seconds, days):
    a, b = F.col("a"), F.col("b")
    [row] = evaluate(
        spark,
        [(later, earlier)],
        "a timestamp_ntz, b timestamp_ntz",
        s=fn.whole_seconds(a, b),
        d=fn.whole_days(a, b),
    )
    assert row == {"s": seconds, "d": days}


def test_whole_days_against_arithmetic(spark):
    start = datetime(2024, 5, 5, 13)
    rows = [(start + timedelta(hours=h), start) for h in range(-100, 100, 7)]
    found = evaluate(spark, rows, "a timestamp_ntz, b timestamp_ntz", d=fn.whole_days(F.col("a"), F.col("b")))
    assert [r["d"] for r in found] == [int((a - b) / timedelta(days=1)) for a, b in rows]


def test_unknown_unit():
    with pytest.raises(ValueError, match="quarter"):
        fn.period_day(F.lit("2024-01-01"), "quarter")


def test_least_and_greatest_keep_nulls(spark):
    found = evaluate(
        spark,
        [(1, 2), (None, 2), (1, None)],
        "a int, b int",
        lo=fn.strict_least(F.col("a"), F.col("b")),
        hi=fn.strict_greatest(F.col("a"), F.col("b")),
    )
    assert found == [{"lo": 1, "hi": 2}, {"lo": None, "hi": None}, {"lo": None, "hi": None}]


def test_next_pow2(spark):
    sizes = [0, 1, 2, 3, 4, 5, 64, 65, 2**29, 2**29 + 1, None]
    found = evaluate(spark, [(n,) for n in sizes], "n bigint", p=fn.next_pow2(F.col("n")))
    assert [r["p"] for r in found] == [1, 1, 2, 4, 4, 8, 64, 128, 2**29, 2**30, None]


def test_text(spark):
    rows = [("a\r\n\nb\n", 5), ("plain", None), (None, 1), ("", 0)]
    found = evaluate(
        spark, rows, "t string, n int", clean=fn.clean_newlines(F.col("t")), label=fn.label("n = ", F.col("n"), "!")
    )
    assert [r["clean"] for r in found] == ["a b ", "plain", None, ""]
    assert [r["label"] for r in found] == ["n = 5!", None, "n = 1!", "n = 0!"]
