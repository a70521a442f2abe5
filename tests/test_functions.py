import random
from datetime import date, timedelta
from fractions import Fraction

import pytest
from conftest import utc
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.functions import calendar as cal
from shiftledger.functions import cells, durations, text


def one(df, *columns):
    return tuple(df.select(*columns).first())


@pytest.mark.parametrize(
    "iso, micros",
    [
        (None, None),
        ("PT0S", 0),
        ("PT36S", 36_000_000),
        ("PT25H", 25 * 3_600_000_000),
        ("PT1H30M", 5_400_000_000),
        ("PT1.25S", 1_250_000),
        ("P1DT1S", 86_401_000_000),
        ("PT-5S", -5_000_000),
    ],
)
def test_duration(rows, iso, micros):
    assert one(rows("d STRING", (iso,)), durations.iso_duration_us(F.col("d"))) == (micros,)


@pytest.mark.parametrize("bad", ["", "P", "PT", "1h", "PT1", "P1M", "P2Y", "PT1S ", "1,2,3,4,5"])
def test_malformed_duration_fails(rows, bad):
    df = rows("d STRING", (bad,))
    assert one(df, durations.parse_iso_duration(F.col("d"))) == (None,)
    with pytest.raises(Exception, match="Malformed duration"):
        df.select(durations.iso_duration_us(F.col("d"))).collect()


@pytest.mark.parametrize("seconds, hours", [(18, "0.01"), (17, "0.00"), (36, "0.01"), (0, "0.00"), (90000, "25.00"), (-18, "-0.01"), (-17, "0.00"), (-54, "-0.02")])
def test_hours_round_half_away(rows, seconds, hours):
    assert str(one(rows("s BIGINT", (seconds,)), durations.entry_hours_2dp(F.col("s") * 1_000_000))[0]) == hours


def test_hours_of_pairs_match_exact_arithmetic(rows):
    rng = random.Random(7)
    pairs = [(rng.randrange(-10**6, 10**6), rng.randrange(-10**10, 10**10)) for _ in range(2000)]
    pairs += [(36 * k + 18, d) for k in range(-5, 5) for d in (-1, 0, 1)] + [(0, 0), (10**15, 5), (-18, 1), (18, -1)]
    df = rows("s BIGINT, us BIGINT", *pairs)
    got = df.select(
        "s", "us", durations.hours_2dp(F.col("s"), F.col("us")).alias("h"), durations.is_positive(F.col("s"), F.col("us")).alias("p")
    ).collect()
    for r in got:
        exact = Fraction(r["s"] * 10**6 + r["us"], 36 * 10**6)
        cents = int(abs(exact) + Fraction(1, 2)) * (1 if exact >= 0 else -1)
        assert (int(r["h"] * 100), r["p"]) == (cents, exact > 0), (r["s"], r["us"])


def test_sum_does_not_overflow(rows):
    big = 9_000_000_000_000_000_000
    total = rows("d BIGINT", (big,), (big,), (big,)).agg(*durations.sum_duration(F.col("d")))
    sum_s, sum_us = one(total, "sum_s", "sum_us")
    assert sum_s * 1_000_000 + sum_us == 3 * big


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_buckets_whatever_the_session_zone(spark, rows, zone):
    df = rows("t TIMESTAMP", (utc("2026-01-31T21:59:59"),), (utc("2026-01-31T22:00:00"),))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        day = cal.local_date(F.col("t"), "Africa/Johannesburg")
        got = [tuple(r) for r in df.select(cal.month_label(cal.month_start(day)), cal.iso_day(day)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [("January 2026", "2026-01-31"), ("February 2026", "2026-02-01")]


@pytest.mark.parametrize(
    "day, label",
    [
        ("2026-01-22", "23 Dec to 22 Jan 2026"),
        ("2026-01-23", "23 Jan to 22 Feb 2026"),
        ("2026-12-25", "23 Dec to 22 Jan 2027"),
        ("2024-03-01", "23 Feb to 22 Mar 2024"),
        ("2024-03-22", "23 Feb to 22 Mar 2024"),
        ("2025-03-01", "23 Feb to 22 Mar 2025"),
        ("2025-03-22", "23 Feb to 22 Mar 2025"),
        ("2025-03-23", "23 Mar to 22 Apr 2025"),
    ],
)
def test_cycle_label(rows, day, label):
    df = rows("d STRING", (day,)).select(F.to_date("d").alias("d"))
    assert one(df, cal.cycle_label(cal.cycle_month(F.col("d"), 23), 23)) == (label,)


def test_cycle_bounds_agree_in_driver_and_plan(rows):
    for text_day in ("2026-01-22", "2026-01-23", "2026-12-31", "2024-02-29"):
        first, after = cal.cycle_bounds(date.fromisoformat(text_day), "Africa/Johannesburg", 23)
        df = rows("d STRING", (text_day,)).select(F.to_date("d").alias("d"))
        got = one(
            df,
            F.unix_seconds(cal.local_midnight(cal.cycle_first_day(F.col("d"), 23), "Africa/Johannesburg")),
            F.unix_seconds(cal.local_midnight(cal.cycle_end_day(F.col("d"), 23), "Africa/Johannesburg")),
        )
        assert got == (int(first.timestamp()), int(after.timestamp()))
    assert first == utc("2024-02-22T22:00:00")


def test_cycle_day_is_checked():
    with pytest.raises(ValueError):
        cal.cycle_bounds(date(2026, 1, 1), "UTC", 29)


def test_month_label_to_date(rows):
    df = rows("m STRING", ("February 2026",), ("December 1999",), (None,))
    got = [r[0] for r in df.select(cal.month_label_to_date(F.col("m"))).collect()]
    assert got == ["2026-02-01", "1999-12-01", None]
    for bad in ("february 2026", "Smarch 2026", "23 Jan to 22 Feb 2026"):
        with pytest.raises(Exception, match="No such month"):
            rows("m STRING", (bad,)).select(cal.month_label_to_date(F.col("m"))).collect()


def test_parse_instant(rows):
    cases = {
        "2026-01-02T03:04:05Z": utc("2026-01-02T03:04:05"),
        "2026-01-02T03:04Z": utc("2026-01-02T03:04:00"),
        "2026-01-02T03:04:05.250Z": utc("2026-01-02T03:04:05.250"),
        "2026-01-02T03:04:05": None,
        "2026-01-02T03:04:05+02:00": None,
        "2026-02-30T00:00:00Z": None,
        "yesterday": None,
        None: None,
    }
    df = rows("s STRING", *[(c,) for c in cases])
    got = [r[0] for r in df.select(F.unix_millis(cal.parse_instant(F.col("s")))).collect()]
    assert got == [None if v is None else int(v.timestamp() * 1000) for v in cases.values()]


def test_lookback():
    assert model.lookback_window(None) == (timedelta(days=1), "FAST")
    assert model.lookback_window(30) == (timedelta(days=30), "DEEP")
    assert cal.lookback_start(utc("2026-03-02T00:00:00"), timedelta(days=2)) == utc("2026-02-28T00:00:00")
    for bad in ("3", 0, -1, 1.5, True):
        with pytest.raises(ValueError):
            model.lookback_window(bad)


def test_names_and_blanks(rows):
    df = rows("n STRING", ("  \tAda﻿ LOVE \n",), (" ",), ("",), (None,))
    got = [tuple(r) for r in df.select(text.normalise_name(F.col("n")), text.blank_to_null(F.col("n"))).collect()]
    assert got == [("ada﻿ love", "Ada﻿ LOVE"), ("", None), ("", None), (None, None)]


@pytest.mark.parametrize("value, shown", [(2, "2"), (1.5, "1.5"), (0.25, "0.25"), (100, "100"), (0, "0"), (10.1, "10.1")])
def test_number_text(rows, value, shown):
    assert one(rows("v DOUBLE", (float(value),)), text.number_text(F.col("v"))) == (shown,)


def test_record_id_shape(rows):
    df = rows("a STRING", *[(str(i),) for i in range(500)]).select(text.record_id(F.lit("t"), F.col("a")).alias("r"))
    assert df.where(~F.col("r").rlike(f"^{model.RECORD_ID_PATTERN}$")).count() == 0
    assert df.distinct().count() == 500


def test_cell_states(rows):
    docs = ['{"Actual Hours": 1}', '{"Actual Hours": 0.0}', '{"Actual Hours": null}', '{"Actual Hours": "1"}', "{}"]
    df = rows("j STRING", *[(d,) for d in docs]).select(F.parse_json("j").alias("f"))
    name = model.FIELD_ACTUAL_HOURS
    got = [tuple(r) for r in df.select(cells.cell_kind(F.col("f"), name), cells.cell_number(F.col("f"), name)).collect()]
    assert got == [("number", 1.0), ("number", 0.0), ("null", None), ("other", None), ("absent", None)]


def test_long_durations(spark):
    from shiftledger.functions.durations import is_iso_duration, parse_iso_duration

    cases = {
        "PT0.1234567S": 123457, "PT1234567890S": 1234567890_000000, "P1234567D": 1234567 * 86_400_000_000,
        "PT0.000000049S": 0, "P99999999999999999999D": None, "PT99999999999999999999H": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "d STRING").select("d", parse_iso_duration(F.col("d")), is_iso_duration(F.col("d")))
    assert {r[0]: r[1] for r in df.collect()} == cases
    assert all(r[2] == (cases[r[0]] is not None) for r in df.collect())
