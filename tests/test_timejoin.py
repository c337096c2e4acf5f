from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from fractions import Fraction

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from millrace.functions.calendar import calendar, date_spine
from millrace.functions.decimals import from_units, half_up_mean, to_units
from millrace.operators.timejoin import fill_rate, hourly_fact, time_bucket_join
from tests.conftest import rows

H = dt.datetime(2026, 7, 24, 13)
READING = "site_id string, bidding_zone string, timestamp_utc timestamp, consumption_kwh decimal(10,4), avg_power_kw decimal(10,2), pue decimal(4,3)"
PRICE = "bidding_zone string, timestamp_utc timestamp, price decimal(10,2)"


def at(minute):
    return H + dt.timedelta(minutes=minute)


def test_unmatched_hours_keep_a_null_price(spark):
    readings = spark.createDataFrame([("A", "PL", at(5), D(10), D(1), D(1)), ("B", "FR", at(70), D(10), D(1), D(1))], READING)
    prices = spark.createDataFrame([("PL", H, D(100))], PRICE)
    joined = time_bucket_join(readings, prices)
    assert rows(joined.select("site_id", "price")) == [("A", D("100.00")), ("B", None)]
    fact = hourly_fact(readings, prices)
    assert rows(fact.select("site_id", "hour", "cost_per_hour")) == [("A", 13, D("1.00")), ("B", 14, None)]
    assert rows(fill_rate(fact, "cost_per_hour")) == [(2, 1, 1)]


def test_quarter_hour_prices_repeat_readings_only_without_collapse(spark):
    readings = spark.createDataFrame([("A", "PL", at(5), D(10), D(1), D(1))], READING)
    prices = spark.createDataFrame([("PL", at(m), D(p)) for m, p in ((0, 10), (15, 20), (30, -30), (45, 41))], PRICE)
    assert time_bucket_join(readings, prices).count() == 4
    assert rows(time_bucket_join(readings, prices, collapse=True).select("price")) == [(D("10.250000"),)]
    assert rows(hourly_fact(readings, prices).select("cost_per_hour")) == [(D("0.10"),)]


def _half_up(value: Fraction, digits: int):
    scaled = abs(value) * 10**digits
    whole = (scaled + Fraction(1, 2)).__floor__()
    return D(whole if value >= 0 else -whole).scaleb(-digits)


cells = st.one_of(st.none(), st.integers(-99999, 99999))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from(["PL", "FR"]), st.integers(0, 179), cells), min_size=1, max_size=25),
    st.lists(st.tuples(st.sampled_from(["PL", "FR"]), st.integers(0, 179), cells), max_size=12),
)
def test_fact_is_the_average_over_all_pairs(spark, readings, prices):
    """Against the plain definition: pair every reading with every price of its hour, then average."""
    r = [(s, z, at(m), None if k is None else D(k).scaleb(-4), None, None) for s, z, m, k in readings]
    p = [(z, at(m), None if v is None else D(v).scaleb(-2)) for z, m, v in prices]
    got = {(x.site_id, x.bidding_zone, x.hour): x for x in hourly_fact(spark.createDataFrame(r, READING), spark.createDataFrame(p, PRICE)).collect()}
    groups: dict = {}
    for s, z, ts, k, *_ in r:
        groups.setdefault((s, z, ts.hour), []).append(k)
    assert set(got) == set(groups)
    for (s, z, hour), kwhs in groups.items():
        kwhs = [Fraction(k) for k in kwhs if k is not None]
        pairs = [k * Fraction(v) / 1000 for k in kwhs for z2, ts, v in p if z2 == z and ts.hour == hour and v is not None]
        assert got[s, z, hour].cost_per_hour == (_half_up(sum(pairs) / len(pairs), 2) if pairs else None)
        assert got[s, z, hour].avg_consumption_kwh == (_half_up(sum(kwhs) / len(kwhs), 2) if kwhs else None)


def test_means_round_once_and_away_from_zero(spark):
    # units of 1e-4, count, mean in 1e-2
    cases = [(150, 3, "0.01"), (149, 1, "0.01"), (150, 1, "0.02"), (-50, 1, "-0.01"), (-49, 1, "0.00"), (10000, 8, "0.13"), (1, 0, None), (None, 2, None)]
    df = spark.createDataFrame([(n, d) for n, d, _ in cases], "n bigint, d bigint")
    got = [r[0] for r in df.select(half_up_mean(F.col("n"), F.col("d"), 4, 2)).collect()]
    assert got == [D(e) if e else None for _, _, e in cases]


def test_units_there_and_back(spark):
    df = spark.createDataFrame([(D("-12.3456"),), (D("0.0001"),), (None,)], "x decimal(10,4)")
    got = [r[0] for r in df.select(from_units(to_units(F.col("x"), 4), 4, 10)).collect()]
    assert got == [D("-12.3456"), D("0.0001"), None]


def test_cost_beyond_bigint_products(spark):
    """A product of units over 64 bits takes the wide path."""
    readings = spark.createDataFrame([("A", "PL", at(i % 60), D("999999.9999"), None, None) for i in range(2000)], READING)
    prices = spark.createDataFrame([("PL", at(i % 60), D("99999.99")) for i in range(500)], PRICE)
    assert hourly_fact(readings, prices).first().cost_per_hour == D("99999989.99")


def test_calendar_and_spine(spark):
    days = spark.createDataFrame([(dt.date(2026, 8, 21),), (dt.date(2026, 8, 23),), (dt.date(2026, 8, 23),), (None,)], "date date")
    got = rows(calendar(days).select("date", "day_of_week", "day_of_week_name", "month_name", "quarter", "week", "is_weekend"))
    assert got == [
        (dt.date(2026, 8, 21), 6, "Friday", "August", 3, 34, False),
        (dt.date(2026, 8, 23), 1, "Sunday", "August", 3, 34, True),
    ]
    assert date_spine(days, "date").count() == 3
    assert date_spine(days.limit(0), "date").count() == 0
