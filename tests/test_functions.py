import pytest
from conftest import values
from pyspark.sql import functions as F

from haulmark import rules
from haulmark.functions import clock, lookup, numbers, text


def one(spark, expr):
    v = spark.range(1).select(expr.alias("v")).first()[0]
    return str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("given,expected", [
    ("₹11,18,555", 1118555.0), ("-₹72,296", -72296.0), ("5.21%", 0.0521), ("", None), ("₹0", 0.0), ("556,840", 556840.0),
    (None, None), ("abc", None)])
def test_parse_money(spark, given, expected):
    v = one(spark, text.parse_money(F.lit(given).cast("string")))
    assert (None if v is None else float(v)) == expected


@pytest.mark.parametrize("given,expected", [
    (0, "₹0"), (999, "₹999"), (1000, "₹1,000"), (99999, "₹99,999"), (100000, "₹1,00,000"), (1234567, "₹12,34,567")])
def test_rupees(spark, given, expected):
    assert one(spark, text.rupees(F.lit(given))) == expected


@pytest.mark.parametrize("given,expected", [(0.0, "   0%"), (85.7, "  86%"), (100.0, " 100%")])
def test_percent_text(spark, given, expected):
    assert one(spark, text.percent_text(F.lit(given))) == expected


def test_substring_from_zero_uses_up_length(spark):
    assert one(spark, text.substring(F.lit("MANUAL__2024-01-02"), 0, 7)) == "MANUAL"
    assert one(spark, text.substring(F.lit("MANUAL__2024-01-02"), 9, 10)) == "2024-01-02"


def test_concat_forms(spark):
    assert one(spark, text.join_skip_null(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert one(spark, text.join_strict(F.lit("a"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("given,skip,expected", [
    ("Lost on Hub: 12. x", 1, "12"), ("Lost on Rider:7.", 0, "7"), ("Lost on Hub: 12", 1, None), ("Lost 12.", 0, None), (". a:b", 0, None)])
def test_between_marks(spark, given, skip, expected):
    assert one(spark, text.between_marks(F.lit(given), ":", ".", skip)) == expected


@pytest.mark.parametrize("num,den,expected", [(0, 5, 0), (4, 5, 0), (5, 5, 1), (3, 0, None)])
def test_int_ratio(spark, num, den, expected):
    assert one(spark, numbers.int_ratio(F.lit(num), F.lit(den))) == expected


def test_truncate_and_round(spark):
    assert one(spark, numbers.truncate(F.lit(0.29), 2)) == 0.29
    assert one(spark, numbers.truncate(F.lit(29.0))) == 29.0
    assert [one(spark, numbers.round_to_int(F.lit(x))) for x in (0.5, 1.5, 86.99999)] == [0, 2, 87]


def test_chargeable_weight_skips_null(spark):
    none = F.lit(None).cast("double")
    assert one(spark, numbers.chargeable_weight(none, F.lit(10000.0), F.lit(1.5))) == 2.0
    assert one(spark, numbers.chargeable_weight(F.lit(3.0), none, none)) == 3.0


def test_haversine(spark):
    assert abs(one(spark, numbers.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) - 111.195) < 0.01


@pytest.mark.parametrize("given,expected", [
    ("2024-01-31 14:59:59", "2024-01-31 17:00:00"), ("2024-01-31 15:00:00", "2024-02-01 12:00:00")])
def test_cutoff(spark, given, expected):
    assert one(spark, clock.cutoff(clock.moment(given))) == expected


def test_month_horizon_and_weeks(spark):
    assert one(spark, clock.months_before(clock.moment("2024-05-31 00:00:00"), 2, 15)) == "2024-03-16 00:00:00"
    assert one(spark, clock.week(clock.moment("2024-03-10 23:59:00"))) == "2024-03-04 00:00:00"
    assert one(spark, clock.week(clock.moment("2024-03-11 00:00:00"))) == "2024-03-11 00:00:00"
    assert one(spark, clock.in_month(clock.moment("2024-03-01 00:00:00"), "2024-02-29")) is False
    assert one(spark, clock.in_month(clock.moment("2024-02-29 23:59:59"), "2024-02-01")) is True


@pytest.mark.parametrize("rule,at,expected", [
    ("program", "12:59", "Morning"), ("program", "13:00", "Evening"), ("productivity", "11:59", "Morning"),
    ("productivity", "12:00", "Afternoon"), ("payout", "14:59", "morning"), ("payout", "15:00", "evening")])
def test_slots(spark, rule, at, expected):
    assert one(spark, clock.slot_of(clock.moment(f"2024-01-01 {at}:00"), rule)) == expected


def test_unknown_time_slots(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert [one(spark, clock.slot_of(none, r)) for r in ("program", "productivity", "payout")] == ["Evening", "Morning", "morning"]


def test_decode_default_and_first_match(spark, rows):
    df = rows([("DEL",), ("XXX",), (None,)], "c string")
    out = df.select(lookup.decode("c", rules.CITY_CODES, F.col("c")).alias("city"))
    assert values(out) == [("Delhi",), ("XXX",), (None,)]
    arms = [(F.lit(False), 1), (F.lit(True), 2), (F.lit(True), 3)]
    assert one(spark, lookup.first_match(arms)) == 2
    assert one(spark, lookup.first_match([(F.lit(False), 1)])) is None


def test_canonical_city(spark, rows):
    df = rows([("Thane",), ("Gurgaon ",), ("Pune",), ("New Delhi West",)], "c string")
    out = df.select(lookup.canonical("c", rules.CITY_GROUPS, {"Delhi": "Dwarka"}).alias("v"))
    assert values(out) == [("Delhi",), ("Dwarka",), ("Mumbai",), ("Pune",)]
