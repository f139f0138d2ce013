"""Interval joins and unit conversion against plain versions on small tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyline.operators import units
from tallyline.operators.intervals import interval_join


def stamp(text):
    return dt.datetime.fromisoformat(text)


def test_interval_join_equals_the_range_join(spark):
    """Far-future, sub-day, overlapping, touching, empty and open intervals; moments on the bounds; keys without intervals."""
    facts = spark.createDataFrame(
        [(k, n, stamp(f"2024-{1 + n % 12:02}-{1 + n % 28:02}T{n % 24:02}:{n % 60:02}:00")) for k in (1, 2, 3) for n in range(120)]
        + [(1, 500, stamp("2024-03-01T10:00:00")), (1, 501, stamp("2024-03-01T10:30:00")), (1, 502, stamp("1969-12-31T23:00:00")), (1, 503, None), (None, 504, stamp("2024-03-01T10:00:00"))],
        "plant int, n int, at timestamp",
    )
    ends = [
        (1, "far", "2024-02-10T00:00:00", "4712-12-31T00:00:00"), (1, "hour", "2024-03-01T10:00:00", "2024-03-01T10:30:00"), (1, "next", "2024-03-01T10:30:00", "2024-03-02T00:00:00"),
        (2, "year", "2024-01-01T00:00:00", "2025-01-01T00:00:00"), (2, "again", "2024-06-01T00:00:00", "2024-07-15T12:00:00"), (2, "back", "2024-09-01T00:00:00", "2024-08-01T00:00:00"),
        (2, "none", "2024-09-01T00:00:00", "2024-09-01T00:00:00"), (1, "old", "1969-12-31T22:00:00", "1970-01-01T00:00:00"), (2, "open", "2024-01-01T00:00:00", None),
    ]
    intervals = spark.createDataFrame([(k, n, stamp(a), stamp(b) if b else None) for k, n, a, b in ends], "plant int, name string, low timestamp, high timestamp")
    want = facts.alias("f").join(
        intervals.alias("i"), (F.col("f.plant") == F.col("i.plant")) & (F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))
    ).select("n", "name")
    for days in (1, 32, 1000):
        got = interval_join(facts, intervals, ["plant"], "at", "low", "high", bin_days=days).select("n", "name")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.filter("name = 'hour'").count() == 1 and want.filter("name = 'old'").count() == 1


def test_far_years_make_few_rows(spark):
    facts = spark.createDataFrame([(1, dt.date(2024, 5, 5))], "plant int, at date")
    intervals = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(4712, 12, 31))], "plant int, low date, high date")
    joined = interval_join(facts, intervals, ["plant"], "at", "low", "high")
    assert joined.count() == 1 and joined.columns == ["plant", "at", "low", "high"]
    assert (4712 - 2024) * 366 / 32 < 40_000


RATES = [
    (None, "TON", "LB", 2000), (None, "KG", "LB", Decimal("2.20462")), (None, "LB", "OZ", 16), (7, "EA", "LB", 12), (7, "LB", "BOX", Decimal("0.02000")),
    (8, "EA", "LB", 0), (9, "KG", "LB", Decimal("2.5")), (9, "LB", "KG", Decimal("0.4")),
]


def rates(spark, rows):
    return spark.createDataFrame([(i, a, b, Decimal(r)) for i, a, b, r in rows], "inventory_item_id bigint, from_uom string, to_uom string, rate decimal(10,5)")


def test_rates_turned_round_and_through_the_base_unit(spark):
    asked = {
        (1, "TON", "LB"): "2000", (1, "LB", "TON"): "0.0005", (1, "TON", "KG"): "907.18582", (1, "KG", "OZ"): "35.27392", (1, "OZ", "OZ"): "1",
        (7, "EA", "LB"): "12", (7, "LB", "EA"): "0.08333", (7, "EA", "TON"): "0.006", (7, "EA", "BOX"): "0.24", (7, "BOX", "EA"): "4.16667", (7, "BOX", "OZ"): "800",
        (8, "EA", "LB"): "0", (8, "LB", "EA"): None, (8, "EA", "TON"): "0", (9, "KG", "LB"): "2.5", (9, "LB", "KG"): "0.4", (9, "TON", "KG"): "800",
        (1, "EA", "LB"): None, (None, "KG", "TON"): "0.0011", (None, None, "LB"): None, (1, "LB", None): None, (1, "GAL", "LB"): None,
    }
    df = spark.createDataFrame(list(asked), "item bigint, a string, b string")
    table = rates(spark, RATES)
    for spread in ((), ("a",)):
        got = units.with_converted_rate(df, table, "rate", item="item", from_uom="a", to_uom="b", base="LB", spread_by=spread)
        assert got.columns == ["item", "a", "b", "rate"]
        assert {tuple(r)[:3]: r["rate"] for r in got.collect()} == {k: None if v is None else Decimal(v).quantize(Decimal("0.00001")) for k, v in asked.items()}
        direct = units.with_unit_rate(df, table, "rate", item="item", from_uom="a", to_uom="b", spread_by=spread).filter("rate is not null")
        assert {tuple(r) for r in direct.select("item", "a", "b", "rate").collect()} <= {tuple(r) for r in got.collect()}


def test_cycles_that_do_not_lead_back_are_told(spark):
    bad = [*RATES, (None, "OZ", "LB", Decimal("0.06")), (7, "EA", "BOX", Decimal("0.3")), (9, "TON", "LB", 2000)]
    told = {(r["inventory_item_id"], r["from_uom"], r["to_uom"], r["way"]) for r in units.rate_conflicts(rates(spark, bad), "LB").collect()}
    assert told == {(None, "OZ", "LB", "turned round"), (None, "LB", "OZ", "turned round"), (7, "EA", "BOX", "through the base unit")}
    assert units.rate_conflicts(rates(spark, RATES), "LB").isEmpty()
