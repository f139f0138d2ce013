"""Rules that are easy to lose: NULL handling, text and period parsing, rounding, ambiguity."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline.functions import dates, money, predicates, text
from tallyline.operators import joins, lookups, quality, state, units

D = dt.date


def values(df, column):
    return [r[column] for r in df.collect()]


def column(spark, kind, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"id int, v {kind}").orderBy("id")


def test_prefix_before(spark):
    df = column(spark, "string", ["12-3-X", "12", "-12", "", None])
    assert values(df.select(text.prefix_before(F.col("v"), "-").alias("o")), "o") == ["12", None, None, None, None]
    assert values(df.select(text.order_from_job(F.col("v"), "0").alias("o")), "o") == ["12", "0", "0", "0", "0"]


def test_text_and_keys(spark):
    df = column(spark, "string", [" 007", "n/a", None])
    assert values(df.select(text.numeric_key(F.col("v")).alias("o")), "o") == [7, None, None]
    assert values(df.select(text.join_text(F.col("v"), ".", F.col("id")).alias("o")), "o")[2] == ".2"
    mapped = text.value_map(F.col("v"), {"n/a": "none"})
    assert values(df.select(mapped.alias("o")), "o") == [None, "none", None]


def test_periods(spark):
    df = column(spark, "string", ["JAN-98", "ADJ-98", "APR-24", "DEC-49", "JAN-50", None])
    found = values(df.select(dates.period_month(F.col("v")).alias("o")), "o")
    assert found == [D(1998, 1, 1), None, D(2024, 4, 1), D(2049, 12, 1), D(1950, 1, 1), None]


def test_month_filter_and_day_range(spark):
    stamps = [dt.datetime(1998, 5, 31, 23, 59, 59), dt.datetime(1998, 6, 1), dt.datetime(1998, 6, 30, 23, 59, 59), None]
    df = column(spark, "timestamp_ntz", stamps)
    assert values(df.filter(dates.in_months(F.col("v"), [D(1998, 6, 15)])), "id") == [1, 2]
    assert values(df.filter(dates.in_months(F.col("v"), None)), "id") == [0, 1, 2]
    assert values(df.filter(dates.in_months(F.col("v"), [])), "id") == []
    assert values(df.filter(dates.day_range(F.col("v"), D(1998, 5, 31), D(1998, 6, 1))), "id") == [0, 1]
    assert values(df.filter(dates.on_last_day(F.col("v"))), "id") == [0, 2]


def test_flags(spark):
    df = column(spark, "string", ["Y", "N", None])
    assert values(df.filter(predicates.not_deleted(F.col("v"))), "id") == [1, 2]
    assert values(df.filter(predicates.strictly_not_deleted(F.col("v"))), "id") == [1]
    ends = column(spark, "date", [D(1998, 6, 14), D(1998, 6, 15), D(1998, 6, 16), None])
    assert values(ends.filter(predicates.active_on(F.col("v"), D(1998, 6, 15))), "id") == [1, 2, 3]
    assert values(ends.filter(predicates.active_on(F.col("v"), D(1998, 6, 15), inclusive=False)), "id") == [2, 3]


def test_margin_percent(spark):
    rows = [(Decimal("200"), Decimal("199.99")), (Decimal("0"), Decimal("5")), (Decimal("8"), None), (None, Decimal("1"))]
    df = spark.createDataFrame(rows, "rev decimal(18,4), cost decimal(18,4)")
    out = df.select(
        money.gross_profit(F.col("rev"), F.col("cost")).alias("p"),
        money.gross_profit_percent(F.col("rev"), F.col("cost")).alias("pct"),
    ).collect()
    # 0.005 rounds away from zero
    assert [r.pct for r in out] == [Decimal("0.01"), Decimal("0"), None, Decimal("0")]
    assert [r.p for r in out] == [Decimal("0.01"), Decimal("-5"), None, None]


def test_unit_rate_precedence(spark):
    rates = spark.createDataFrame(
        [(1, "EA", "LB", Decimal("3")), (None, "EA", "LB", Decimal("1.5"))],
        "inventory_item_id bigint, from_uom string, to_uom string, rate decimal(10,5)",
    )
    df = spark.createDataFrame([(1, "EA"), (2, "EA"), (2, "LB"), (2, "KG"), (None, "EA")], "item bigint, u string")
    out = units.with_unit_rate(df, rates, "rate", item="item", from_uom="u", to_literal="LB").collect()
    assert {(r.item, r.u): r.rate for r in out} == {
        (1, "EA"): Decimal("3"), (2, "EA"): Decimal("1.5"), (2, "LB"): Decimal("1"), (2, "KG"): None,
        (None, "EA"): Decimal("1.5"),
    }


def test_ambiguous_lookup_fails_only_when_asked(spark):
    inner = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k bigint, v string")
    fine = spark.createDataFrame([(1,), (3,), (None,)], "k bigint")
    found = lookups.scalar_lookup(fine, inner, ["k"], ["v"], spread_by=["k"])
    assert sorted(values(found, "v"), key=str) == [None, None, "a"]
    asked = spark.createDataFrame([(2,)], "k bigint")
    with pytest.raises(PySparkException):
        lookups.scalar_lookup(asked, inner, ["k"], ["v"], spread_by=["k"]).collect()
    distinct = lookups.scalar_lookup(asked, inner, ["k"], ["v"], spread_by=["k"], distinct=True)
    assert values(distinct, "v") == ["b"]


def test_null_counts_as_a_distinct_value(spark):
    inner = spark.createDataFrame([(1, "a"), (1, None)], "k bigint, v string")
    assert values(lookups.one_row_per_key(inner, ["k"], ["v"], distinct=True), "_ambiguous") == [True]


def test_spread_join_equals_plain_join(spark):
    left = spark.range(400).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("0")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    right = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    for how in ("left", "inner"):
        plain = sorted(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()), key=str)
        spread = joins.spread_join(left, right, ["k"], ["id"], how, hot=["0"]).select("id", "k", "v")
        assert sorted(map(tuple, spread.collect()), key=str) == plain


KEYS = ["c", "l"]
STATE = "c bigint, l string, m string, a int, b int"


def test_upsert_reset_and_null_keys(spark):
    old = spark.createDataFrame([(1, "x", "now", 1, 1), (2, None, "now", 2, 2), (3, "x", "then", 3, 3), (4, "x", "now", 4, 4)], STATE)
    batch = spark.createDataFrame([(1, "x", 10), (2, None, 20), (9, "x", 90)], "c bigint, l string, a int")
    new = state.upsert_measures(old, batch, KEYS, ["a"], insert_defaults={"b": 0}, reset=F.col("m") == "now")
    got = {r.c: (r.a, r.b) for r in new.collect()}
    assert got == {1: (10, 1), 2: (20, 2), 3: (3, 3), 4: (0, 4), 9: (90, 0)}
    again = state.upsert_measures(new, batch, KEYS, ["a"], reset=F.col("m") == "now")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, new.collect()), key=str)
    appended = state.upsert_measures(old, batch, KEYS, ["a"], null_safe=False)
    assert appended.filter("c = 2").count() == 2


def test_period_replace_twice_and_empty(spark):
    old = spark.createDataFrame([(1, "now"), (2, "then"), (3, None)], "id bigint, m string")
    fresh = spark.createDataFrame([(7, "now"), (2, "now")], "id bigint, m string")
    once = state.period_replace(old, fresh, "m", "now", key="id")
    twice = state.period_replace(once, fresh, "m", "now", key="id")
    assert sorted(values(once, "id")) == sorted(values(twice, "id")) == [2, 3, 7]
    assert sorted(values(state.period_replace(old, fresh.limit(0), "m", "now"), "id")) == [2, 3]


def test_quarantine_counts(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id bigint, q int")
    rules = {"quantity missing": F.col("q").isNotNull(), "quantity not positive": F.col("q") > 0}
    good, bad = quality.row_quarantine(df, rules)
    assert values(good, "id") == [1]
    assert {r.id: r.load_error for r in bad.collect()} == {
        2: "quantity missing, quantity not positive", 3: "quantity not positive",
    }
    flagged, seen = quality.observed_load(df, rules)
    flagged.write.format("noop").mode("overwrite").save()
    assert seen.get == {"loaded": 1, "rejected": 2}
