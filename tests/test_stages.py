"""Jobs over the whole detail are written step by step: the disk holds the shuffles of one step, not of all."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from tallyline import catalog
from tallyline.sources import sinks
from tallyline.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


@pytest.fixture
def small(tables):
    """The supplied tables with the invoice lines of few orders."""
    lines = tables["ra_customer_trx_lines_all"].filter("customer_trx_id % 50 = 3")
    return Tables(lambda name: lines if name == "ra_customer_trx_lines_all" else tables[name])


def test_a_step_leaves_no_shuffles_and_the_setting_as_it_was(spark):
    before, setting = shuffle_files(spark), spark.conf.get(sinks.GIVE_UP_SHUFFLES, None)
    df = spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count()
    kept = sinks.Stages(spark)(df)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(sinks.GIVE_UP_SHUFFLES, None) == setting
    assert sorted(map(tuple, kept.collect())) == [(k, 100) for k in range(10)]


def test_a_step_replaces_only_the_one_it_is_made_of(spark):
    keep = sinks.Stages(spark)
    first, aside = keep(spark.range(3)), keep(spark.range(7))
    second = keep(first.selectExpr("id + 1 as id"), first)
    folders = [df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] for df in (aside, second)]
    assert len(keep._kept) == 2 and all(map(os.path.isdir, folders))
    assert sorted(r.id for r in second.collect()) == [1, 2, 3] and aside.count() == 7


def test_a_step_keeps_values_and_nothing_at_all(spark):
    schema = "d date, t timestamp, n decimal(18,4), a array<struct<x: string, r: decimal(10,5)>>, s string, `_ambiguous` boolean"
    rows = [
        (dt.date(1, 1, 1), dt.datetime(1500, 3, 1), Decimal("-1.5000"), [("KG", Decimal("2.20462"))], "", True),
        (dt.date(4712, 12, 31), dt.datetime(4712, 12, 31), Decimal("0.0001"), [], "a/b=c", False),
        (None,) * 6,
    ]
    df = spark.createDataFrame(rows, schema)
    kept = sinks.Stages(spark)(df)
    assert kept.dtypes == df.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert sinks.Stages(spark)(df.filter("s = 'none'")).count() == 0


JOBS = ["om_detail", "om_part1_sales", "om_part2_config", "om_part3_returns", "om_part6_no_txn", "invoice_stage", "history_backfill"]


@pytest.mark.parametrize("job, steps", [(job, 4) for job in JOBS] + [("period_replace", 5), ("incremental_refresh", 5)])
def test_jobs_over_the_whole_detail_are_written_in_steps(tables, monkeypatch, job, steps):
    seen = []

    class Seen:
        def __init__(self, spark):
            pass

        def __call__(self, df, made_of=None):
            assert made_of is None or any(made_of is old for old in seen)
            seen.append(df)
            return df

    monkeypatch.setattr(catalog, "Stages", Seen)
    catalog.JOBS[job](tables)
    assert len(seen) == steps


def test_staged_rows_are_those_of_one_plan(spark, small):
    before = shuffle_files(spark)
    staged = catalog.staged_detail(small)
    # the steps left nothing, and the last one meets written rows: no distribution and no transaction is joined again
    assert not shuffle_files(spark) - before
    plain = catalog.detail(small)
    for key in ("code_combination_id", " transaction_id"):
        assert key in plan(plain) and key not in plan(staged)
    assert staged.columns == plain.columns and staged.dtypes == plain.dtypes
    rows = [sorted(map(str, df.collect())) for df in (staged, plain)]
    assert rows[0] == rows[1] and rows[0]
