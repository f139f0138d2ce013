"""Loads of stored tables, each run twice on temporary folders."""

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tallyline import catalog, fixed_values as fixed, loads
from tallyline.operators import cost_store, quality
from tallyline.operators.costs import COST_COLUMNS, cost_by_transaction
from tallyline.plans import invoice_stage, margin, tonnage_load as fact
from tallyline.sources import load_log
from tallyline.sources.sinks import replace_period, swap_partitions, swap_table

JUNE, JULY = dt.date(1998, 6, 1), dt.date(1998, 7, 1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_margin_months_and_their_summary(spark, tables, tmp_path):
    detail, summary, rejects = (str(tmp_path / x) for x in ("detail", "summary", "rejects"))
    rules = {"quantity is one": F.col("quantity") != 1}
    for _ in range(2):
        report = loads.load_margin_months(tables, detail, [JUNE, JULY], as_of=catalog.MOMENT, request_id=1, rejects=rejects, rules=rules)
    want = margin.om_detail(tables, [JUNE, JULY], as_of=catalog.MOMENT, request_id=1)
    good = want.filter("quantity <> 1")
    stored = loads.stored_margin(spark, detail)
    assert stored.count() == good.count() == report.loaded > 0 and report.rejected == want.count() - report.loaded
    assert report.code == (2 if report.rejected else 0) and report.periods == [JUNE, JULY]
    if report.rejected:
        assert spark.read.parquet(rejects).count() == report.rejected
    keys = ["customer_trx_line_id", "order_line_id", "om_rev", "om_cogs", "summary_date", "query_identifier"]
    assert same(stored.select(*keys), good.select(*keys))
    loads.load_month_summary(spark, detail, summary, [JUNE, JULY])
    loads.load_month_summary(spark, detail, summary, [JUNE])
    expected = margin.om_month_summary(good)
    assert same(spark.read.parquet(summary).select(*expected.columns), expected)


def test_tonnage(spark, tables, tmp_path):
    path = str(tmp_path / "tonnage")
    loads.load_tonnage(tables, spark, path, catalog.LAST_PERIOD, JUNE, first_load=True, first_period=catalog.FIRST_PERIOD)
    full = fact.tonnage_backfill(tables, catalog.LAST_PERIOD, catalog.FIRST_PERIOD)
    for requested in (None, "JUN-98", "MAY-98"):
        report = loads.load_tonnage(tables, spark, path, requested, JUNE, first_load=False)
        assert report.periods == ([] if requested == "MAY-98" else ["JUN-98"])
    assert same(spark.read.parquet(path).select(*full.columns), full)


def test_rows_outside_the_listed_years_are_told(tables):
    detail = margin.om_detail(tables, [JUNE], as_of=catalog.MOMENT)
    assert [tuple(r) for r in loads.outside_history(detail).collect()] == [(1998, detail.count())]
    assert loads.outside_history(detail, [1998]).isEmpty()


def test_rep_dimension(spark, tables, tmp_path):
    root = str(tmp_path / "reps")
    for _ in range(2):
        report = loads.load_rep_dimension(tables, "rep_dimension", root)
    stored = spark.table("rep_dimension")
    assert stored.columns == list(fixed.SALES_REP_DIMENSION_COLUMNS) and stored.count() == report.loaded > 0
    log = load_log.load_log(spark, f"{root}.log").orderBy("seq").collect()
    assert [(r["rows_before"], r["rows_after"]) for r in log] == [(0, report.loaded), (report.loaded, report.loaded)]
    broken = tables.with_tables(jtf_rs_salesreps=tables["jtf_rs_salesreps"].withColumn("salesrep_id", F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        loads.load_rep_dimension(broken, "rep_dimension", root)
    assert same(spark.table("rep_dimension"), stored)


# ---- rejected rows ---------------------------------------------------------------------


def test_every_misfit_of_a_row_is_told(spark):
    rows = [("1", "ab", "1.5", "2024-02-01"), (None, "abcd", "x", "2024-02-30"), ("2", None, "12345.6", None), ("z", "abc", "-999.99", "2024-01-01")]
    df = spark.createDataFrame(rows, "id string, name string, amount string, day string")
    schema = T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("name", T.VarcharType(3)), T.StructField("amount", T.DecimalType(5, 2)), T.StructField("day", T.DateType())]
    )
    got = quality.flag_misfits(df, schema, {"no negative amount": F.coalesce(F.expr("try_cast(amount as double)"), F.lit(0)) >= 0})
    assert [f.dataType for f in got.schema][:4] == [T.LongType(), T.StringType(), T.DecimalType(5, 2), T.DateType()]
    told = [(r["id"], r["load_error"], r["load_row"]) for r in got.collect()]
    assert told[0] == (1, None, None)
    assert told[1][1] == "id is missing, name has 4 of 3 characters, amount is no decimal(5,2), day is no date"
    assert told[2] == (2, "amount is no decimal(5,2)", '{"id":"2","name":null,"amount":"12345.6","day":null}')
    assert told[3][1] == "id is no bigint, no negative amount"


def test_rejected_rows_are_always_kept(spark, tables, tmp_path):
    """Too long a text and a missing key, without naming a folder; a later clean load empties it again."""
    path = str(tmp_path / "detail")
    whole = margin.om_detail(tables, [JUNE], as_of=catalog.MOMENT)
    longest = whole.agg(F.max(F.length("customer"))).head()[0]
    report = loads.load_margin_months(tables, path, [JUNE], as_of=catalog.MOMENT, lengths={"customer": longest - 1})
    rejected = spark.read.parquet(f"{path}.rejects")
    assert report.code == 2 and rejected.count() == report.rejected == whole.filter(F.length("customer") == longest).count()
    assert report.loaded + report.rejected == whole.count()
    row = rejected.head()
    assert row["load_error"] == f"customer has {longest} of {longest - 1} characters" and f'"customer":"' in row["load_row"]
    again = loads.load_margin_months(tables, path, [JUNE], as_of=catalog.MOMENT)
    assert again.code == 0 and spark.read.schema(rejected.schema).parquet(f"{path}.rejects").isEmpty()
    log = load_log.load_log(spark, f"{path}.log").orderBy("seq").collect()
    assert [(r["rows_before"], r["rows_after"], r["rows_rejected"]) for r in log] == [(0, report.loaded, report.rejected), (report.loaded, again.loaded, 0)]


# ---- history that goes on --------------------------------------------------------------


def test_an_ended_history_goes_on_with_the_rest(spark, tables, tmp_path):
    detail = margin.om_detail(tables, as_of=catalog.MOMENT)
    detail.write.partitionBy("summary_date").parquet(str(tmp_path / "detail"))
    detail = loads.stored_margin(spark, str(tmp_path / "detail"))
    asked = []

    class Ended(Exception):
        pass

    def table(path):
        return spark.read.parquet(path).select(*invoice_stage.COLUMNS)

    def history(path, fail_at=None):
        def rows_of(months):
            if len(asked) == fail_at:
                raise Ended
            asked.append(list(months))
            return invoice_stage.invoice_stage(tables, detail.filter(F.col("summary_date").isin(list(months))), as_of=catalog.MOMENT, user="x")

        chunks = {str(y): [dt.date(y, m, 1) for m in range(1, 13)] for y in range(1995, 1999)}
        return loads.load_history(loads.Store(path, "staging", 7, "one"), chunks, rows_of, "summary_date")

    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    history(whole)
    asked.clear()
    with pytest.raises(Ended):
        history(cut, fail_at=2)
    first = load_log.done(spark, f"{cut}.log", "staging", "one")
    assert len(first) == 24
    before = files(cut)
    report = history(cut)
    assert {p.year for p in report.periods} == {1997, 1998} and report.loaded > 0
    assert before.items() <= files(cut).items()
    assert same(table(cut), table(whole))
    seen = load_log.audit(spark, f"{cut}.log", "staging", table(cut), "summary_date").collect()
    assert len(seen) == 48 and all(r["agrees"] for r in seen) and sum(r["rows_stored"] for r in seen) == table(cut).count()
    # a period that was changed behind the log's back is found
    month = next(r["period"] for r in seen if r["rows_stored"])
    replace_period(table(cut).filter(F.col("summary_date") == month).limit(0), cut, "summary_date", dt.date.fromisoformat(month))
    assert [r["period"] for r in load_log.audit(spark, f"{cut}.log", "staging", table(cut), "summary_date").collect() if not r["agrees"]] == [month]
    assert history(cut).periods == []


# ---- the account plan ------------------------------------------------------------------


def files(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in Path(path).rglob("*.parquet")}


def seed_plan(tables, path):
    """The interface with some months more, as a table in a folder."""
    target = tables["account_plan_interface"]
    old = target.withColumn("summary_date", F.to_date(F.lit("1997-01-01"))).withColumn("account_number", F.lit("kept"))
    none = target.limit(3).withColumn("summary_date", F.lit(None).cast("date")).withColumn("account_number", F.lit(None).cast("string"))
    whole = target.unionByName(old).unionByName(none)
    whole.write.partitionBy("summary_date").parquet(path)
    return whole.schema


def load_plan(tables, path, schema, **more):
    return loads.load_account_plan(tables, path, schema, as_of=catalog.MOMENT, request_id=4, freight_item=catalog.FREIGHT_ITEM, **more)


def test_account_plan_is_stored_month_by_month(spark, tables, tmp_path):
    path = str(tmp_path / "plan")
    schema = seed_plan(tables, path)
    seeded = spark.createDataFrame(loads.stored_plan(spark, path, schema).collect(), schema)
    want = catalog.account_plan(tables.with_tables(account_plan_interface=seeded))
    before = files(path)
    first = load_plan(tables, path, schema)
    after = files(path)
    same_months = {f for f in before if f.startswith("summary_date=1997-01-01")}
    assert same_months and all(after[f] == before[f] for f in same_months) and first.code == 0
    # the missing month is rewritten too: account numbers of its rows are known now
    assert None in first.periods and dt.date(1998, 6, 1) in first.periods and dt.date(1997, 1, 1) not in first.periods
    assert same(loads.stored_plan(spark, path, schema), want.select(*schema.names))
    # a row that a later loader inserts has no measures of the earlier ones; the next run's resets make these 0
    once = spark.createDataFrame(loads.stored_plan(spark, path, schema).collect(), want.schema)
    second = load_plan(tables, path, schema)
    twice = spark.createDataFrame(loads.stored_plan(spark, path, schema).collect(), want.schema)
    assert same(twice, catalog.account_plan(tables.with_tables(account_plan_interface=once)).select(*schema.names))
    # the missing month's account numbers are filled now
    assert second.periods == first.periods[1:]
    load_plan(tables, path, schema)
    assert same(loads.stored_plan(spark, path, schema), twice)
    log = load_log.load_log(spark, f"{path}.log")
    assert log.filter("request_id = 4 and state = 'done'").count() == len(first.periods) + 2 * len(second.periods)
    assert load_log.audit(spark, f"{path}.log", "account plan", loads.stored_plan(spark, path, schema), "summary_date").filter("not agrees").isEmpty()


def test_account_plan_reads_only_the_months_it_changes(spark, tables, tmp_path, monkeypatch):
    path = str(tmp_path / "plan")
    schema = seed_plan(tables, path)
    plans = []
    swap = loads._swap_periods

    def seen(rows, *args, **named):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString() + rows._jdf.queryExecution().executedPlan().toString())
        return swap(rows, *args, **named)

    monkeypatch.setattr(loads, "_swap_periods", seen)
    load_plan(tables, path, schema, month=dt.date(1998, 6, 9))
    scan = next(line for line in plans[0].splitlines() if "FileScan" in line and str(path) in line)
    assert "PartitionFilters" in scan and "summary_date" in scan.split("PartitionFilters")[1].split("]")[0]


def test_account_plan_from_nothing_and_with_an_amount_too_large(spark, tables, tmp_path):
    """The first load makes the table; an amount that its column cannot hold keeps one row out, and code 2."""
    path = str(tmp_path / "plan")
    schema = tables["account_plan_interface"].schema
    report = load_plan(tables, path, schema)
    stored = loads.stored_plan(spark, path, schema)
    assert report.code == 0 and stored.count() == report.loaded > 0
    largest = stored.agg(F.max(F.abs("om_revenue"))).head()[0]
    digits = len(str(int(largest))) + 4 - 1
    narrow = T.StructType([T.StructField(f.name, T.DecimalType(digits, 4)) if f.name == "om_revenue" else f for f in schema])
    other = str(tmp_path / "narrow")
    short = load_plan(tables, other, narrow)
    rejected = spark.read.parquet(f"{other}.rejects")
    assert short.code == 2 and rejected.count() == short.rejected > 0
    assert {r["load_error"] for r in rejected.collect()} == {f"om_revenue is no decimal({digits},4)"}
    limit = 10 ** (digits - 4)
    kept = stored.filter(F.coalesce(F.abs("om_revenue"), F.lit(0)) < limit)
    assert loads.stored_plan(spark, other, narrow).count() == kept.count() and kept.count() + short.rejected == stored.count()


# ---- transaction costs -----------------------------------------------------------------


def account_rows(spark, rows):
    schema = "month date, transaction_id bigint, accounting_line_type int, cost_element_id int, base_transaction_value decimal(18,4), sign int"
    return spark.createDataFrame([(m, t, k, e, None if v is None else Decimal(v), s) for m, t, k, e, v, s in rows], schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_cost_increments_in_any_order_equal_the_full_sum(spark, tmp_path, seed):
    """Account rows added in parts, some changed, some taken away again; a fallback that comes and goes; no month, no value."""
    draw = random.Random(seed)
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]
    rows = [
        (months[t % 3], t, draw.choice([2, 36, 36, 7]), draw.choice([1, 2, 3, None]), draw.choice([None, "0", "1.5", "-2.25", str(draw.randint(1, 99))]), 1)
        for t in range(40) for _ in range(draw.randint(1, 5))
    ]
    rows.append((months[0], 900, 2, 1, "5", 1))
    gone = draw.sample(rows, 25) + rows[-1:]
    changed = [(m, t, 2, e, "7.5", 1) for m, t, _, e, *_ in gone[:10]]
    parts = [*((r,) for r in draw.sample(rows, 6))]
    taken = {id(p[0]) for p in parts}
    parts += [[r for r in rows if id(r) not in taken][k::3] for k in range(3)] + [[(*r[:5], -1) for r in gone], changed]
    draw.shuffle(parts)
    path = str(tmp_path / "costs")
    for part in parts:
        loads.load_costs(account_rows(spark, part), path, "month", sign="sign")
    schema = cost_store.increment(account_rows(spark, []), "month", "sign").schema
    stored = cost_store.costs(loads.stored_costs(spark, path, schema))
    left = list(rows)
    for r in gone:
        left.remove(r)
    full = cost_by_transaction(account_rows(spark, left + changed)).filter(" or ".join(f"{c} is not null" for c in COST_COLUMNS))
    got = {r["transaction_id"]: tuple(r[c] for c in COST_COLUMNS) for r in stored.collect()}
    want = {r["transaction_id"]: tuple(r[c] for c in COST_COLUMNS) for r in full.collect()}
    assert got == want and 900 not in got


def test_a_cost_increment_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "costs")
    first = [(dt.date(2024, m, 1), 10 * m, 2, 1, "3", 1) for m in (1, 2, 3)]
    loads.load_costs(account_rows(spark, first), path, "month")
    before = files(path)
    report = loads.load_costs(account_rows(spark, [(dt.date(2024, 2, 1), 20, 2, 1, "4", 1)]), path, "month")
    after = files(path)
    assert report.periods == [dt.date(2024, 2, 1)] and {f for f in after if "2024-02" not in f} == {f for f in before if "2024-02" not in f}
    assert all(after[f] == before[f] for f in after if "2024-02" not in f) and not {f for f in after if "2024-02" in f} & set(before)


# ---- replacement by metadata -----------------------------------------------------------


def test_a_failing_write_leaves_table_and_period_readable(spark, tmp_path):
    root = str(tmp_path / "root")
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None), (4, None, "n")], "id int, period string, note string")
    swap_table(rows, "whole", root)
    swap_table(rows.filter("id < 3").select("note", "period", "id"), "whole", root)
    assert sorted(r["id"] for r in spark.table("whole").collect()) == [1, 2]
    bad = rows.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        swap_table(bad, "whole", root)
    assert sorted(r["id"] for r in spark.table("whole").collect()) == [1, 2]

    swap_partitions(rows, "parted", "period", ["a", "b", None], root)
    ids = lambda: sorted(r["id"] for r in spark.table("parted").collect())
    assert ids() == [1, 2, 3, 4]
    with pytest.raises(Exception, match="stop"):
        swap_partitions(bad, "parted", "period", ["a", "b"], root)
    assert ids() == [1, 2, 3, 4]
    # one period gets other rows, one is emptied, the missing one stays
    swap_partitions(rows.filter("id = 1"), "parted", "period", ["a", "b"], root)
    assert ids() == [1, 4]
    swap_partitions(rows, "parted", "period", [None, "b"], root)
    assert ids() == [1, 3, 4]
