"""Loads: compute a job's rows, set bad rows aside, swap the result in, log the counts.

Each stored table is a folder of parquet files partitioned by its period (month or accounting
period). A load may be run again at any time: it replaces whole periods, so a second run gives the
same table. The new rows are computed before anything is replaced (`sources/sinks.py`); a load that
fails changes nothing, except that periods that were already swapped stay swapped.

Every load keeps the rows it sets aside, with their causes, and appends a row per period to the log
(`sources/load_log.py`). By default both lie beside the table: ``<path>.rejects``, ``<path>.log``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallyline import fixed_values as fixed
from tallyline.operators import cost_store
from tallyline.operators.quality import declared, flag_misfits
from tallyline.plans import account_plan as plan, invoice_stage, margin, projects, sales_org, tonnage_load
from tallyline.sources import load_log
from tallyline.sources.sinks import exists, new_folder, partition_folder, remove, replace_periods, swap_table
from tallyline.sources.tables import Tables

DETAIL_REQUIRED = ("customer_trx_line_id", "gl_date", "om_rev")


@dataclass
class Report:
    """What a load did: rows stored and set aside; 0 is the code of a clean load, 2 of one with rejected rows."""

    loaded: int = 0
    rejected: int = 0
    periods: list[object] = field(default_factory=list)

    @property
    def code(self) -> int:
        return 2 if self.rejected else 0


@dataclass
class Store:
    """Where a load keeps its table, its rejected rows and its log, and in whose name it runs."""

    path: str
    load: str
    request_id: int | None = None
    run: str = ""
    rejects: str | None = None
    log: str | None = None

    def __post_init__(self) -> None:
        self.rejects = self.rejects or f"{self.path}.rejects"
        self.log = self.log or f"{self.path}.log"


def _text(value: object) -> str | None:
    return None if value is None else str(value)


def _rows_per_period(spark: SparkSession, path: str, period: str, values: Sequence[object]) -> dict[str | None, int]:
    """Stored rows of the given periods; reads no column."""
    if not exists(spark, path) or not any(exists(spark, partition_folder(path, period, v)) for v in values):
        return {}
    stored = spark.read.parquet(path)
    key = F.col(period).cast("string")
    named = [_text(v) for v in values if v is not None]
    asked = stored.filter(key.isin(named) | (key.isNull() & F.lit(None in values)))
    return {r[0]: r[1] for r in asked.groupBy(key).agg(F.count(F.lit(1))).collect()}


def _swap_periods(
    rows: DataFrame, store: Store, period: str, values: Sequence[object], report: Report, *,
    schema: T.StructType | None = None, rules: Mapping[str, Column] | None = None,
) -> None:
    """Replace periods by the good rows of one computation; the bad rows go to the folder of rejects.

    The rows are computed once, into a folder of their own, and counted and digested per period on the
    way. Only then are the rejects and the periods swapped, and last the log tells that they are in place.
    """
    spark, staged = rows.sparkSession, new_folder(f"{store.path}.staged")
    columns = rows.columns
    flagged = flag_misfits(rows, schema or declared(rows.schema), rules)
    good = F.col("load_error").isNull()
    digest = F.xxhash64(*sorted(c for c in columns if c != period)).cast("decimal(38,0)")
    seen, measures = Observation(), []
    for k, value in enumerate(values):
        mine = F.col(period).eqNullSafe(F.lit(value))
        measures += [
            F.count_if(mine & good).alias(f"good_{k}"), F.count_if(mine & ~good).alias(f"bad_{k}"),
            F.sum(F.when(mine & good, digest)).alias(f"digest_{k}"),
        ]
    # a bad row may have lost its period, which is the only one of the load then
    flagged.observe(seen, *measures, F.count_if(~good).alias("bad")).write.parquet(staged)
    copy, counts = spark.read.schema(flagged.schema).parquet(staged), seen.get
    before = _rows_per_period(spark, store.path, period, values)
    lost = F.coalesce(F.col(period).cast("string"), F.lit(_text(values[0]) if len(values) == 1 else None))
    bad = copy.filter(~good).select(lost.alias("_period"), F.lit(store.load).alias("load"), "load_error", "load_row")
    named = {_text(v): counts[f"bad_{k}"] for k, v in enumerate(values)}
    if counts["bad"] or exists(spark, store.rejects):
        known = {v: n or int(counts["bad"] > sum(named.values())) for v, n in named.items()}
        replace_periods(bad, store.rejects, "_period", known)
    replace_periods(copy.filter(good).select(*columns), store.path, period, {v: counts[f"good_{k}"] for k, v in enumerate(values)})
    remove(spark, staged)
    load_log.append(
        spark, store.log,
        [
            load_log.Entry(
                store.load, store.run, store.request_id, _text(v), load_log.DONE, before.get(_text(v), 0), counts[f"good_{k}"],
                counts[f"bad_{k}"], counts[f"digest_{k}"],
            )
            for k, v in enumerate(values)
        ],
    )
    report.loaded += sum(counts[f"good_{k}"] for k in range(len(values)))
    report.rejected += counts["bad"]
    report.periods += list(values)


def load_margin_months(
    t: Tables, path: str, months: Sequence[dt.date], *, as_of: dt.datetime, request_id: int | None = None,
    rejects: str | None = None, rules: Mapping[str, Column] | None = None, lengths: Mapping[str, int] | None = None, log: str | None = None,
) -> Report:
    """Reload months of the stored margin detail, all in one computation.

    Rows without key, date or amount are rejected, as are those that break a rule or are longer than ``lengths`` allows.
    """
    report, firsts = Report(), [m.replace(day=1) for m in months]
    rows = margin.om_detail(t, firsts, as_of=as_of, request_id=request_id)
    schema = declared(rows.schema, DETAIL_REQUIRED, lengths)
    store = Store(path, "margin detail", request_id, rejects=rejects, log=log)
    _swap_periods(rows, store, "summary_date", firsts, report, schema=schema, rules=rules)
    return report


def stored_margin(spark: SparkSession, path: str) -> DataFrame:
    """The stored detail in the order of its column contract."""
    return spark.read.parquet(path).select(*fixed.MARGIN_DETAIL_COLUMNS)


def load_month_summary(
    spark: SparkSession, detail_path: str, path: str, months: Sequence[dt.date], *, request_id: int | None = None, log: str | None = None
) -> Report:
    """Summaries of the given months, from the stored detail."""
    report, firsts = Report(), [m.replace(day=1) for m in months]
    stored = stored_margin(spark, detail_path).filter(F.col("summary_date").isin(firsts))
    _swap_periods(margin.om_month_summary(stored), Store(path, "month summary", request_id, log=log), "summary_date", firsts, report)
    return report


def load_tonnage(
    t: Tables, spark: SparkSession, path: str, requested: str | None, as_of: dt.date, *, first_load: bool,
    first_period: str = fixed.FIRST_TONNAGE_PERIOD, request_id: int | None = None, log: str | None = None,
) -> Report:
    """First load of all periods up to the requested one, or a refresh of the current period; see `tonnage_refresh`."""
    report, current = Report(), tonnage_load.current_period(as_of)
    store = Store(path, "tonnage", request_id, log=log)
    if first_load:
        if requested is None:
            raise ValueError("a first load needs a period")
        names = sorted(r["period_name"] for r in tonnage_load.periods_to_load(t, requested, first_period).collect())
        _swap_periods(tonnage_load.tonnage_backfill(t, requested, first_period), store, "period_name", names, report)
    elif requested in (None, current):
        _swap_periods(tonnage_load.tonnage_load(t, current), store, "period_name", [current], report)
    return report


def load_history(
    store: Store, chunks: Mapping[str, Sequence[object]], rows_of: Callable[[Sequence[object]], DataFrame], period: str
) -> Report:
    """Store a history chunk by chunk; a run that was ended goes on with the periods that its log does not tell.

    ``chunks`` names the steps and their periods, ``rows_of`` computes the rows of some periods. Each step is
    swapped and logged before the next begins. A step that was ended in between is computed again, with the
    same result.
    """
    report = Report()
    for periods in chunks.values():
        rows = rows_of(periods)
        known = load_log.done(rows.sparkSession, store.log, store.load, store.run)
        rest = [p for p in periods if _text(p) not in known]
        if rest:
            _swap_periods(rows if rest == list(periods) else rows_of(rest), store, period, rest, report)
    return report


def load_staging(
    t: Tables, detail: DataFrame, path: str, *, as_of: dt.datetime, user: str, first_load: bool,
    years: Sequence[int] = fixed.STAGING_HISTORY_YEARS, request_id: int | None = None, run: str = "first load", log: str | None = None,
) -> Report:
    """Invoice staging from the stored detail: all listed years at first, year by year, later the current month."""
    store = Store(path, "invoice staging", request_id, run if first_load else "refresh", log=log)
    if not first_load:
        report, month = Report(), as_of.date().replace(day=1)
        _swap_periods(invoice_stage.current_month(t, detail, as_of=as_of, user=user), store, "summary_date", [month], report)
        return report

    def rows_of(months: Sequence[object]) -> DataFrame:
        return invoice_stage.invoice_stage(t, detail.filter(F.col("summary_date").isin(list(months))), as_of=as_of, user=user)

    chunks = {str(y): [dt.date(y, m, 1) for m in range(1, 13)] for y in years}
    return load_history(store, chunks, rows_of, "summary_date")


def outside_history(detail: DataFrame, years: Sequence[int] = fixed.STAGING_HISTORY_YEARS) -> DataFrame:
    """Rows per year that a first staging load leaves out because their year is not listed."""
    year = F.year("summary_date")
    return detail.filter(~F.coalesce(year.isin(*years), F.lit(False))).groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


def load_rep_dimension(t: Tables, table: str, root: str, *, request_id: int | None = None, log: str | None = None) -> Report:
    """Rebuild the rep dimension, a catalog table below ``root``: readers see the old rows until the new ones are complete."""
    rows = sales_org.sales_rep_dimension(t)
    spark, seen = rows.sparkSession, Observation()
    before = spark.table(table).count() if spark.catalog.tableExists(table) else 0
    observed = rows.observe(seen, F.count(F.lit(1)).alias("n"), load_log.row_digest(rows.columns).alias("digest"))
    swap_table(observed, table, root)
    n = seen.get["n"]
    entry = load_log.Entry("rep dimension", "", request_id, None, load_log.DONE, before, n, 0, seen.get["digest"])
    load_log.append(spark, log or f"{root}.log", [entry])
    return Report(n, 0, [])


# ---- transaction costs -----------------------------------------------------------------


def load_costs(
    accounts: DataFrame, path: str, month: str, *, sign: str | None = None, request_id: int | None = None, log: str | None = None
) -> Report:
    """Add account rows to the stored transaction costs, or take them away (``sign``); see `operators/cost_store.py`.

    Only the months of these account rows are read and rewritten, and no account row but these is read. An
    increment must be loaded once: loading it again adds it again.
    """
    spark, report = accounts.sparkSession, Report()
    staged = new_folder(f"{path}.staged")
    cost_store.increment(accounts, month, sign).write.parquet(staged)
    more = spark.read.parquet(staged)
    months = sorted((r[0] for r in more.select("month").distinct().collect()), key=lambda m: (m is not None, m))
    dated = [m for m in months if m is not None]
    touched = F.col("month").isin(dated) | (F.col("month").isNull() & F.lit(None in months))
    new = cost_store.added(stored_costs(spark, path, more.schema).filter(touched), more)
    if months:
        _swap_periods(new, Store(path, "transaction costs", request_id, log=log), "month", months, report)
    remove(spark, staged)
    return report


def stored_costs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored state; empty before the first load."""
    stored = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return stored.select(*schema.names)


# ---- the account plan ------------------------------------------------------------------


def plan_batch(t: Tables, periods: DataFrame, *, as_of: dt.datetime, request_id: int | None, freight_item: int) -> DataFrame:
    """What the order, billing and project loaders bring for the months of ``periods``."""
    recent = plan.limited_to_periods(t, periods)
    detail = margin.om_detail(recent, as_of=as_of, request_id=request_id, refresh=True)
    return plan.combined_batch(
        margin.om_month_summary(detail), margin.project_billing(recent, None, freight_item),
        projects.project_revenue(recent, few=True), projects.project_cost(recent, few=True),
    )


def stored_plan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored summary table; empty before the first load."""
    stored = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return stored.select(*schema.names)


def _fillable_months(t: Tables, target: DataFrame) -> list[dt.date | None]:
    """Months of rows without account number that the accounts can now give one."""
    known = t["hz_cust_accounts_all"].filter(F.col("account_number").isNotNull()).select(F.col("cust_account_id").alias("customer_account_id"))
    rows = target.filter(F.col("account_number").isNull()).select("customer_account_id", "summary_date")
    return [r[0] for r in rows.join(known, "customer_account_id", "left_semi").select("summary_date").distinct().collect()]


def load_account_plan(
    t: Tables, path: str, schema: T.StructType, *, as_of: dt.datetime, month: dt.date | None = None, request_id: int | None = None,
    freight_item: int = fixed.PROJECT_FREIGHT_ITEM, rejects: str | None = None, log: str | None = None,
    null_safe: bool = True, strict: bool = False,
) -> Report:
    """Refresh the stored account plan: the open months, or one month; then fill missing account numbers.

    ``schema`` declares the stored columns. A row with an amount that its column cannot hold is rejected with its cause, and the rest is
    loaded (code 2). Only months that change are read and written: those of the run, those of the batch (the missing month too),
    and those with a missing account number that is known now. All of them are replaced in one commit; files of other months stay
    as they are. A second run with the same inputs makes measures 0 that a later loader's new rows had none of, as the resets of the
    loaders do; from then on nothing changes.
    """
    spark = t["hz_cust_accounts_all"].sparkSession
    store = Store(path, "account plan", request_id, rejects=rejects, log=log)
    if month is None:
        found = [tuple(r) for r in plan.open_periods(t, as_of.date()).collect()]
    else:
        found = [(None, month.replace(day=1))]
    # a handful of months, looked up once: every use below sees the same ones
    periods = spark.createDataFrame(found, "period_name string, summary_date date")
    months = sorted({m for _, m in found})
    staged = new_folder(f"{path}.staged")
    batch = plan_batch(t, periods, as_of=as_of, request_id=request_id, freight_item=freight_item)
    measures = T.StructType([schema[m] for m in plan.MEASURES])
    # a loader brings its own measures only: none is required of a row
    whole = declared(T.StructType([batch.schema[c] for c in batch.columns if c not in plan.MEASURES] + measures.fields))
    flag_misfits(batch, whole).write.parquet(staged)
    told = spark.read.schema(flag_misfits(batch, whole).schema).parquet(staged)
    good, bad = told.filter("load_error is null").select(*batch.columns), told.filter("load_error is not null")
    n_bad = {r[0]: r[1] for r in bad.groupBy("summary_date").count().collect()}
    target = stored_plan(spark, path, schema)
    touched = {*months, *(r[0] for r in good.select("summary_date").distinct().collect()), *_fillable_months(t, target)}
    some = sorted(touched, key=lambda m: (m is not None, m))
    dated = [m for m in some if m is not None]
    chosen = F.col("summary_date").isin(dated) | (F.col("summary_date").isNull() & F.lit(None in touched))
    old = target.filter(chosen).withColumn("_in_run", F.coalesce(F.col("summary_date").isin(months), F.lit(False)))
    new = plan.refreshed_interface(old, good, F.col("_in_run"), null_safe=null_safe, strict=strict).select(*schema.names)
    new = plan.backfill_null(new, t["hz_cust_accounts_all"], "customer_account_id", "cust_account_id", "account_number")
    report = Report()
    if some:
        _swap_periods(new, store, "summary_date", some, report)
    named = {_text(m): n_bad.get(m, 0) for m in {*months, *n_bad}}
    if n_bad or exists(spark, store.rejects):
        rows = bad.select(F.col("summary_date").cast("string").alias("_period"), F.lit(store.load).alias("load"), "load_error", "load_row")
        replace_periods(rows, store.rejects, "_period", named)
    remove(spark, staged)
    report.rejected = sum(n_bad.values())
    return report
