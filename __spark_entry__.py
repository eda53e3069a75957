"""Every query of the engine on the driver's tables, with its oracle.

Raw orders are derived from orders, customer and nation. "old" and "new" states
of raw orders stand for two days of the daily job: for the incremental marts old
lacks the last days, for change capture and history some keys are absent,
dropped or changed. What the job would hold as a stored table is settled here.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import ORACLE
from ordertide import fixed_values as V
from ordertide.functions.numbers import is_special
from ordertide.operators import changes, checks, history, upsert
from ordertide.plans import models
from ordertide.plans.check_list import run_checks
from ordertide.plans.refresh import KEY, TRACKED, open_tables, refresh, refresh_cdc
from ordertide.sources.orders import load_csv, star_orders
from ordertide.sources.scratch import settle, shared_folder
from ordertide.sources.tables import BY_MONTH, Table
from ordertide.streaming.cdc import follow_feed

try:  # the operators for training data may be left out as a whole
    import corpus_pipeline
    from ordertide.llm import oracles as llm_oracles, queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ordertide.llm"):
        raise
    llm_queries = None

AS_OF = "2001-08-02"
FIRST_LOAD, LOADED_AT = "2001-08-01 00:00:00", "2001-08-02 00:00:00"
NOON = "2001-08-02 12:00:00"


@dataclass
class Star:
    """Models of one state of raw orders, built when asked for."""

    raw: DataFrame

    @cached_property
    def staged(self) -> DataFrame:
        return models.stg_orders(self.raw)

    @cached_property
    def enriched(self) -> DataFrame:
        return models.int_orders_enriched(self.staged)

    @cached_property
    def fact(self) -> DataFrame:
        return models.fact_sales(self.enriched)

    @cached_property
    def statuses(self) -> DataFrame:
        return settle(models.dim_status(self.staged))

    @cached_property
    def customers(self) -> DataFrame:
        return models.dim_customer(self.staged)

    @cached_property
    def unique(self) -> bool:
        """Whether order ids are unique: a narrow check that spares a full build a wide shuffle."""
        return checks.duplicates(self.fact, KEY).isEmpty()

    def mart(self, as_of: str | None = AS_OF) -> DataFrame:
        return models.agg_customers(
            self.fact, self.statuses, self.customers, as_of, unique_orders=self.unique)

    def kpi(self) -> DataFrame:
        return models.sales_daily_kpi(models.daily_sales(
            self.fact, self.statuses, self.customers, unique_orders=self.unique))


def _star(spark: SparkSession, folder: str) -> Star:
    return Star(star_orders(spark, folder))


def _stored(spark: SparkSession, folder: str) -> Star:
    """The same over raw orders written once, for queries that read them several times."""
    return Star(settle(star_orders(spark, folder)))


def _before(raw: DataFrame, day: str) -> Star:
    return Star(raw.filter(F.col("order_date") < F.lit(day).cast("date")))


def _two_days(spark: SparkSession, folder: str) -> tuple[Star, Star]:
    new = _stored(spark, folder)
    return _before(new.raw, "2001-07-20"), new


def _two_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = _stored(spark, folder).raw
    group = F.col("order_id") % 10
    old = raw.filter(group != 0)
    new = raw.filter(group.isNull() | (group != 2)).withColumn(
        "status", F.when(group == 1, "returned").otherwise(F.col("status"))
    )
    return old, new


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# -- staging, dimensions, full marts -----------------------------------------


def csv_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Staged orders written as CSV, loaded back strictly, stored and read.

    Ids lie beyond 32 bits, and some cells hold line breaks.
    """
    path = _folder(spark, "csv")
    rows = _star(spark, folder).staged.withColumn("order_id", F.col("order_id") + 3_000_000_000)
    rows = rows.withColumn("country", F.translate("country", " ", "\n"))
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
    table = Table(spark, _folder(spark, "raw"), BY_MONTH)
    table.replace(load_csv(spark, path, multiline=True))
    return table.read()


# -- incremental runs ----------------------------------------------------------


def _fact_before(spark: SparkSession, folder: str):
    """What is stored, and the new state, of the incremental fact."""
    old, new = _two_days(spark, folder)
    return settle(old.fact), new


def _fact_run(stored: DataFrame, new: Star) -> DataFrame:
    since = models.lookback_start(stored, "order_date")
    return upsert.upsert(stored, models.fact_sales(new.enriched, since), [KEY])


def _customers_before(spark: SparkSession, folder: str):
    """Fact and dimensions of today, and yesterday's mart."""
    old, new = _two_days(spark, folder)
    fact = settle(_fact_run(settle(old.fact), new))
    return fact, new.statuses, settle(new.customers), settle(old.mart())


def _customers_run(fact, statuses, customers, stored) -> DataFrame:
    since = models.lookback_start(stored, "last_order_date")
    only = settle(models.active_customers(fact, since))
    rows = models.agg_customers(fact, statuses, customers, AS_OF, only)
    return upsert.upsert(stored, settle(rows), ["customer_id"])


def _kpi_before(spark: SparkSession, folder: str):
    """Fact and dimensions of today, and yesterday's daily figures."""
    old, new = _two_days(spark, folder)
    fact = settle(_fact_run(settle(old.fact), new))
    return fact, new.statuses, settle(new.customers), settle(old.kpi())


def _kpi_rows(fact, statuses, customers, stored):
    since = models.lookback_start(stored, "order_date")
    daily = models.daily_sales(fact, statuses, customers, since)
    before = models.seeds(models.kpi_months(stored.filter(F.col("order_date") < since)))
    return models.sales_daily_kpi(daily, before, since), since


def _kpi_run(fact, statuses, customers, stored) -> DataFrame:
    rows, _ = _kpi_rows(fact, statuses, customers, stored)
    return upsert.upsert(stored, settle(rows), ["order_date", "country"])


def _job_before(spark: SparkSession, folder: str):
    """Root of a first run of the job, and today's raw orders."""
    old, new = _two_days(spark, folder)
    root = _folder(spark, "job")
    refresh(spark, root, old.raw, "2001-07-21 00:00:00", FIRST_LOAD)
    return spark, root, new.raw


def _job_run(spark: SparkSession, root: str, raw: DataFrame, **how) -> DataFrame:
    refresh(spark, root, raw, NOON, LOADED_AT, **how)
    return open_tables(spark, root)["sales_daily_kpi"].read()


#: Daily runs as two steps, so that the second can be timed alone: what is stored, and the run.
DAILY_RUNS = {
    "fact_sales_incremental": (_fact_before, _fact_run),
    "agg_customers_incremental": (_customers_before, _customers_run),
    "sales_daily_kpi_incremental": (_kpi_before, _kpi_run),
    "refresh_job_second_run": (_job_before, _job_run),
}


def daily_run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    before, run = DAILY_RUNS[name]
    return lambda spark, folder: run(*before(spark, folder))


def kpi_replace_window(spark: SparkSession, folder: str) -> DataFrame:
    *state, stored = _kpi_before(spark, folder)
    rows, since = _kpi_rows(*state, stored)
    return upsert.replace_window(stored, rows, "order_date", since)


def schema_sync(spark: SparkSession, folder: str) -> DataFrame:
    """A stored fact with one column too many and one too few meets new rows."""
    old, new = _two_days(spark, folder)
    stored = settle(old.fact.drop("amount_bucket").withColumn("channel", F.lit("web")))
    since = models.lookback_start(stored, "order_date")
    return upsert.upsert(stored, models.fact_sales(new.enriched, since), [KEY])


_jobs: dict[tuple[str, str], str] = {}


def _job(spark: SparkSession, folder: str) -> str:
    """Root of a first and a second run of the whole job, run once per session and folder."""
    place = spark.sparkContext.applicationId, folder
    root = _jobs.get(place)
    if root is None or open_tables(spark, root)["sales_daily_kpi"].version() is None:
        _, root, raw = _job_before(spark, folder)
        _job_run(spark, root, raw)
        _jobs[place] = root
    return root


def job_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A stored table after two runs of the job."""
    return lambda spark, folder: open_tables(spark, _job(spark, folder))[name].read()


def job_dims(spark: SparkSession, folder: str) -> DataFrame:
    """The members of all stored dimensions after two runs of the job."""
    tables = open_tables(spark, _job(spark, folder))
    members = {
        "customer": F.concat_ws("/", "customer_id", "country"),
        "status": F.concat_ws("/", "status", F.col("is_completed").cast("string")),
        "date": F.col("order_date").cast("string"), "amount_bucket": F.col("amount_bucket"),
    }
    parts = [tables[f"dim_{n}"].read().select(
        F.lit(n.removeprefix("amount_")).alias("dim"), m.alias("member")) for n, m in members.items()]
    return reduce(DataFrame.unionByName, parts)


def job_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Daily figures after a second run that rebuilds the marts."""
    return _job_run(*_job_before(spark, folder), full_refresh=True)


def customers_special(spark: SparkSession, folder: str) -> DataFrame:
    """The customer mart where some amounts are NaN or infinite."""
    raw, group = star_orders(spark, folder), F.col("order_id") % 500
    amount = F.col("amount")
    for k, value in enumerate(("nan", "inf", "-inf"), 1):
        amount = F.when(group == k, float(value)).otherwise(amount)
    mart = Star(settle(raw.withColumn("amount", amount))).mart()
    value = F.col("lifetime_value")
    kind = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(
        value == -float("inf"), "-inf").otherwise("finite")
    return mart.select("customer_id", "total_orders", "customer_segment", kind.alias("kind"), *[
        F.when(~is_special(F.col(c)), F.col(c)).alias(c) for c in ("lifetime_value", "avg_order_value")])


# -- change capture and history ------------------------------------------------


def _first_load(old: DataFrame) -> DataFrame:
    return changes.initial_load(models.stg_orders(old), FIRST_LOAD)


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    return changes.change_feed(*_two_states(spark, folder), KEY)


def change_feed_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Some rows of the old state, and others of the new, are there twice."""
    old, new = _two_states(spark, folder)
    group = F.col("order_id") % 10
    return changes.change_feed(
        old.unionByName(old.filter(group == 4)), new.unionByName(new.filter(group.isin(0, 3))), KEY)


def _three_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The third takes back a change of the second and has changes of its own."""
    old, new = _two_states(spark, folder)
    group = F.col("order_id") % 10
    last = star_orders(spark, folder).filter(group.isNull() | (group != 6)).withColumn(
        "amount", F.when(group == 5, F.col("amount") + 1).otherwise(F.col("amount")))
    return old, new, settle(last)


def cdc_two_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Two feeds wait in the folder when the stream runs once."""
    old, new, last = _three_states(spark, folder)
    target = Table(spark, _folder(spark, "cdc"), BY_MONTH)
    target.replace(_first_load(old))
    files = _folder(spark, "feed")
    for before, after in ((old, new), (new, last)):
        changes.change_feed(before, after, KEY).write.mode("append").parquet(files)
    offset = _folder(spark, "offset")
    follow_feed(spark, files, old.schema, target, KEY, offset, lambda batch: LOADED_AT)
    return target.read()


def cdc_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """A stream batch is merged between two daily runs on one table."""
    old, new, last = _three_states(spark, folder)
    raw, merged = (Table(spark, _folder(spark, n), BY_MONTH) for n in ("raw", "merged"))
    raw.replace(old)
    refresh_cdc(raw, merged, FIRST_LOAD)
    merged.merge(changes.change_feed(old, new, KEY), KEY, LOADED_AT, feed="stream", batch=2)
    raw.replace(last)
    refresh_cdc(raw, merged, LOADED_AT)
    return merged.read().drop(*changes.MARKS)


def net_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes.net_changes(change_feed(spark, folder), KEY)


def cdc_initial(spark: SparkSession, folder: str) -> DataFrame:
    return _first_load(_two_states(spark, folder)[0])


def cdc_merge(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _two_states(spark, folder)
    net = settle(changes.net_changes(changes.change_feed(old, new, KEY), KEY))
    return changes.merge_changes(_first_load(old), net, KEY, LOADED_AT)


def cdc_merge_literal(spark: SparkSession, folder: str) -> DataFrame:
    """The feed merged as it comes, NULL keys included."""
    old, new = _two_states(spark, folder)
    feed = settle(changes.change_feed(old, new, KEY))
    return changes.merge_changes(_first_load(old), feed, KEY, LOADED_AT)


def cdc_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as files, merged by a stream over two runs."""
    old, new = _two_states(spark, folder)
    target = Table(spark, _folder(spark, "cdc"), BY_MONTH)
    target.replace(_first_load(old))
    feed = settle(changes.change_feed(old, new, KEY))
    files, offset = _folder(spark, "feed"), _folder(spark, "offset")
    odd = F.coalesce(F.col(KEY) % 2 == 1, F.lit(False))
    for part in (odd, ~odd):
        feed.filter(part).write.mode("append").parquet(files)
        follow_feed(spark, files, old.schema, target, KEY, offset, lambda batch: LOADED_AT)
    return target.read()


def _history(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _two_states(spark, folder)
    first = settle(history.scd2_apply(None, old, KEY, TRACKED, FIRST_LOAD))
    return history.scd2_apply(first, new, KEY, TRACKED, LOADED_AT)


def orders_as_of(moment: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: history.state_at(settle(_history(spark, folder)), moment)


# -- checks, on inputs that some rows fail ---------------------------------------


def _refunds(star: Star) -> DataFrame:
    return star.fact.withColumn("amount", F.col("amount") - 400)


def check_running_total(spark: SparkSession, folder: str) -> DataFrame:
    star = _stored(spark, folder)
    daily = models.daily_sales(
        _refunds(star), star.statuses, star.customers, unique_orders=star.unique)
    return checks.falling_totals(models.sales_daily_kpi(daily))


def check_ltv(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _two_days(spark, folder)
    return checks.value_mismatches(checks.expected_values(new.fact), old.mart())


def check_relationships(spark: SparkSession, folder: str) -> DataFrame:
    star = _stored(spark, folder)
    early = _before(star.raw, "1996-01-01")
    return checks.orphans(star.fact, "customer_id", early.customers, "customer_id")


def check_orphan_customers(spark: SparkSession, folder: str) -> DataFrame:
    star = _stored(spark, folder)
    return checks.customers_without_mart(star.fact, _before(star.raw, "1996-01-01").mart())


def check_type(spark: SparkSession, folder: str) -> DataFrame:
    return checks.column_types(_star(spark, folder).staged, {
        "order_id": "int", "customer_id": "string", "order_date": "date", "amount": "double",
    })


def check_report_failing(spark: SparkSession, folder: str) -> DataFrame:
    """All checks on tables of which each breaks some rules, at least one of every kind."""
    star, key = _stored(spark, folder), F.col("order_id")
    lost = F.when(key % 50 == 0, "lost").when(key % 50 != 1, F.col("status"))
    twice = star.raw.unionByName(star.raw.filter(key % 100 == 3))
    broken = Star(settle(twice.withColumns({
        "amount": F.col("amount") - 400, "status": F.when(key.isNull(), F.col("status")).otherwise(lost)})))
    early = _before(star.raw, "1996-01-01")
    kpi = broken.kpi()
    tables = {
        "stg_orders": broken.staged.withColumn("order_date", F.col("order_date").cast("string")),
        "stg_orders_cdc": changes.initial_load(broken.staged, FIRST_LOAD).withColumn(
            "_cdc_action", F.lit("LOAD")),
        "int_orders_enriched": broken.enriched, "dim_customer": early.customers,
        "dim_status": models.dim_status(broken.staged).filter("status <> 'pending'"),
        "dim_date": models.dim_date(early.enriched),
        "dim_amount_bucket": models.dim_amount_bucket(early.enriched).filter("amount_bucket <> 'small'"),
        "fact_sales": broken.fact, "agg_customers": early.mart(),
        "sales_daily_kpi": kpi.unionByName(kpi.filter("country = 'FRANCE'")),
    }
    return run_checks({name: settle(df) for name, df in tables.items()})


def check_report(spark: SparkSession, folder: str) -> DataFrame:
    """All checks on the tables of a first run of the job."""
    raw = star_orders(spark, folder)
    return refresh(spark, _folder(spark, "job"), raw, NOON, LOADED_AT).checks


def entry(spark: SparkSession) -> DataFrame:
    """Daily revenue, growth and rank per country."""
    return _stored(spark, "/root/testdata/sf0.001").kpi()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return order_queries()
    return order_queries() | llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def order_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_orders": star_orders,
        "raw_orders_csv_reload": csv_reload,
        "stg_orders": lambda s, d: _star(s, d).staged,
        "int_orders_enriched": lambda s, d: _star(s, d).enriched,
        "dim_customer": lambda s, d: _star(s, d).customers,
        "dim_status": lambda s, d: models.dim_status(_star(s, d).staged),
        "dim_date": lambda s, d: models.dim_date(_star(s, d).enriched),
        "dim_amount_bucket": lambda s, d: models.dim_amount_bucket(_star(s, d).enriched),
        "fact_sales_full": lambda s, d: _star(s, d).fact,
        "agg_customers_full": lambda s, d: _stored(s, d).mart(),
        "agg_customers_today": lambda s, d: _stored(s, d).mart(None),
        "agg_customers_special": customers_special,
        "sales_daily_kpi_full": lambda s, d: _stored(s, d).kpi(),
        "fact_sales_incremental": daily_run("fact_sales_incremental"),
        "agg_customers_incremental": daily_run("agg_customers_incremental"),
        "sales_daily_kpi_incremental": daily_run("sales_daily_kpi_incremental"),
        "kpi_replace_window": kpi_replace_window,
        "schema_sync": schema_sync,
        "refresh_job": job_table("sales_daily_kpi"),
        "refresh_job_fact": job_table("fact_sales"),
        "refresh_job_customers": job_table("agg_customers"),
        "refresh_job_cdc": job_table("stg_orders_cdc"),
        "refresh_job_history": job_table("orders_snapshot"),
        "refresh_job_dims": job_dims,
        "refresh_job_full": job_full_refresh,
        "orders_change_feed": change_feed,
        "orders_change_feed_copies": change_feed_copies,
        "orders_net_changes": net_changes,
        "stg_orders_cdc_initial": cdc_initial,
        "stg_orders_cdc_merge": cdc_merge,
        "stg_orders_cdc_merge_literal": cdc_merge_literal,
        "stg_orders_cdc_stream": cdc_stream,
        "stg_orders_cdc_two_feeds": cdc_two_feeds,
        "stg_orders_cdc_mixed": cdc_mixed,
        "orders_snapshot": _history,
        "orders_as_of": orders_as_of("2001-08-01 12:00:00"),
        "orders_as_of_boundary": orders_as_of(LOADED_AT),
        "orders_as_of_later": orders_as_of("2001-08-03 00:00:00"),
        "check_not_null": lambda s, d: checks.null_rows(star_orders(s, d), KEY),
        "check_unique": lambda s, d: checks.duplicates(star_orders(s, d), "customer_id"),
        "check_accepted_values": lambda s, d: checks.unaccepted_values(
            star_orders(s, d), "status", V.STATUSES[:2]),
        "check_relationships": check_relationships,
        "check_between": lambda s, d: checks.rows_outside(star_orders(s, d), "amount", 50, 900),
        "check_type": check_type,
        "check_ltv": check_ltv,
        "check_running_total": check_running_total,
        "check_kpi_grain": lambda s, d: checks.repeated_values(
            _star(s, d).staged, ["order_date", "country"]),
        "check_revenue_positive": lambda s, d: checks.negative_amounts(_refunds(_star(s, d))),
        "check_orphan_customers": check_orphan_customers,
        "source_freshness": lambda s, d: checks.freshness(star_orders(s, d), "order_date", NOON),
        "check_report": check_report,
        "check_report_failing": check_report_failing,
    }


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return ORACLE
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLE | llm_oracles.ORACLES | more
