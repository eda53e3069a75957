"""The daily job: load, gate, history, staging, star schema, marts, checks."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordertide import fixed_values as V
from ordertide.functions import orders
from ordertide.operators.changes import change_feed, initial_load
from ordertide.operators.checks import freshness
from ordertide.operators.history import differing, state_at
from ordertide.plans import models
from ordertide.plans.check_list import run_checks, watched
from ordertide.schema import RAW_ORDERS
from ordertide.sources.scratch import settle
from ordertide.sources.tables import (
    BY_LAST_MONTH, BY_MONTH, BY_ORDER_MONTH, BY_VALIDITY, WHOLE, Table, create_layers)

KEY = "order_id"
TRACKED = ["status", "amount"]

# Where each stored table lives and how it is cut into slices.
STORED = {
    "orders": ("raw", BY_MONTH),
    "orders_snapshot": ("snapshots", BY_VALIDITY),
    "stg_orders_cdc": ("staging", BY_MONTH),
    "dim_customer": ("marts", WHOLE),
    "dim_status": ("marts", WHOLE),
    "dim_date": ("marts", WHOLE),
    "dim_amount_bucket": ("marts", WHOLE),
    "fact_sales": ("marts", BY_MONTH),
    "agg_customers": ("marts", BY_LAST_MONTH),
    "sales_daily_kpi": ("marts", BY_MONTH),
}

# Stored tables that should hold each order once, those that are looked up by order, and
# the one whose versions are compared by fingerprint.
UNIQUE = ["orders", "stg_orders_cdc", "fact_sales"]
KEYED = [*UNIQUE, "orders_snapshot"]
COMPARED = "orders"

# What months of a stored table add up to, kept beside the marts and not published.
STATES = {"customer_months": "fact_sales", "kpi_months": "sales_daily_kpi"}


@dataclass
class Report:
    """What a run did: rows written per table, gate status and check results."""

    freshness: str = ""
    rows: dict[str, int] = field(default_factory=dict)
    checks: DataFrame | None = None


def open_tables(spark: SparkSession, root: str, held: bool = False) -> dict[str, Table]:
    """The stored tables below ``root``; ``held`` by a run that is their only writer."""
    return {
        name: Table(
            spark, f"{root}/{layer}/{name}", slices, key=KEY if name in KEYED else None,
            unique=name in UNIQUE, prints=name == COMPARED, watch=partial(watched, name), held=held)
        for name, (layer, slices) in STORED.items()
    }


def open_states(spark: SparkSession, root: str, held: bool = False) -> dict[str, Table]:
    """The states of months below ``root``."""
    return {name: Table(spark, f"{root}/states/{name}", BY_ORDER_MONTH, held=held) for name in STATES}


def create_raw(spark: SparkSession, root: str, prefix: str = "") -> None:
    """The layers and, if missing, an empty raw.orders with its declared columns."""
    create_layers(spark, root, prefix)
    raw = open_tables(spark, root)["orders"]
    if raw.version() is None:
        raw.replace(spark.createDataFrame([], RAW_ORDERS))
    raw.publish(f"{prefix}raw", "orders")


def attach(spark: SparkSession, root: str, prefix: str = "") -> dict[str, Table]:
    """Give a new session the views over the tables stored below ``root``."""
    create_layers(spark, root, prefix)
    tables = open_tables(spark, root)
    for name, table in tables.items():
        if table.version() is not None:
            table.publish(prefix + STORED[name][0], name)
    create_views(spark, prefix)
    return tables


def create_views(spark: SparkSession, prefix: str = "") -> None:
    """The staging views; they hold no rows and follow raw.orders."""
    columns = ", ".join(V.ORDER_COLUMNS)
    derived = ", ".join(orders.named(orders.ENRICHMENT))
    spark.sql(f"CREATE OR REPLACE VIEW {prefix}staging.stg_orders AS "
              f"SELECT {columns} FROM {prefix}raw.orders WHERE order_id IS NOT NULL")
    spark.sql(f"CREATE OR REPLACE VIEW {prefix}staging.int_orders_enriched AS "
              f"SELECT {columns}, {derived} FROM {prefix}staging.stg_orders")


def refresh_cdc(raw: Table, merged: Table, loaded_at) -> int:
    """Load the merged table once, then bring it from the raw version it knows to the newest.

    Only months of raw whose fingerprint differs between the two versions are
    compared; a row in any other month is in both. Of the others the keys are read
    where they may be those of a lost row.

    A merged table whose newest version did not come from raw (loaded by hand, or
    merged from another feed) is no raw version any more; it is compared itself.
    """
    current, known = raw.version(), merged.version()
    if known is None:
        rows = initial_load(models.stg_orders(raw.read()), loaded_at)
        return merged.replace(rows, feed="raw", batch=current.number, clustered=True)
    base = known.batches.get("raw") if known.feed == "raw" else None
    if base == current.number:
        return 0
    first = 2 * current.number
    if base is None:
        old, new = merged.read().select(*V.ORDER_COLUMNS), models.stg_orders(raw.read())
        feed = change_feed(old, new, KEY, first)
    else:
        feed = raw_changes(raw, base, first)
    return merged.merge(feed, KEY, loaded_at, feed="raw", batch=current.number)


def raw_changes(raw: Table, base: int, first_seq: int = 0) -> DataFrame:
    """The change feed from version ``base`` of raw orders to the newest; reads changed months only."""
    changed = raw.changed_slices(base)
    old, new = raw.read(changed, number=base), raw.read(changed)
    return change_feed(old, new, KEY, first_seq, unchanged=raw.read_near(changed, base))


def refresh_history(raw: Table, history: Table, as_of) -> int:
    """Bring the history from the raw version it has seen to the newest.

    Its open versions stand for that version, so what changed since is found
    between the two raw versions, in months whose fingerprint differs.
    """
    base, number = history.source_seen(), raw.version().number
    if base is None or raw.version(base) is None:
        return history.remember(raw.read(), KEY, TRACKED, as_of, seen=number, clustered=True)
    months = raw.changed_slices(base)
    old, new = raw.read(months, number=base), raw.read(months)
    changed = settle(differing(old, new, KEY, TRACKED, raw.read_near(months, base)))
    return history.remember(new, KEY, TRACKED, as_of, changed, number)


def lookback_day(target: Table, column: str) -> date | None:
    """First day an incremental run looks at; None for an empty table."""
    newest = F.date_sub(F.max(column), V.LOOKBACK_DAYS)
    rows = target.read_newest() if target.slice_by in (BY_MONTH, BY_LAST_MONTH) else target.read()
    return rows.agg(newest).first()[0]


def orders_at(history: Table, moment: datetime) -> DataFrame:
    """All orders as they stood at ``moment``; older closed versions are not read."""
    return state_at(history.read_valid(moment), moment)


def refresh_fact(raw: Table, fact: Table, full_refresh: bool = False) -> int:
    """Rebuild the fact table, or upsert the orders inside the lookback.

    The lookback is a plain date, so older months of raw orders are not read.
    """
    day = None if full_refresh or fact.version() is None else lookback_day(fact, "order_date")
    rows = raw.read() if day is None else raw.read_from(day)
    enriched = models.int_orders_enriched(models.stg_orders(rows))
    if day is None:
        return fact.replace(models.fact_sales(enriched), clustered=True)
    return fact.upsert(models.fact_sales(enriched, F.lit(day)), [KEY])


def roll_up(source: Table, state: Table, build: Callable[[DataFrame], DataFrame]) -> None:
    """Bring the states of months up to the newest version of ``source``.

    Only months that some write has replaced since the version the states know are
    read and built anew, whatever the reason of the write.
    """
    version, known = source.version(), state.version()
    base = None if known is None else known.batches["source"]
    if base == version.number:
        return
    months = set(version.folders) if base is None else source.changed_slices(base)
    if known is not None:
        months |= known.folders.keys() - version.folders.keys()
    state.replace_slices(build(source.read(months)), months, "source", version.number)


def refresh_customers(
    fact: Table, statuses: DataFrame, customers: DataFrame, mart: Table, months: Table,
    as_of=None, full_refresh: bool = False, unique_orders: bool = False,
) -> int:
    """Rebuild the customer mart, or upsert the customers active inside the lookback.

    Where order ids are unique the states of touched months are rebuilt and those
    of the customers merged; the fact's other months are not read. Else orders
    must be told apart over all months.
    """
    day = None if full_refresh or mart.version() is None else lookback_day(mart, "last_order_date")
    only = None
    if day is not None:
        only = settle(models.active_customers(fact.read_from(day), F.lit(day)))
    if unique_orders:
        roll_up(fact, months, models.customer_months)
        rows = models.merged_customers(months.read(), statuses, customers, as_of, only)
    else:
        rows = models.agg_customers(fact.read(), statuses, customers, as_of, only)
    if day is None:
        return mart.replace(rows)
    return mart.upsert(rows, ["customer_id"])


def kpi_seeds(kpi: Table, months: Table, day: date) -> DataFrame:
    """One row per country for its stored days before ``day``.

    Of whole months before it the states are merged; of its own month the days.
    """
    roll_up(kpi, months, models.kpi_months)
    own = f"{day:%Y-%m}".zfill(7)
    begun = kpi.read([own]).filter(F.col("order_date") < F.lit(day))
    earlier = months.read([m for m in months.version().folders if m < own])
    return models.seeds(earlier.unionByName(models.kpi_months(begun)))


def refresh_kpi(
    fact: Table, statuses: DataFrame, customers: DataFrame, kpi: Table, months: Table,
    full_refresh: bool = False, replace_window: bool = False, unique_orders: bool = False,
) -> int:
    """Rebuild the daily figures, or compute and store those inside the lookback.

    ``replace_window`` also removes stored days and countries of the lookback
    that no longer occur; an upsert leaves them.
    """
    day = None if full_refresh or kpi.version() is None else lookback_day(kpi, "order_date")
    if day is None:
        daily = models.daily_sales(
            fact.read(), statuses, customers, unique_orders=unique_orders)
        return kpi.replace(models.sales_daily_kpi(daily))
    since = F.lit(day)
    daily = models.daily_sales(fact.read_from(day), statuses, customers, since, unique_orders)
    rows = models.sales_daily_kpi(daily, kpi_seeds(kpi, months, day), since)
    if replace_window:
        return kpi.replace_since(rows, "order_date", since)
    return kpi.upsert(rows, ["order_date", "country"])


def refresh(
    spark: SparkSession, root: str, raw: DataFrame, as_of, loaded_at,
    full_refresh: bool = False, replace_window: bool = False, threads: int = 4, prefix: str = "",
) -> Report:
    """One daily run over ``raw``; stops after the load if the newest order is too old.

    ``as_of`` is the run's moment (freshness, history, recency), ``loaded_at``
    the load stamp. Tables that do not need each other are built side by side,
    ``threads`` at a time. A run that broke off can be run again. ``prefix`` goes
    before the names of the layers, for several roots in one catalog.
    """
    report, tables = Report(), open_tables(spark, root, held=True)
    states = open_states(spark, root, held=True)
    if tables["orders"].version() is None:
        create_raw(spark, root, prefix)
    else:
        create_layers(spark, root, prefix)

    def store(name: str, write: Callable[[Table], int]) -> DataFrame:
        report.rows[name] = write(tables[name])
        tables[name].publish(prefix + STORED[name][0], name)
        return tables[name].read()

    def store_all(writes: dict[str, Callable[[Table], int]]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            return dict(zip(writes, pool.map(store, writes, writes.values())))

    store("orders", lambda table: table.replace(raw))
    newest = tables["orders"].read_newest()
    report.freshness = freshness(newest, "order_date", as_of).first()["status"]
    if report.freshness == "error":
        return report

    create_views(spark, prefix)
    staged = spark.table(f"{prefix}staging.stg_orders")
    enriched = spark.table(f"{prefix}staging.int_orders_enriched")
    # One pass over the orders serves the three small dimensions.
    members = settle(enriched.select("status", "amount_bucket", "order_date").distinct())
    built = store_all({
        "orders_snapshot": lambda table: refresh_history(tables["orders"], table, as_of),
        "stg_orders_cdc": lambda table: refresh_cdc(tables["orders"], table, loaded_at),
        "fact_sales": lambda table: refresh_fact(tables["orders"], table, full_refresh),
        "dim_customer": lambda table: table.replace(models.dim_customer(staged)),
        "dim_status": lambda table: table.replace(models.dim_status(members)),
        "dim_date": lambda table: table.replace(models.dim_date(members)),
        "dim_amount_bucket": lambda table: table.replace(models.dim_amount_bucket(members)),
    })

    # Known since the fact was written: where ids are unique, the marts need no distinct count.
    unique = tables["fact_sales"].version().repeats == 0
    star = tables["fact_sales"], built["dim_status"], built["dim_customer"]
    built |= store_all({
        "agg_customers": lambda table: refresh_customers(
            *star, table, states["customer_months"], as_of, full_refresh, unique),
        "sales_daily_kpi": lambda table: refresh_kpi(
            *star, table, states["kpi_months"], full_refresh, replace_window, unique),
    })
    del built["orders_snapshot"]
    failing = reduce(dict.__or__, [tables[name].failing() for name in ("orders", *built)])
    repeats = {name: tables[name].version().repeats for name in UNIQUE}
    views = {"stg_orders": staged, "int_orders_enriched": enriched}
    report.checks = settle(run_checks(
        {**views, **built}, repeats={
            (name, KEY): repeats[name if name in built else "orders"]
            for name in (*views, "stg_orders_cdc", "fact_sales")},
        failing=failing,
    ))
    return report
