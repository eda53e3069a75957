"""The business models, each a function from DataFrames to a DataFrame."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ordertide import fixed_values as V
from ordertide.functions import numbers, orders


def lookback_start(target: DataFrame, day: str) -> Column:
    """First day an incremental run looks at: the newest stored day less the lookback.

    A scalar subquery: Spark runs it once and uses the value in the scan. An
    empty target, or one with no dates, gives a day before all others.
    """
    newest = F.date_sub(F.max(day), V.LOOKBACK_DAYS)
    return target.agg(F.coalesce(newest, F.lit("0001-01-01").cast("date")).alias("since")).scalar()


def stg_orders(raw: DataFrame) -> DataFrame:
    """Orders that have an id."""
    return raw.select(*V.ORDER_COLUMNS).filter(F.col("order_id").isNotNull())


def int_orders_enriched(staged: DataFrame) -> DataFrame:
    """Orders with calendar attributes, amount bucket and completed flag."""
    return staged.selectExpr(*V.ORDER_COLUMNS, *orders.named(orders.ENRICHMENT))


def dim_customer(staged: DataFrame) -> DataFrame:
    """One row per customer and country."""
    return staged.select("customer_id", "country").distinct()


def dim_status(staged: DataFrame) -> DataFrame:
    """One row per status with its completed flag."""
    return staged.select("status").distinct().selectExpr(
        "status", *orders.named({"is_completed": orders.COMPLETED_FLAG})
    )


def dim_date(enriched: DataFrame) -> DataFrame:
    """One row per order date; its attributes follow from the date."""
    return enriched.select("order_date").distinct().selectExpr(
        "order_date", *orders.named(orders.CALENDAR)
    )


def dim_amount_bucket(enriched: DataFrame) -> DataFrame:
    """One row per bucket in use with its bounds."""
    low, high = orders.bucket_bounds(F.col("amount_bucket"))
    return enriched.select("amount_bucket").distinct().select(
        "amount_bucket", low.alias("min_amount"), high.alias("max_amount")
    )


def fact_sales(enriched: DataFrame, since: Column | None = None) -> DataFrame:
    """One row per order: keys and amount; from ``since`` on if given."""
    if since is not None:
        enriched = enriched.filter(F.col("order_date") >= since)
    return enriched.select(
        "order_id", "customer_id", "order_date", "status", "amount_bucket", "amount"
    )


def order_count(unique_orders: bool) -> Column:
    """Distinct orders; a plain count says the same where order ids are known unique."""
    return F.count("order_id") if unique_orders else F.count_distinct("order_id")


def active_customers(fact: DataFrame, since: Column) -> DataFrame:
    """Customers with an order from ``since`` on."""
    return fact.filter(F.col("order_date") >= since).select("customer_id").distinct()


def agg_customers(
    fact: DataFrame, statuses: DataFrame, customers: DataFrame,
    as_of=None, only: DataFrame | None = None, unique_orders: bool = False,
) -> DataFrame:
    """Lifetime value, recency, segment and completion per customer.

    ``only`` limits the result to its customers, over their whole history. The
    semi join stands after the aggregate: Spark moves it below by itself when
    ``only`` is small enough to broadcast, and otherwise joins one row per
    customer instead of shuffling orders by a customer who may own a third of
    them. The distinct count spreads each customer over (customer, order) in a
    shuffle of its own; with ``unique_orders`` orders are summed up before the
    only shuffle.
    """
    amount, done = F.col("amount"), F.sum("is_completed")
    per_customer = (
        fact.filter(F.col("customer_id").isNotNull())
        .join(statuses, "status")
        .groupBy("customer_id")
        .agg(
            order_count(unique_orders).alias("total_orders"),
            numbers.money_sum(amount).alias("lifetime_value"),
            numbers.money_avg(amount).alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            done.alias("completed_orders"),
        )
    )
    if only is not None:
        per_customer = per_customer.join(only, "customer_id", "left_semi")
    return _customer_rows(per_customer, customers, as_of)


def _customer_rows(per_customer: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """The rows of the customer mart from each customer's totals."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    first, last = F.col("first_order_date"), F.col("last_order_date")
    total, completed = F.col("total_orders"), F.col("completed_orders")
    # Customers grow with the orders: never collected for a broadcast, whatever their files' size.
    return per_customer.join(customers.hint("merge"), "customer_id").select(
        "customer_id", "country", "total_orders", "lifetime_value", "avg_order_value",
        "first_order_date", "last_order_date",
        F.date_diff(last, first).alias("customer_lifespan_days"),
        "completed_orders",
        (total - completed).alias("non_completed_orders"),
        F.date_diff(today, last).alias("days_since_last_order"),
        orders.customer_segment(total, F.col("lifetime_value")).alias("customer_segment"),
        numbers.percent(completed, total).alias("completion_rate_pct"),
    )


def customer_months(fact: DataFrame) -> DataFrame:
    """What a customer's orders of a month and status add up to, for merging with other months.

    Orders are counted, not told apart: only for a fact whose order ids are unique.
    Status stays a key, as its completed flag may change without the orders.
    """
    return fact.filter(F.col("customer_id").isNotNull()).groupBy(
        "customer_id", order_month("order_date").alias("order_month"), "status").agg(
        F.count(F.lit(1)).alias("orders"), *numbers.money_parts(F.col("amount")),
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))


def order_month(day: str) -> Column:
    """Name of the month that a day is in, as slices of stored tables are named."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def merged_customers(
    months: DataFrame, statuses: DataFrame, customers: DataFrame,
    as_of=None, only: DataFrame | None = None,
) -> DataFrame:
    """The customer mart from ``customer_months``: the same rows as ``agg_customers``.

    A customer brings a row per month and status at most, whatever the number of
    orders, so ``only`` is joined first.
    """
    if only is not None:
        months = months.join(only, "customer_id", "left_semi")
    per_customer = months.join(statuses, "status").groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"), *numbers.merged_parts(),
        F.min("first_day").alias("first_order_date"), F.max("last_day").alias("last_order_date"),
        F.sum(F.col("is_completed") * F.col("orders")).alias("completed_orders"),
    ).withColumns({"lifetime_value": numbers.parts_sum(), "avg_order_value": numbers.parts_avg()})
    return _customer_rows(per_customer, customers, as_of)


DAILY = ["order_date", "country", "total_orders", "revenue", "avg_order_value", "completed_orders"]


def daily_sales(
    fact: DataFrame, statuses: DataFrame, customers: DataFrame, since: Column | None = None,
    unique_orders: bool = False,
) -> DataFrame:
    """Orders, revenue and completions per day and country, from ``since`` on if given.

    Status is a few rows and is broadcast once its size is known; customers, who
    grow with the orders, are joined by shuffle. With
    ``unique_orders`` the orders of a customer and day are summed up, map-side
    first, before they are joined with the customers: the join meets one row per
    customer and day, so a customer with a third of all orders brings it as many
    rows as there are days. Distinct orders cannot be summed up like that; they
    are joined by shuffle, where Spark splits a hot customer, and counted in a
    shuffle on (day, country, order).
    """
    if since is not None:
        fact = fact.filter(F.col("order_date") >= since)
    amount, sold = F.col("amount"), fact.join(statuses, "status")
    if unique_orders:
        days = sold.filter(F.col("customer_id").isNotNull()).groupBy("order_date", "customer_id").agg(
            F.count("order_id").alias("orders"), F.sum("is_completed").alias("completed"),
            *numbers.money_parts(amount))
        totals = days.join(customers.hint("merge"), "customer_id").groupBy("order_date", "country").agg(
            F.sum("orders").alias("total_orders"), F.sum("completed").alias("completed_orders"),
            *numbers.merged_parts())
        return totals.select(
            "order_date", "country", "total_orders", numbers.parts_sum().alias("revenue"),
            numbers.parts_avg().alias("avg_order_value"), "completed_orders")
    return (
        sold.join(customers.hint("merge"), "customer_id")
        .groupBy("order_date", "country")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            numbers.money_sum(amount).alias("revenue"),
            numbers.money_avg(amount).alias("avg_order_value"),
            F.sum("is_completed").alias("completed_orders"),
        )
    )


def kpi_months(stored: DataFrame) -> DataFrame:
    """What the stored days of a country and month add up to, and the last of them."""
    return stored.groupBy("country", order_month("order_date").alias("order_month")).agg(
        *numbers.money_parts(F.col("revenue"), numbers.MONEY_TOTAL), _last_day())


def _last_day() -> Column:
    return F.max_by(F.struct(*DAILY), "order_date").alias("last_day")


def seeds(months: DataFrame) -> DataFrame:
    """One row per country from its ``kpi_months``: its last day, and the total of all its days."""
    merged = months.groupBy("country").agg(
        F.max_by("last_day", "last_day.order_date").alias("last_day"), *numbers.merged_parts())
    return merged.select("last_day.*", "exact", "marks")


def sales_daily_kpi(
    daily: DataFrame, before: DataFrame | None = None, since: Column | None = None
) -> DataFrame:
    """Running total, previous day, rank and growth per day and country.

    With ``before`` (``seeds`` of the stored days before ``since``) the windows run
    over one row for all of a country's earlier days and over the fresh days
    after it, and only the fresh days come out. Windows see one row per day and
    country, never orders.
    """
    days = W.partitionBy("country").orderBy("order_date")
    so_far = days.rowsBetween(W.unboundedPreceding, W.currentRow)
    ranking = W.partitionBy("order_date").orderBy(F.desc_nulls_last("revenue"))
    revenue, total = F.col("revenue"), F.col("total_orders")
    rows = daily.select(*DAILY, numbers.exact(revenue, numbers.MONEY_TOTAL).alias("exact"),
                        numbers.marks(revenue).alias("marks"))
    if before is not None:
        rows = before.select(*rows.columns).unionByName(rows)
    earlier, total_before = F.col("revenue_prev_day"), F.col("orders_prev_day")
    out = rows.select(
        *DAILY,
        numbers.resolved(F.sum("exact").over(so_far), F.bit_or("marks").over(so_far)).alias(
            "revenue_running_total"),
        F.lag("revenue").over(days).alias("revenue_prev_day"),
        F.lag("total_orders").over(days).alias("orders_prev_day"),
        F.rank().over(ranking).alias("country_revenue_rank"),
    ).select(
        "*",
        numbers.growth_percent(revenue, earlier).alias("revenue_growth_pct"),
        numbers.growth_percent(total, total_before).alias("orders_growth_pct"),
    )
    return out if since is None else out.filter(F.col("order_date") >= since)
