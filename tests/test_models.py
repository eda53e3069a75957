"""Full builds of the models on fixtures A and B."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ordertide.operators import checks
from ordertide.plans import models
from ordertide.schema import RAW_ORDERS
from tests.fixtures import A, B, as_set, day, raw_orders


def build(spark, rows, as_of="2025-04-01"):
    raw = raw_orders(spark, rows)
    staged = models.stg_orders(raw)
    enriched = models.int_orders_enriched(staged)
    fact = models.fact_sales(enriched)
    statuses, customers = models.dim_status(staged), models.dim_customer(staged)
    return {
        "raw": raw, "staged": staged, "enriched": enriched, "fact": fact,
        "statuses": statuses, "customers": customers,
        "mart": models.agg_customers(fact, statuses, customers, as_of),
        "kpi": models.sales_daily_kpi(models.daily_sales(fact, statuses, customers)),
    }


@pytest.fixture(scope="module")
def a(spark):
    return build(spark, A)


@pytest.fixture(scope="module")
def b(spark):
    return build(spark, B)


MART = ["customer_id", "country", "total_orders", "lifetime_value", "first_order_date",
        "last_order_date", "customer_lifespan_days", "completed_orders", "non_completed_orders",
        "customer_segment", "completion_rate_pct"]
KPI = ["order_date", "country", "total_orders", "revenue", "completed_orders",
       "revenue_running_total", "revenue_prev_day", "orders_prev_day", "country_revenue_rank",
       "revenue_growth_pct", "orders_growth_pct"]


def dated(month, rows, *places):
    return {tuple(day(f"{month}{v:02d}") if i in places else v for i, v in enumerate(r))
            for r in rows}


def test_small_shop(a):
    assert as_set(a["enriched"], "order_id", "amount_bucket", "week_of_year") == {
        (1, "medium", 1), (2, "medium", 1), (3, "small", 1), (4, "large", 1), (5, "medium", 1)}
    days = dict(as_set(a["enriched"], "order_id", "day_of_week"))
    assert (days[1], days[5]) == (4, 1)
    assert as_set(a["statuses"]) == {("completed", 1), ("cancelled", 0)}
    assert as_set(a["mart"], *MART) == dated("2025-01-", [
        ("C001", "FR", 2, 160.5, 1, 3, 2, 1, 1, "occasional", 50.0),
        ("C002", "FR", 1, 80.0, 2, 2, 0, 1, 0, "one-time", 100.0),
        ("C003", "DE", 1, 220.0, 4, 4, 0, 1, 0, "one-time", 100.0),
        ("C004", "ES", 1, 150.0, 5, 5, 0, 1, 0, "one-time", 100.0),
    ], 4, 5)
    assert as_set(a["kpi"], *KPI) == dated("2025-01-", [
        (1, "FR", 1, 120.5, 1, 120.5, None, None, 1, None, None),
        (2, "FR", 1, 80.0, 1, 200.5, 120.5, 1, 1, -33.61, 0.0),
        (3, "FR", 1, 40.0, 0, 240.5, 80.0, 1, 1, -50.0, 0.0),
        (4, "DE", 1, 220.0, 1, 220.0, None, None, 1, None, None),
        (5, "ES", 1, 150.0, 1, 150.0, None, None, 1, None, None),
    ], 0)


def test_calendar_is_of_type_date(a):
    kinds = dict(a["enriched"].dtypes)
    assert {kinds[c] for c in ("order_year", "order_month", "order_quarter")} == {"date"}
    row = a["enriched"].filter("order_id = 4").first()
    assert (row.order_year, row.order_month, row.order_quarter) == (dt.date(2025, 1, 1),) * 3


def test_iso_week_at_the_turn_of_the_year(spark):
    rows = [(1, "X", "2024-12-30", 1.0, "completed", "FR"), (2, "X", "2021-01-03", 1.0, "completed", "FR")]
    enriched = models.int_orders_enriched(raw_orders(spark, rows))
    assert as_set(enriched, "order_id", "week_of_year") == {(1, 1), (2, 53)}


def test_edge_buckets(b):
    found = dict(as_set(b["enriched"], "order_id", "amount_bucket"))
    by_label = {label: sorted(i for i in found if found[i] == label) for label in set(found.values())}
    assert by_label == {"small": [4, 6, 9, 10, 12], "medium": [1, 2, 3],
                        "large": [13, 14, 15, 16], "premium": [5, 7, 8, 11]}
    weeks = dict(as_set(b["enriched"], "order_id", "week_of_year"))
    assert {weeks[i] for i in (1, 2, 3)} == {9} and {w for i, w in weeks.items() if i > 3} == {10}


def test_not_a_number_is_premium(spark):
    raw = spark.createDataFrame([(1, "X", day("2025-01-01"), math.nan, "completed", "FR")], RAW_ORDERS)
    assert models.int_orders_enriched(raw).first()["amount_bucket"] == "premium"


def test_null_status_has_a_dim_row_but_no_mart_rows(b):
    assert (None, 0) in as_set(b["statuses"])
    assert b["statuses"].count() == 5
    assert "F" not in {r[0] for r in as_set(b["mart"], "customer_id", "country")}


def test_edge_mart(b):
    assert as_set(b["mart"], *MART) == dated("2025-03-", [
        ("A", "FR", 2, 150.0, 1, 1, 0, 1, 1, "occasional", 50.0),
        ("B", "DE", 3, 650.0, 1, 5, 4, 2, 1, "regular", 66.67),
        ("C", "FR", 1, 49.995, 5, 5, 0, 0, 1, "one-time", 0.0),
        ("D", "ES", 2, 2500.0, 5, 5, 0, 2, 0, "vip", 100.0),
        ("E", "DE", 2, 30.0, 6, 6, 0, 1, 1, "occasional", 50.0),
        ("E", "FR", 2, 30.0, 6, 6, 0, 1, 1, "occasional", 50.0),
        ("G", "IT", 1, -5.0, 7, 7, 0, 1, 0, "one-time", 100.0),
        ("H", "FR", 4, 800.0, 8, 9, 1, 3, 1, "loyal", 75.0),
    ], 4, 5)
    average = dict(as_set(b["mart"].filter("country = 'DE'"), "customer_id", "avg_order_value"))
    assert round(average["B"], 4) == 216.6667
    recency = dict(as_set(b["mart"].filter("customer_id = 'H'"), "customer_id", "days_since_last_order"))
    assert recency["H"] == 23


def test_edge_kpi(b):
    assert as_set(b["kpi"], *KPI) == dated("2025-03-", [
        (1, "DE", 1, 150.0, 1, 150.0, None, None, 1, None, None),
        (1, "FR", 2, 150.0, 1, 150.0, None, None, 1, None, None),
        (4, "DE", 1, 0.0, 0, 150.0, 150.0, 1, 1, -100.0, 0.0),
        (5, "DE", 1, 500.0, 1, 650.0, 0.0, 1, 2, None, 0.0),
        (5, "ES", 2, 2500.0, 2, 2500.0, None, None, 1, None, None),
        (5, "FR", 1, 49.995, 0, 199.995, 150.0, 2, 3, -66.67, -50.0),
        (6, "DE", 2, 30.0, 1, 680.0, 500.0, 1, 1, -94.0, 100.0),
        (6, "FR", 2, 30.0, 1, 229.995, 49.995, 1, 1, -39.99, 100.0),
        (7, "IT", 1, -5.0, 1, -5.0, None, None, 1, None, None),
        (8, "FR", 2, 400.0, 2, 629.995, 30.0, 2, 1, 1233.33, 0.0),
        (9, "FR", 2, 400.0, 1, 1029.995, 400.0, 2, 1, 0.0, 0.0),
    ], 0)


def test_all_null_revenue_ranks_last(spark):
    rows = [(1, "X", "2025-01-01", None, "completed", "FR"), (2, "Y", "2025-01-01", -3.0, "completed", "DE")]
    kpi = build(spark, rows)["kpi"]
    assert as_set(kpi, "country", "revenue", "avg_order_value", "country_revenue_rank") == {
        ("DE", -3.0, -3.0, 1), ("FR", None, None, 2)}


def test_repeated_order_id_counts_once_and_its_amounts_add_up(spark):
    rows = [(1, "X", "2025-01-01", 10.0, "completed", "FR"), (1, "X", "2025-01-01", 5.0, "pending", "FR")]
    built = build(spark, rows)
    assert as_set(built["mart"], "total_orders", "lifetime_value", "completed_orders") == {(1, 15.0, 1)}
    assert as_set(built["kpi"], "total_orders", "revenue") == {(1, 15.0)}


@pytest.mark.parametrize("rows", [A, B])
def test_plain_count_is_the_distinct_count_of_unique_orders(spark, rows):
    b = build(spark, rows)
    star = b["fact"], b["statuses"], b["customers"]
    assert as_set(models.agg_customers(*star, "2025-04-01", unique_orders=True)) == as_set(b["mart"])
    daily = models.daily_sales(*star, unique_orders=True)
    assert as_set(models.sales_daily_kpi(daily)) == as_set(b["kpi"])


def test_sums_do_not_depend_on_row_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 49.99] * 200
    rows = [(i, "X", "2025-01-01", a, "completed", "FR") for i, a in enumerate(amounts)]
    one = build(spark, rows)["mart"].first()["lifetime_value"]
    other = build(spark, sorted(rows, key=lambda r: r[3]))["mart"].first()["lifetime_value"]
    assert one == other == 10118.0


def test_checks_on_edges(b):
    assert as_set(checks.customers_without_mart(b["fact"], b["mart"])) == {("F",)}
    assert as_set(checks.duplicates(b["mart"], "customer_id")) == {("E", 2)}
    assert as_set(checks.negative_amounts(b["fact"])) == {(12, -5.0)}
    assert checks.value_mismatches(checks.expected_values(b["fact"]), b["mart"]).count() == 0
    # Italy's first total is negative, but no total falls.
    assert checks.falling_totals(b["kpi"]).count() == 0
    assert checks.null_rows(b["fact"], "amount").count() == 1
    assert checks.duplicates(b["statuses"], "status").count() == 0


@pytest.mark.parametrize("now, status", [
    ("2025-01-05 12:00", "pass"), ("2025-01-06 00:00", "pass"), ("2025-01-06 06:00", "warn"),
    ("2025-01-07 00:00", "warn"), ("2025-01-07 06:00", "error"),
])
def test_freshness(a, now, status):
    assert checks.freshness(a["raw"], "order_date", now).first()["status"] == status


def test_freshness_of_nothing_is_an_error(a):
    assert checks.freshness(a["raw"].filter("1 = 0"), "order_date", "2025-01-05").first()["status"] == "error"


def test_bucket_dim_lists_only_buckets_in_use(a):
    dim = models.dim_amount_bucket(a["enriched"])
    assert dict(dim.dtypes) == {"amount_bucket": "string", "min_amount": "int", "max_amount": "decimal(5,2)"}
    assert {(n, lo, None if hi is None else float(hi)) for n, lo, hi in as_set(dim)} == {
        ("small", 0, 49.99), ("medium", 50, 199.99), ("large", 200, 499.99)}
