"""What the plans must look like: no pair joins, no Python, pruned scans, split hot keys."""

import contextlib
import datetime as dt
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter, functions as F

import __spark_entry__ as entry
from ordertide.operators import changes, checks, history, upsert
from ordertide.plans import models
from ordertide.sources.scratch import settle
from ordertide.sources.tables import BY_MONTH, Table
from tests.comparing import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
T1, T2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


@contextlib.contextmanager
def settings(spark, **values):
    """Session settings for a while; names with "__" for dots."""
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """200,000 stored orders; one customer has a third of them."""
    n = F.xxhash64("id")
    path = str(tmp_path_factory.mktemp("shop") / "orders")
    spark.range(200_000, numPartitions=8).select(
        F.col("id").alias("order_id"),
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), F.pmod(n, F.lit(20_000)))).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        (F.pmod(n, F.lit(90_000)) / 100).alias("amount"),
        F.when(n % 2 == 0, "completed").otherwise("pending").alias("status"),
        F.concat(F.lit("N"), F.pmod(n, F.lit(20))).alias("country"),
    ).write.parquet(path)
    return spark.read.parquet(path)


BIG = dict(spark__sql__autoBroadcastJoinThreshold="8k",
           spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
           spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
           spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
           spark__sql__shuffle__partitions="16")


@pytest.fixture
def written(monkeypatch):
    """Plans of everything that is written: settled rows, slices of stored tables, feeds."""
    plans, write = [], DataFrameWriter.parquet

    def record(writer, *args, **more):
        plans.append(plan(writer._df))
        return write(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    return plans


@pytest.mark.parametrize("name", list(entry.order_queries()))
def test_no_pair_joins_and_no_python(spark, name, written):
    last = plan(entry.order_queries()[name](spark, FOLDER))
    for text in [*written, last]:
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "MapPartitions"):
            assert node not in text


def test_scans_read_only_what_they_need(spark, shop):
    staged = models.stg_orders(shop)
    text = plan(models.dim_customer(staged))
    assert re.findall(r"ReadSchema: struct<(.*?)>", text) == ["order_id:bigint,customer_id:string,country:string"]
    assert "IsNotNull(order_id)" in text


def star(shop):
    staged = models.stg_orders(shop)
    fact = models.fact_sales(models.int_orders_enriched(staged))
    return fact, settle(models.dim_status(staged)), settle(models.dim_customer(staged))


def test_daily_sales_broadcast_status_and_split_the_hot_customer(spark, shop):
    fact, statuses, customers = star(shop)
    expected = {tuple(r) for r in models.daily_sales(fact, statuses, customers).collect()}
    with settings(spark, **BIG):
        daily = models.daily_sales(fact, statuses, customers)
        text = final_plan(daily)
        assert {tuple(r) for r in daily.collect()} == expected
    assert text.count("BroadcastHashJoin") == 1
    assert "SortMergeJoin(skew=true)" in text


def test_customers_meet_one_row_per_customer_and_day(spark, shop):
    """With unique ids orders are summed up before the join, map-side first."""
    fact, statuses, customers = star(shop)
    expected = {tuple(r) for r in models.daily_sales(fact, statuses, customers).collect()}
    with settings(spark, **BIG):
        daily = models.daily_sales(fact, statuses, customers, unique_orders=True)
        text = final_plan(daily)
        assert {tuple(r) for r in daily.collect()} == expected
    join = text.index("SortMergeJoin")
    below = text[join:]
    summed = below.index("HashAggregate(keys=[order_date")
    assert "partial_sum" in below[summed:] and "customer_id" in below[summed:].split("\n")[0]
    rows = fact.filter("customer_id = 'hot'").groupBy("order_date").count()
    assert rows.count() == 300 and rows.agg(F.sum("count")).first()[0] > 60_000


def test_customers_without_id_and_of_two_countries(spark):
    day = "date_add(DATE'2025-01-01', int(id % 2))"
    fact = spark.range(12).selectExpr(
        "id AS order_id", "IF(id % 4 = 3, NULL, 'C' || id % 3) AS customer_id", f"{day} AS order_date",
        "IF(id = 5, NULL, IF(id = 6, double('NaN'), id + 0.125)) AS amount", "IF(id % 5 = 4, NULL, 'x') AS status")
    statuses = spark.createDataFrame([("x", 1)], "status string, is_completed int")
    customers = spark.createDataFrame([("C0", "FR"), ("C0", "DE"), ("C1", "FR"), (None, "ES"), ("C2", None)],
                                      "customer_id string, country string")
    eager, plain = (models.daily_sales(fact, statuses, customers, unique_orders=u) for u in (True, False))
    assert eager.dtypes == plain.dtypes
    rows = sorted(map(str, eager.collect()))
    assert rows == sorted(map(str, plain.collect())) and len(rows) > 4 and "nan" in str(rows)


def test_customer_mart_spreads_a_customer_over_orders(spark, shop):
    fact, statuses, customers = star(shop)
    with settings(spark, **BIG):
        text = plan(models.agg_customers(fact, statuses, customers, "2025-01-01"))
    spread = re.search(r"Exchange hashpartitioning\(customer_id#\d+, order_id#\d+L, 16\)", text)
    assert spread, text


def semi_join_depth(text):
    """Position of the semi join relative to the shuffle by customer and order."""
    shuffle = re.search(r"Exchange hashpartitioning\(customer_id#\d+, order_id", text).start()
    return text.index("LeftSemi") > shuffle


def test_few_active_customers_cut_the_scan_and_many_the_result(spark, shop):
    fact, statuses, customers = star(shop)
    only = settle(fact.select("customer_id").distinct().limit(50))
    with settings(spark, **BIG):
        text = plan(models.agg_customers(fact, statuses, customers, "2025-01-01", only))
    assert semi_join_depth(text)
    many = settle(fact.select("customer_id").distinct())
    with settings(spark, **BIG):
        text = plan(models.agg_customers(fact, statuses, customers, "2025-01-01", many))
    assert not semi_join_depth(text)


def test_feed_shuffles_both_states_once(spark, shop):
    new = shop.withColumn("status", F.when(F.col("order_id") % 50 == 1, "x").otherwise(F.col("status")))
    with settings(spark, **BIG):
        text = final_plan(changes.change_feed(shop, new, "order_id"))
    assert "ReusedExchange" in text


def test_events_are_read_and_folded_once(spark, shop, monkeypatch):
    group = F.col("order_id") % 1000
    feed = settle(changes.change_feed(shop.filter(group != 0), shop.filter(group != 2), "order_id"))
    plans, write = [], DataFrameWriter.parquet

    def record(writer, *args, **more):
        plans.append(final_plan(writer._df))
        return write(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    net = settle(changes.net_changes(feed, "order_id"))
    assert sum(len(re.findall(r"FileScan parquet \[[^]]*_action#", p)) for p in plans) == 1
    assert net.groupBy("_action").count().orderBy("_action").collect() == [("DELETE", 200), ("INSERT", 200)]


def test_small_changes_leave_the_target_unshuffled(spark, shop):
    target = changes.initial_load(shop, T1)
    net = settle(changes.net_changes(changes.change_feed(
        shop, shop.filter("order_id <> 7"), "order_id"), "order_id"))
    merged = changes.merge_changes(target, net, "order_id", T2)
    assert "Exchange hashpartitioning" not in plan(merged)
    replaced = upsert.upsert(shop, settle(shop.filter("order_id < 100")), ["order_id"])
    assert "Exchange hashpartitioning" not in plan(replaced)
    first = settle(history.scd2_apply(None, shop, "order_id", ["status", "amount"], T1))
    second = history.scd2_apply(first, shop.filter("order_id <> 7"), "order_id", ["status", "amount"], T2)
    assert "Exchange hashpartitioning" not in plan(second)


def hot(shop):
    """The hot customer's orders become copies of one key."""
    mine = F.col("customer_id") == "hot"
    return shop.select(
        F.when(mine, -1).otherwise(F.col("order_id")).alias("order_id"), "customer_id", "order_date",
        F.when(~mine, F.col("amount")).alias("amount"), F.when(~mine, F.col("status")).alias("status"),
        F.col("order_id").cast("string").alias("country"))


def test_hot_keys_are_split_and_stay_whole(spark, shop):
    old = settle(hot(shop))
    copies = old.filter("order_id = -1").count()
    new = old.withColumn("status", F.when(F.col("order_id") % 7 == 1, "returned").otherwise(F.col("status")))
    with settings(spark, **BIG):
        feed = settle(changes.change_feed(old, new, "order_id"))
        merged = changes.merge_changes(
            changes.initial_load(old, T1), settle(changes.net_changes(feed, "order_id")), "order_id", T2)
        assert "skew=true" in final_plan(merged)
        assert merged.count() == old.count() and merged.filter("order_id = -1").count() == copies
        updates = settle(new.filter("order_id > 50000"))
        replaced = upsert.upsert(old, updates, ["order_id"])
        assert "skew=true" in final_plan(replaced)
        assert replaced.count() == old.count()
        first = settle(history.scd2_apply(None, old, "order_id", ["status", "amount"], T1))
        second = history.scd2_apply(first, new, "order_id", ["status", "amount"], T2)
        assert "skew=true" in final_plan(second)
        assert history.state_at(second, T2).count() == old.count()


def test_feed_splits_a_hot_key(spark, shop):
    """A third of the rows, all different, belong to one key that changes as a whole."""
    old = settle(hot(shop))
    new = settle(old.withColumn("amount", F.coalesce("amount", F.lit(1.0)) + 1))
    with settings(spark, **BIG):
        feed = changes.change_feed(old, new, "order_id")
        assert "skew=true" in final_plan(feed)
        assert feed.count() == 2 * old.count()


def test_customers_are_never_broadcast(spark, shop):
    """A table of customers grows with the orders; a broadcast would bring it to the driver."""
    staged, since = models.stg_orders(shop), F.lit("2024-03-01").cast("date")
    fact = models.fact_sales(models.int_orders_enriched(staged))
    statuses, people = settle(models.dim_status(staged)), settle(models.dim_customer(staged))
    months, active = settle(models.customer_months(fact)), models.active_customers(fact, since)
    mart, spent = settle(models.merged_customers(months, statuses, people)), settle(checks.expected_values(fact))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="100m"):
        for df, small in ((models.daily_sales(fact, statuses, people, unique_orders=True), 1),
                          (models.daily_sales(fact, statuses, people), 1),
                          (models.merged_customers(months, statuses, people), 1),
                          (models.merged_customers(months, statuses, people, only=settle(active)), 2),
                          (models.agg_customers(fact, statuses, people), 1),
                          (checks.orphans(spent, "customer_id", people, "customer_id"), 0),
                          (checks.value_mismatches(spent, mart), 0),
                          (checks.customers_without_mart(spent, mart), 0)):
            assert final_plan(df).count("BroadcastHashJoin") == small


def test_types_are_checked_without_a_scan(spark, shop):
    right = checks.column_types(shop, {"order_id": "bigint", "amount": "double"})
    assert "FileScan" not in plan(right) and {r.failing_rows for r in right.collect()} == {0}
    wrong = checks.column_types(shop, {"order_id": "int"})
    assert [r.failing_rows for r in wrong.collect()] == [200_000]


def test_date_bound_prunes_folders_and_reaches_the_scan(spark, shop, tmp_path):
    table = Table(spark, str(tmp_path), BY_MONTH)
    table.replace(shop)
    day = dt.date(2024, 9, 20)
    rows = models.fact_sales(models.int_orders_enriched(table.read_from(day)), F.lit(day))
    months = {re.search(r"slice=([\d-]+)", f).group(1) for f in rows.inputFiles()}
    assert months == {"2024-09", "2024-10"}
    assert "GreaterThanOrEqual(order_date,2024-09-20)" in plan(rows)
    newest = {os.path.basename(os.path.dirname(f)) for f in table.read_newest().inputFiles()}
    assert newest == {"slice=2024-10"}


def test_month_files_are_sorted_by_day(spark, shop, tmp_path):
    table, copy = (Table(spark, f"{tmp_path}/{n}", BY_MONTH) for n in ("t", "copy"))
    table.replace(shop)
    assert copy.replace(table.read(), clustered=True) == 200_000
    for stored in (table, copy):
        files = stored.read().inputFiles()
        assert len(files) <= 20
        for file in files:
            days = pq.read_table(file.replace("file://", ""), columns=["order_date"])["order_date"].to_pylist()
            assert days == sorted(days)


def test_scalar_bound_is_one_subquery(spark, shop):
    fact, _, _ = star(shop)
    since = models.lookback_start(fact, "order_date")
    rows = fact.filter(F.col("order_date") >= since)
    text = final_plan(rows)
    assert "Subquery" in text and "Join" not in text


def test_a_large_month_is_written_as_several_files(spark, shop, tmp_path):
    table = Table(spark, str(tmp_path), "'all'")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200k"):
        table.replace(shop)
    assert len(table.read().inputFiles()) > 3
