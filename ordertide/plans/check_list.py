"""The checks that belong to each table, and their run over built tables."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordertide import fixed_values as V
from ordertide.functions.orders import ENRICHMENT
from ordertide.operators import checks as Q
from ordertide.sources.scratch import settle

# Columns of each table that must not be NULL.
NOT_NULL = {
    "stg_orders": ["order_id", "customer_id", "order_date", "amount", "status", "country"],
    "stg_orders_cdc": ["order_id", "customer_id", "order_date", "amount", "status", "country",
                       "_cdc_action", "_loaded_at"],
    "int_orders_enriched": ["order_id", "customer_id", "order_date", "amount", "status",
                            "country", "is_completed"],
    "dim_customer": ["customer_id", "country"],
    "dim_date": ["order_date"],
    "dim_status": ["status", "is_completed"],
    "dim_amount_bucket": ["amount_bucket"],
    "fact_sales": ["order_id", "customer_id", "order_date", "status", "amount_bucket", "amount"],
    "agg_customers": ["customer_id", "total_orders", "lifetime_value", "avg_order_value",
                      "first_order_date", "last_order_date"],
    "sales_daily_kpi": ["order_date", "country", "total_orders", "revenue", "avg_order_value"],
}

# Columns that hold each value once.
UNIQUE = {
    "stg_orders": ["order_id"],
    "stg_orders_cdc": ["order_id"],
    "int_orders_enriched": ["order_id"],
    "dim_customer": ["customer_id"],
    "dim_date": ["order_date"],
    "dim_status": ["status"],
    "dim_amount_bucket": ["amount_bucket"],
    "fact_sales": ["order_id"],
    "agg_customers": ["customer_id"],
}

# Columns with a closed list of values.
_BUCKETS = [label for label, *_ in V.AMOUNT_BUCKETS]
ACCEPTED = {
    "stg_orders": {"status": V.STATUSES},
    "stg_orders_cdc": {
        "status": V.STATUSES,
        "_cdc_action": [V.INITIAL_LOAD, V.INSERT, V.UPDATE, V.DELETE],
    },
    "int_orders_enriched": {
        "status": V.STATUSES, "amount_bucket": _BUCKETS, "is_completed": [0, 1],
    },
    "dim_status": {"status": V.STATUSES, "is_completed": [0, 1]},
    "dim_amount_bucket": {"amount_bucket": _BUCKETS},
    "fact_sales": {"status": V.STATUSES},
    "agg_customers": {"customer_segment": V.SEGMENTS},
}

# Columns with a lowest and maybe a highest value.
BETWEEN = {
    "stg_orders": {"amount": (0, None)},
    "stg_orders_cdc": {"amount": (0, None)},
    "int_orders_enriched": {"amount": (0, None)},
    "fact_sales": {"amount": (0, None)},
    "agg_customers": {"total_orders": (1, None), "lifetime_value": (0, None),
                      "completion_rate_pct": (0, 100)},
    "sales_daily_kpi": {"total_orders": (1, None), "revenue": (0, None)},
}

# Foreign keys of the fact table as column -> parent table.
PARENTS = {
    "customer_id": "dim_customer",
    "order_date": "dim_date",
    "status": "dim_status",
    "amount_bucket": "dim_amount_bucket",
}

# Columns of a given type.
TYPES = {"stg_orders": {"order_date": "date"}}


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row at a time."""

    column: str
    name: str
    fails: Column


def row_checks(table: str, derived: dict[str, str] | None = None) -> list[RowCheck]:
    """All checks of a table that one pass over it can answer.

    ``derived`` gives expressions for columns that the rows at hand do not have.
    """
    def value(column: str) -> Column:
        return F.expr((derived or {}).get(column, f"`{column}`"))

    found = [RowCheck(c, "not_null", value(c).isNull()) for c in NOT_NULL.get(table, [])]
    for column, values in ACCEPTED.get(table, {}).items():
        found.append(RowCheck(column, "accepted_values", Q.is_unaccepted(value(column), values)))
    for column, (low, high) in BETWEEN.get(table, {}).items():
        found.append(RowCheck(column, "between", Q.is_outside(value(column), low, high)))
    if table == "fact_sales":
        found.append(RowCheck("amount", "not_negative", value("amount") < 0))
    return found


def watched(table: str) -> dict[str, Column]:
    """Row checks to count while a table is written, by ``place``.

    Raw orders answer for the two views that show their rows with an id.
    """
    if table != "orders":
        return {place(table, c): c.fails for c in row_checks(table)}
    shown = F.col("order_id").isNotNull()
    return {place(view, c): shown & c.fails
            for view, derived in (("stg_orders", {}), ("int_orders_enriched", ENRICHMENT))
            for c in row_checks(view, derived)}


def place(table: str, check: RowCheck) -> str:
    return f"{table}.{check.column}.{check.name}"


def _result(table: str, column: str, check: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count("*").alias("failing_rows")).select(
        F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.lit(check).alias("check"), "failing_rows",
    )


def _counted(spark: SparkSession, found: list[tuple[str, str, str, int]]) -> DataFrame:
    """Results already known: table, column, check and failing rows."""
    entries = F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(column).alias("column"),
                 F.lit(check).alias("check"), F.lit(failing).cast("long").alias("failing_rows"))
        for table, column, check, failing in found
    ])
    return spark.range(1).select(F.inline(entries))


def _row_results(table: str, df: DataFrame) -> DataFrame:
    """The row checks of a table in one pass over it."""
    found = row_checks(table)
    counts = df.agg(*[F.count_if(c.fails).alias(f"n{i}") for i, c in enumerate(found)])
    entries = F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(c.column).alias("column"),
                 F.lit(c.name).alias("check"), F.col(f"n{i}").alias("failing_rows"))
        for i, c in enumerate(found)
    ])
    return counts.select(F.inline(entries))


def run_checks(
    tables: dict[str, DataFrame], repeats: dict[tuple[str, str], int] | None = None,
    failing: dict[str, int] | None = None,
) -> DataFrame:
    """One row per check over built tables.

    ``repeats`` holds the repeated values of (table, column) already counted, and
    ``failing`` the rows that fail row checks (``watched``), counted while the
    tables were written. Of a table that is in neither the row checks share one
    pass, and uniqueness is an aggregate per key.

    Of the fact table all cross-table rules need only its customers with their
    sums and its distinct dates, statuses and buckets; both are made once and
    settled. Pass tables that are stored (or settled).
    """
    repeats, failing = repeats or {}, failing or {}
    known = [(*at, "unique", found) for at, found in repeats.items()]
    results = []
    for name, df in tables.items():
        checks = row_checks(name)
        if all(place(name, c) in failing for c in checks):
            known += [(name, c.column, c.name, failing[place(name, c)]) for c in checks]
        else:
            results.append(_row_results(name, df))
    if known:
        results.append(_counted(tables["fact_sales"].sparkSession, known))
    for name, columns in UNIQUE.items():
        for c in columns:
            if name in tables and (name, c) not in repeats:
                results.append(_result(name, c, "unique", Q.duplicates(tables[name], c)))
    for name, kinds in TYPES.items():
        results.append(Q.column_types(tables[name], kinds).select(
            F.lit(name).alias("table"), F.col("column_name").alias("column"),
            F.lit("type").alias("check"), "failing_rows",
        ))
    fact, mart, kpi = (tables[n] for n in ("fact_sales", "agg_customers", "sales_daily_kpi"))
    spent = settle(Q.expected_values(fact))
    members = settle(fact.select(*[c for c in PARENTS if c != "customer_id"]).distinct())
    for column, parent in PARENTS.items():
        child = spent if column == "customer_id" else members
        lost = Q.orphans(child, column, tables[parent], column)
        results.append(_result("fact_sales", column, "relationship", lost))
    results += [
        _result("agg_customers", "lifetime_value", "equals_sum_of_orders",
                Q.value_mismatches(spent, mart)),
        _result("sales_daily_kpi", "revenue_running_total", "never_falls", Q.falling_totals(kpi)),
        _result("sales_daily_kpi", "order_date, country", "unique_grain",
                Q.repeated_values(kpi, ["order_date", "country"])),
        _result("fact_sales", "customer_id", "has_customer_mart",
                Q.customers_without_mart(spent, mart)),
    ]
    return reduce(DataFrame.unionByName, results).select(
        "table", "column", "check",
        F.when(F.col("failing_rows") == 0, "pass").otherwise("error").alias("status"),
        "failing_rows",
    )
