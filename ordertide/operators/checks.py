"""Data-quality operators: each returns what fails, so no rows means pass."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ordertide.fixed_values import ERROR_AFTER_HOURS, VALUE_TOLERANCE, WARN_AFTER_HOURS
from ordertide.functions.numbers import is_special, money_sum


def is_unaccepted(value: Column, accepted: list) -> Column:
    """True for a value outside the list; NULL is not judged."""
    return ~value.isin(*accepted)


def is_outside(value: Column, low=None, high=None) -> Column:
    """True below ``low`` or above ``high``, bounds allowed, and for NaN and infinite values.

    NULL is not judged.
    """
    below = value < low if low is not None else F.lit(False)
    above = value > high if high is not None else F.lit(False)
    return below | above | is_special(value.cast("double"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values, or value combinations, held by more than one row."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values held by more than one row."""
    return repeated_values(df.filter(F.col(column).isNotNull()), [column])


def unaccepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values outside the list with their row counts."""
    bad = df.filter(is_unaccepted(F.col(column), accepted))
    return bad.groupBy(column).agg(F.count("*").alias("row_count"))


def rows_outside(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows whose value lies outside the bounds."""
    return df.filter(is_outside(F.col(column), low, high))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values with no parent; distinct first, so hot values collapse early.

    Distinct values are shuffled by value already, so merging them takes no more
    shuffles, and no broadcast brings as many as there are customers to the driver.
    """
    values = child.filter(F.col(column).isNotNull()).select(column).distinct()
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return values.join(known.hint("merge"), column, "left_anti")


def column_types(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Expected and actual type of columns, with the number of rows held in the wrong type."""
    actual = dict(df.dtypes)
    if all(actual.get(name) == kind for name, kind in expected.items()):
        rows = df.sparkSession.range(1).select(F.lit(0).alias("n"))  # no row is in a wrong type
    else:
        rows = df.agg(F.count("*").alias("n"))
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("expected_type"),
            F.lit(actual.get(name)).alias("actual_type"),
        )
        for name, kind in expected.items()
    ])
    wrong = ~F.col("actual_type").eqNullSafe(F.col("expected_type"))
    return rows.select("n", F.inline(entries)).select(
        "column_name", "expected_type", "actual_type",
        F.when(wrong, F.col("n")).otherwise(0).cast("long").alias("failing_rows"),
    )


def expected_values(fact: DataFrame) -> DataFrame:
    """One row per customer with orders, a NULL id included: the sum of their amounts."""
    return fact.groupBy("customer_id").agg(money_sum(F.col("amount")).alias("expected_ltv"))


def value_mismatches(expected: DataFrame, customers: DataFrame,
                     tolerance: float = VALUE_TOLERANCE) -> DataFrame:
    """Customers whose lifetime value is not the sum of their orders (``expected_values``)."""
    actual = customers.select("customer_id", F.col("lifetime_value").alias("actual_ltv"))
    gap = F.abs(F.col("expected_ltv") - F.col("actual_ltv"))
    return expected.join(actual.hint("merge"), "customer_id").withColumn("delta", gap).filter(
        F.col("delta") > tolerance
    )


def falling_totals(kpi: DataFrame) -> DataFrame:
    """Days on which a country's running total is below that of the day before."""
    days = W.partitionBy("country").orderBy("order_date")
    return kpi.select(
        "order_date", "country",
        F.lag("revenue_running_total").over(days).alias("prev_running_total"),
        "revenue_running_total",
    ).filter(F.col("revenue_running_total") < F.col("prev_running_total"))


def negative_amounts(fact: DataFrame) -> DataFrame:
    """Orders with a negative amount."""
    return fact.filter(F.col("amount") < 0).select("order_id", "amount")


def customers_without_mart(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with orders but no row in the customer mart; a NULL id is one too."""
    ids = fact.select("customer_id").distinct()
    return ids.join(customers.select("customer_id").hint("merge"), "customer_id", "left_anti")


def freshness(source: DataFrame, column: str, now) -> DataFrame:
    """Age of the newest value and its status; a table without one is an error."""
    newest = F.max(F.col(column).cast("timestamp_ntz"))
    moment = F.lit(now).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("newest"), moment) / 3600
    return source.agg(newest.alias("newest")).withColumn("age_hours", age).withColumn(
        "status",
        F.when(F.col("age_hours") <= WARN_AFTER_HOURS, "pass")
        .when(F.col("age_hours") <= ERROR_AFTER_HOURS, "warn")
        .otherwise("error"),
    )
