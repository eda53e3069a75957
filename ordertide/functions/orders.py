"""Derived order and customer attributes, all built from native functions.

Order attributes are SQL expressions over the columns of a staged order, so the
same text serves DataFrames and the stored views.
"""

from pyspark.sql import Column, functions as F

from ordertide import fixed_values as V

# 1 = Sunday … 7 = Saturday; ISO weeks.
CALENDAR = {
    "order_year": "trunc(order_date, 'year')",
    "order_month": "trunc(order_date, 'month')",
    "order_quarter": "trunc(order_date, 'quarter')",
    "day_of_week": "dayofweek(order_date)",
    "week_of_year": "weekofyear(order_date)",
}

# 1 for completed orders, else 0 (also for NULL).
COMPLETED_FLAG = f"int(status <=> '{V.COMPLETED}')"


def _bucket_of_amount() -> str:
    steps = " ".join(
        f"WHEN amount < {below} THEN '{name}'"
        for name, below, _, _ in V.AMOUNT_BUCKETS if below is not None
    )
    return f"CASE {steps} ELSE '{V.AMOUNT_BUCKETS[-1][0]}' END"


# NULL and NaN fall through to the open-ended bucket.
AMOUNT_BUCKET = _bucket_of_amount()

ENRICHMENT = {**CALENDAR, "amount_bucket": AMOUNT_BUCKET, "is_completed": COMPLETED_FLAG}


def named(expressions: dict[str, str]) -> list[str]:
    """The expressions with their names, for selectExpr or a view."""
    return [f"{text} AS {name}" for name, text in expressions.items()]


def bucket_bounds(label: Column) -> tuple[Column, Column]:
    """Lowest and highest amount of a bucket; the open-ended one has no highest."""
    lows = [F.when(label == name, low) for name, _, low, _ in V.AMOUNT_BUCKETS]
    highs = [
        F.when(label == name, F.lit(high).cast("decimal(5,2)"))
        for name, _, _, high in V.AMOUNT_BUCKETS
    ]
    return F.coalesce(*lows), F.coalesce(*highs)


def customer_segment(orders: Column, value: Column) -> Column:
    """Segment by order count and lifetime value; the first match wins."""
    few = orders <= V.OCCASIONAL_MAX_ORDERS
    return (
        F.when(orders == 1, "one-time")
        .when(few & (value < V.LOYAL_MIN_VALUE), "occasional")
        .when(~few & (value >= V.LOYAL_MIN_VALUE), "loyal")
        .when(value >= V.VIP_MIN_VALUE, "vip")
        .otherwise("regular")
    )
