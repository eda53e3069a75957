"""Sums that do not depend on row order, and guarded ratios."""

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"
MONEY_TOTAL = "decimal(28,4)"


def is_special(amount: Column) -> Column:
    """NaN or infinite, which no decimal can hold."""
    return F.isnan(amount) | (F.abs(amount) == float("inf"))


# Which special values were added, as bits.
NAN, UP, DOWN = 1, 2, 4


def exact(amount: Column, kind: str = MONEY) -> Column:
    """The amount as a decimal, NULL for special values."""
    return F.when(~is_special(amount), amount.cast(kind))


def marks(amount: Column) -> Column:
    """The bit of a special value, NULL for all others."""
    return F.when(is_special(amount), F.when(F.isnan(amount), NAN).when(amount > 0, UP).otherwise(DOWN))


def resolved(total: Column, found: Column) -> Column:
    """The exact total as a double, unless special values were added: then what doubles give."""
    return (
        F.when(found.isNull(), total.cast("double")).when(found == UP, float("inf"))
        .when(found == DOWN, -float("inf")).otherwise(float("nan"))
    )


def money_parts(amount: Column, kind: str = MONEY) -> list[Column]:
    """Aggregates exact, marks and valued of some rows, to be merged with those of others."""
    return [F.sum(exact(amount, kind)).alias("exact"), F.bit_or(marks(amount)).alias("marks"),
            F.count(amount).alias("valued")]


def merged_parts() -> list[Column]:
    """The same three of several groups, from theirs."""
    return [F.sum("exact").alias("exact"), F.bit_or("marks").alias("marks"), F.sum("valued").alias("valued")]


def parts_sum() -> Column:
    """The total that merged parts stand for."""
    return resolved(F.col("exact"), F.col("marks"))


def parts_avg() -> Column:
    """Their total over the count of non-NULL amounts; NULL when there is none."""
    return parts_sum() / F.when(F.col("valued") > 0, F.col("valued"))


def money_sum(amount: Column) -> Column:
    """Exact sum as a double: amounts are added as decimals, so any partitioning gives one result.

    NaN and infinite amounts only leave a mark, which decides the result if there
    is one: it is what the sum of doubles would be.
    """
    return resolved(F.sum(exact(amount)), F.bit_or(marks(amount)))


def money_avg(amount: Column) -> Column:
    """Exact sum over the count of non-NULL amounts; NULL when there is none.

    Guarded by ``when``: ``nullif`` inside an aggregate keeps Spark from moving
    a semi join below it.
    """
    count = F.count(amount)
    return money_sum(amount) / F.when(count > 0, count)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 at two decimals; NULL when whole is 0."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, 2)


def growth_percent(now: Column, before: Column) -> Column:
    """Change against ``before`` in percent at two decimals; NULL when it is 0."""
    return percent(now - before, before)
