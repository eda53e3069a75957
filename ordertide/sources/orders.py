"""Sources of raw orders: CSV files, and the sales tables of a star schema."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ordertide.schema import RAW_ORDERS


# What a number or a date must look like as a whole; a cast alone reads "2024" as a day.
PATTERNS = {
    "bigint": r"[+-]?\d+",
    "double": r"(?i)[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)",
    "date": r"\d{4}-\d{1,2}-\d{1,2}",
}


def _required(name: str, kind: str) -> Column:
    text = F.col(name)
    whole = F.regexp(F.trim(text), F.lit(f"^(?:{PATTERNS[kind]})$"))
    value = F.when(whole, F.trim(text).try_cast(kind))
    problem = F.concat(F.lit(f"raw orders: bad {name}: "), F.coalesce(text, F.lit("(empty)")))
    return F.when(value.isNull(), F.raise_error(problem).cast(kind)).otherwise(value)


def load_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw orders from UTF-8 CSV with a header row; columns are found by name.

    Text that is no number or date fails the load, an empty one too. Other
    empty cells stay empty text. All files need the same header. ``multiline``
    allows line breaks inside quotes but makes each file one task, so it is off.
    """
    cells = spark.read.csv(
        path, header=True, inferSchema=False, encoding="UTF-8", quote='"', escape='"',
        mode="FAILFAST", multiLine=multiline, enforceSchema=False,
    )
    return cells.select(*[
        (F.coalesce(F.col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType)
         else _required(f.name, f.dataType.simpleString())).alias(f.name)
        for f in RAW_ORDERS.fields
    ])


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders derived from the orders, customer and nation tables of ``folder``.

    Every 997th order gets a NULL id so that staging has rows to drop. Customer
    is joined by shuffle at scale; nation is broadcast only while its file size
    is below the session's threshold.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    closed = F.when(key % 2 == 0, "cancelled").otherwise("returned")
    cents = F.floor(F.col("o_totalprice") / 5).cast("bigint") / F.lit(100.0)
    people = table("customer").join(
        table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "n_name")
    return table("orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(key % 997 != 0, key).alias("order_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        cents.cast("decimal(18,2)").cast("double").alias("amount"),
        F.when(state == "F", "completed").when(state == "O", "pending")
        .when(state == "P", closed).alias("status"),
        F.col("n_name").alias("country"),
    )
