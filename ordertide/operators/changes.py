"""Change feed between two states of a table, its net effect, and the merge."""

from pyspark.sql import DataFrame, functions as F

from ordertide.fixed_values import DELETE, INITIAL_LOAD, INSERT, UPDATE
from ordertide.schema import FEED_COLUMNS
from ordertide.sources.scratch import settle

FEED = [f.name for f in FEED_COLUMNS]
MARKS = ["_cdc_action", "_loaded_at"]


def change_feed(old: DataFrame, new: DataFrame, key: str, first_seq: int = 0,
                unchanged: DataFrame | None = None) -> DataFrame:
    """Inserts, deletes and update pairs that lead from ``old`` to ``new``.

    Rows that both states are known to share may be left out of both; of them
    ``unchanged`` must hold those with a key that ``old`` has here, as such a key
    is still there when its row in ``old`` is gone.

    Rows are compared as a whole, null-safe, by one aggregate over both states
    that counts copies, so copies of a key never meet in pairs; as many events
    come out as there are copies more or less. A key that lost rows and gained
    others is an update: its old rows are DELETE events, its new ones INSERT
    events, both with ``_is_update``. A key that lost rows but still has one is
    not deleted either, so its DELETE events carry the mark too.
    """
    columns = new.columns
    sides = old.select(*columns, F.lit(-1).alias("sign")).unionByName(
        new.select(*columns, F.lit(1).alias("sign"))
    )
    changed = (
        sides.groupBy(*columns)
        .agg(F.sum("sign").alias("more"))
        .filter(F.col("more") != 0)
        .withColumn("was", F.col("more") < 0)
    )
    # Keys that lost a row and have one now. The keys that lost rows are few.
    lost = changed.filter("was").select(F.col(key).alias("_key")).distinct()
    present = new.select(key) if unchanged is None else new.select(key).unionByName(unchanged.select(key))
    updated = (
        present.join(lost, F.col(key).eqNullSafe(F.col("_key")), "left_semi").distinct()
        .withColumn("paired", F.lit(True))
    )
    # Null-safe, so that no filter on the key tells the two uses of "changed"
    # apart and Spark shuffles the two states once for both.
    row, event = F.col(f"c.{key}"), changed.alias("c")
    pair = event.join(updated.alias("u"), row.eqNullSafe(F.col(f"u.{key}")), "left")
    copies = F.explode(F.array_repeat(F.lit(0), F.abs("c.more").cast("int")))
    return pair.select("*", copies.alias("_copy")).select(
        *[F.col(f"c.{c}") for c in columns],
        F.when(F.col("c.was"), DELETE).otherwise(INSERT).alias("_action"),
        (F.col("u.paired").isNotNull() & row.isNotNull()).alias("_is_update"),
        (F.when(F.col("c.was"), 0).otherwise(1) + F.lit(first_seq)).cast("long").alias("_seq"),
    )


def net_changes(feed: DataFrame, key: str) -> DataFrame:
    """The net effect of all events per key; NULL keys are left out.

    Events of equal rows cancel, whatever their order and number, so feeds that
    wait together need no common numbering and no tie is decided by values. What
    a key gained in the end is one INSERT per copy, an update if it also lost
    rows. A key that only lost rows is a DELETE, unless every such event says
    that the key is still there. Counts are combined before each shuffle, so a
    key with very many events is no hot spot. Events are folded once and settled:
    the uses below need different columns, and each would fold them anew.
    """
    values = [c for c in feed.columns if c not in FEED]
    came = F.col("_action") == INSERT
    rows = settle(
        feed.filter(F.col(key).isNotNull() & F.col("_action").isin(INSERT, DELETE))
        .groupBy(*values)
        .agg(F.sum(F.when(came, 1).otherwise(-1)).alias("more"), F.max("_seq").alias("last"),
             F.max(~came & ~F.col("_is_update")).alias("ended"))
    )
    lost = F.when(F.col("more") < 0, F.struct(*values))
    keys = rows.groupBy(F.col(key).alias("_key")).agg(
        F.max(F.col("more") > 0).alias("gain"), F.max(lost).alias("lost"),
        F.max("last").alias("_seq"), F.max("ended").alias("ended"))
    gone = keys.filter(~F.col("gain") & F.col("lost").isNotNull() & F.col("ended")).select(
        *[F.col(f"lost.{c}").alias(c) for c in values], F.lit(DELETE).alias("_action"),
        F.lit(False).alias("_is_update"), "_seq")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("more").cast("int"))).alias("_copy")
    gained = rows.filter("more > 0").select(*values, copies).join(
        keys.select("_key", F.col("lost").isNotNull().alias("_lost"), "_seq"), F.col(key) == F.col("_key"))
    return gained.select(
        *values, F.lit(INSERT).alias("_action"), F.col("_lost").alias("_is_update"), "_seq",
    ).unionByName(gone)


def initial_load(rows: DataFrame, loaded_at) -> DataFrame:
    """First content of a merged table: the rows with their marks."""
    return rows.select(
        "*",
        F.lit(INITIAL_LOAD).alias("_cdc_action"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("_loaded_at"),
    )


def merge_changes(target: DataFrame, changes: DataFrame, key: str, loaded_at) -> DataFrame:
    """``target`` after the changes, each judged against the target as it was.

    A DELETE that is no update removes its key; an INSERT that is one replaces
    the row's other columns; an INSERT of an absent or NULL key adds a row. All
    other events do nothing. If several events fit one key the latest counts.

    The latest change of each key, and the keys already there, are settled, so
    their size is known: while they are small enough to broadcast the target is
    not shuffled at all. Beyond that the joins are by key with one row per key
    on the right, and as the right is then a plain shuffle Spark splits a key
    that is hot on the left. Pass ``changes`` settled too; they are read twice.
    """
    marks = {m.lower() for m in MARKS}
    columns = [c for c in target.columns if c.lower() not in marks]
    rest = [c for c in columns if c.lower() != key.lower()]
    came = F.col("_action") == INSERT
    if "_seq" not in changes.columns:
        changes = changes.withColumn("_seq", F.lit(0).cast("long"))

    stamp = F.lit(loaded_at).cast("timestamp_ntz")
    fitting = changes.filter(
        (came & F.col("_is_update")) | ((F.col("_action") == DELETE) & ~F.col("_is_update"))
    ).filter(F.col(key).isNotNull())
    latest = settle(fitting.groupBy(key).agg(
        F.max(F.struct("_seq", came.alias("came"), *rest)).alias("change")
    ))
    hit = F.col("change").isNotNull()
    kept = target.join(latest, key, "left").filter(~hit | F.col("change.came")).select(
        key,
        *[F.when(hit, F.col(f"change.{c}")).otherwise(F.col(c)).alias(c) for c in rest],
        F.when(hit, UPDATE).otherwise(F.col("_cdc_action")).alias("_cdc_action"),
        F.when(hit, stamp).otherwise(F.col("_loaded_at")).alias("_loaded_at"),
    )

    arrivals = changes.filter(came).select(*columns)
    present = settle(target.select(key).distinct().join(
        arrivals.select(key).distinct(), key, "left_semi"
    ))
    added = arrivals.join(present, key, "left_anti").select(
        *columns, F.lit(INSERT).alias("_cdc_action"), stamp.alias("_loaded_at")
    )
    return kept.select(*target.columns).unionByName(added)
