"""Row history with validity intervals."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ordertide.sources.scratch import settle

VALIDITY = ["valid_from", "valid_to"]


def _same(left: str, right: str, key: str, tracked: list[str]):
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked]
    return reduce(lambda a, b: a & b, tests, F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))


def changed_groups(
    history: DataFrame, source: DataFrame, key: str, tracked: list[str]
) -> DataFrame:
    """Key and tracked values that only open versions have (``was``) or only the source (``is``)."""
    return settle(differing(history.filter(F.col("valid_to").isNull()), source, key, tracked))


def differing(old: DataFrame, new: DataFrame, key: str, tracked: list[str],
              shared: DataFrame | None = None) -> DataFrame:
    """Key and tracked values that only ``old`` (``was``) or only ``new`` (``is``) has.

    One aggregate over the union of both sides; it combines copies before its
    shuffle, which carries nothing but these columns. Rows known to be on both
    sides may be left out of both; what is found in ``shared``, those of them whose
    keys may be among these, is no difference.
    """
    values = [key, *tracked]
    sides = [rows.filter(F.col(key).isNotNull()).select(*values, F.lit(was).alias("was"), F.lit(not was).alias("is"))
             for rows, was in ((old, True), (new, False))]
    groups = sides[0].unionByName(sides[1]).groupBy(*values).agg(
        F.max("was").alias("was"), F.max("is").alias("is")).filter(F.col("was") != F.col("is"))
    if shared is None:
        return groups
    groups = settle(groups)
    still = in_groups(shared, groups, key, tracked).select(*values).distinct()
    return groups.alias("r").join(still.alias("g"), _same("r", "g", key, tracked), "left_anti")


def in_groups(rows: DataFrame, groups: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """The rows whose key and tracked values form one of the groups."""
    return rows.alias("r").join(groups.alias("g"), _same("r", "g", key, tracked), "left_semi")


def scd2_apply(
    history: DataFrame | None, source: DataFrame, key: str, tracked: list[str], as_of,
    changed: DataFrame | None = None,
) -> DataFrame:
    """History after seeing ``source`` at ``as_of``.

    An open version whose key and tracked values are still in the source stays
    as it is; otherwise it is closed, which covers removed keys. A source row
    without such a version opens one, which covers new and returning keys.
    Columns that are not tracked never make a version. NULL keys are left out.

    ``changed`` are the changed groups, if already known. While they are few
    Spark broadcasts them and whole rows are not shuffled at all; beyond that
    each join has one row per group on its right and a splittable left.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    rows = source.filter(F.col(key).isNotNull())
    fresh = rows.withColumns({"valid_from": now, "valid_to": never})
    if history is None:
        return fresh

    if changed is None:
        changed = changed_groups(history, source, key, tracked)
    closed = history.filter(F.col("valid_to").isNotNull())
    standing = history.filter(F.col("valid_to").isNull())
    ended = changed.filter("was").alias("g")
    reviewed = standing.alias("r").join(ended, _same("r", "g", key, tracked), "left").select(
        *[F.col(f"r.{c}") for c in history.columns if c != "valid_to"],
        F.when(F.col("g.was"), now).alias("valid_to"),
    )
    opened = in_groups(fresh, changed.filter("is"), key, tracked)
    return closed.unionByName(reviewed).unionByName(opened).select(*history.columns)


def state_at(history: DataFrame, moment) -> DataFrame:
    """The rows as they stood at ``moment``."""
    t = F.lit(moment).cast("timestamp_ntz")
    return history.filter(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    ).drop(*VALIDITY)
