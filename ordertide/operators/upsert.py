"""Keyed upsert, window replacement and column sync."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Key equality between two aliased frames in which NULL equals NULL."""
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Updates replace the target rows that share their key; nothing else goes.

    The result has the columns of ``updates``. Keys compare null-safe, so the
    group of a NULL key is stored once. The anti join emits each target row at
    most once whatever the number of copies of a key; both its sides are plain
    shuffles, with no aggregate between, so Spark can split a hot key.
    """
    kept = target.alias("t").join(
        updates.select(*keys).alias("u"), same_key("t", "u", keys), "left_anti"
    )
    return sync_columns(kept, updates).unionByName(updates)


def replace_window(target: DataFrame, updates: DataFrame, day: str, since: Column) -> DataFrame:
    """Updates take the place of all target rows from ``since`` on, vanished ones too."""
    kept = target.filter((F.col(day) < since) | F.col(day).isNull())
    return sync_columns(kept, updates).unionByName(updates)


def sync_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Target rows in the columns and types of ``updates``: new ones NULL, others gone."""
    have = set(target.columns)
    return target.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in updates.schema.fields
    ])
