"""Joins whose plan holds for any key distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.session import stage

# Largest number of (narrow) rows that is ever broadcast.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Stage an aggregated side and broadcast it only when its counted size allows it.

    Beyond the limit the side is joined by shuffle, where AQE splits hot keys of the other side.
    """
    staged = stage(df)
    return F.broadcast(staged) if staged.count() <= max_rows else staged


def small_table(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """As ``small_side`` for a stored table, which needs counting but no staging."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def attach_parent(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    extra: list[Column] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """parents LEFT JOIN children, for children that may crowd under a few parents.

    A left join cannot split a hot key on its nullable side. An inner join can (AQE splits either
    side), so parents without children are added from an anti join on the distinct keys. ``seen`` may
    name a cheaper frame to take those keys from than ``children``; ``extra`` are the columns of a parent
    without children.
    """
    matched = children.join(parents, key)
    keys = (children if seen is None else seen).select(key).distinct()
    childless = parents.join(keys, key, "left_anti")
    if extra:
        childless = childless.select("*", *extra)
    return matched.unionByName(childless, allowMissingColumns=True)


def latest_by(df: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """The newest row per key. ``version`` must be unique within a key and not null.

    The newest version is a number per key, found by a hash aggregate that combines before the shuffle; the rows
    follow by a join on key and version. The maximum of whole rows would sort all versions ever written.
    """
    newest = df.groupBy(*[F.col(name).alias(f"_{name}") for name in keys]).agg(F.max(version).alias("_newest"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys]
    found = df.withColumn("_version", version).join(newest, [*same, F.col("_version") == F.col("_newest")], "left_semi")
    return found.drop("_version")


def without_top(df: DataFrame, order: list[Column], count: int) -> DataFrame:
    """All rows but the first ``count`` in the given order.

    An OFFSET over a sorted frame would pull every row into one task; finding the few rows to leave
    out is a bounded top-k, and removing them needs no sort at all.
    """
    top = stage(df.orderBy(*order, *df.columns).limit(count))
    distinct = F.broadcast(top.select(*[F.col(name).alias(f"_{name}") for name in df.columns]).distinct())
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in df.columns]
    # Only copies of a top row can be left over in part; all others are no copies and stay as they are.
    return df.join(distinct, same, "left_anti").unionByName(df.join(distinct, same, "left_semi").exceptAll(top))
