"""As-of merge of two event tables: each row on the left meets the nearest row on the right in time.

Both tables are laid out together by range of (key, time), so a range holds a bounded run of the merged order whatever
a key's share of all rows. Within a range a running aggregate per key finds the match. A match may also lie in an
earlier range, but then only the key that a range begins with can have it there, and only the last right-hand row
before the range can be it: one row per range is carried over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.operators.ordered import ROWS_PER_SEGMENT, SEGMENT, TIE, with_segments

AT, SIDE, LEFT, RIGHT, ORDER = "_at", "_side", "_left", "_right", "_order"


def _instant(df: DataFrame, name: str) -> Column:
    """A time or number as a long: micros of a time, days of a date, the number itself."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("long")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(name).cast("long")
    raise TypeError(f"{name} is {kind}, not a time or a whole number")


def asof_merge(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    at: str,
    right_at: str | None = None,
    columns: list[str] | None = None,
    ties: list[str] | None = None,
    direction: str = "backward",
    tolerance: int | None = None,
    exact: bool = True,
    how: str = "left",
    rows_per_range: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Rows of ``left`` with ``columns`` of the nearest row of ``right`` that has the same keys.

    ``direction``: the last row at or before (``backward``), the first at or after (``forward``), or the nearer of both,
    the earlier one if they are equally far (``nearest``). ``exact=False`` leaves rows of the same time out.
    ``tolerance`` bounds the distance, in micros for times, days for dates, else as numbers. Among right-hand rows of one
    time the last in order of ``ties`` is taken backward and the first forward. Rows with a null key or time match
    nothing; ``how="inner"`` drops rows without a match. Neither table may be shuffled by key alone: a key may hold
    most rows of either.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction}")
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join {how}")
    right_at = right_at or at
    columns = columns or [name for name in right.columns if name not in keys and name != right_at]
    taken = set(columns) & set(left.columns)
    if taken:
        raise ValueError(f"both sides have {sorted(taken)}")

    usable = reduce(Column.__and__, [F.col(name).isNotNull() for name in [*keys, AT]])
    lefts = left.withColumn(AT, _instant(left, at)).select(*keys, AT, F.struct(*left.columns).alias(LEFT))
    rights = right.withColumn(AT, _instant(right, right_at)).where(usable).select(
        *keys, AT, F.struct(*[F.col(name) for name in ties or []], F.lit(0).alias("_")).alias(ORDER),
        F.struct(F.col(AT).alias("_found"), *columns).alias(RIGHT))

    found, near = lefts.where(usable), []
    for way in ("backward", "forward"):
        if direction in (way, "nearest"):
            found = _merged(found, rights, keys, way == "backward", exact, f"_{way}", rows_per_range)
            match = F.col(f"_{way}")
            within = F.abs(F.col(AT) - match["_found"]) <= tolerance if tolerance is not None else F.lit(True)
            near.append(F.when(within, match))
    if direction == "nearest":
        before, after = near
        closer = F.col(AT) - before["_found"] <= after["_found"] - F.col(AT)
        near = [F.when(after.isNull() | closer, before).otherwise(after)]
    result = found.select(LEFT, near[0].alias(RIGHT))
    if how == "inner":
        result = result.where(F.col(RIGHT).isNotNull())
    else:
        kind = rights.schema[RIGHT].dataType.simpleString()
        unplaced = lefts.where(~usable).select(LEFT, F.lit(None).cast(kind).alias(RIGHT))
        result = result.unionByName(unplaced)
    return result.select(f"{LEFT}.*", *[F.col(RIGHT)[name].alias(name) for name in columns])


def _merged(
    lefts: DataFrame, rights: DataFrame, keys: list[str], backward: bool, exact: bool, name: str, rows_per_range: int
) -> DataFrame:
    """``lefts`` with the struct of the nearest right-hand row on one side as column ``name``."""
    # In the direction of travel, right-hand rows stand before left-hand rows of the same time if those may match.
    first = backward == exact
    both = lefts.withColumn(SIDE, F.lit(1)).unionByName(
        rights.withColumn(SIDE, F.lit(0 if first else 2)), allowMissingColumns=True)
    order = [AT, SIDE, ORDER]
    cut = with_segments(both, keys, order, max(1, -(-both.count() // rows_per_range)), rows_per_range)
    is_right = F.col(RIGHT).isNotNull()

    # Per range: the key that it begins with, and its last right-hand row, both in the direction of travel.
    place = [*keys, *order, TIE]
    begin, end = (F.min, F.max_by) if backward else (F.max, F.min_by)
    ends = cut.groupBy(SEGMENT).agg(
        begin(F.struct(*keys)).alias("_begin"),
        end(F.struct(*place, RIGHT), F.when(is_right, F.struct(*place))).alias("_end"))
    travel = F.asc if backward else F.desc
    passed = Window.orderBy(travel(SEGMENT)).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = ends.select(SEGMENT, "_begin", F.last("_end", ignorenulls=True).over(passed).alias("_end"))
    same = reduce(Column.__and__, [F.col("_end")[key] == F.col("_begin")[key] for key in keys], F.lit(True))
    carried = carried.where(same).select(SEGMENT, "_end.*")

    together = cut.unionByName(carried, allowMissingColumns=True)
    running = Window.partitionBy(SEGMENT, *keys).orderBy(*[travel(column) for column in [*order, TIE]])
    match = F.last(RIGHT, ignorenulls=True).over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return together.withColumn(name, match).where(F.col(LEFT).isNotNull()).select(*lefts.columns, name)
