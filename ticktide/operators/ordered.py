"""Order-dependent operators that survive a key holding a large share of all rows.

A plain window puts every row of a key into one task. Keys whose counted size calls for it are taken apart: their
rows are dealt out by range of (key, order), so each partition is a consecutive run of the order, a segment of
bounded size, whatever the values look like. Where that would be more partitions than the driver should keep track of,
partitions are sorted and cut into several segments. Windows run per (key, segment); what they need from the segments
before travels as a few carried rows or one offset per segment. A row number as the last order value splits even
rows that are equal in everything. The results equal those of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.operators.sides import small_side
from ticktide.session import stage

ROWS_PER_SEGMENT = 4_000_000
RANGES = 400  # partitions by range at most: each is a task, with a result and a sample that reach the driver
SEGMENT = "_segment"
TIE = "_tie"


def hot_keys(df: DataFrame, keys: list[str], rows_per_segment: int) -> tuple[DataFrame, int] | None:
    """The keys with more rows than a segment, staged, and the number of their rows; None without such keys.

    There are at most rows / rows_per_segment of them, and each carries one number.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_segment)
    hot = stage(counted)
    total = hot.agg(F.sum("_rows")).first()[0]
    return (hot.drop("_rows"), total) if total else None


def with_segments(
    df: DataFrame, keys: list[str], order: list[str], segments: int, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Add the number of the range of (keys, order) that a row lies in, and a row number that breaks ties.

    Numbers rise with the order, with gaps. Of more segments than ``RANGES``, several are cut from a sorted partition.
    Staged, because ranges come from a sample and must be the same wherever the result is used.
    """
    place = [*keys, *order, TIE]
    ranges = min(segments, RANGES)
    dealt = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(ranges, *place)
    if segments == ranges:
        return stage(dealt.withColumn(SEGMENT, F.spark_partition_id().cast("bigint")))
    # The row number holds the partition's number above 33 bits and the row's place in the partition below them; a
    # segment is named by its first row.
    row = F.monotonically_increasing_id()
    in_partition = row.bitwiseAND(F.lit((1 << 33) - 1))
    return stage(dealt.sortWithinPartitions(*place).withColumn(SEGMENT, row - in_partition % rows_per_segment))


def lagged(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    offsets: dict[str, int],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Earlier values of ``value`` per key: one column per entry of ``offsets`` (name -> rows back)."""
    def lags(over: Window) -> list[Column]:
        return [F.lag(value, back).over(over).alias(name) for name, back in offsets.items()]

    hot = hot_keys(df, keys, rows_per_segment)
    if hot is None:
        return df.select("*", *lags(Window.partitionBy(*keys).orderBy(*order)))
    names, rows = hot
    named = small_side(names.select(*[F.col(name).alias(f"_{name}") for name in keys]))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys]
    rest = df.join(named, same, "left_anti").select("*", *lags(Window.partitionBy(*keys).orderBy(*order)))
    cut = with_segments(df.join(named, same, "left_semi"), keys, order, -(-rows // rows_per_segment) + 1, rows_per_segment)

    full, depth = [*order, TIE], max(offsets.values())
    last_first = Window.partitionBy(*keys, SEGMENT).orderBy(*[F.col(name).desc() for name in full])
    tails = stage(
        cut.select(*keys, SEGMENT, *[name for name in dict.fromkeys([*full, value]) if name not in keys])
        .withColumn("back", F.row_number().over(last_first)).where(F.col("back") <= depth).drop("back")
    )
    # For each segment of a key, the last rows of the key before it: few rows per segment, over all segments.
    inside = [name for name in tails.columns if name not in keys and name != SEGMENT]
    following = Window.partitionBy(*keys).orderBy(SEGMENT, *full)
    carried = (
        tails.withColumn("recent", F.collect_list(F.struct(*inside)).over(following.rowsBetween(-(depth - 1), 0)))
        .withColumn("next", F.lead(SEGMENT).over(following))
        .where(F.col("next") != F.col(SEGMENT))
        .select(*keys, F.col("next").alias(SEGMENT), F.inline("recent"))
        .withColumn("_carried", F.lit(True))
    )
    whole = cut.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    over = Window.partitionBy(*keys, SEGMENT).orderBy(*full)
    found = whole.select("*", *lags(over)).where(~F.col("_carried")).drop("_carried", SEGMENT, TIE)
    return rest.unionByName(found)


def numbered(
    df: DataFrame, order: list[str], name: str = "row_no", rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Number all rows from 0 in the given order; rows that tie in it are ordered by their other columns."""
    total = [*order, *[column for column in df.columns if column not in order]]
    rows = df.count()
    if rows <= rows_per_segment:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*total)).cast("bigint") - 1)
    cut = with_segments(df, [], total, -(-rows // rows_per_segment) + 1, rows_per_segment)
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(SEGMENT)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(SEGMENT, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(SEGMENT).orderBy(*total, TIE)
    return (
        cut.join(small_side(offsets), SEGMENT)
        .withColumn(name, F.col("offset") + F.row_number().over(inside) - 1)
        .drop(SEGMENT, TIE, "offset")
    )


def numbered_within(
    df: DataFrame, keys: list[str], order: list[str], name: str = "row_no", rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Number the rows of every key, null ones too, from 0 in the given order."""
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint") - 1
    hot = hot_keys(df, keys, rows_per_segment)
    if hot is None:
        return df.withColumn(name, plain)
    names, rows = hot
    renamed = [F.col(key).alias(f"_{key}") for key in keys]
    named = small_side(names.select(*renamed))
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    rest = df.join(named, same, "left_anti").withColumn(name, plain)
    cut = with_segments(df.join(named, same, "left_semi"), keys, order, -(-rows // rows_per_segment) + 1, rows_per_segment)
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, SEGMENT)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*renamed, F.col(SEGMENT).alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(*order, TIE)
    found = cut.join(small_side(offsets), [*same, F.col(SEGMENT) == F.col("_of")])
    found = found.withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
    return rest.unionByName(found.select(*rest.columns))


def carried_forward(points: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Replace nulls by the last known value. For groups that the calendar bounds, such as hourly series."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.withColumn(value, F.last(value, ignorenulls=True).over(upto))
