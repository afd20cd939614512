"""Posts and their comments: nesting, flattening, counting, selecting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.operators.ordered import numbered_within
from ticktide.operators.sides import attach_parent, small_side
from ticktide.schemas import COMMENT, POST_KEY
from ticktide.session import stage

COMMENTS_PER_ROW = 10_000
DAY = 86_400.0
HOUR = 3_600


def nest_comments(
    posts: DataFrame, comments: DataFrame, per_row: int = COMMENTS_PER_ROW, keep_orphans: bool = False
) -> DataFrame:
    """One row per post with its comments as a sorted array.

    (``post_id``, ``part``) is the key of a row, at every size. A row holds about ``per_row`` comments at
    most: a post with more gets parts 0, 1, ..., each a share of its comments by their hash. Part 0 always exists
    and stands for the post where one row per post is wanted. ``keep_orphans`` adds rows of comments whose post is
    missing, which know of it only the key, if they name one.
    """
    crowded = (
        comments.groupBy("post_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > per_row)
        .select(F.col("post_id").alias("_post_id"), F.ceil(F.col("n") / per_row).alias("parts"))
    )
    nested = (
        comments.join(small_side(crowded), F.col("post_id").eqNullSafe(F.col("_post_id")), "left")
        .withColumn("part", F.pmod(F.xxhash64("comm_id", "comm_body", "comm_time_utc"), F.coalesce("parts", F.lit(1))).cast("int"))
        .groupBy(*POST_KEY)
        .agg(F.collect_list(F.struct("comm_time_utc", "comm_id", "comm_body", "comm_score")).alias("comments"))
        .withColumn("comments", _in_time_order(F.col("comments")))
    )
    none = F.array().cast(f"array<{COMMENT.simpleString()}>").alias("comments")
    without_first = posts.join(nested.where(F.col("part") == 0).select("post_id"), "post_id", "left_anti")
    found = nested.join(posts, "post_id").unionByName(without_first.select("*", F.lit(0).alias("part"), none))
    if not keep_orphans:
        return found
    orphans = nested.join(posts.select("post_id").distinct(), "post_id", "left_anti")
    return found.unionByName(orphans, allowMissingColumns=True)


def nest_all(posts: DataFrame, comments: DataFrame, per_row: int = COMMENTS_PER_ROW) -> DataFrame:
    """As ``nest_comments``, with every post and every comment: also comments without a post, and all copies of a post that
    was pulled more than once, of which one has the comments."""
    pulled = stage(posts.withColumn("_pull", F.monotonically_increasing_id()))
    first = stage(pulled.groupBy("post_id").agg(F.min("_pull").alias("_pull")).select("_pull"))
    once, copies = (pulled.join(first, "_pull", how).drop("_pull") for how in ("left_semi", "left_anti"))
    none = F.array().cast(f"array<{COMMENT.simpleString()}>").alias("comments")
    nested = nest_comments(once, comments, per_row, keep_orphans=True)
    return nested.unionByName(copies.select("*", F.lit(0).alias("part"), none))


def placed_comments(nested: DataFrame, rows_per_segment: int = COMMENTS_PER_ROW) -> DataFrame:
    """Every nested comment as a row, with its ``place`` among the comments of its post in time order, over all parts, and the
    number of ``posts`` that have the key: 0 if the post is missing, more than 1 if it was pulled again."""
    rows = nested.select("post_id", F.inline("comments"))
    order = ["comm_time_utc", "comm_id", "comm_score", "comm_body"]
    placed = numbered_within(rows, ["post_id"], order, "place", rows_per_segment)
    known = first_parts(nested).where(F.col("post_time").isNotNull()).groupBy("post_id").agg(F.count(F.lit(1)).alias("posts"))
    return placed.join(known, "post_id", "left").withColumn("posts", F.coalesce("posts", F.lit(0)))


def _in_time_order(comments: Column) -> Column:
    return F.transform(
        F.array_sort(comments),
        lambda c: F.struct(
            c["comm_id"].alias("comm_id"),
            c["comm_body"].alias("comm_body"),
            c["comm_time_utc"].alias("comm_time_utc"),
            c["comm_score"].alias("comm_score"),
        ),
    )


def explode_comments(posts: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Comment rows with their post's key; posts without comments give none, or one row of nulls."""
    return posts.select("post_id", F.inline_outer("comments") if keep_empty else F.inline("comments"))


def comment_count(posts: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Comments per post. Array lengths are added up, so no comment is materialised as a row."""
    counted = posts.groupBy("post_id").agg(
        F.sum(F.when(F.col("comments").isNull(), 0).otherwise(F.size("comments"))).cast("bigint").alias("count")
    )
    return counted if keep_empty else counted.where(F.col("count") > 0)


def count_flat(comments: DataFrame) -> DataFrame:
    """Comments per post from comment rows; only keys are read and shuffled."""
    return comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("count"))


def day_band(posts: DataFrame, as_of: Column) -> DataFrame:
    """Posts created between 48 and 24 hours before ``as_of`` (epoch seconds), both ends included."""
    return posts.where(F.col("post_time").between(as_of - 2 * DAY, as_of - DAY))


def newest(posts: DataFrame, count: int = 1000) -> DataFrame:
    return posts.orderBy(F.desc("post_time"), "post_id").limit(count)


def comments_to_json(posts: DataFrame) -> DataFrame:
    return posts.select(*POST_KEY, F.to_json("comments").alias("comments_json"))


def join_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Every post with each of its comments; posts without comments stay with nulls."""
    return attach_parent(comments, posts, "post_id")


def first_parts(posts: DataFrame) -> DataFrame:
    """One row per post."""
    return posts.where(F.col("part") == 0)


def landings(posts: DataFrame, first: int = 24, last: int = 48) -> DataFrame:
    """Posts with the hours (``hour``, as in the landing's folders) whose files hold them: an hourly pull takes the
    posts that are one to two days old, so a post lands once in each of these hours after the hour of its creation."""
    after = F.explode(F.sequence(F.lit(first), F.lit(last)))
    hour = F.timestamp_seconds(F.floor(F.col("post_time") / HOUR) * HOUR + F.col("after") * HOUR)
    return posts.withColumn("after", after).withColumn("hour", F.date_format(hour, "yyyy-MM-dd-HH")).drop("after")
