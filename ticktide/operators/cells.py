"""Keyed wide-column rows: a key and text cells named ``family:qualifier``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.functions.texts import cell_text, plain_double
from ticktide.operators.posts import first_parts
from ticktide.schemas import COMMENT


def cells_of(scored: DataFrame, *others: str) -> DataFrame:
    """Scored nested rows as (post_id, part, cells) with every value as text; ``others`` are columns to keep."""
    cells = {
        "post_info:post_title": cell_text(F.col("post_title")),
        "post_info:post_time": cell_text(plain_double(F.col("post_time"))),
        "post_info:post_score": cell_text(F.col("post_score")),
        "post_info:post_upvote": cell_text(plain_double(F.col("post_upvote"))),
        "post_info:comments": F.to_json("comments"),
        "sentiment:post_sentiment": cell_text(plain_double(F.col("post_sentiment"))),
        "sentiment:comments_sentiment": cell_text(plain_double(F.col("comments_sentiment"))),
    }
    pairs: list[Column] = [part for name, value in cells.items() for part in (F.lit(name), value)]
    return scored.select(F.col("post_id").cast("string"), "part", *others, F.create_map(*pairs).alias("cells"))


def posts_of(cells: DataFrame) -> DataFrame:
    """Posts table of a cell scan: every cell but the comments, typed again."""
    return first_parts(cells).select(
        F.col("post_id").alias("post_key"),
        _cell("post_info:post_score").try_cast("int").alias("post_score"),
        _cell("post_info:post_time").try_cast("double").alias("post_time"),
        _cell("post_info:post_title").alias("post_title"),
        _cell("post_info:post_upvote").try_cast("double").alias("post_upvote"),
        _cell("sentiment:comments_sentiment").try_cast("double").alias("comments_sentiment"),
        _cell("sentiment:post_sentiment").try_cast("double").alias("post_sentiment"),
    )


def comments_of(cells: DataFrame) -> DataFrame:
    """Comments of a cell scan as rows with their post's key."""
    comments = F.from_json(_cell("post_info:comments"), f"array<{COMMENT.simpleString()}>")
    return cells.select(F.col("post_id").alias("post_key"), F.inline(comments)).select(
        F.col("comm_id").alias("comment_id"),
        F.col("comm_body").alias("comment_body"),
        F.col("comm_time_utc").alias("comment_time"),
        F.col("comm_score").alias("comment_score"),
        "post_key",
    )


def _cell(name: str) -> Column:
    return F.col("cells")[name]
