"""Landings of many small hours, landed again by hour, and of comments without a post."""

import duckdb
import pytest
from pyspark.sql import functions as F

from ticktide.operators import posts
from ticktide.plans import catalogue, checks, views
from ticktide.session import scratch_path
from ticktide.sinks.files import overwrite_hours_by_day
from ticktide.sources import files

DAYS = 5


def by_hour(spark):
    """A post an hour."""
    return spark.range(24 * DAYS).select(
        F.col("id").cast("string").alias("post_id"), F.lit(0).alias("part"), F.lit("title").alias("post_title"),
        (F.lit(1704067200.0) + F.col("id") * 3600).alias("post_time"), F.lit(1).alias("post_score"), F.lit(0.5).alias("post_upvote"),
        F.array(F.struct(F.col("id").cast("string").alias("comm_id"), F.lit("}").alias("comm_body"), F.lit(1.0).alias("comm_time_utc"),
                         F.lit(2).alias("comm_score"))).alias("comments"))


def read(spark, root, how=files.read_lines):
    rows = files.good_posts(files.read_hourly_posts(spark, root, how))
    return {(r.hour, r.post_id, r.post_score, len(r.comments)) for r in rows.collect()}


def expected(score=lambda at: 1):
    return {(f"2024-01-{1 + at // 24:02}-{at % 24:02}", str(at), score(at), 1) for at in range(24 * DAYS)}


def test_hours_of_one_post_make_few_files(spark):
    """F8, F10, F11: a folder and file for every hour took most of the time."""
    root = scratch_path(spark, "landing-test")
    views.land_posts(by_hour(spark), root)
    assert read(spark, root) == expected()
    assert len(spark.read.text(root).inputFiles()) <= DAYS


def test_an_hour_landed_again_replaces_only_itself(spark):
    """also beside unreadable lines and posts without a time, with few days named or many joined."""
    for few in (1_000, 0):
        root = scratch_path(spark, "landing-test")
        views.land_posts(by_hour(spark).union(by_hour(spark).limit(1).withColumns({"post_id": F.lit("x"), "post_time": F.lit(None)})), root)
        spark.createDataFrame([("{broken", "2024-01-02")], "value string, day string").write.partitionBy("day").mode("append").text(root)
        hour = F.date_format(F.timestamp_seconds("post_time"), "yyyy-MM-dd-HH")
        again = by_hour(spark).where("post_id in ('30', '50')").withColumns({"hour": hour, "post_score": F.lit(9)})
        overwrite_hours_by_day(again, root, few)
        assert read(spark, root) == expected(lambda at: 9 if at in (30, 50) else 1) | {(None, "x", 1, 1)}
        assert files.bad_records(files.read_hourly_posts(spark, root)).count() == 1


def test_indented_hours_of_one_post_make_few_files(spark):
    """read whole and cut into records."""
    root = scratch_path(spark, "landing-test")
    views.land_indented_posts(by_hour(spark), root)
    assert read(spark, root, files.read_documents) == read(spark, root, files.read_split_documents) == expected()
    assert len(spark.read.text(root).inputFiles()) <= DAYS


def test_comments_without_a_post_are_landed(spark, tmp_path):
    """the SQL and the landing left out comments whose post is missing, and repeated those of a repeated post."""
    rows = [(1, 0, "u", "post"), (1, 1, "u", "a"), (1, 2, "u", "b"), (2, 1, "u", "orphan"), (2, 2, "u", "orphan"),
            (3, 0, "u", "post"), (4, 0, "u", "twice"), (4, 0, "u", "again"), (4, 1, "u", "c"), (4, 1, "u", "c")]
    conversations = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(conversations)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{conversations}/*.parquet'")
    found = catalogue.QUERIES["posts_scan_parts"](spark, str(tmp_path))
    wanted = duck.execute(checks.CHECKS["posts_scan_parts"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted) and len(wanted) == 6


FIRST_TEXTS = checks.with_parts(f"SELECT post_id, {checks.SHOWN} AS comments FROM comments GROUP BY 1", "comments")
JOINED_ROWS = checks.with_parts("SELECT post_id, comm_id FROM comments JOIN posts USING (post_id)", "comments", "posts")


@pytest.mark.parametrize("segment", [2, 10_000])
def test_comments_keep_their_posts_order_and_posts(spark, tmp_path, monkeypatch, segment):
    """the order of a post's comments, its posts and comments that name no post had gone from the SQL or the query."""
    rows = [(1, 0, "u", "post"), *[(1, turn, "u", f"text {turn * 7 % 5}") for turn in range(9, 0, -1)], (2, 2, "u", "orphan"),
            (2, 1, "u", "orphan, first"), (3, 0, "u", "post"), (4, 0, "u", "pulled"), (4, 0, "u", "again"), (4, 0, "u", "again"),
            (4, 1, "u", "c"), (4, 1, "u", "b"), (5, 0, "u", "post"), (5, 2, "u", "x"), (5, 1, "u", None)]
    keyless = [(None, 0, "u", "post"), *[(None, turn, "u", f"{turn}") for turn in range(1, 6)]]
    conversations = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows + keyless, "conv_id bigint, turn bigint, role string, text string").write.parquet(conversations)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{conversations}/*.parquet'")
    monkeypatch.setattr(posts.placed_comments, "__defaults__", (segment,))
    found = catalogue.QUERIES["posts_scan_parts"](spark, str(tmp_path)).collect()
    wanted = duck.execute(checks.CHECKS["posts_scan_parts"]).fetchall()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted)) and len(wanted) == 20
    texts = {}
    for row in sorted((r for r in found if r.post_id not in (None, "4", "5")), key=lambda r: r.place):
        texts.setdefault(row.post_id, []).append(f"{row.comm_id}:{int(row.comm_time_utc)}:{row.comm_score}:{row.comm_body}")
    first = {post: text for post, text in duck.execute(FIRST_TEXTS).fetchall() if post not in (None, "4", "5")}
    assert {post: ",".join(text) for post, text in texts.items()} == first
    joined = [(r.post_id, r.comm_id) for r in found for _ in range(r.posts)]
    assert sorted(joined) == sorted(duck.execute(JOINED_ROWS).fetchall())
