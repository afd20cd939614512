"""Sentiment of texts, posts and hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.functions import sentiment as rules_of
from ticktide.functions.sentiment import Rules
from ticktide.operators.posts import first_parts, landings
from ticktide.operators.sides import small_table

NO_UPVOTES = 1e-12


def lexicon_sentiment(
    texts: DataFrame, ids: list[str], text: str, lexicon: DataFrame, rules: Rules = Rules(), words: str | None = None
) -> DataFrame:
    """Score each text in [-1, 1]; an empty text gets 0. ``words`` may name a column with the text's words.

    Words meet the lexicon in a broadcast join and are summed inside the task that holds the text, so
    one narrow row per text crosses the network.
    """
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    if words:
        cut = texts.select(*ids, body, F.col(words).alias("tokens"))
    else:
        cut = texts.select(*ids, body).withColumn("tokens", rules_of.words(F.col("text")))
    tokens, lowered, loud = F.col("tokens"), F.col("lowered"), F.col("loud")
    ruled = (
        cut.withColumns({
            "lowered": F.transform(tokens, lambda word: F.lower(word)),
            "loud": rules_of.partly_shouted(tokens),
            "strength": rules_of.emphasis(F.col("text")),
        })
        .withColumns({
            "degree": rules_of.degrees(tokens, lowered, loud, rules),
            "negated": rules_of.negations(lowered, rules),
            "contrast_at": F.array_position(lowered, rules.contrast),
        })
        .select(*ids, "strength", "loud", "degree", "negated", "contrast_at", F.posexplode_outer("tokens").alias("spot", "word"))
    )
    known = small_table(lexicon.select("token", "valence"))
    found = ruled.join(known, F.lower("word") == F.col("token"), "left")
    value = rules_of.word_valence(
        F.col("valence"), F.col("word"), F.col("spot"), F.col("degree"), F.col("negated"), loud, F.col("contrast_at")
    )
    summed = found.groupBy(*ids).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"),
        F.max("strength").alias("strength"),
    )
    return summed.select(*ids, rules_of.compound(F.col("total"), F.col("strength")).alias("sentiment"))


def post_scores(posts: DataFrame, lexicon: DataFrame, rules: Rules = Rules(), keys: list[str] = ["post_id"]) -> DataFrame:
    """``post_sentiment`` of the title, per post; ``keys`` name a post, with its landing hour if it lands repeatedly."""
    scores = lexicon_sentiment(first_parts(posts), keys, "post_title", lexicon, rules)
    return scores.withColumnRenamed("sentiment", "post_sentiment")


def _comments_sentiment(scored: Column, upvotes: Column, comment: Column) -> Column:
    """Upvote-weighted mean of the comments' scores, divided once more by their number.

    Negative and null upvotes weigh 0; a post without comments scores 0.
    """
    weight = F.when(comment, F.greatest(upvotes, F.lit(0)))
    weighted, weights = F.sum(scored * weight), F.sum(weight)
    return F.coalesce(weighted / (weights + F.lit(NO_UPVOTES)) / F.nullif(F.count_if(comment), F.lit(0)), F.lit(0.0))


def _texts(posts: DataFrame, keys: list[str], titles: bool) -> DataFrame:
    """One row per text of a post: its title, and each comment by its place in the array. Ids of comments may be
    missing or repeated, so they name nothing here."""
    title = F.array(F.struct(
        F.lit(True).alias("is_title"), F.lit(-1).alias("place"), F.lit(None).cast("int").alias("upvotes"),
        F.col("post_title").alias("body") if titles else F.lit(None).cast("string").alias("body")))
    comments = F.transform(F.coalesce("comments", F.array()), lambda c, at: F.struct(
        F.lit(False).alias("is_title"), at.alias("place"), c["comm_score"].alias("upvotes"), c["comm_body"].alias("body")))
    return posts.select(*keys, "part", F.inline(F.when(F.col("part") == 0, F.concat(title, comments)).otherwise(comments)))


def _scores(posts: DataFrame, lexicon: DataFrame, rules: Rules, keys: list[str], titles: bool) -> DataFrame:
    ids = [*keys, "part", "is_title", "place", "upvotes"]
    scored = lexicon_sentiment(_texts(posts, keys, titles), ids, "body", lexicon, rules)
    return scored.groupBy(*keys).agg(
        F.max(F.when(F.col("is_title"), F.col("sentiment"))).alias("post_sentiment"),
        _comments_sentiment(F.col("sentiment"), F.col("upvotes"), ~F.col("is_title")).alias("comments_sentiment"),
    )


def comment_scores(posts: DataFrame, lexicon: DataFrame, rules: Rules = Rules(), keys: list[str] = ["post_id"]) -> DataFrame:
    """``comments_sentiment`` per post, over all its parts."""
    return _scores(posts, lexicon, rules, keys, titles=False).drop("post_sentiment")


def scored_posts(posts: DataFrame, lexicon: DataFrame, rules: Rules = Rules(), keys: list[str] = ["post_id"]) -> DataFrame:
    """Nested rows with both sentiment columns of their post. Titles and comments are scored in one pass."""
    return posts.join(_scores(posts, lexicon, rules, keys, titles=True), keys)


def hourly_sentiment(landed: DataFrame, lexicon: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Mean title sentiment, to six decimals, of the posts that landed in each hour (column ``hour`` of the landing).

    A post that landed in several hours is scored once, as long as its title stayed the same. Scores have four decimals.
    They are summed as whole numbers, so the mean does not depend on the order of rows.
    """
    title = F.xxhash64("post_title").alias("title")
    once = first_parts(landed).groupBy("post_id", title, "post_title").agg(F.collect_list("hour").alias("hours"))
    scores = lexicon_sentiment(once, ["post_id", "title", "hours"], "post_title", lexicon, rules)
    return _mean_by_hour(scores.select("sentiment", F.explode("hours").alias("hour")))


def landing_sentiment(posts: DataFrame, lexicon: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """As ``hourly_sentiment`` of all hours in which ``posts`` land: each title is scored once, and only its score is
    dealt out to the hours."""
    scores = lexicon_sentiment(first_parts(posts), ["post_id", "post_time"], "post_title", lexicon, rules)
    return _mean_by_hour(landings(scores))


def _mean_by_hour(scores: DataFrame) -> DataFrame:
    hour = F.to_timestamp("hour", "yyyy-MM-dd-HH").cast("timestamp_ntz")
    return scores.groupBy(hour.alias("hour")).agg(_mean_of_scores().alias("sentiment"))


def _mean_of_scores() -> Column:
    total, n = F.sum(F.round(F.col("sentiment") * 10_000).cast("bigint")), F.count(F.lit(1))
    return F.floor((200 * total + n) / (2 * n)) / 1e6
