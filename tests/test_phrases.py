"""Phrases in the sentiment of texts."""

import random

import pytest
from pyspark.sql import functions as F

from ticktide.functions.sentiment import Rules
from ticktide.operators import phrases, scoring


def plain(words, known):
    result, at = [], 0
    while at < len(words):
        size = max((n for n in range(2, 9) if at + n <= len(words) and " ".join(words[at:at + n]).lower() in known), default=1)
        result.append(phrases.JOINER.join(words[at:at + size]))
        at += size
    return result


@pytest.mark.parametrize("max_rows", [200_000, 1])
def test_the_leftmost_and_longest_phrases_are_held_together(spark, max_rows):
    rng = random.Random(6)
    vocabulary = ["kiss", "of", "death", "The", "the", "bomb", "and", "not"]
    known = {"kiss of death", "kiss of", "of the", "the bomb", "death of the bomb and", "and and", "the the the"}
    texts = [(at, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(14)))) for at in range(150)]
    frame = spark.createDataFrame([*texts, (None, None), (900, ""), (901, "kiss,  of Death!\n")], "id int, text string").repartition(3)
    table = spark.createDataFrame([(p.upper() + " ",) for p in known] + [("single",)], "phrase string")
    rows = phrases.merged_words(frame, ["id"], "text", table, max_rows).collect()
    found = {row.id: row.words for row in rows}
    assert len(rows) == 153 and found[None] == [] and found[900] == [] and found[901] == [f"kiss{phrases.JOINER}of{phrases.JOINER}Death"]
    assert all(found[at] == plain(text.split(), known) for at, text in texts)


def test_many_phrases_are_joined_by_shuffle(spark):
    table = spark.range(100_000).select(F.concat(F.lit("w"), "id", F.lit(" x")).alias("phrase"))
    frame = spark.range(2000).select("id", F.concat(F.lit("a w"), F.col("id") * 100, F.lit(" x b")).alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = phrases.merged_words(frame, ["id"], "text", table, max_rows=1000)
        text = merged._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in text and "CartesianProduct" not in text and "Python" not in text
        assert merged.where(F.size("words") == 3).count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_phrase_has_the_valence_and_is_negated_as_one(spark):
    lexicon = spark.createDataFrame([("kiss", 2.0), ("bad", -2.5)], "token string, valence double")
    table = spark.createDataFrame([("kiss of death", -1.5), ("bad ass", 3.0)], "phrase string, valence double")
    texts = spark.createDataFrame([(1, "a kiss of death"), (2, "a kiss"), (3, "not bad ass!"), (4, "bad")], "id int, text string")
    rules = Rules(negators=("not",))
    found = {r.id: r.sentiment for r in phrases.phrase_sentiment(texts, ["id"], "text", lexicon, table, rules).collect()}
    usual = {r.id: r.sentiment for r in scoring.lexicon_sentiment(texts, ["id"], "text", lexicon, rules).collect()}
    assert found[1] < 0 < usual[1] and found[2] == usual[2] > 0 and found[3] < 0 < usual[3] and found[4] == usual[4]
    none = table.limit(0)
    assert {r.id: r.sentiment for r in phrases.phrase_sentiment(texts, ["id"], "text", lexicon, none, rules).collect()} == usual
