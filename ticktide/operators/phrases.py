"""Phrases of several words that count as one in the sentiment of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.functions import sentiment as rules_of
from ticktide.functions.sentiment import Rules
from ticktide.operators.scoring import lexicon_sentiment
from ticktide.operators.sides import BROADCAST_ROWS, small_table

JOINER = "⁠"  # an invisible sign that holds the words of a phrase together
LONGEST = 8


def merged_words(
    texts: DataFrame, ids: list[str], text: str, phrases: DataFrame, max_rows: int = BROADCAST_ROWS, longest: int = LONGEST
) -> DataFrame:
    """(ids, text, words): the words of each text, with the words of every phrase (column ``phrase``) held together.

    Phrases are found from left to right, at each word the longest one, whatever their case. Every run of as many words as
    some phrase has becomes a key, and keys meet the phrases in a join: broadcast for a counted few phrases, else by
    shuffle, so that their number is not bounded by a task. ``ids`` name a text; phrases have two to ``longest`` words.
    """
    split = F.split(F.lower(F.btrim("phrase")), r"\s+")
    known = phrases.select(F.array_join(split, " ").alias("key"), F.size(split).alias("n"))
    known = known.where(F.col("n").between(2, longest)).distinct()
    sizes = sorted(row["n"] for row in known.select("n").distinct().collect())
    cut = texts.select(*ids, text, rules_of.words(F.col(text)).alias("words"))
    if not sizes:
        return cut
    lowered = F.transform("words", lambda word: F.lower(word))

    def runs(size: int) -> Column:
        starts = F.when(F.size("words") >= size, F.sequence(F.lit(1), F.size("words") - size + 1)).otherwise(F.array())
        return F.transform(starts, lambda at: F.struct(
            at.alias("at"), F.lit(-size).alias("less"), F.array_join(F.slice(F.col("lowered"), at, size), " ").alias("key")))

    keyed = cut.select(*ids, "words", lowered.alias("lowered")).select(*ids, F.inline(F.concat(*[runs(n) for n in sizes])))
    met = keyed.join(small_table(known.select("key"), max_rows), "key", "left_semi")
    found = met.groupBy(*[F.col(name).alias(f"_{name}") for name in ids]).agg(
        F.array_sort(F.collect_list(F.struct("at", "less"))).alias("found"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in ids]
    joined = cut.join(found, same, "left")

    start = F.struct(F.lit(1).alias("free"), F.array().cast("array<struct<at:int,n:int>>").alias("taken"))
    chosen = F.aggregate(F.coalesce("found", F.array().cast("array<struct<at:int,less:int>>")), start, lambda state, hit: F.when(
        hit["at"] >= state["free"],
        F.struct((hit["at"] - hit["less"]).alias("free"),
                 F.concat(state["taken"], F.array(F.struct(hit["at"].alias("at"), (-hit["less"]).alias("n")))).alias("taken")),
    ).otherwise(state))["taken"]

    def held(word: Column, place: Column) -> Column:
        """The whole phrase at its first word, null at its others, and every other word as it is."""
        over = F.filter(F.col("taken"), lambda hit: (hit["at"] <= place + 1) & (place + 1 < hit["at"] + hit["n"]))
        first = F.get(over, F.lit(0))
        whole = F.array_join(F.slice(F.col("words"), place + 1, F.greatest(first["n"], F.lit(1))), JOINER)
        return F.when(F.size(over) == 0, word).when(first["at"] == place + 1, whole)

    taken = joined.withColumn("taken", chosen)
    merged = F.when(F.size("taken") == 0, F.col("words")).otherwise(F.array_compact(F.transform("words", held)))
    return taken.select(*ids, text, merged.alias("words"))


def phrase_sentiment(
    texts: DataFrame, ids: list[str], text: str, lexicon: DataFrame, phrases: DataFrame, rules: Rules = Rules(),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """As ``lexicon_sentiment``, with phrases (columns ``phrase`` and ``valence``) that stand for their words: these have no
    valence of their own and neither strengthen nor negate, the phrase as a whole is strengthened and negated."""
    merged = merged_words(texts, ids, text, phrases, max_rows)
    tokens = F.array_join(F.split(F.lower(F.btrim("phrase")), r"\s+"), JOINER)
    both = lexicon.select("token", "valence").unionByName(phrases.select(tokens.alias("token"), "valence"))
    return lexicon_sentiment(merged, ids, text, both, rules, words="words")
