"""Rule-based sentiment (Hutto & Gilbert, ICWSM 2014) as column expressions.

A text becomes one row per word. Rows meet the lexicon in a join, the rules adjust what was found, and a
sum per text gives the score; see ``operators.scoring``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the published method.
NORMALISER = 15.0
CAPS_GAIN = 0.733
NEGATION_FACTOR = -0.74
DEGREE_GAIN = 0.293
DISTANCE_DECAY = (1.0, 0.95, 0.9)
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
EXCLAMATION_GAIN, EXCLAMATION_MAX = 0.292, 4
QUESTION_GAIN, QUESTION_MAX, QUESTION_CAP = 0.18, 3, 0.96

# Fixed value: the punctuation taken off both ends of a word.
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""


# Largest number of rule words; they are literals of the plan.
RULE_WORDS = 10_000


@dataclass(frozen=True)
class Rules:
    """Word lists of the rule families and the word behind which a text turns. Without words no rule applies."""

    negators: tuple[str, ...] = ()
    intensifiers: tuple[str, ...] = ()
    dampeners: tuple[str, ...] = ()
    contrast: str = ""


def rules_of(table: DataFrame) -> Rules:
    """Rules from an input table (token, kind) with the kinds negator, intensifier, dampener and contrast."""
    rows = table.select("token", "kind").distinct().limit(RULE_WORDS + 1).collect()
    if len(rows) > RULE_WORDS:
        raise ValueError(f"more than {RULE_WORDS} rule words")
    found = {kind: tuple(sorted(r["token"] for r in rows if r["kind"] == kind))
             for kind in ("negator", "intensifier", "dampener", "contrast")}
    return Rules(found["negator"], found["intensifier"], found["dampener"], next(iter(found["contrast"]), ""))


def words(text: Column) -> Column:
    """Words without edge punctuation; short leftovers stay whole so that ``:)`` survives."""

    def bare(word: Column) -> Column:
        inner = F.btrim(word, F.lit(PUNCTUATION))
        return F.when(F.length(inner) > 2, inner).otherwise(word)

    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda word: word != "")
    return F.transform(pieces, bare)


def shouted(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def partly_shouted(tokens: Column) -> Column:
    return F.exists(tokens, shouted) & ~F.forall(tokens, shouted)


def degrees(tokens: Column, lowered: Column, loud: Column, rules: Rules) -> Column:
    """How far each word strengthens (+) or weakens (-) the words after it; 0 for an ordinary word."""

    def degree(word: Column, at: Column) -> Column:
        gain = F.when(word.isin(*rules.intensifiers), DEGREE_GAIN).when(word.isin(*rules.dampeners), -DEGREE_GAIN)
        extra = F.when(loud & shouted(F.get(tokens, at)), CAPS_GAIN).otherwise(0.0)
        return F.when(gain.isNotNull(), gain + extra).otherwise(0.0)

    return F.transform(lowered, degree)


def negations(lowered: Column, rules: Rules) -> Column:
    return F.transform(lowered, lambda word: word.isin(*rules.negators) | word.contains("n't"))


def word_valence(
    valence: Column, word: Column, spot: Column, degree: Column, negated: Column, loud: Column, contrast_at: Column
) -> Column:
    """Valence of the word at ``spot`` (from 0) after caps, degree words, negation and contrast.

    ``degree`` and ``negated`` are the whole text's arrays; only words found in the lexicon look at them.
    """
    value = valence + F.signum(valence) * F.when(loud & shouted(word), CAPS_GAIN).otherwise(0.0)
    for back, decay in enumerate(DISTANCE_DECAY, start=1):
        near = F.coalesce(F.get(degree, spot - back), F.lit(0.0)) * F.lit(decay)
        flips = F.coalesce(F.get(negated, spot - back), F.lit(False))
        value = value + F.signum(value) * near
        value = value * F.when(flips, NEGATION_FACTOR).otherwise(1.0)
    side = (
        F.when(contrast_at == 0, 1.0)
        .when(spot + 1 < contrast_at, BEFORE_CONTRAST)
        .when(spot + 1 > contrast_at, AFTER_CONTRAST)
        .otherwise(1.0)
    )
    return F.when(valence.isNull(), 0.0).when(F.get(degree, spot) != 0, 0.0).otherwise(value * side)


def emphasis(text: Column) -> Column:
    """Extra strength from exclamation and question marks."""

    def marks(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    exclaimed = F.least(marks("!"), F.lit(EXCLAMATION_MAX)) * F.lit(EXCLAMATION_GAIN)
    asked = (
        F.when(marks("?") <= 1, 0.0)
        .when(marks("?") <= QUESTION_MAX, marks("?") * F.lit(QUESTION_GAIN))
        .otherwise(QUESTION_CAP)
    )
    return F.coalesce(exclaimed + asked, F.lit(0.0))


def compound(total: Column, strength: Column) -> Column:
    """Sum of valences squeezed into [-1, 1], to four decimals."""
    loud = total + F.signum(total) * strength
    squeezed = loud / F.sqrt(loud * loud + F.lit(NORMALISER))
    return F.round(F.least(F.greatest(squeezed, F.lit(-1.0)), F.lit(1.0)), 4)


def scorer_udf(score: Callable[[str], float]):
    """Plug in any other scorer; batches cross to Python through Arrow."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: float(score(text)) if text else 0.0).astype("float64")

    return scored
