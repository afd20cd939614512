"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source, targets are filled up by weight below a ceiling of repetitions, and every
document is emitted floor(rate) times plus once more with the probability of the fraction. The coin of a
document is a hash of the seed, its id, its text and the number of the equal row, so reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticktide.llm.tables import WORD, staged
from ticktide.operators.sides import small_table

WEIGHTS = (5, 2, 1)
CEILING = 3
COIN_BITS = 52
EQUAL_ROWS = 10_000  # rows that one row is turned into in a task


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(doc_id: Column, text_hash: Column, nth: Column, seed: int) -> Column:
    """A number in [0, 1) from the md5 of seed, id, the text's md5 and the number of the equal row; the SQL check can
    compute the same."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), text_hash, nth)
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, COIN_BITS // 4), 16, 10).cast("long") / float(1 << COIN_BITS)


def text_md5(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def numbered(groups: DataFrame, size: str, name: str, block: int = EQUAL_ROWS) -> DataFrame:
    """Each row as often as column ``size`` says, numbered from 1; one that stands for very many is dealt out in blocks."""
    first = F.col("__block") * block + 1
    each = F.explode(F.sequence(first, F.least(first + (block - 1), F.col(size)))).alias(name)
    blocked = groups.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(size) - 1) / block))))
    few = blocked.where(F.col(size) <= block).select("*", each)
    many = blocked.where(F.col(size) > block).repartition(F.col("__block")).select("*", each)
    return few.unionByName(many).drop("__block", size)


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Give the sources the repeating weights in code point order, null last, without one global window.

    Sources are dealt out by range; each range is numbered on its own and moved by the number of sources in
    the ranges before it, which is a cumulative sum over one row per range.
    """
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last())
    placed = staged(ranged.withColumn("row", F.monotonically_increasing_id()), "mix-order").withColumns({
        "range": F.shiftright("row", 33), "at": F.col("row").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("skip"))
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("skip") + F.col("at")) % len(weights) + 1).cast("int"))
    return placed.join(before, "range").withColumn("weight", choice.cast("long")).drop("row", "range", "at", "skip")


def targets(sources: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """Append ``target``: the share of all words by weight, at most ``ceiling`` times the source's words.

    Sources above their ceiling are fixed at it and the excess is shared anew among the others, until none is
    above. Only the four totals of a round reach the driver, whatever the number of sources. A source without
    words has target zero. With no source above its ceiling the targets add up to all words.
    """
    top = F.col("source_size") * ceiling
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all")).first()["all"]
    level, known = None, -1
    while True:
        free = F.lit(True) if level is None else F.lit(level[0]) * F.col("weight") <= top * level[1]
        sums = sources.agg(
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0)).alias("weights"),
            F.coalesce(F.sum(F.when(~free, top)), F.lit(0)).alias("fixed"),
            F.count(F.when(~free, F.lit(1))).alias("n"),
        ).first()
        if sums["n"] == known:
            break
        known = sums["n"]
        if not sums["weights"]:
            break
        level = (total - sums["fixed"], sums["weights"])
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    share = F.lit(level[0]) * F.col("weight")
    return sources.withColumn(
        "target", F.when(share <= top * level[1], share.cast("double") / float(level[1])).otherwise(top.cast("double")))


def rates(sized: DataFrame, weights: tuple[int, ...], ceiling: int) -> DataFrame:
    """(__source, source_size, target, rate) per source; broadcast only below a counted number of sources."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = targets(staged(weighted(sources, weights), "mix-sources"), ceiling)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = known.select(F.col("source").alias("__source"), "source_size", "target", rate.alias("rate"))
    return small_table(staged(known, "mix-rates"))


def copies(doc_id: Column, text_hash: Column, nth: Column, seed: int, rate: str = "rate") -> Column:
    whole = F.floor(rate)
    return whole + (coin(doc_id, text_hash, nth, seed) < F.col(rate) - whole).cast("long")


def plan(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    size is the number of words (null text: 0). copies is floor(rate) plus one with the probability of
    the fraction, for which every document has a coin of its own, also those that share an id or are equal in id, source
    and text: equal rows are counted and numbered. A source of size zero has rate zero. Null sources form one source.
    Extra columns are ignored; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", text_md5(F.col("text")).alias("__text"), word_count(F.col("text")).alias("size"))
    groups = staged(sized.groupBy("doc_id", "source", "__text", "size").agg(F.count(F.lit(1)).alias("__equal")), "mix-sizes")
    known = rates(groups.select("source", (F.col("size") * F.col("__equal")).alias("size")), weights, ceiling)
    each = numbered(groups, "__equal", "__nth")
    joined = each.join(known, F.col("source").eqNullSafe(F.col("__source")))
    times = copies(F.col("doc_id"), F.col("__text"), F.col("__nth"), seed)
    taken = F.col("copies") * F.col("size")
    return joined.withColumn("copies", times).withColumn("taken", taken).drop("__source", "__text", "__nth")


def mixed(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """The documents themselves, each as often as its plan says, with their own columns only.

    Rows that are equal in id and text have their place in the table in their coins instead of a number, which needs no
    group of them; a rerun over the same table gives the same.
    """
    sized = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("size"))
    known = rates(sized, weights, ceiling).select(F.col("__source").alias("__mix_source"), F.col("rate").alias("__mix_rate"))
    coined = docs.withColumns({
        "__mix_text": text_md5(F.col("text")), "__mix_row": F.monotonically_increasing_id()})
    again = coined.groupBy(F.col("doc_id").alias("__mix_id"), F.col("__mix_text").alias("__mix_same")).agg(
        F.count(F.lit(1)).alias("__mix_equal")).where(F.col("__mix_equal") > 1)
    again = small_table(staged(again, "mix-equal"))
    marked = coined.join(again, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_text") == F.col("__mix_same")), "left")
    nth = F.when(F.col("__mix_equal").isNull(), 1).otherwise(F.col("__mix_row"))
    joined = marked.withColumn("__mix_nth", nth).join(known, F.col("source").eqNullSafe(F.col("__mix_source")))
    times = copies(F.col("doc_id"), F.col("__mix_text"), F.col("__mix_nth"), seed, "__mix_rate").cast("int")
    repeated = joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*docs.columns)
