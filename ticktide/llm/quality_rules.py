"""Learned decision lists over text statistics.

Sequential covering on labelled rows: a rule is grown as a conjunction of thresholds by information gain on two
thirds of the rows, pruned on the rest and kept while it is precise enough; the bad rows it covers are
removed and the next rule is learned. The list is emitted as ordered Spark conditional expressions, so applying it
stays inside Spark's generated code and every verdict names its rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktide.llm.tables import hashed_sample, staged
from ticktide.llm.words import mix, text_of, text_slices, words_of

SAMPLE_ROWS = 20_000   # labelled rows from which a list is learned
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_PRECISION = 0.95   # share of bad rows among those a rule covers, on the pruning rows as well
MIN_COVER = 5
CUTS = 48              # candidate thresholds per statistic
WINDOW = 3


def _table(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


_LEAD = np.ones(256, bool)
_LEAD[128:192] = False
_SYMBOLS = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_MARKS = _table(b"!?")
_DIGITS = _table(b"0123456789")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits", "n_lines")

def statistics() -> dict[str, Column]:
    """The shares over which rules are learned; zero where there is nothing to divide by."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    return {
        "mean_word": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "upper_share": share("n_upper", "word_chars"), "mark_share": share("n_marks", "n_words"),
        "digit_share": share("n_digits", "word_chars"), "words_per_line": share("n_words", "n_lines"),
    }


def _distinct_per_row(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ mix(row.astype(np.uint64) + np.uint64(1)))


def _counts(column: pa.Array) -> list[np.ndarray]:
    words = words_of(column)
    texts, row = len(column), words.row
    lead = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_LEAD[words.data], out=lead[1:])
    chars = np.bincount(row, lead[words.end] - lead[words.start], texts).astype(np.int64)
    lines = words.lines()
    line_row = lines.row
    n_lines = np.bincount(line_row, minlength=texts)
    _, at = np.unique(_distinct_per_row(line_row, lines.hashes()), return_index=True)
    duplicates = n_lines - np.bincount(line_row[at], minlength=texts)
    repeated = np.zeros(len(row), bool)
    if len(row) >= WINDOW:
        hashes = words.hashes()
        span = len(row) - WINDOW + 1
        window = np.zeros(span, np.uint64)
        for k in range(WINDOW):
            window = mix(window + hashes[k:k + span])
        inside = np.flatnonzero(row[:span] == row[WINDOW - 1:])
        _, back, times = np.unique(_distinct_per_row(row[inside], window[inside]), return_inverse=True, return_counts=True)
        again = inside[times[back] > 1]
        for k in range(WINDOW):
            repeated[again + k] = True
    n_repeated = np.bincount(row[repeated], minlength=texts)
    return [np.diff(words.first), chars, words.per_text(_SYMBOLS), duplicates, n_repeated, words.per_text(_UPPER),
            words.per_text(_MARKS), words.per_text(_DIGITS), n_lines]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text; null and empty texts count zero everywhere."""
    def work(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                found = [pa.array(np.asarray(value, np.int64)) for value in _counts(text_of(batch, "text"))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["doc_id", *COUNTS])

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(work, "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        value = values[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold

    def column(self) -> Column:
        value = statistics()[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    inside = np.ones(size, bool)
    for condition in rule:
        inside &= condition.holds(values)
    return inside


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition of the largest gain until no good row is covered or no condition gains."""
    inside, rule = np.ones(len(bad), bool), ()
    while len(rule) < MAX_CONDITIONS and inside.any() and not bad[inside].all():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        level, best = np.log2(p / (p + n)), (1e-9, None)
        for name, value in values.items():
            known, order = value[inside], bad[inside]
            for cut in np.unique(np.quantile(known, np.linspace(0, 1, CUTS))):
                for above in (True, False):
                    met = known > cut if above else known <= cut
                    hit = order[met].sum()
                    if hit >= MIN_COVER:
                        gain = hit * (np.log2(hit / met.sum()) - level)
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(cut)))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = _covered(rule, values, len(bad))
    hit, total = bad[inside].sum(), inside.sum()
    return (2.0 * hit - total) / total if total else -1.0


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop final conditions as long as the rule gets no worse on rows it was not grown on."""
    options = [rule[:size] for size in range(len(rule), 0, -1)]
    return max(options, key=lambda option: (_worth(option, values, bad), -len(option))) if options else rule


def _centre(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Move each threshold half way to the bulk of the covered bad rows, so that rows just beyond what good
    training rows showed are given the benefit of the doubt."""
    inside = _covered(rule, values, len(bad)) & bad
    return tuple(Condition(c.statistic, c.above, float(
        (c.threshold + np.quantile(values[c.statistic][inside], 0.02 if c.above else 0.98)) / 2)) for c in rule)


def learn(values: dict[str, np.ndarray], bad: np.ndarray, seed: int = 3) -> list[Rule]:
    """Ordered rules for bad rows. None are found where a label is missing or nothing separates the labels."""
    rules = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and bad[left].sum() >= 2 * MIN_COVER:
        at = np.flatnonzero(left)
        growing = rng.random(len(at)) < 2 / 3
        grow, prune = at[growing], at[~growing]
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        rule = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        if not rule:
            break
        precise = []
        for part in (grow, prune):
            inside = _covered(rule, {k: v[part] for k, v in values.items()}, len(part))
            precise.append(bad[part][inside].mean() if inside.any() else 0.0)
        covered = left & _covered(rule, values, len(bad))
        if min(precise) < MIN_PRECISION or covered[bad].sum() < MIN_COVER:
            break
        rule = _centre(rule, {k: v[left] for k, v in values.items()}, bad[left])
        rules.append(rule)
        left &= ~_covered(rule, values, len(bad))
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """The text of the first rule that holds, null if none does."""
    chain = None
    for rule in rules:
        met = rule[0].column()
        for condition in rule[1:]:
            met = met & condition.column()
        label = F.lit(" and ".join(map(str, rule)))
        chain = F.when(met, label) if chain is None else chain.when(met, label)
    return F.lit(None).cast("string") if chain is None else chain.otherwise(F.lit(None).cast("string"))


def judged(docs: DataFrame, labels: DataFrame, seed: int = 3) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept and the rule that dropped it.

    Rules are learned from documents that pass the base and have a quality label, SAMPLE_ROWS of them by a hash of
    the id; documents that pass the base are kept unless a rule holds. If a label is repeated the worse one counts,
    null labels are ignored, and without labels of both kinds there are no rules. Null and empty texts fail the
    base. Repeated documents are judged each, a null doc_id has no label, extra columns are ignored.
    """
    counts = staged(measured(docs), "quality-counts")
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    passing = counts.where(~base_failed()).select("doc_id", *[value.alias(name) for name, value in statistics().items()])
    drawn = passing.join(known, "doc_id").withColumn("draw", F.xxhash64(F.lit(seed), "doc_id"))
    sample = hashed_sample(drawn, "draw", SAMPLE_ROWS).toPandas().sort_values(["draw", "doc_id"])
    values = {name: sample[name].to_numpy(float) for name in statistics()}
    rule = first_rule(learn(values, (sample["quality"] == 0).to_numpy(bool), seed))
    return counts.select("*", base_failed().alias("base_failed"), rule.alias("rule")).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())
