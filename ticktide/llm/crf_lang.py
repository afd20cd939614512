"""Language of every word and document by a linear-chain conditional random field.

A word's features are its byte affixes, its byte bigrams and trigrams and its row of a lexicon of word counts
per language. Transitions between languages are learned with them. Word labels are forward-backward
marginals, so a text may switch languages; a document's language has the largest mean marginal over the words
that hold a letter.

Training labels are documents' languages. Since a labelled document hardly ever switches, training
sequences are joined from pieces of different documents, which teaches the transitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ticktide.llm.tables import staged, with_largest
from ticktide.llm.words import Words, crc_remainder, mix, text_of, text_slices, words_of

BUCKETS = 1 << 17        # hashed features
LEXICON_WORDS = 30_000   # most frequent words kept in the lexicon, of those seen LEXICON_MIN times
LEXICON_MIN = 20
SAMPLE_DOCS = 500        # labelled documents per language from which the weights are fitted
SAMPLE_WORDS = 120       # words taken from each of them
BLOCK = 32               # words per block of the forward-backward pass
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[65:91] = True
_LETTER[128:] = True


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # BUCKETS x labels
    transitions: np.ndarray  # labels x labels, log scale
    lexicon: np.ndarray      # sorted word hashes
    odds: np.ndarray         # their log-probabilities per label, centred
    trust: np.ndarray        # weight of the lexicon per label


def _lettered(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters' bytes alone, and each word's range in them."""
    keep = _LETTER[words.data]
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return words.data[keep], before[words.start], before[words.end]


def _features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words given as byte ranges: (feature, word index), words ascending per template."""
    size = end - start
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint64)
    front = np.concatenate([np.zeros(4, np.uint8), data]).astype(np.uint64)
    found, owners = [], []

    def add(template: int, code: np.ndarray, owner: np.ndarray) -> None:
        found.append((mix(code | np.uint64(template << 40)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(owner)

    for n in (1, 2, 3):
        owner = np.flatnonzero(size >= n)
        at = start[owner]
        add(n, sum(padded[at + k] << np.uint64(8 * k) for k in range(n)), owner)
    for n in (1, 2, 3, 4):
        owner = np.flatnonzero(size >= n)
        at = end[owner] + 4 - n
        add(4 + n, sum(front[at + k] << np.uint64(8 * k) for k in range(n)), owner)
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        owner = np.repeat(np.arange(len(size)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + start[owner]
        add(10 + n, sum(padded[at + k] << np.uint64(8 * k) for k in range(n)), owner)
    return np.concatenate(found), np.concatenate(owners)


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a chunk: one index of each, its hash, and each word's place among them."""
    hashes, at, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return hashes, at, back


def _lexicon_rows(model: Model, hashes: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(hashes), len(model.labels)))
    if len(model.lexicon):
        at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
        known = model.lexicon[at] == hashes
        rows[known] = model.odds[at[known]]
    return rows


def _emissions(model: Model, hashes, data, start, end) -> np.ndarray:
    features, owner = _features(data, start, end)
    size = len(start)
    total = _lexicon_rows(model, hashes) * model.trust
    for label in range(len(model.labels)):
        total[:, label] += np.bincount(owner, model.weights[features, label], size)
    return total


class Chain:
    """Exact forward-backward over many sequences at once, in blocks of a fixed number of words.

    Each block's product of transition matrices is formed for all blocks together; only the pass over the
    blocks of one sequence is sequential, so a very long text costs few steps.
    """

    def __init__(self, first: np.ndarray, labels: int):
        length = np.diff(first)
        self.blocks = -(-length // BLOCK)
        self.labels = labels
        self.begin = np.cumsum(self.blocks) - self.blocks
        total = int(self.blocks.sum())
        place = np.arange(first[-1]) - np.repeat(first[:-1], length)
        self.slot = (np.repeat(self.begin, length) + place // BLOCK, place % BLOCK)
        self.mask = np.zeros((total, BLOCK), bool)
        self.mask[self.slot] = True

    def marginals(self, scores: np.ndarray, transitions: np.ndarray, pairs: bool = False):
        count, L = len(self.mask), self.labels
        step = np.exp(transitions)
        level = scores.max(axis=1, keepdims=True) if len(scores) else scores
        grid = np.ones((count, BLOCK, L))
        grid[self.slot] = np.exp(scores - level)
        whole = self.mask.all(axis=0)
        matrix = np.broadcast_to(np.eye(L), (count, L, L)).copy()
        for t in range(BLOCK):
            moved = (matrix.reshape(-1, L) @ step).reshape(count, L, L) * grid[:, t, None, :]
            moved /= moved.max(axis=(1, 2), keepdims=True)
            matrix = moved if whole[t] else np.where(self.mask[:, t, None, None], moved, matrix)
        into = np.full((count, L), 1.0 / L)
        out = np.ones((count, L))
        order = np.argsort(-self.blocks, kind="stable")
        ranked, begin = self.blocks[order], self.begin[order]
        longest = int(ranked[0]) if len(ranked) else 0
        active = np.searchsorted(-ranked, -np.arange(longest), side="left")  # sequences with more than k blocks
        for k in range(1, longest):
            at = begin[:active[k]] + k
            value = np.einsum("bi,bij->bj", into[at - 1], matrix[at - 1])
            into[at] = value / value.sum(axis=1, keepdims=True)
        for k in range(longest - 2, -1, -1):
            at = begin[:active[k + 1]] + k
            value = np.einsum("bij,bj->bi", matrix[at + 1], out[at + 1])
            out[at] = value / value.max(axis=1, keepdims=True)
        ahead = np.empty((BLOCK, count, L))
        state = into
        for t in range(BLOCK):
            moved = (state @ step) * grid[:, t]
            moved /= moved.sum(axis=1, keepdims=True)
            state = moved if whole[t] else np.where(self.mask[:, t, None], moved, state)
            ahead[t] = state
        result = np.empty((count, BLOCK, L))
        expected = np.zeros((L, L))
        state = out
        for t in range(BLOCK - 1, -1, -1):
            value = ahead[t] * state
            result[:, t] = value / value.sum(axis=1, keepdims=True)
            weighted = grid[:, t] * state
            if pairs:
                before = ahead[t - 1] if t else into
                joint = before[:, :, None] * step * weighted[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                expected += (joint * self.mask[:, t, None, None]).sum(axis=0)
            moved = weighted @ step.T
            moved /= moved.max(axis=1, keepdims=True)
            state = moved if whole[t] else np.where(self.mask[:, t, None], moved, state)
        return (result[self.slot], expected) if pairs else result[self.slot]


def _training_rows(docs: DataFrame, keep: Column) -> DataFrame:
    return docs.where(keep & F.col("lang").isNotNull()).select("doc_id", "text", "lang")


def lexicon_counts(rows: DataFrame) -> DataFrame:
    """(word, lang, n): how often each word, as a 64-bit hash, occurs in the texts of each language."""
    def work(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                words = words_of(text_of(batch, "text"), lower=True)
                names, code = np.unique(np.array(batch.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
                hashes, row = words.hashes(), code[words.row]
                for at, name in enumerate(names):
                    found, n = np.unique(hashes[row == at], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array([name] * len(found), pa.string()), pa.array(n)],
                        ["word", "lang", "n"])

    counted = rows.select("text", "lang").mapInArrow(work, "word long, lang string, n long")
    return counted.groupBy("word", "lang").agg(F.sum("n").alias("n"))


def _sampled(rows: DataFrame, seed: int) -> DataFrame:
    """At most SAMPLE_DOCS rows per language, those with the smallest hashes.

    A hash limit from the language's number of rows leaves somewhat more than that; only those are ordered.
    """
    chosen = F.lit(False)
    for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        share = min(1.0, 1.3 * (SAMPLE_DOCS + 100) / row["n"])
        limit = min(int(-(1 << 63) + share * (1 << 64)), (1 << 63) - 1)
        chosen = chosen | ((F.col("lang") == row["lang"]) & (F.col("draw") <= limit))
    drawn = rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id")).where(chosen)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return drawn.withColumn("at", place).where(F.col("at") <= SAMPLE_DOCS)


def fit(docs: DataFrame, keep: Column | None = None, seed: int = 5, rounds: int = 60) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that satisfy ``keep`` and have a language.

    The lexicon counts the words of all those texts and keeps the LEXICON_WORDS most frequent. The weights are
    fitted on SAMPLE_DOCS documents per language, chosen by a hash of the id, SAMPLE_WORDS words of each from
    its middle. Without any labelled row the model has no labels and predicts ``und`` everywhere.
    """
    rows = _training_rows(docs, F.lit(True) if keep is None else keep)
    counts = lexicon_counts(rows)
    words = counts.groupBy("word").agg(F.sum("n").alias("total"), F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by")).where(F.col("total") >= LEXICON_MIN)
    top = with_largest(staged(words, "crf-words"), "total", LEXICON_WORDS).collect()
    sample = _sampled(rows, seed)
    pieces = F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " ")
    middle = F.greatest(F.lit(1), F.floor((F.size("w") - SAMPLE_WORDS) / 2) + 1).cast("int")
    sample = sample.select("lang", "doc_id", pieces.alias("w")).where(F.size("w") > 0)
    sample = sample.select("lang", "doc_id", F.array_join(F.slice("w", middle, SAMPLE_WORDS), " ").alias("text"))
    known = sorted(((r["lang"], str(r["doc_id"]), r["text"]) for r in sample.where("text != ''").collect()))
    return _fit(known, top, seed, rounds)


def _fit(known: list[tuple], top: list, seed: int, rounds: int) -> Model:
    labels = sorted({lang for lang, _, _ in known})
    L = len(labels)
    lexicon = sorted((r["word"] & ((1 << 64) - 1), [r["by"].get(lang, 0) for lang in labels]) for r in top)
    share = np.log(np.array([n for _, n in lexicon], float).reshape(-1, max(L, 1)) + 0.5)
    model = Model(labels, np.zeros((BUCKETS, max(L, 1))), np.zeros((L, L)), np.array([w for w, _ in lexicon], np.uint64),
                  share - share.mean(axis=1, keepdims=True), np.full(max(L, 1), 0.1))
    if L < 2:
        return model
    rng = np.random.default_rng(seed)
    pieces, truth = [], []
    for lang, _, text in known:
        parts, at = text.split(" "), 0
        while at < len(parts):
            width = int(rng.integers(15, 80))
            pieces.append(" ".join(parts[at:at + width]))
            truth.append(labels.index(lang))
            at += width
    order = rng.permutation(len(pieces))
    words = words_of(pa.array([pieces[at] for at in order], pa.large_string()), lower=True)
    gold = np.array(truth)[order][words.row]
    groups = np.cumsum(rng.integers(1, 4, len(pieces)))
    cut = np.unique(np.concatenate([[0], groups[groups < len(pieces)], [len(pieces)]]))
    first = words.first[cut]
    data, start, end = _lettered(words)
    hashes, at, back = _distinct(words)
    features, owner = _features(data, start[at], end[at])
    rows = _lexicon_rows(model, hashes)
    chain = Chain(first, L)
    target = np.zeros((len(back), L))
    target[np.arange(len(back)), gold] = 1
    inner = np.setdiff1d(np.arange(1, len(back)), first)
    moves = np.zeros((L, L))
    np.add.at(moves, (gold[inner - 1], gold[inner]), 1)
    parameters = [model.weights, model.transitions, model.trust]
    first_moment, second_moment = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for turn in range(1, rounds + 1):
        total = rows * model.trust
        for label in range(L):
            total[:, label] += np.bincount(owner, model.weights[features, label], len(hashes))
        found, expected = chain.marginals(total[back], model.transitions, pairs=True)
        error = target - found
        word_error = np.stack([np.bincount(back, error[:, label], len(hashes)) for label in range(L)], axis=1)
        slope = np.stack([np.bincount(features, word_error[owner, label], BUCKETS) for label in range(L)], axis=1)
        gradients = [slope - 0.05 * model.weights, moves - expected, (word_error * rows).sum(axis=0)]
        for p, g, m, v, rate in zip(parameters, gradients, first_moment, second_moment, (0.1, 0.1, 0.02)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-6)
    model.weights = model.weights.astype(np.float32)
    return model


def word_marginals(model: Model, column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the texts, each word's probabilities over the labels, and whether it holds a letter."""
    words = words_of(column, lower=True)
    data, start, end = _lettered(words)
    hashes, at, back = _distinct(words)
    scores = _emissions(model, hashes, data, start[at], end[at])[back]
    return words, Chain(words.first, len(model.labels)).marginals(scores, model.transitions), end > start


def _predict(model: Model, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """Language, its mean marginal and the mean of every word's largest marginal, of each text."""
    texts = len(column)
    L = len(model.labels)
    if not L:
        return [UNKNOWN] * texts, np.zeros(texts), np.zeros(texts)
    words, marginals, lettered = word_marginals(model, column)
    row = words.row[lettered]
    mass = np.stack([np.bincount(row, marginals[lettered, label], texts) for label in range(L)], axis=1)
    n = mass.sum(axis=1)
    best = mass.argmax(axis=1)
    score = np.clip(mass.max(axis=1) / np.maximum(n, 1e-300), 0.0, 1.0)
    sure = np.clip(np.bincount(row, marginals[lettered].max(axis=1), texts) / np.maximum(n, 1e-300), 0.0, 1.0)
    ascii_letter = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_LETTER[words.data] & (words.data < 128), out=ascii_letter[1:])
    plain = ascii_letter[words.offsets[1:]] > ascii_letter[words.offsets[:-1]]
    predicted = []
    for at in range(texts):
        letter = plain[at] or (n[at] > 0 and any(map(str.isalpha, column[at].as_py())))
        predicted.append(model.labels[best[at]] if letter else UNKNOWN)
        if not letter:
            score[at] = sure[at] = 0.0
    return predicted, score, sure


def label(docs: DataFrame, model: Model, text: str = "text", prediction: str = "lang_pred", score: str = "score",
          certainty: str | None = None) -> DataFrame:
    """Append the predicted language of each whole text and its mean marginal.

    Null and empty texts, and texts without a letter, are ``und`` with score 0. Only the text is looked at. Columns
    of the same names are replaced. Equal means are resolved in favour of the smaller label. ``certainty`` names a
    further column with the mean of every word's largest marginal, which is high for a text that switches between languages.
    """
    added = [prediction, score, *([certainty] if certainty else [])]
    docs = docs.drop(*added)
    schema = StructType([*docs.schema.fields, StructField(prediction, StringType()), *[StructField(name, DoubleType()) for name in added[1:]]])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def work(batches):
        for whole in batches:
            for batch in text_slices(whole, text):
                names, *values = _predict(shared.value, text_of(batch, text))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), *map(pa.array, values[:len(added) - 1])], [*batch.schema.names, *added])

    return docs.mapInArrow(work, schema)


def predict(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Per document doc_id, held_out, lang_pred, score; learned from documents that are not held out.

    A document is held out if crc32 of its id as text is divisible by ``modulus``; a null id counts as the
    empty text. Repeated rows stay repeated, an empty table gives an empty result, extra columns are ignored.
    """
    held = crc_remainder(F.col("doc_id"), modulus) == 0
    model = fit(docs, ~held)
    return label(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def accepted(docs: DataFrame, min_score: float = 0.5, modulus: int = 5) -> DataFrame:
    """The documents whose words are of known languages, one or several, with a mean certainty of at least ``min_score``,
    with their own columns."""
    model = fit(docs, crc_remainder(F.col("doc_id"), modulus) != 0)
    named = label(docs, model, prediction="__lang", score="__score", certainty="__sure")
    return named.where((F.col("__lang") != UNKNOWN) & (F.col("__sure") >= min_score)).select(*docs.columns)
