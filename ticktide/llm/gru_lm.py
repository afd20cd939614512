"""Complete-document log-likelihood under a gated recurrent language model.

Word counts come from all training documents. The most frequent words form the vocabulary of a gated recurrent
network written in numpy; they are dealt into classes by frequency, so a word's probability is that of its
class times that within the class. All other words share one class, within which a word is as probable as its
smoothed count in the corpus, so that the probabilities of all words, seen or not, add up to one.

The network is trained by truncated backpropagation, in one pass over all training documents in whole at every size. The
counted words only decide how many shards there are. A shard goes through lanes, each of which carries its state through
whole texts; each round trains on its part of the documents and averages the shards' weights. Scoring carries the state likewise. Counts of words beyond
those that every task holds are joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktide.llm.tables import staged, with_largest
from ticktide.llm.words import crc_remainder, text_of, text_slices, words_of
from ticktide.session import scratch_path

WORDS = 4_096         # vocabulary of the network
CLASS_WORDS = 64
HIDDEN = 16
COMMON = 1 << 18      # words whose counts every task holds: at most 4 MB
LEAD = np.uint64(44)  # a hash shifted by this leaves its leading 20 bits
ROUNDS = 4                 # averages of the shards' weights; each round trains on its own quarter of the documents
SHARD_TOKENS = 1 << 21     # words that a shard trains on in a round, give or take those of a text
LANES, WINDOW, RATE = 256, 24, 0.01
LARGE = 40.0               # exponents within this bound need no shift: 64 of them add up in 32 bits
FILLED = 8                 # windows that a lane is filled for at a time
CHUNK = 1 << 12            # rows whose class scores are made at a time
SCORED = 1 << 17           # states that are scored at a time
GROUP_TOKENS = 1 << 22     # words of the texts that take their steps together, give or take those of a slice
PIECE = 1 << 14            # weights that are averaged in one row
END = np.uint64(0)    # stands for the end of a text among the word hashes
KEPT = 31 << 20       # bytes; the allocator's own bound is 32 MB
PENDING = 1 << 20     # distinct words that a task gathers before it hands counts on


def _keep_memory() -> None:
    """Let the allocator keep the memory of freed arrays below this size, which it does once one of it was freed.

    Otherwise the arrays of each window are given back to the system, which zeroes their pages again for the next one.
    """
    np.empty(KEPT, np.uint8)


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts, each followed by END, and the index of each text's first."""
    words = words_of(column, lower=True)
    first = words.first + np.arange(len(words.first))
    result = np.full(first[-1], END)
    result[np.arange(len(words.start)) + words.row] = np.maximum(words.hashes(), np.uint64(1))
    return result, first


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts, ends included; words are 64-bit hashes, counted in each task before the shuffle."""
    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        words, back = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(back, np.concatenate([n for _, n in parts]), len(words)).astype(np.int64)

    def work(batches):
        _keep_memory()
        parts, size = [], 0
        for whole in batches:
            for batch in text_slices(whole, "text"):
                parts.append(np.unique(_hashes(text_of(batch, "text"))[0], return_counts=True))
                size += len(parts[-1][0])
                if size > 2 * PENDING:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > PENDING:
                        yield _batch(*parts[0])
                        parts, size = [], 0
        if parts:
            yield _batch(*merged(parts))

    counted = docs.select("text").mapInArrow(work, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _batch(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])


@dataclass
class Vocabulary:
    """What every task holds of the counts: the common words, sorted by hash, and the corpus totals."""

    words: np.ndarray    # sorted hashes of the common words, END among them if it was seen
    n: np.ndarray
    number: np.ndarray   # their number in the network: 0 .. size - 1, size (others) or size + 1 (end)
    size: int            # words of the network
    frequency: np.ndarray  # counts of the network's words, by number
    tokens: int
    types: int
    ends: int

    @property
    def classes(self) -> int:
        """Classes of words; behind them come the class of all other words and that of the end."""
        return -(-self.size // CLASS_WORDS)

    @cached_property
    def begins(self) -> np.ndarray:
        """Place of the first common word at or above each value of a hash's leading bits; few values have several words."""
        lead = (self.words >> LEAD).astype(np.int64)
        return np.concatenate([[0], np.cumsum(np.bincount(lead, minlength=1 << 64 - int(LEAD)))]).astype(np.int32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the common words, or behind the last one."""
        lead = (hashes >> LEAD).astype(np.int32)
        place, stop = self.begins[lead], self.begins[1:][lead]
        keys = np.append(self.words, END)
        open_ = np.flatnonzero((place < stop) & (keys[place] != hashes))
        while len(open_):
            place[open_] += 1
            at = place[open_]
            open_ = open_[(at < stop[open_]) & (keys[at] != hashes[open_])]
        place[place == stop] = len(self.words)
        return place

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash in the network."""
        return self.look_up(hashes)[1]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, number and whether the count is held here, of each hash."""
        place, end = self.places(hashes), hashes == END
        number = np.append(self.number, self.size).astype(np.int16)[place]
        number[end] = self.size + 1
        return np.append(self.n, 0)[place], number, (place < len(self.words)) | end

    @property
    def other_mass(self) -> int:
        """Tokens and types outside of the network's words and the end, and one for unseen words."""
        other_types = self.types - self.size - (self.ends > 0)
        return self.tokens - int(self.frequency.sum()) - self.ends + other_types + 1


def vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types"),
                        F.coalesce(F.sum(F.when(F.col("word") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    top = with_largest(counts, "n", COMMON).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words, n = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    inner = np.flatnonzero(words != END)[:WORDS]
    number = np.full(len(words), len(inner))
    number[inner] = np.arange(len(inner))
    number[words == END] = len(inner) + 1
    order = np.argsort(words)
    return Vocabulary(words[order], n[order], number[order], len(inner), n[inner], int(totals["tokens"]),
                      int(totals["types"]), int(totals["ends"]))


def _exponents(scores: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """exp of the scores in place, less the row's maximum unless they are known to be small, and the rows' sums.

    Sums over rows are products with ones, which is faster than adding up short rows.
    """
    if not small:
        scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    return scores, scores @ np.ones(scores.shape[1], scores.dtype)


def _log_softmax_at(scores: np.ndarray, column: np.ndarray, small: bool) -> np.ndarray:
    """The logarithm of each row's softmax at one column."""
    scores, total = _exponents(scores, small)
    return np.log(scores[np.arange(len(column)), column] / total)


def _slopes(states: np.ndarray, weights: np.ndarray, column: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log-softmax at one column of each row: by the weights, the last of which are the biases,
    and by the states. What the softmax is divided by goes into the states and their gradients, which are narrower."""
    scores, total = _exponents(states @ weights, small)
    scores[np.arange(len(column)), column] -= total
    share = np.reciprocal(total)[:, None]
    back = scores @ weights[:-1].T
    back *= share
    return (states * share).T @ scores, back


class Network:
    """Weights: input rows per word number, recurrent matrix, class outputs, word outputs within each class."""

    NAMES = ("into", "again", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, vocabulary: Vocabulary, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.size, self.classes = vocabulary.size, vocabulary.classes
        count = self.classes + 2
        self.into = rng.normal(0, 0.1, (self.size + 2, 3 * HIDDEN)).astype(np.float32)
        self.again = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32)
        self.to_class = np.zeros((HIDDEN, count), np.float32)
        self.to_word = np.zeros((self.classes, HIDDEN, CLASS_WORDS), np.float32)
        padded = np.zeros(self.classes * CLASS_WORDS)
        padded[:self.size] = vocabulary.frequency
        by_class = padded.reshape(-1, CLASS_WORDS)
        mass = np.concatenate([by_class.sum(axis=1), [vocabulary.other_mass, vocabulary.ends + 1]])
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.word_bias = np.where(by_class > 0, np.log(by_class), -30).astype(np.float32)  # places without a word

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def packed(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parameters()]).astype(np.float32).tobytes()

    def load(self, raw: bytes | np.ndarray) -> Network:
        flat, at = np.frombuffer(raw, np.float32) if isinstance(raw, bytes) else raw, 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, flat[at:at + old.size].reshape(old.shape).copy())
            at += old.size
        return self

    def small(self) -> bool:
        """Whether no score can pass the bound below which exponents need no shift: states lie between -1 and 1."""
        by_class = np.abs(self.to_class).sum(axis=0) + np.abs(self.class_bias)
        by_word = np.abs(self.to_word).sum(axis=1) + np.abs(self.word_bias)
        return max(by_class.max(initial=0), by_word.max(initial=0)) < LARGE

    def step(self, number: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The state behind each number."""
        x = self.into.take(number, axis=0)
        inner, again, after = (np.empty_like(state) for _ in range(3))
        self._advance(x, state, np.empty((len(x), 2 * HIDDEN), x.dtype), inner, again, after)
        return after

    def _advance(self, x, state, gates, inner, again, after) -> None:
        """One step of the gated unit; gates, the proposed state, its recurrent part and the new state go into arrays."""
        np.matmul(state, self.again[:, :2 * HIDDEN], out=gates)
        np.matmul(state, self.again[:, 2 * HIDDEN:], out=again)
        gates += x[:, :2 * HIDDEN]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[:, HIDDEN:], again, out=inner)
        inner += x[:, 2 * HIDDEN:]
        np.tanh(inner, out=inner)
        np.subtract(state, inner, out=after)
        after *= gates[:, :HIDDEN]
        after += inner

    def log_probability(self, states: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Natural log-probability of each number in the state before it."""
        group = np.where(number < self.size, number // CLASS_WORDS, self.classes + number - self.size)
        result, small = np.empty(len(group), np.float64), self.small()
        for at in range(0, len(group), CHUNK):
            cut = slice(at, at + CHUNK)
            result[cut] = _log_softmax_at(states[cut] @ self.to_class + self.class_bias, group[cut], small)
        order = np.argsort(group.astype(np.int16), kind="stable")
        cuts = np.searchsorted(group[order], np.arange(self.classes + 1))
        for at in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[at]:cuts[at + 1]]
            inner = states.take(own, axis=0) @ self.to_word[at] + self.word_bias[at]
            result[own] += _log_softmax_at(inner, number[own] - at * CLASS_WORDS, small)
        return result

    def window(self, inputs: np.ndarray, outputs: np.ndarray, state: np.ndarray):
        """Gradients over one window (steps x lanes) by truncated backpropagation; also the state to carry on.

        Places with a negative output hold no word and count for nothing.
        """
        steps, lanes = inputs.shape
        ends, x = inputs == self.size + 1, self.into.take(inputs, axis=0)
        before, inner, again, known = (np.empty((steps, lanes, HIDDEN), x.dtype) for _ in range(4))
        gates = np.empty((steps, lanes, 2 * HIDDEN), x.dtype)
        for t in range(steps):
            before[t] = state
            before[t][ends[t]] = 0  # a text begins behind an end
            self._advance(x[t], before[t], gates[t], inner[t], again[t], known[t])
            state = known[t]
        number = outputs.ravel()
        group = np.where(number < self.size, number // CLASS_WORDS, self.classes + number - self.size)
        order = np.argsort(group.astype(np.int16), kind="stable")
        order = order[np.searchsorted(group[order], 0):]  # places without a word come first
        number, group = number[order], group[order]
        flat, small = np.ones((len(order), HIDDEN + 1), x.dtype), self.small()  # a state and the input of the bias
        np.take(known.reshape(-1, HIDDEN), order, axis=0, out=flat[:, :HIDDEN], mode="clip")
        slopes = [np.zeros_like(p) for p in self.parameters()]
        to_class, back = np.vstack([self.to_class, self.class_bias]), np.empty((len(order), HIDDEN), x.dtype)
        d_class = np.zeros_like(to_class)
        for at in range(0, len(order), CHUNK):
            own = slice(at, at + CHUNK)
            slope, back[own] = _slopes(flat[own], to_class, group[own], small)
            d_class += slope
        slopes[2], slopes[3] = d_class[:-1], d_class[-1]
        cuts = np.searchsorted(group, np.arange(self.classes + 1))
        to_word = np.concatenate([self.to_word, self.word_bias[:, None]], axis=1)
        place = number - group * CLASS_WORDS
        for at in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[at], cuts[at + 1])
            slope, more = _slopes(flat[own], to_word[at], place[own], small)
            slopes[4][at], slopes[5][at] = slope[:-1], slope[-1]
            back[own] += more
        by_place = np.zeros((steps * lanes, HIDDEN), x.dtype)
        by_place[order] = back
        count, back = max(1, len(order)), by_place.reshape(steps, lanes, HIDDEN)

        z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
        to_inner, to_z, to_r = (1 - z) * (1 - inner * inner), (before - inner) * z * (1 - z), again * r * (1 - r)
        carried = np.zeros((lanes, HIDDEN), x.dtype)
        d_input, d_again = np.empty_like(x), np.empty_like(x)
        for t in range(steps - 1, -1, -1):
            total, d = back[t] + carried, d_input[t]
            np.multiply(total, to_z[t], out=d[:, :HIDDEN])
            np.multiply(total, to_inner[t], out=d[:, 2 * HIDDEN:])
            np.multiply(d[:, 2 * HIDDEN:], to_r[t], out=d[:, HIDDEN:2 * HIDDEN])
            d_again[t] = d
            d_again[t][:, 2 * HIDDEN:] *= r[t]
            carried = total * z[t]
            carried += d_again[t] @ self.again.T
            carried[ends[t]] = 0
        slopes[1] = before.reshape(-1, HIDDEN).T @ d_again.reshape(-1, 3 * HIDDEN)
        order = np.argsort(inputs.ravel().astype(np.int16), kind="stable")
        read = inputs.ravel()[order]
        first = np.flatnonzero(np.append(True, read[1:] != read[:-1]))
        slopes[0][read[first]] = np.add.reduceat(d_input.reshape(-1, 3 * HIDDEN).take(order, axis=0), first, axis=0)
        for slope in slopes:
            slope /= count
        return slopes, state


def lane_windows(texts: Iterator[np.ndarray], lanes: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every word and end of the texts in windows: inputs and outputs (steps x lanes), and the lanes of the window before
    that go on.

    A lane takes the next text where its last one ends, so no text is cut between lanes. Once the texts run out, places
    without a word have output -1 and lanes without one are left out.
    """
    rest = [np.zeros(0, np.int64)] * lanes
    last, width = np.full(lanes, end), FILLED * WINDOW
    while True:
        filling = np.full((len(rest), width), -1)  # several windows at a time
        for lane in range(len(rest)):
            filled = 0
            while filled < width:
                if not len(rest[lane]):
                    text = next(texts, None)
                    if text is None:
                        break
                    rest[lane] = np.append(text, end)
                taken = rest[lane][:width - filled]
                filling[lane, filled:filled + len(taken)] = taken
                rest[lane] = rest[lane][len(taken):]
                filled += len(taken)
        for at in range(0, width, WINDOW):
            live = np.flatnonzero(filling[:, at] >= 0)
            if not len(live):
                return
            rest, filling = [rest[lane] for lane in live], filling[live]
            outputs = filling[:, at:at + WINDOW]
            inputs = np.hstack([last[live, None], np.where(outputs < 0, end, outputs)[:, :-1]])
            last = outputs[:, -1]
            yield inputs.T, outputs.T, live


def lane_order(length: np.ndarray, lanes: int) -> np.ndarray:
    """The order in which texts of these lengths, ends included, go into the lanes.

    Each begins at a place drawn evenly from those that let it end when the lanes do, if it is not longer than a lane:
    a long text that came last would go on in windows that are nearly empty. The texts come in drawn order.
    """
    room = np.maximum(0, 1 - length * (lanes / max(1, length.sum())))
    return np.argsort(np.arange(len(length)) * room, kind="stable")


def train_shard(network: Network, texts: Iterator[np.ndarray], lanes: int) -> int:
    """One pass over the whole texts as they come, the state carried from window to window; the number of outputs.

    A window with fewer lanes says less about the texts, and its step is shorter by as much.
    """
    state, seen = np.zeros((lanes, HIDDEN), np.float32), 0
    parameters = network.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for turn, (inputs, outputs, live) in enumerate(lane_windows(iter(texts), lanes, network.size + 1), 1):
        slopes, state = network.window(inputs, outputs, state[live])
        seen += int((outputs >= 0).sum())
        norm = max(1.0, float(np.sqrt(sum(np.vdot(slope, slope) for slope in slopes))))
        by_first, by_second = 1 - 0.9 ** turn, 1 - 0.99 ** turn
        for p, s, m, v in zip(parameters, slopes, first, second):
            s *= 0.1 / norm
            m *= 0.9
            m += s
            v *= 0.99
            s *= s
            v += s  # s holds a hundredth of the squared slope
            np.sqrt(v, out=s)
            s += 1e-6 * by_second ** 0.5
            np.divide(m, s, out=s)
            s *= RATE * len(live) / lanes / by_first * by_second ** 0.5
            p -= s
    return seen


def _averaged(trained: DataFrame, shards: int) -> list:
    """Per piece of the weights their mean over the shards by words, summed in two steps of about sqrt(shards) rows each."""
    def total(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "weights"])
        size = int(rows["size"].sum())
        mean = sum(np.frombuffer(w, np.float32) * np.float32(n / size) for n, w in zip(rows["size"], rows["weights"]))
        return pd.DataFrame({"piece": rows["piece"].iloc[:1].to_numpy(), "part": [0], "size": [size], "weights": [mean.tobytes()]})

    step = trained.withColumn("part", F.pmod("part", F.lit(int(shards ** 0.5) or 1)))
    kind = "piece int, part int, size long, weights binary"
    return step.groupBy("piece", "part").applyInPandas(total, kind).groupBy("piece").applyInPandas(total, kind).orderBy("piece").collect()


def fit(docs: DataFrame, known: Vocabulary, seed: int = 9) -> Network:
    """One pass over all documents in whole. Every document belongs to one shard of one round."""
    network = Network(known)
    if not known.size:
        return network
    spark = docs.sparkSession
    vocabulary_everywhere = spark.sparkContext.broadcast(known)
    shards = max(1, -(-known.tokens // (ROUNDS * SHARD_TOKENS)))

    def numbers(batches):
        _keep_memory()
        for whole in batches:
            for batch in text_slices(whole, "text"):
                hashes, first = _hashes(text_of(batch, "text"))
                number = vocabulary_everywhere.value.numbers(hashes)
                rows = [number[low:high].tobytes() for low, high in zip(first[:-1], first[1:] - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())], ["draw", "numbers"])

    drawn = docs.select("text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"))
    numbered = drawn.mapInArrow(numbers, "draw long, numbers binary").withColumn("turn", F.pmod("draw", F.lit(ROUNDS)).cast("int"))
    path = scratch_path(spark, "gru-texts")
    numbered.write.partitionBy("turn").parquet(path)  # so that a round reads its own part only
    texts = spark.read.schema("draw long, numbers binary, turn int").parquet(path)

    def trainer(turn: int):
        weights = spark.sparkContext.broadcast(network.packed())

        def train(rows: pa.Table) -> pa.Table:
            _keep_memory()
            rows = rows.sort_by([("draw", "ascending"), ("numbers", "ascending")])
            own = Network(vocabulary_everywhere.value).load(weights.value)
            order = lane_order(pc.binary_length(rows["numbers"]).to_numpy() // 2 + 1, LANES)
            texts = (np.frombuffer(row.as_py(), np.int16).astype(np.int64) for row in rows["numbers"].take(pa.array(order)))
            seen = train_shard(own, texts, LANES)
            raw = own.packed()
            pieces = [raw[at:at + 4 * PIECE] for at in range(0, len(raw), 4 * PIECE)]
            shard = rows["shard"][0].as_py()
            return pa.table([pa.array(range(len(pieces)), pa.int32()), pa.array([shard] * len(pieces), pa.int32()),
                             pa.array([seen] * len(pieces), pa.int64()), pa.array(pieces, pa.binary())],
                            names=["piece", "part", "size", "weights"])

        return train

    for turn in range(ROUNDS):
        own = texts.where(F.col("turn") == turn)
        shard = F.pmod(F.xxhash64(F.lit(turn), "draw"), F.lit(shards)).cast("int").alias("shard")
        trained = own.select(shard, "draw", "numbers").groupBy("shard").applyInArrow(
            trainer(turn), "piece int, part int, size long, weights binary")
        averaged = _averaged(trained, shards)
        if averaged:
            network.load(b"".join(row["weights"] for row in averaged))
    return network


def log_likelihood(network: Network, number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text, its words and its end, with the state carried from start to end.

    All texts take their steps together, the longest first, so that those which are done need not be looked at again.
    States are kept only until enough have come together to be scored at once.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, size = first[:-1][order], length[order]
    total = np.zeros(len(order))
    state = np.zeros((len(order), HIDDEN), np.float32)
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left").tolist()
    states, wanted, held = [], [], 0

    def settle() -> None:
        found = network.log_probability(np.concatenate(states), np.concatenate(wanted))
        texts = np.concatenate([np.arange(len(some)) for some in wanted])
        total[:] += np.bincount(texts, found, len(total))

    given = np.full(len(order), network.size + 1)
    for t, live in enumerate(active):
        state = network.step(given[:live], state[:live])
        given = number[begin[:live] + t].astype(np.int64)
        states.append(state)
        wanted.append(given)
        held += live
        if held >= SCORED or t + 1 == len(active):
            settle()
            states, wanted, held = [], [], 0
    result = np.empty(len(order))
    result[order] = total
    return result


PARTS = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, base double, other double, "
         "network double, rare array<struct<word: long, n: long>>")


def _parts(docs: DataFrame, known: Vocabulary, network: Network) -> DataFrame:
    """Per document what a task can tell alone, and its words whose counts it does not hold."""
    shared = docs.sparkSession.sparkContext.broadcast((known, network))

    def work(batches):
        _keep_memory()
        held_counts, model = shared.value
        names = [part.split()[0] for part in PARTS.split(", ")[:9]] + ["rare"]
        waiting, numbers, firsts, size = [], [], [], 0

        def together() -> Iterator[pa.RecordBatch]:
            first = np.concatenate([[0], *[part[1:] for part in firsts]])
            found, at = log_likelihood(model, np.concatenate(numbers), first) / np.log(10), 0
            for columns in waiting:
                texts = len(columns[0])
                network_scores = pa.array(found[at:at + texts])
                at += texts
                yield pa.RecordBatch.from_arrays([*columns[:-1], network_scores, columns[-1]], names)

        for whole in batches:
            for batch in text_slices(whole, "text"):
                hashes, first = _hashes(text_of(batch, "text"))
                texts, length = batch.num_rows, np.diff(first)
                row = np.repeat(np.arange(texts), length)
                n, number, held = held_counts.look_up(hashes)
                logs, other = np.log10(n + 1.0), number == model.size
                loose = np.flatnonzero(~held)
                order = loose[np.lexsort((hashes[loose], row[loose]))]
                new = np.ones(len(order), bool)
                new[1:] = (row[order][1:] != row[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
                at = np.flatnonzero(new)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(hashes[order[at]].view(np.int64)), pa.array(np.diff(np.append(at, len(order))).astype(np.int64))],
                    ["word", "n"])
                rare = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row[order[at]], np.arange(texts + 1)).astype(np.int32)), pairs)

                def count(flags):
                    return pa.array(np.bincount(row[flags], minlength=texts))

                waiting.append([
                    batch.column(0), batch.column(1), batch.column(2), pa.array(length), count(n > 0), count(other),
                    pa.array(np.bincount(row, logs, texts)), pa.array(np.bincount(row, np.where(other, logs, 0), texts)), rare])
                numbers.append(number)
                firsts.append(first + size)
                size += len(number)
                if size >= GROUP_TOKENS:
                    yield from together()
                    waiting, numbers, firsts, size = [], [], [], 0
        if waiting:
            yield from together()

    return docs.mapInArrow(work, PARTS)


def scored(docs: DataFrame, modulus: int = 7, held_remainder: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from documents whose crc32 of the id as text has another remainder than ``held_remainder``. A null or
    empty text consists of its end only. Scores are log10 probabilities of the whole text: ``base_score`` of the
    smoothed word counts, ``score`` of the network. Repeated rows are scored each, a null id counts as the empty
    text for the split, extra columns are ignored; an empty table gives an empty result.
    """
    held: Column = crc_remainder(F.col("doc_id"), modulus) == held_remainder
    narrow = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    training = narrow.where(~F.col("held_out"))
    counts = staged(word_counts(training), "gru-counts")
    known = vocabulary(counts)
    network = fit(training, known)
    rows = narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    parts = staged(_parts(rows, known, network), "gru-parts")
    rare = parts.select("row", F.inline("rare")).join(counts.withColumnRenamed("n", "c"), "word").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_logs"), F.sum("n").alias("rare_known"))
    whole = parts.drop("rare").join(rare, "row", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    per_token = float(np.log10(known.tokens + known.types + 1))
    per_other = float(np.log10(known.other_mass))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("network") + F.col("other") + logs - F.col("n_other") * per_other).alias("score"))
