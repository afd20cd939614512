"""Perplexity under an interpolated modified Kneser-Ney model of words in trusted text, thresholded per language.

Four fifths of the trusted documents make the model, the others, which it has not seen, give the limits. Every word that
occurs more than once in the trusted text is a token of its own, however many there are; every other word is a token by its
shape (length, capitals, digits, signs, other characters, closing mark), so that invented, shouted or broken words stay
telling. All counts are Spark aggregates and joins that are dealt out by n-gram: pair counts of the trusted text, the
continuation counts of their second words, and per context the discounted mass. Pairs that the trusted text lacks take the
context's mass times the word's own probability. A text's score is that sum over all its pairs plus the gain of the pairs that
the trusted text has. The most frequent words and pairs are held by every task; the others are joined by shuffle, so what
is held changes where a pair is scored, never its score. Documents are scored over their whole texts, and kept between a lower
and an upper limit: text that repeats itself is as unlike the trusted texts as broken text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktide.llm.tables import bounded, parted, staged
from ticktide.llm.words import Words, byte_flags, crc_remainder, text_of, text_slices, words_of
from ticktide.operators.ordered import numbered
from ticktide.operators.sides import small_table
from ticktide.session import scratch_path

TOKENS = 4_096                     # at least: the model's size where fewer words have tokens of their own
HELD_WORDS = 1 << 22               # words (16 bytes each) and pairs (8 bytes each) that a task holds; others are joined
HELD_PAIRS = 1 << 24
PAIRS_PER_FILE = 1 << 20
LENGTHS = (2, 3, 4, 6, 8, 11, 16)  # longest words, in bytes, of all but the last class of length
SHAPES = (len(LENGTHS) + 1) * 3 * 2 ** 4
LOW, HIGH = 0.01, 0.99             # quantiles of unseen trusted documents' perplexities in a language
BELOW, ABOVE = 4.0, 1.25           # factors beyond them, so that clean documents stay; seen texts have low perplexities
MIN_TRUSTED = 30                   # languages with fewer such documents use the quantiles of all of them
SPREAD = 7.0                       # of a word's log-probability: limits of a text of n words are wider by exp(SPREAD / sqrt(n))
FOLDS = 5                          # trusted documents whose id's remainder is 0 set the limits, the others train
MIN_TRUSTED = 30                   # languages with fewer trusted documents use the quantiles of all trusted documents
SHORT = 10.0                       # words; a text of this length may be twice as far from the trusted ones as a long one
PENDING = 1 << 20                  # distinct words or pairs that a task gathers before it hands counts on
_START = 0                         # token before every text

_CAPITAL, _DIGIT = byte_flags(bytes(range(65, 91))), byte_flags(bytes(range(48, 58)))
_SIGN, _MARK, _OTHER = byte_flags(b"#*$%&|<>/\\@+=~^_{}[]"), byte_flags(b".,;:!?"), byte_flags(bytes(range(128, 256)))


def _shapes(words: Words) -> np.ndarray:
    """Shape token of every word: 1 to SHAPES."""
    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum(flags[words.data], out=sums[1:])
        return sums[words.end] - sums[words.start]

    shape = np.searchsorted(LENGTHS, words.end - words.start)
    capitals = inside(_CAPITAL)
    first = _CAPITAL[words.data[words.start]]
    shape = 3 * shape + np.where(capitals == 0, 0, np.where((capitals == 1) & first, 1, 2))
    for flags in (_DIGIT, _SIGN, _OTHER):
        shape = 2 * shape + (inside(flags) > 0)
    return 1 + 2 * shape + _MARK[words.data[words.end - 1]]


@dataclass
class Vocabulary:
    """The words that are tokens of their own: those that every task holds, and the others."""

    held: np.ndarray           # sorted hashes; their tokens follow the shapes
    further: DataFrame | None  # (key, token), where key is as in _keys; None without others
    words: int                 # held and others

    def __len__(self) -> int:
        return self.words

    def tolist(self) -> list[int]:
        return self.held.tolist()

    @property
    def size(self) -> int:
        """Tokens in all."""
        return max(TOKENS, 1 + SHAPES + self.words)

    @property
    def held_tokens(self) -> int:
        """Tokens whose probabilities every task holds."""
        return self.size if self.further is None else 1 + SHAPES + len(self.held)

    @property
    def local(self) -> tuple[np.ndarray, int, bool]:
        """What a task needs: the held words, the number of tokens, and whether there are other words."""
        return self.held, self.size, self.further is not None


def _places(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted table, or its length. Values are looked up in order, which is kind to the cache."""
    wanted, back = (values, slice(None)) if len(table) < 1 << 16 else np.unique(values, return_inverse=True)
    at = np.searchsorted(table, wanted)
    at[at < len(table)] = np.where(table[at[at < len(table)]] == wanted[at < len(table)], at[at < len(table)], len(table))
    return at[back]


def _keys(hashes: np.ndarray) -> np.ndarray:
    """Negative numbers for words that are not held, to tell them from tokens."""
    return -1 - (hashes >> np.uint64(1)).view(np.int64)


def _pairs(column: pa.Array, held: np.ndarray, opens: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token of each word and of the one before it, the shapes of both, and the index of each text's first word, plus
    their number. If there are further words (``opens``), a word that is not held has its key instead of a token."""
    words = words_of(column)
    shape = token = _shapes(words)
    if len(held) or opens:
        hashes = words.hashes()
        at = _places(held, hashes)
        token = np.where(at < len(held), 1 + SHAPES + at, _keys(hashes) if opens else shape)

    def before(values: np.ndarray) -> np.ndarray:
        shifted = np.empty_like(values)
        shifted[1:] = values[:-1]
        shifted[words.first[:-1][words.first[:-1] < len(values)]] = _START
        return shifted

    return before(token), token, before(shape), shape, words.first


def _counts(docs: DataFrame, found, name: str) -> DataFrame:
    """(name, n): how often each 64-bit value that ``found`` takes from the texts occurs, counted in each task before the shuffle."""
    def work(batches):
        values, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                new, times = np.unique(found(text_of(batch, "text")).astype(np.uint64, copy=False).view(np.int64), return_counts=True)
                values, back = np.unique(np.concatenate([values, new]), return_inverse=True)
                n = np.bincount(back, np.concatenate([n, times]), len(values)).astype(np.int64)
                if len(values) > PENDING:
                    yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], [name, "n"])
                    values, n = values[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], [name, "n"])

    return docs.select("text").mapInArrow(work, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n"))


def frequent_words(trusted: DataFrame) -> Vocabulary:
    """All words that occur more than once in the trusted text."""
    counts = staged(_counts(trusted, lambda texts: words_of(texts).hashes(), "word"), "kn-words")
    top, others = parted(counts.where("n > 1"), "n", F.col("word"), HELD_WORDS)
    held = np.sort(bounded(top.select("word").toPandas()["word"], HELD_WORDS).to_numpy(np.int64).view(np.uint64))
    if others is None:
        return Vocabulary(held, None, len(held))
    token = F.col("row_no") + 1 + SHAPES + len(held)
    key = -1 - F.shiftrightunsigned("word", 1)
    further = staged(numbered(others.select("word"), ["word"]).select(key.alias("key"), token.alias("token")), "kn-words-further")
    return Vocabulary(held, further, len(held) + further.count())


def gram_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(gram, n): occurrences of the word pairs in the whole texts. A gram is the first token times their number plus the second."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.local)

    def closed(texts):
        held, size, opens = shared.value
        a, b, _, _, _ = _pairs(texts, held, opens)
        known = (a >= 0) & (b >= 0)
        return a[known] * size + b[known]

    found = _counts(docs, closed, "gram")
    if vocabulary.further is None:
        return found

    def opened(batches):
        held, _, opens = shared.value
        for whole in batches:
            for batch in text_slices(whole, "text"):
                a, b, shape_a, shape_b, _ = _pairs(text_of(batch, "text"), held, opens)
                yield _rows(np.flatnonzero((a < 0) | (b < 0)), a=a, b=b, shape_a=shape_a, shape_b=shape_b)

    rows = docs.select("text").mapInArrow(opened, "a long, b long, shape_a long, shape_b long")
    counted = rows.groupBy("a", "b").agg(F.min("shape_a").alias("shape_a"), F.min("shape_b").alias("shape_b"), F.count(F.lit(1)).alias("n"))
    return found.unionByName(_named(counted, vocabulary).select("gram", "n")).groupBy("gram").agg(F.sum("n").alias("n"))


def _rows(at: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[at]) for values in columns.values()], list(columns))


def _named(rows: DataFrame, vocabulary: Vocabulary, words: DataFrame | None = None) -> DataFrame:
    """Rows of pairs with their gram: words that are not held get their token or, if they are rare, their shape. ``words``
    may bring further columns of the words, which then end in _a and _b."""
    for side in ("a", "b"):
        known = vocabulary.further if words is None else words
        known = known.select(*[F.col(name).alias(f"{name}_{side}") for name in known.columns])
        rows = rows.join(known, F.col(side) == F.col(f"key_{side}"), "left")
    first, second = (F.when(F.col(side) >= 0, F.col(side)).otherwise(F.coalesce(f"token_{side}", f"shape_{side}")) for side in "ab")
    return rows.withColumn("gram", first * vocabulary.size + second)


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of modified Kneser-Ney from the counts of counts; 0.5, 1 and 1.5 if they are degenerate."""
    row = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(value, 0.05), k - 0.05) for k, value in enumerate(found, 1)]


@dataclass
class Model:
    """Natural log-probabilities: of every held token alone and of leaving each held context's seen pairs, and by how much a seen
    pair's is larger than the sum of both."""

    alone: np.ndarray
    back: np.ndarray
    pairs: str                # folder of the held pairs (gram, gain), sorted over its files
    size: int                 # tokens in all
    others: DataFrame | None  # (gram, gain) of pairs that are not held, of all pairs if there are further words
    words: DataFrame | None   # (key, token, alone, back) of further words

    def table(self) -> np.ndarray:
        """Log-probability of the second token of every pair, of a model that is held as a whole."""
        table = (self.back[:, None] + self.alone[None, :]).ravel()
        pairs = _held_pairs(self.pairs, self.size, self.size)
        table[np.repeat(np.arange(self.size), np.diff(pairs.begin)) * self.size + pairs.second] += pairs.gain
        return table


@dataclass
class HeldPairs:
    """Pairs in order: those of first token t lie from begin[t] to begin[t + 1]. 8 bytes a pair."""

    begin: np.ndarray
    second: np.ndarray
    gain: np.ndarray

    def gains(self, first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
        """The gain of each pair, NaN if it is not held."""
        wanted, back = np.unique(first * size + second, return_inverse=True)
        first, second = wanted // size, wanted % size
        low, high = self.begin[first], self.begin[first + 1]
        stop, left = high.copy(), np.flatnonzero(low < high)
        while len(left):
            middle = (low[left] + high[left]) >> 1
            less = self.second[middle] < second[left]
            low[left[less]], high[left[~less]] = middle[less] + 1, middle[~less]
            left = left[low[left] < high[left]]
        found = np.flatnonzero(low < stop)
        found = found[self.second[low[found]] == second[found]]
        gain = np.full(len(wanted), np.nan)
        gain[found] = self.gain[low[found]]
        return gain[back]


def _held_pairs(path: str, size: int, tokens: int) -> HeldPairs:
    """The pairs of a folder, whose first tokens are below ``tokens``. Read by each task, so that no idle worker keeps them."""
    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    names = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("part-"))
    files = [pq.ParquetFile(store.open_input_file(name)) for name in names]
    rows = sum(file.metadata.num_rows for file in files)
    count, second, gain, at = np.zeros(tokens + 1, np.int32), np.empty(rows, np.uint32), np.empty(rows, np.float32), 0
    for file in files:
        for batch in file.iter_batches(1 << 18):
            gram, stop = batch.column(0).to_numpy(), at + len(batch)
            second[at:stop], gain[at:stop] = gram % size, batch.column(1).to_numpy()
            first, times = np.unique(gram // size, return_counts=True)
            count[first + 1] += times.astype(np.int32)
            at = stop
        file.close()
    return HeldPairs(np.cumsum(count, dtype=np.int32), second, gain)


def model(counts: DataFrame, vocabulary: Vocabulary | None = None) -> Model:
    """The model of the pair counts (gram, n) of trusted text; without any, all tokens are equally probable."""
    spark = counts.sparkSession
    size, held = (vocabulary.size, vocabulary.held_tokens) if vocabulary else (TOKENS, TOKENS)
    further = vocabulary.further if vocabulary else None
    pairs = counts.select("gram", F.col("n").alias("c"))

    def discount(d: list[float]) -> Column:
        return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])

    continued = staged(pairs.groupBy(F.pmod("gram", F.lit(size)).alias("token")).agg(F.count(F.lit(1)).alias("c")), "kn-words-continued")
    d1 = discount(_discounts(continued))
    row = continued.agg(F.sum("c").alias("all"), F.sum(d1).alias("left")).first()
    rest = (row["left"] / row["all"] if row["all"] else 1.0) / size
    alone = continued.select("token", ((F.col("c") - d1) / F.lit(row["all"] or 1) + rest).alias("p"))
    d2 = discount(_discounts(pairs))
    mass = staged(pairs.groupBy(F.expr(f"gram div {size}").alias("token")).agg(F.sum("c").alias("all"), F.sum(d2).alias("left")), "kn-mass")

    p, left, back = np.full(held, rest), np.zeros(held), np.ones(held)
    found = bounded(alone.where(F.col("token") < held).toPandas(), held)
    p[found["token"].to_numpy(int)] = found["p"].to_numpy(float)
    found = bounded(mass.where(F.col("token") < held).toPandas(), held)
    left[found["token"].to_numpy(int)] = found["left"].to_numpy(float)
    back[found["token"].to_numpy(int)] = found["left"].to_numpy(float) / found["all"].to_numpy(float)
    shared = spark.sparkContext.broadcast((p, left))

    def gains(batches):
        p, left = shared.value
        for batch in batches:
            gram, more = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            gain = np.log1p(more / (left[gram // size] * p[gram % size]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gain.astype(np.float32))], ["gram", "gain"])

    def of_held(rows: DataFrame) -> DataFrame:
        return rows.select("gram", (F.col("c") - d2).cast("double").alias("more")).mapInArrow(gains, "gram long, gain float")

    inside = pairs if further is None else pairs.where((F.expr(f"gram div {size}") < held) & (F.col("gram") % size < held))
    top, others = parted(inside, "c", F.xxhash64("gram"), HELD_PAIRS)
    path = scratch_path(spark, "kn-pairs")
    ranges = -(-top.count() // PAIRS_PER_FILE) or 1
    of_held(top.repartitionByRange(ranges, "gram").sortWithinPartitions("gram")).write.parquet(path)
    words = None
    if further is not None:
        probable = further.join(alone, "token", "left").join(mass, "token", "left")
        log_p, log_back = F.log(F.coalesce("p", F.lit(rest))), F.log(F.coalesce(F.col("left") / F.col("all"), F.lit(1.0)))
        words = staged(probable.select("key", "token", log_p.alias("alone"), log_back.alias("back")), "kn-further")
        outside = pairs.where((F.expr(f"gram div {size}") >= held) | (F.col("gram") % size >= held))
        outside = outside.withColumns({"context": F.expr(f"gram div {size}"), "word": F.col("gram") % size})
        outside = outside.join(mass.select(F.col("token").alias("context"), "left"), "context").join(alone.withColumnRenamed("token", "word"), "word")
        gain = F.log1p((F.col("c") - d2) / (F.col("left") * F.col("p"))).cast("float")
        others = staged(of_held(inside).unionByName(outside.select("gram", gain.alias("gain"))), "kn-others")
    elif others is not None:
        others = staged(of_held(others), "kn-others")
    return Model(np.log(p).astype(np.float32), np.log(back).astype(np.float32), path, size, others, words)


def with_perplexity(docs: DataFrame, vocabulary: Vocabulary, learned: Model) -> DataFrame:
    """doc_id, lang, n_words and perplexity by word of every whole text; null perplexity for one without words.

    If pairs are joined, ``docs`` is read twice and must give its rows in the same order, as a stored table does.
    """
    opens, joins = vocabulary.further is not None, learned.others is not None
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.held, learned.alone, learned.back, learned.pairs, learned.size))
    rows = docs.select("doc_id", "lang", "text", F.monotonically_increasing_id().alias("row"))

    def scored(texts: pa.Array, pairs: HeldPairs):
        """Of each pair the tokens and shapes, its score as far as it can be told here, and whether that is not all."""
        held, alone, back, _, size = shared.value
        a, b, shape_a, shape_b, first = _pairs(texts, held, opens)
        closed = np.flatnonzero((a >= 0) & (b >= 0))
        gain = pairs.gains(a[closed], b[closed], size)
        score, left = np.zeros(len(a)), np.ones(len(a), bool)
        score[closed] = back[a[closed]].astype(float) + alone[b[closed]] + np.nan_to_num(gain)
        left[closed] = np.isnan(gain)
        return a, b, shape_a, shape_b, first, score, left

    def held_pairs() -> HeldPairs:
        _, alone, _, path, size = shared.value
        return _held_pairs(path, size, len(alone))

    def work(batches):
        pairs = None
        for whole in batches:
            pairs = pairs or held_pairs()
            for batch in text_slices(whole, "text"):
                *_, first, score, _ = scored(text_of(batch, "text"), pairs)
                sums = np.zeros(len(score) + 1)
                np.cumsum(score, out=sums[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(first)), pa.array(sums[first[1:]] - sums[first[:-1]])],
                    ["doc_id", "lang", "row", "n_words", "score"])

    def unheld(batches):
        """Pairs that are to be joined, a row each."""
        pairs = None
        for whole in batches:
            pairs = pairs or held_pairs()
            for batch in text_slices(whole, "text"):
                a, b, shape_a, shape_b, first, _, left = scored(text_of(batch, "text"), pairs)
                row = np.repeat(batch.column(3).to_numpy(), np.diff(first))
                if opens:
                    alone, back = shared.value[1:3]
                    # Zeros, where nothing is needed, take little room.
                    shape_a, shape_b, closed = np.where(a < 0, shape_a, 0), np.where(b < 0, shape_b, 0), (a >= 0) & (b >= 0)
                    back, alone = back[np.where(a < 0, shape_a, a)], alone[np.where(b < 0, shape_b, b)]
                    back[closed], alone[closed] = 0, 0
                    yield _rows(np.flatnonzero(left), row=row, a=a, b=b, shape_a=shape_a, shape_b=shape_b, back=back, alone=alone)
                else:
                    yield _rows(np.flatnonzero(left), row=row, gram=a * shared.value[4] + b)

    found = rows.mapInArrow(work, "doc_id long, lang string, row long, n_words long, score double")
    if joins:
        if opens:
            kind = "row long, a long, b long, shape_a long, shape_b long, back float, alone float"
            known = learned.words.withColumnsRenamed({"alone": "log", "back": "log_back"})
            pairs = _named(rows.mapInArrow(unheld, kind), vocabulary, known)
            alone, back = F.coalesce("log_b", F.col("alone").cast("double")), F.coalesce("log_back_a", F.col("back").cast("double"))
            open_pair = (F.col("a") < 0) | (F.col("b") < 0)
            pairs = pairs.select("row", "gram", F.when(open_pair, alone + back).otherwise(0.0).alias("base"))
            more = pairs.join(learned.others, "gram", "left")
        else:
            more = rows.mapInArrow(unheld, "row long, gram long").withColumn("base", F.lit(0.0)).join(learned.others, "gram")
        more = more.groupBy("row").agg(F.sum(F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("more"))
        found = found.join(more, "row", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    perplexity = F.when(F.col("n_words") > 0, F.exp(-F.col("score") / F.col("n_words")))
    return found.select("doc_id", "lang", "n_words", perplexity.alias("perplexity"))


def _wider() -> Column:
    """How much further than a long text's the perplexity of a text of n_words may lie from the trusted ones."""
    return F.exp(SPREAD / F.sqrt(F.greatest("n_words", F.lit(1))))


def thresholds(scored: DataFrame) -> tuple[DataFrame, tuple[float | None, float | None]]:
    """Per language the limits for long texts from trusted documents that the model has not seen, and those of all languages together.

    If there are none, the trusted documents of the model stand in.
    """
    known = scored.where("trusted and perplexity is not null")
    unseen = known.where(crc_remainder(F.col("doc_id"), FOLDS) == 0)
    known = known if unseen.isEmpty() else unseen
    wider = _wider()
    cuts = [(F.percentile_approx(F.col("perplexity") * wider, LOW, 10_000) / BELOW).alias("low"),
            (F.percentile_approx(F.col("perplexity") / wider, HIGH, 10_000) * ABOVE).alias("high")]
    overall = known.agg(*cuts).first()
    by = known.groupBy("lang").agg(*cuts, F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TRUSTED)
    return by.select(F.col("lang").alias("known_lang"), "low", "high"), (overall["low"], overall["high"])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids (trusted_id) whose labels are all of good quality and not toxic; labels without an id count for nothing."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("good")).where("good").select(
        F.col("doc_id").alias("trusted_id"))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, n_words, perplexity, low, high, trusted, kept.

    A document is kept if its perplexity lies between the limits of its language, which are wider for short texts.
    Documents of a null or rare language use the limits of all trusted documents. Null and empty texts have no
    perplexity and are not kept; without trusted text nothing else is dropped and the limits are null. Repeated documents
    are scored each, a null doc_id is never trusted, extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "lang", "text")
    ids = small_table(staged(trusted_ids(labels), "kn-trusted"))
    trusted = docs.join(ids, docs.doc_id == ids.trusted_id, "left_semi")
    training = trusted.where(crc_remainder(F.col("doc_id"), FOLDS) != 0)
    vocabulary = frequent_words(training)
    learned = model(staged(gram_counts(training, vocabulary), "kn-grams"), vocabulary)
    scored = with_perplexity(docs, vocabulary, learned)
    scored = staged(scored.join(ids, scored.doc_id == ids.trusted_id, "left").select(
        "doc_id", "lang", "n_words", "perplexity", F.col("trusted_id").isNotNull().alias("trusted")), "kn-documents")
    by, overall = thresholds(scored)
    by = small_table(staged(by, "kn-thresholds"))
    low, high = (F.coalesce(name, F.lit(limit).cast("double")) for name, limit in zip(("low", "high"), overall))
    named = scored.join(by, F.col("lang") == F.col("known_lang"), "left").withColumns({"low": low / _wider(), "high": high * _wider()})
    within = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return named.select("doc_id", "lang", "n_words", "perplexity", "low", "high", "trusted",
                        (F.col("perplexity").isNotNull() & within).alias("kept"))
