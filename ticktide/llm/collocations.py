"""Collocations: phrases of two to N words that occur together far more often than their parts would suggest.

Only the longest windows are counted: every word occurrence opens one row of N lead columns, the word and the words
behind it in its piece, padded with nulls at the piece's end. Spark's ROLLUP over the counted windows sums successively
shorter prefixes, which gives the counts of all shorter phrases and of the words without windows of their own.

Two steps before the ROLLUP keep it small and lose nothing. Words rarer than the least count are no part of any
candidate, so they end a window like the end of a piece does. Counted windows are dealt out by their first two words, so
a prefix that stays below the least count is seen there in whole; its rest is folded into the shorter prefix, whose sum
stays the same. Pairs of very frequent words are dealt out by their third word too and not folded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticktide.llm.tables import staged, with_largest
from ticktide.llm.words import Words, byte_flags, mix, text_of, text_slices, words_of

MAX_WORDS = 3
LEAST = 10
TOP = 2000
WITHIN = 50  # percent of a candidate's count that a longer candidate needs to make it redundant
HELD_WORDS = 1_000_000  # at most so many frequent words go to every task
HOT_WORDS = 100_000  # at most so many words count as hot
SLICE_WINDOWS = 2_000_000
BATCH_WINDOWS = 100_000  # windows a batch that leaves a task: larger ones are held whole on both sides of the pipe
PARTITION_ROWS = 1_500_000
SHARED = "two words share a 63-bit code; change the finaliser of the word hash"

_PIECE_ENDS = byte_flags(b".,;:!?\n\x0b\x0c\r")
_BREAKS = _PIECE_ENDS | byte_flags(b" \t")
_APART = np.uint64(0x6C616E67)  # keeps the hash of a language apart from that of an equal word


def _text_hash(value: str) -> np.uint64:
    column = pa.array([value], pa.large_string())
    plain = words_of(column, separator=np.zeros(256, bool)).hashes() if value else np.zeros(1, np.uint64)
    return mix(plain + _APART)[0]


def _coded(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Words, np.ndarray]]:
    """Slices of a batch: languages, words and each word's 63-bit code, which depends on the language too."""
    for part in text_slices(batch, "text"):
        words = words_of(text_of(part, "text"), lower=True, separator=_BREAKS)
        langs = part.column(part.schema.get_field_index("lang")).dictionary_encode()
        salts = np.array([_text_hash(value.as_py()) for value in langs.dictionary], np.uint64)
        salt = salts[langs.indices.to_numpy(zero_copy_only=False)] if len(salts) else np.zeros(0, np.uint64)
        yield langs, words, (mix(words.hashes() ^ salt[words.row]) >> np.uint64(1)).astype(np.int64)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, code, f): all word occurrences, staged. Two words with one code end the job."""
    def work(batches):
        for batch in batches:
            for langs, words, codes in _coded(batch):
                code, first, same, count = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
                lang = langs.indices.to_numpy(zero_copy_only=False)[words.row]
                size = words.end - words.start
                if (lang[first][same] != lang).any() or (size[first][same] != size).any():
                    raise RuntimeError(SHARED)
                raw, start, end = words.data.tobytes(), words.start[first].tolist(), words.end[first].tolist()
                yield pa.RecordBatch.from_arrays([
                    langs.dictionary.take(pa.array(lang[first])).cast(pa.string()),
                    pa.array([raw[a:b] for a, b in zip(start, end)], pa.binary()).cast(pa.string()),
                    pa.array(code), pa.array(count.astype(np.int64)),
                ], ["lang", "word", "code", "f"])

    found = _narrow(docs).mapInArrow(work, "lang string, word string, code long, f long")
    counted = staged(found.groupBy("lang", "word", "code").agg(F.sum("f").alias("f")), "phrase-words")
    if not counted.groupBy("code").count().where("count > 1").isEmpty():
        raise RuntimeError(SHARED)
    return counted


class Lexicon:
    """The most frequent words in every task: their codes in order of size, with the number (by frequency) of each.

    A word beyond the held ones keeps its code, as a negative number. ``whole`` says that no such word is frequent.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, whole: bool, hot: int):
        self.by_number = codes[np.argsort(-counts, kind="stable")]
        order = np.argsort(self.by_number)
        self.codes, self.numbers = self.by_number[order], order
        self.whole, self.hot = whole, int((counts >= hot).sum())

    def numbered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each code's number, and whether the word may be part of a candidate."""
        if not len(self.codes):
            return -1 - codes, np.full(len(codes), not self.whole)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        return np.where(known, self.numbers[at], -1 - codes), known | (not self.whole)

    def decoded(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return -1 - numbers
        return np.where(numbers >= 0, self.by_number[np.maximum(numbers, 0)], -1 - numbers)


def lexicon(counted: DataFrame, least: int, held: int, total: int) -> Lexicon:
    frequent = counted.where(F.col("f") >= least)
    whole = frequent.count() <= held
    rows = (frequent if whole else with_largest(frequent, "f", held)).select("code", "f").toArrow()
    hot = max(PARTITION_ROWS // 2, -(-total // HOT_WORDS))
    return Lexicon(rows["code"].to_numpy(), rows["f"].to_numpy(), whole, hot)


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct windows, as columns, and how often each occurs. The columns hold small numbers; the list is emptied.

    A window is one number, sorted in place and taken apart again, so that no more than the windows, their numbers
    and a few flags are held at once.
    """
    base, packed = max(int(column.max()) for column in columns) + 1, []
    key, top = columns.pop(0).astype(np.int64), base
    while columns:
        distinct = None
        if top * base >= 1 << 63:
            distinct, key = np.unique(key, return_inverse=True)
            top = len(distinct)
        key *= base
        key += columns.pop(0)
        top *= base
        packed.append(distinct)
    key.sort()
    fresh = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=fresh[1:])
    first, key = np.flatnonzero(fresh), key[fresh]
    count, found = np.diff(first, append=len(fresh)), []
    for distinct in reversed(packed):
        key, column = np.divmod(key, base)
        found.append(column.astype(np.int32))
        key = key if distinct is None else distinct[key]
    return [key.astype(np.int32), *reversed(found)], count


def _windows(codes: list[np.ndarray], fresh: list[np.ndarray], held: Lexicon, width: int) -> Iterator[pa.RecordBatch]:
    """Distinct padded windows of some slices: numbers w1..wN, null behind the end, the number of the hot pair's third
    word or 0, and their count. ``fresh`` marks the first words of pieces. The lists are emptied, the windows come in
    batches of a bounded size: both keep down what a task holds, here and where the batches are read.
    """
    whole = _joined(codes)
    distinct = np.unique(whole)
    number, wanted = held.numbered(distinct)
    local = np.searchsorted(distinct, whole).astype(np.int32)
    del whole
    inside = wanted[local]
    apart = _joined(fresh)
    apart[1:] |= ~inside[:-1]
    apart, columns = apart[inside], [local[inside] + np.int32(1)]
    del local, inside
    for _ in range(1, width):
        ahead = np.zeros_like(columns[0])
        ahead[:-1] = np.where(apart[1:], 0, columns[-1][1:])
        columns.append(ahead)
    if not len(apart):
        return
    del ahead
    columns, count = _counted(columns)
    number = np.concatenate([np.zeros(1, np.int64), number])
    for at in range(0, len(count), BATCH_WINDOWS):
        local = [column[at:at + BATCH_WINDOWS] for column in columns]
        values = [number[column] for column in local]
        hot = (local[1] > 0) & (values[0] >= 0) & (values[0] < held.hot) & (values[1] >= 0) & (values[1] < held.hot)
        third = np.where(hot & (local[2] > 0), values[2] + 1, 0) if width > 2 else np.zeros(len(hot), np.int64)
        nulls = [pa.array(value, pa.int64(), mask=column == 0) for value, column in zip(values, local)]
        yield pa.RecordBatch.from_arrays(
            [*nulls, pa.array(third, pa.int64()), pa.array(hot), pa.array(count[at:at + BATCH_WINDOWS], pa.int64())],
            [*_names(width), "third", "hot", "c"])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def _names(width: int) -> list[str]:
    return [f"w{at}" for at in range(1, width + 1)]


def windows(docs: DataFrame, held: Lexicon, width: int) -> DataFrame:
    """The longest windows of all documents, counted per slice of about two million."""
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def work(batches):
        codes, fresh, size = [], [], 0
        for batch in batches:
            for _, words, code in _coded(batch):
                ends = np.zeros(len(words.data) + 1, np.int32)
                np.cumsum(_PIECE_ENDS[words.data], out=ends[1:])
                piece, row = ends[words.start], words.row
                begins = np.ones(len(code), bool)
                begins[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
                codes.append(code)
                fresh.append(begins)
                size += len(code)
                del words, code, ends, piece, row, begins
                if size >= SLICE_WINDOWS:
                    yield from _windows(codes, fresh, shared.value, width)
                    size = 0
        if size:
            yield from _windows(codes, fresh, shared.value, width)

    columns = ", ".join(f"{name} long" for name in _names(width))
    return _narrow(docs).mapInArrow(work, f"{columns}, third long, hot boolean, c long")


def folded(found: DataFrame, width: int, least: int, partitions: int) -> DataFrame:
    """Counted windows without the words behind a prefix that is rarer than ``least``.

    All windows of one prefix (w1, w2), or of (w1, w2, w3) below a hot pair, lie in one partition, so sums over
    prefixes there are whole.
    """
    names = _names(width)
    dealt = found.repartition(partitions, "w1", "w2", "third")
    counted = dealt.groupBy(*names[:2], "third", "hot", *names[2:]).agg(F.sum("c").alias("c"))
    totals = {width: F.col("c")}
    for size in range(2, width):
        totals[size] = F.sum("c").over(Window.partitionBy("w1", "w2", "third", "hot", *names[2:size]))
    counted = counted.withColumns({f"t{size}": total for size, total in totals.items()})
    kept, enough = [F.col("w1")], F.lit(True)
    for size in range(2, width + 1):
        enough = enough & ((F.col(f"t{size}") >= least) | (F.col("hot") if size == 2 else F.lit(False)))
        kept.append(F.when(enough, F.col(names[size - 1])).alias(names[size - 1]))
    return counted.select(*kept, "c").groupBy(*names).agg(F.sum("c").alias("c"))


def marginals(counted: DataFrame, width: int, least: int) -> DataFrame:
    """(size, w1..wN, f) of every phrase and word with at least ``least`` occurrences, by one ROLLUP, staged."""
    names = _names(width)
    rolled = counted.rollup(*names).agg(F.sum("c").alias("f"), F.grouping_id().alias("gone"))
    size = F.lit(None).cast("int")
    for at in range(1, width + 1):
        size = F.when((F.col("gone") == (1 << (width - at)) - 1) & F.col(names[at - 1]).isNotNull(), at).otherwise(size)
    sized = rolled.withColumn("size", size).where(F.col("size").isNotNull() & (F.col("f") >= least))
    return staged(sized.select("size", *names, "f"), "phrase-counts")


def _part(grams: DataFrame, first: int, size: int, value: str) -> DataFrame:
    """Counts of the phrases of one size, named as words ``first``, ``first + 1``, ... of a longer phrase."""
    names = [F.col(f"w{at}").alias(f"w{first + at - 1}") for at in range(1, size + 1)]
    return grams.where(F.col("size") == size).select(*names, F.col("f").alias(value))


def scored(grams: DataFrame, width: int) -> DataFrame:
    """(size, w1..wN, a, l, r, score) of all candidates, with the cut that scores lowest."""
    result = None
    for size in range(2, width + 1):
        whole = _part(grams, 1, size, "a")
        cuts = []
        for cut in range(1, size):
            left, right = f"l{cut}", f"r{cut}"
            whole = whole.join(_part(grams, 1, cut, left), _names(cut)).join(
                _part(grams, cut + 1, size - cut, right), [f"w{at}" for at in range(cut + 1, size + 1)])
            cuts.append(F.struct(_score(left, right).alias("score"), F.lit(cut).alias("cut"),
                                 F.col(left).alias("l"), F.col(right).alias("r")))
        lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        padding = [F.lit(None).cast("long").alias(f"w{at}") for at in range(size + 1, width + 1)]
        rows = whole.withColumn("low", lowest).select(
            F.lit(size).alias("size"), *_names(size), *padding, "a", "low.l", "low.r", "low.score")
        result = rows if result is None else result.unionByName(rows)
    return result


def _score(left: str, right: str) -> Column:
    """floor(10^6 a^2 / (l r)) with 38 digits in between."""
    whole = {name: F.col(name).cast("decimal(15,0)") for name in ("a", left, right)}
    above = F.lit(1_000_000).cast("decimal(7,0)") * whole["a"] * whole["a"]
    return F.call_function("div", above, whole[left] * whole[right])


def standing(candidates: DataFrame, width: int, within: int) -> DataFrame:
    """The candidates without those that lie in a longer one with ``within`` percent of their count."""
    rows = staged(candidates, "phrase-candidates")
    result = rows.where(F.col("size") == width)
    for size in range(2, width):
        longer = None
        for other in range(size + 1, width + 1):
            for first in range(1, other - size + 2):
                part = [F.col(f"w{first + at - 1}").alias(f"w{at}") for at in range(1, size + 1)]
                found = rows.where(F.col("size") == other).select(*part, F.col("a").alias("most"))
                longer = found if longer is None else longer.unionByName(found)
        most = longer.groupBy(*_names(size)).agg(F.max("most").alias("most"))
        kept = rows.where(F.col("size") == size).join(most, _names(size), "left")
        kept = kept.where(F.col("most").isNull() | (100 * F.col("most") < within * F.col("a"))).drop("most")
        result = result.unionByName(kept)
    return result


def _with_codes(rows: DataFrame, held: Lexicon, width: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(held)
    wanted = set(_names(width))

    def work(batches):
        for batch in batches:
            columns = []
            for name, column in zip(batch.schema.names, batch.columns):
                if name in wanted:
                    missing = pc.is_null(column).to_numpy(zero_copy_only=False)
                    numbers = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
                    column = pa.array(shared.value.decoded(numbers), pa.int64(), mask=missing)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rows.mapInArrow(work, rows.schema)


def phrases(
    docs: DataFrame, width: int = MAX_WORDS, least: int = LEAST, top: int = TOP, within: int = WITHIN, held: int = HELD_WORDS
) -> DataFrame:
    """The best phrases per language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words.
    a counts the phrase, l and r the parts at the cut that scores lowest, n all words of the language. Null texts are
    empty, null languages count as ``und``; repeated rows count each, ids are not read and extra columns are ignored.
    Ties go to the larger a, then to the smaller phrase by bytes. An empty table gives an empty result.
    """
    if width < 2:
        raise ValueError("a phrase has two words at least")
    counted = word_counts(docs)
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    total = counted.agg(F.sum("f")).first()[0] or 0
    known = lexicon(counted, least, held, total)
    partitions = max(1, -(-total // PARTITION_ROWS))
    counts = staged(folded(windows(docs, known, width), width, least, partitions), "phrase-windows")
    grams = marginals(counts, width, least)
    best = _with_codes(standing(scored(grams, width), width, within), known, width)

    frequent = counted.where(F.col("f") >= least)
    lang = frequent.select(F.col("code").alias("w1"), "lang")
    leading = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = best.join(lang, "w1").withColumn("place", F.rank().over(leading)).where(F.col("place") <= top).drop("place")
    for name in _names(width):
        best = best.join(frequent.select(F.col("code").alias(name), F.col("word").alias(f"text_{name}")), name, "left")
    named = best.withColumn("phrase", F.concat_ws(" ", *[f"text_{name}" for name in _names(width)]))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
