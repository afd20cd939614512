"""Benchmark passages in documents, by CGK embedding and bit-sampling LSH over item-sized windows.

Texts are compared as sequences of words, lower-cased and reduced to letters and digits. An item of m words leaks
if some stretch of the document is within k = floor(m / 5) word edits (similarity 0.8). Such a stretch holds
one of any k + 1 disjoint pieces of the item unchanged, so only windows around such a piece need be looked at;
this loses nothing. Each window and each item of its length is embedded by a random walk that repeats
a word or moves on depending on a random bit of step and word (CGK), which turns edits into substitutions.
Repeated samples of coordinates are bucket keys; windows that meet an item in a bucket are verified by an exact
alignment. The number of repeats follows from the recall wanted and the agreement measured on edited items; items for
which that would be too many are aligned with all of their windows, which loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktide.llm.words import Words, mix, text_of, text_slices, words_of

EDITS_PER = 5        # one edit per so many item words: similarity 0.8
MIN_WORDS = 5        # shorter items match only a document that equals them
SAMPLED = 2          # coordinates per bucket key
MOST_REPEATS = 256   # an item that needs more is aligned with every window around one of its pieces instead
ALIGNED_WORDS = 16   # so is an item of fewer words: too few coordinates agree to sample from
DRAWS = 256          # edited items that the agreement is measured on
ITEMS_PER_BLOCK = 20_000
_WALK = 3            # steps of the walk per word
_ROLL = np.uint64(0xD6E8FEB86659FD93)

_KEPT = np.zeros(256, bool)
_KEPT[48:58] = _KEPT[97:123] = _KEPT[128:] = True


def _normal(column: pa.Array) -> tuple[Words, np.ndarray]:
    words = words_of(column, lower=True).only(_KEPT)
    return words, np.maximum(words.hashes(), np.uint64(1))  # zero stands for the end of the text


def embed(windows: np.ndarray, seed: int) -> np.ndarray:
    """CGK embedding of equally long word sequences, row by row."""
    count, size = windows.shape
    padded = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1)
    multipliers = np.random.default_rng(seed).integers(0, 1 << 63, _WALK * size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    result = np.empty((count, _WALK * size), np.uint64)
    at, rows = np.zeros(count, np.int64), np.arange(count)
    for step in range(_WALK * size):
        word = padded[rows, at]
        result[:, step] = word
        at = np.minimum(at + (mix(word * multipliers[step]) >> np.uint64(63)).astype(np.int64), size)
    return result


def bucket_keys(embedded: np.ndarray, repeats: int, seed: int) -> np.ndarray:
    """One key per row and repeat, from SAMPLED coordinates of the embedding."""
    rng = np.random.default_rng(seed + 1)
    keys = np.empty((len(embedded), repeats), np.uint64)
    for at in range(repeats):
        value = np.full(len(embedded), at + 1, np.uint64)
        for coordinate in rng.choice(embedded.shape[1], SAMPLED, replace=False):
            value = mix(value * _ROLL + embedded[:, coordinate])
        keys[:, at] = value
    return keys


def align(regions: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least word edits between each item and any stretch of its region, with the stretch's start and end."""
    count, width = regions.shape
    unit = 1 << 20
    column = np.arange(width + 1, dtype=np.int64)
    best = np.broadcast_to(column, (count, width + 1)).copy()  # cost times unit, plus where the stretch starts
    for at in range(items.shape[1]):
        moved = best + unit
        moved[:, 1:] = np.minimum(moved[:, 1:], best[:, :-1] + unit * (regions != items[:, at, None]))
        best = np.minimum.accumulate(moved - unit * column, axis=1) + unit * column
    end = (best // unit).argmin(axis=1)
    value = best[np.arange(count), end]
    return value // unit, value % unit, end


@dataclass
class Group:
    """Items of one length."""

    ids: np.ndarray
    items: np.ndarray
    edits: int
    keys: np.ndarray    # sorted bucket keys of all items and repeats
    owner: np.ndarray   # item of each key
    repeats: int        # 0: every window is aligned with the items whose piece it holds


@dataclass
class Index:
    groups: dict[int, Group]
    pieces: dict[int, tuple[np.ndarray, ...]]  # piece length: sorted hash, item length, offset, item or -1 for any
    short: dict[bytes, list]  # words of an item below MIN_WORDS: item ids
    seed: int


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    value = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for at in range(size):
        value = value * _ROLL + hashes[at:at + len(value)]
    return mix(value)


def _repeats(items: np.ndarray, edits: int, recall: float, seed: int) -> int:
    """Repeats that find an item with the allowed edits with the wanted probability, measured by editing; 0 for too many."""
    if not edits:
        return 1
    if items.shape[1] < ALIGNED_WORDS:
        return 0
    rng = np.random.default_rng(seed + 2)
    size = items.shape[1]
    chosen = items[rng.integers(0, len(items), DRAWS)]
    changed = np.zeros_like(chosen)
    for row, source in enumerate(chosen):
        words = list(source)
        for _ in range(edits):
            at, kind = int(rng.integers(0, len(words))), int(rng.integers(0, 3))
            words[at:at + (kind != 0)] = [] if kind == 1 else [np.uint64(rng.integers(1, 1 << 63))]
        words = (words + [np.uint64(0)] * size)[:size]
        changed[row] = words
    agreement = (embed(chosen, seed) == embed(changed, seed)).mean(axis=1)
    hit = agreement ** SAMPLED
    for repeats in range(1, MOST_REPEATS + 1):  # the mean chance over all draws, not that of a mean draw
        if (1 - (1 - hit) ** repeats).mean() >= recall:
            return repeats
    return 0


def build(rows: list[tuple], recall: float = 0.99, seed: int = 11) -> Index:
    """Index of (item_id, text) rows. Null and empty items are never found."""
    column = pa.array([text or "" for _, text in rows], pa.large_string())
    words, hashes = _normal(column)
    by_length: dict[int, list[tuple]] = {}
    short: dict[bytes, list] = {}
    for (item_id, _), low, high in zip(rows, words.first[:-1], words.first[1:]):
        if high - low >= MIN_WORDS:
            by_length.setdefault(int(high - low), []).append((item_id, hashes[low:high]))
        elif high > low:
            short.setdefault(hashes[low:high].tobytes(), []).append(item_id)
    groups, pieces = {}, {}
    for size, members in by_length.items():
        items, edits = np.stack([value for _, value in members]), size // EDITS_PER
        repeats = _repeats(items, edits, recall, seed)
        keys = bucket_keys(embed(items, seed), repeats, seed)
        order = np.argsort(keys, axis=None, kind="stable")
        groups[size] = Group(
            np.array([i for i, _ in members], object), items, edits, keys.ravel()[order], order // max(repeats, 1), repeats)
        piece = size // (edits + 1)
        for at in range(0, piece * (edits + 1), piece):
            found, owner = mix(_roll_rows(items[:, at:at + piece])), np.arange(len(items))
            if repeats:
                found = np.unique(found)
                owner = np.full(len(found), -1)
            pieces.setdefault(piece, []).append(np.stack(
                [found, np.full(len(found), size, np.uint64), np.full(len(found), at, np.uint64), owner.astype(np.int64).view(np.uint64)]))
    merged = {}
    for piece, parts in pieces.items():
        table = np.concatenate(parts, axis=1)
        table = table[:, np.argsort(table[0], kind="stable")]
        merged[piece] = (table[0], *(column.astype(np.int64) for column in table[1:]))
    return Index(groups, merged, short, seed)


def _roll_rows(items: np.ndarray) -> np.ndarray:
    value = np.zeros(len(items), np.uint64)
    for at in range(items.shape[1]):
        value = value * _ROLL + items[:, at]
    return value


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (position, index) with low[position] <= index < high[position]."""
    count = high - low
    owner = np.repeat(np.arange(len(low)), count)
    return owner, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[owner]


def _windows(index: Index, words: Words, hashes: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By item length, the starts of the windows that hold a piece of such an item in its place, and the item or -1."""
    last = words.first[1:]
    found: dict[int, list] = {}
    for piece, (table, sizes, offsets, items) in index.pieces.items():
        rolled = _rolled(hashes, piece)
        flags = np.zeros(1 << 16, bool)
        flags[(table >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(flags[(rolled >> np.uint64(48)).astype(np.int64)])
        low = np.searchsorted(table, rolled[at], side="left")
        hit = low < len(table)
        hit[hit] = table[low[hit]] == rolled[at[hit]]
        at, low = at[hit], low[hit]
        row = np.searchsorted(last, at, side="right")
        inside = at + piece <= last[row]
        at, low, row = at[inside], low[inside], row[inside]
        owner, entry = _expand(low, np.searchsorted(table, rolled[at], side="right"))
        start = np.maximum(at[owner] - offsets[entry], words.first[row[owner]])
        for size in np.unique(sizes[entry]):
            own = sizes[entry] == size
            found.setdefault(int(size), []).append(start[own] * (len(index.groups[size].items) + 1) + items[entry[own]] + 1)
    result = {}
    for size, parts in found.items():
        start, item = np.divmod(np.unique(np.concatenate(parts)), len(index.groups[size].items) + 1)
        result[size] = (start, item - 1)
    return result


def _gather(hashes: np.ndarray, low: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` words from ``low``, zero from ``stop`` on."""
    at = low[:, None] + np.arange(width)
    known = at < stop[:, None]
    return np.where(known, hashes[np.minimum(at, max(len(hashes) - 1, 0))], np.uint64(0))


def search(index: Index, column: pa.Array) -> list[tuple]:
    """(row, item_id, edits, first word, number of words) of the best match of each item in each text."""
    words, hashes = _normal(column)
    best: dict[tuple, tuple] = {}
    for row in np.flatnonzero((np.diff(words.first) < MIN_WORDS) & (np.diff(words.first) > 0)) if index.short else ():
        low, high = words.first[row], words.first[row + 1]
        for item_id in index.short.get(hashes[low:high].tobytes(), ()):
            best[int(row), item_id] = (0, 0, int(high - low))
    for size, (starts, whose) in _windows(index, words, hashes).items() if len(hashes) else ():
        group = index.groups[size]
        for cut in np.array_split(np.arange(len(starts)), -(-len(starts) // 4096)):
            part = starts[cut]
            row = np.searchsorted(words.first[1:], part, side="right")
            at, item = np.arange(len(part)), whose[cut]
            if group.repeats:
                keys = bucket_keys(embed(_gather(hashes, part, words.first[row + 1], size), index.seed), group.repeats, index.seed)
                flat = keys.ravel()
                low = np.searchsorted(group.keys, flat, side="left")
                met = low < len(group.keys)
                met[met] = group.keys[low[met]] == flat[met]
                place = np.flatnonzero(met)
                owner, entry = _expand(low[place], np.searchsorted(group.keys, flat[place], side="right"))
                at, item = np.unique(np.stack([place[owner] // group.repeats, group.owner[entry]]), axis=1)
            begin = np.maximum(part[at] - group.edits, words.first[row[at]])
            regions = _gather(hashes, begin, words.first[row[at] + 1], size + 3 * group.edits)
            for a in range(0, len(at), 4096):
                cut = slice(a, a + 4096)
                edits, start, end = align(regions[cut], group.items[item[cut]])
                for k in np.flatnonzero(edits <= group.edits):
                    r = int(row[at[a + k]])
                    value = (int(edits[k]), int(begin[a + k] + start[k] - words.first[r]), int(end[k] - start[k]))
                    key = (r, group.ids[item[a + k]])
                    best[key] = min(best.get(key, value), value)
    return [(*key, *value) for key, value in best.items()]


def _indexes(benchmark: DataFrame, recall: float) -> list[Index]:
    """Indexes over blocks of at most about ITEMS_PER_BLOCK items, so that what a task holds is bounded."""
    items = benchmark.select("item_id", "text")
    blocks = -(-items.count() // ITEMS_PER_BLOCK)
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    return [build(sorted(map(tuple, items.where(spread == at).distinct().collect()), key=str), recall) for at in range(blocks)]


MATCH = "doc_id long, item_id long, edits int, first_word long, n_words long"


def matches(docs: DataFrame, benchmark: DataFrame, recall: float = 0.99) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, edits, first_word, n_words (of normalised words).

    ``edits`` is the least number of word edits found, ties go to the first place. Items below five words
    only match documents that equal them. Null or empty texts and items match nothing; items that are repeated with
    one id count once, repeated documents are reported each. Extra columns are ignored; an empty table on
    either side gives an empty result.
    """
    spark = docs.sparkSession
    result = spark.createDataFrame([], MATCH)
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    for index in _indexes(benchmark, recall):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for whole in batches:
                for batch in text_slices(whole, "text"):
                    ids = batch.column(0).to_pylist()
                    found = search(shared.value, text_of(batch, "text"))
                    columns = list(zip(*found)) or [()] * 5
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[row] for row in columns[0]], pa.int64()), pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()),
                    ], ["doc_id", "item_id", "edits", "first_word", "n_words"])

        result = result.unionByName(narrow.mapInArrow(work, MATCH))
    return result


def clean(docs: DataFrame, benchmark: DataFrame, recall: float = 0.99) -> DataFrame:
    """The documents without any leaked item, with their own columns; all of them if there are no items."""
    spark = docs.sparkSession
    for index in _indexes(benchmark, recall):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for whole in batches:
                for batch in text_slices(whole, "text"):
                    leaked = np.zeros(batch.num_rows, bool)
                    leaked[[row for row, *_ in search(shared.value, text_of(batch, "text"))]] = True
                    yield batch.filter(pa.array(~leaked))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
