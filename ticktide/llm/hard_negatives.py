"""Hard negatives: for every anchor and each of its best positives, the best rows of other labels in a band of scores.

Scores are exact integer inner products by the method of the Four Russians. Components become integers, and a row is
packed into bit planes of their two's complement: one byte per plane and group of eight dimensions. For every anchor and
group a table holds the sums of the anchor's eight components over all 256 subsets, so a byte of a plane picks the sum of
the components where the row's bit is set. Looked-up sums are added over groups and doubled from plane to plane.

The anchors are a stated query set and meet the rows in blocks: one bounded block at a time goes to all tasks, each of
which reads its packed rows once, keeps the best few per anchor, and sends only those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticktide.llm.tables import staged
from ticktide.session import scratch_path

POSITIVES = 5
NEGATIVES = 10
BAND = (30, 90)  # percent of the positive's score
SCALE = 256
LABELS = 10
RELABELLED = 7
ANCHOR_EVERY = 100
ANCHORS_PER_BLOCK = 4096
TABLE_BYTES = 8 << 20  # the subset sums that are looked up at a time
SCORE_BYTES = 1 << 20  # the scores that are made at a time
GROUP = 8
LARGEST = (1 << 63) // 100

PACKED = "vec_id long, label long, planes int, groups int, bits binary"
HIT = "anchor int, slot int, score long, row_id long"


def _integers(column: pa.ListArray) -> np.ndarray:
    """floor(256 x) of all vectors, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(values * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 1 << 31:
        raise ValueError("components of 2^23 or more would not give scores of 64 bits")
    filled = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    filled[np.arange(filled.shape[1]) < sizes[:, None]] = scaled
    return filled


def packed(integers: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of bit planes, and per row, plane (sign first) and group of eight dimensions one byte."""
    most = int(np.maximum(integers, ~integers).max(initial=0))
    planes = most.bit_length() + 1
    shifts = np.arange(planes - 1, -1, -1)
    bits = (integers[:, None, :] >> shifts[None, :, None]) & 1
    return planes, np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpacked(planes: int, packs: np.ndarray) -> np.ndarray:
    """The integers again, filled up with zeros to whole groups."""
    bits = np.unpackbits(packs, axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(planes - 1, -1, -1, dtype=np.int64)
    weights[0] = -weights[0]
    return np.einsum("p,npd->nd", weights, bits)


def subset_sums(anchors: np.ndarray, dtype: type) -> np.ndarray:
    """Per group and byte, the sums of every anchor's components at the byte's set bits: (groups, 256, anchors)."""
    groups = anchors.shape[1] // GROUP
    sums = np.zeros((groups, 1 << GROUP, len(anchors)), dtype)
    for group in range(groups):
        for bit in range(GROUP):
            low = 1 << bit
            sums[group, low:2 * low] = sums[group, :low] + anchors[:, GROUP * group + bit].astype(dtype)
    return sums


def scores(sums: np.ndarray, packs: np.ndarray) -> np.ndarray:
    """Inner products of all packed rows (rows, planes, groups) with all anchors."""
    groups = min(sums.shape[0], packs.shape[2])
    total = np.zeros((len(packs), sums.shape[2]), sums.dtype)
    picked = np.empty_like(total)
    for plane in range(packs.shape[1]):
        if plane:
            total <<= 1
        for group in range(groups):
            np.take(sums[group], packs[:, plane, group], axis=0, out=picked, mode="clip")
            total += picked
        if not plane:
            np.negative(total, out=total)
    return total


class Block:
    """Up to a block of anchors: vector ids, row numbers, labels, integer vectors; later the bounds of their bands."""

    def __init__(self, ids: list, labels: list, vectors: list[np.ndarray]):
        self.ids, self.labels = ids, np.array(labels, np.int64)
        width = max(map(len, vectors), default=0)
        self.vectors = np.zeros((len(vectors), width), np.int64)
        for at, vector in enumerate(vectors):
            self.vectors[at, :len(vector)] = vector
        self.most = np.abs(self.vectors).sum(axis=1).max(initial=0)
        self.low = self.high = None  # (anchors, positives)

    def chunks(self, chosen: np.ndarray, planes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Anchors in chunks with their tables, in numbers as wide as the scores need."""
        bound = int(self.most) << (planes - 1)
        if bound >= LARGEST:
            raise ValueError("scores of this size do not fit the comparison in 64 bits")
        dtype = np.int32 if bound < 1 << 31 else np.int64
        step = max(1, TABLE_BYTES // (max(self.vectors.shape[1], 1) * 32 * np.dtype(dtype).itemsize))
        for at in range(0, len(chosen), step):
            part = chosen[at:at + step]
            yield part, subset_sums(self.vectors[part], dtype)


class Best:
    """The best ``size`` hits per slot so far: larger scores first, then smaller ids, missing ids last."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot = np.zeros(0, np.int64)
        self.score, self.row_id, self.missing = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
        self.least = np.full(slots, np.iinfo(np.int64).min)  # the last kept score of full slots

    def add(self, slot: np.ndarray, score: np.ndarray, row_id: np.ndarray, missing: np.ndarray) -> None:
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        row_id, missing = np.concatenate([self.row_id, row_id]), np.concatenate([self.missing, missing])
        order = np.lexsort((row_id, missing, -score, slot))
        ordered = slot[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        kept = order[place < self.size]
        self.slot, self.score, self.row_id, self.missing = slot[kept], score[kept], row_id[kept], missing[kept]
        full = order[place == self.size - 1]
        self.least[slot[full]] = score[full]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]]:
    """Rows of one packed layout: ids, their absence, labels, planes, bits."""
    ids = batch.column("vec_id")
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    values, labels = ids.fill_null(0).to_numpy(), batch.column("label").to_numpy()
    planes, groups = batch.column("planes").to_numpy(), batch.column("groups").to_numpy()
    for layout in np.unique(np.stack([planes, groups], axis=1), axis=0):
        chosen = np.flatnonzero((planes == layout[0]) & (groups == layout[1]))
        raw = b"".join(batch.column("bits").take(pa.array(chosen)).to_pylist())
        packs = np.frombuffer(raw, np.uint8).reshape(len(chosen), *map(int, layout))
        yield values[chosen], missing[chosen], labels[chosen], int(layout[0]), packs


def _hits(best: Best, slots: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(best.slot // slots, pa.int32()), pa.array(best.slot % slots, pa.int32()), pa.array(best.score),
        pa.array(best.row_id, pa.int64(), mask=best.missing),
    ], ["anchor", "slot", "score", "row_id"])


def _pieces(rows: int, anchors: int, size: int) -> Iterator[slice]:
    step = max(1, SCORE_BYTES // (max(anchors, 1) * size))
    return (slice(at, at + step) for at in range(0, rows, step))


def _positives(block: Block, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of the anchors' own labels in this task; one more, because the anchor itself is among them."""
    best = Best(len(block.ids), size + 1)
    for batch in batches:
        for ids, missing, labels, planes, packs in _rows(batch):
            for label in np.intersect1d(labels, block.labels):
                of = np.flatnonzero(labels == label)
                for chosen, sums in block.chunks(np.flatnonzero(block.labels == label), planes):
                    for piece in _pieces(len(of), len(chosen), sums.itemsize):
                        found = scores(sums, packs[of[piece]])
                        row, column = np.nonzero(found >= best.least[chosen])
                        at = of[piece][row]
                        best.add(chosen[column], found[row, column].astype(np.int64), ids[at], missing[at])
    yield _hits(best, 1)


def _negatives(block: Block, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of other labels in the band of every anchor and positive, in this task."""
    slots = block.low.shape[1]
    best = Best(len(block.ids) * slots, size)
    anchors = np.flatnonzero((block.low <= block.high).any(axis=1))
    for batch in batches:
        for ids, missing, labels, planes, packs in _rows(batch):
            for chosen, sums in block.chunks(anchors, planes):
                for piece in _pieces(len(ids), len(chosen), sums.itemsize):
                    found = scores(sums, packs[piece])
                    other = labels[piece][:, None] != block.labels[chosen]
                    for slot in range(slots):
                        of = chosen * slots + slot
                        least = np.maximum(best.least[of], block.low[chosen, slot])
                        row, column = np.nonzero((found >= least) & (found <= block.high[chosen, slot]) & other)
                        if len(row):
                            best.add(of[column], found[row, column].astype(np.int64), ids[piece][row], missing[piece][row])
    yield _hits(best, slots)


def _best(hits: DataFrame, size: int) -> DataFrame:
    order = [F.desc("score"), F.col("row_id").asc_nulls_last()]
    leading = Window.partitionBy("anchor", "slot").orderBy(*order)
    return hits.withColumn("place", F.row_number().over(leading)).where(F.col("place") <= size)


def prepared(vectors: DataFrame) -> DataFrame:
    """Packed rows of all usable vectors, with labels as they count here; staged."""
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>"))

    def work(batches):
        for batch in batches:
            planes, packs = packed(_integers(batch.column(2)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array(np.full(len(packs), planes, np.int32)), pa.array(np.full(len(packs), packs.shape[2], np.int32)),
                pa.array([pack.tobytes() for pack in packs], pa.binary()),
            ], ["vec_id", "label", "planes", "groups", "bits"])

    return staged(rows.mapInArrow(work, PACKED), "packed-vectors")


def _blocks(rows: DataFrame, size: int) -> Iterator[Block]:
    """The anchors, at most ``size`` of them at a time on the driver."""
    ids, labels, vectors = [], [], []
    for row in rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).toLocalIterator():
        packs = np.frombuffer(bytes(row["bits"]), np.uint8).reshape(1, row["planes"], row["groups"])
        ids.append(row["vec_id"])
        labels.append(row["label"])
        vectors.append(unpacked(row["planes"], packs)[0])
        if len(ids) == size:
            yield Block(ids, labels, vectors)
            ids, labels, vectors = [], [], []
    if ids:
        yield Block(ids, labels, vectors)


def _without_itself(block: Block, hits: list, size: int) -> list[list[tuple[int, int]]]:
    """Per anchor its positives (score, id): of the rows with its id and its own score, one is the anchor itself."""
    own = (block.vectors ** 2).sum(axis=1)
    found, itself = [[] for _ in block.ids], [False] * len(block.ids)
    for hit in hits:
        at = hit["anchor"]
        if not itself[at] and hit["row_id"] == block.ids[at] and hit["score"] == own[at]:
            itself[at] = True
        else:
            found[at].append((hit["score"], hit["row_id"]))
    return [rows[:size] for rows in found]


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without label or vector, or with a missing or non-finite component, take no part. A vector shorter than another
    counts as filled up with zeros. Every row counts for itself: repeated anchors give repeated results, and a copy
    of an anchor is one of its positives. Rows without id are no anchors; among equal scores they come last. Scores
    must stay below 2^63 / 100; larger components are refused. Extra columns are ignored; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors)
    path = scratch_path(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for block in _blocks(rows, anchors_per_block):
        shared = spark.sparkContext.broadcast(block)
        hits = rows.mapInArrow(lambda batches, own=shared: _positives(own.value, positives, batches), HIT)
        best = _best(hits, positives + 1).orderBy("anchor", "place").collect()  # a few rows for each anchor of the block
        shared.destroy()
        chosen = _without_itself(block, best, positives)
        block.low = np.zeros((len(chosen), positives), np.int64)
        block.high = np.full((len(chosen), positives), -1, np.int64)
        names = []
        for at, pairs in enumerate(chosen):
            for slot, (score, row_id) in enumerate(pairs):
                block.low[at, slot], block.high[at, slot] = -(-band[0] * score // 100), band[1] * score // 100
                names.append((at, slot, block.ids[at], row_id, score))
        shared = spark.sparkContext.broadcast(block)
        hits = rows.mapInArrow(lambda batches, own=shared: _negatives(own.value, negatives, batches), HIT)
        known = spark.createDataFrame(names, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
        _best(hits, negatives).join(known, ["anchor", "slot"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("row_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(RESULT).parquet(path)
