"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts is its embedding.
The Manhattan distance of two embeddings never exceeds the Hamming distance of the fingerprints, so
fingerprints within ``max_bits`` have embeddings within ``max_bits``. The embedding space is cut into a grid
of ``max_bits + 3`` blocks of segments; a distance of at most ``max_bits`` leaves at least three blocks with
equal counts. Fingerprints therefore meet in the cells named by three blocks and their counts, are filtered by
the Manhattan distance of the whole embeddings and then verified on the bits.

Equal fingerprints are one node. A cell with more than ``cell_limit`` fingerprints is not joined with itself;
its members meet exactly in another way: each sends out the points that it can reach by flipping half of
``max_bits`` (rounded up) bits. Two fingerprints within the limit share such a point, and the few fingerprints
around one point are bounded by its neighbourhood, so no group grows with the input.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ticktide.llm.tables import fixpoint, staged
from ticktide.llm.words import text_of, text_slices, words_of

SEED = 42
EQUAL_BLOCKS = 3
_BIT_SHIFT = np.arange(64, dtype=np.uint64)


def _fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    words = words_of(column, lower=True)
    single = b" ".join(words.tokens())
    length = words.end - words.start
    end = np.cumsum(length + 1) - 1
    start = (end - length).tolist()
    end = end.tolist()
    digest = xxhash.xxh64_intdigest
    result = np.zeros(len(column), np.uint64)
    first = words.first.tolist()
    for row, (low, high) in enumerate(zip(first[:-1], first[1:])):
        if low == high:
            continue
        width = min(shingle, high - low)
        hashes = np.fromiter(
            (digest(single[a:b], SEED) for a, b in zip(start[low:high - width + 1], end[low + width - 1:high])),
            np.uint64, high - low - width + 1)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 4096):
            part = hashes[at:at + 4096].astype("<u8").view(np.uint8)
            ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        result[row] = np.bitwise_or.reduce((2 * ones > len(hashes)).astype(np.uint64) << _BIT_SHIFT)
    return result


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Append the 64-bit fingerprint of each whole text as a long.

    Null and empty texts, and texts of separators only, have fingerprint zero. Fewer words than ``shingle``
    form one shingle. A column that is already called ``name`` is replaced.
    """
    docs = docs.drop(name)
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def work(batches):
        for whole in batches:
            for batch in text_slices(whole, text):
                found = _fingerprints(text_of(batch, text), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    return docs.mapInArrow(work, schema)


def popcounts(value: Column) -> Column:
    """The embedding: 32 two-bit fields, each the number of ones in one two-bit segment of the fingerprint."""
    low = F.lit(0x5555555555555555).cast("long")
    lower, upper = value.bitwiseAND(low), F.shiftrightunsigned(value, 1).bitwiseAND(low)
    return lower.bitwiseXOR(upper).bitwiseOR(F.shiftleft(lower.bitwiseAND(upper), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed embeddings.

    A field holds 0, 1 or 2. Written in unary (00, 01, 11) the distance of two fields is the number of
    differing bits, so the sum over all fields is one bit count.
    """
    def unary(x: Column) -> Column:
        high = x.bitwiseAND(F.lit(-0x5555555555555556).cast("long"))
        return x.bitwiseOR(F.shiftrightunsigned(high, 1))

    return F.bit_count(unary(a).bitwiseXOR(unary(b)))


def _blocks(count: int) -> list[int]:
    """Bit masks that cut the 32 fields into consecutive blocks."""
    edges = [round(32 * at / count) for at in range(count + 1)]
    return [sum(3 << (2 * field) for field in range(a, b)) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cells(value: Column, max_bits: int) -> Column:
    """All grid cells of a fingerprint: each choice of three blocks, with the counts in them."""
    masks = [reduce(int.__or__, chosen) for chosen in combinations(_blocks(max_bits + EQUAL_BLOCKS), EQUAL_BLOCKS)]
    counts = popcounts(value)
    return F.array(*[F.struct(F.lit(at).cast("byte").alias("grid"),
                              counts.bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("counts"))
                     for at, mask in enumerate(masks)])


def _points(value: Column, flips: int) -> Column:
    """The fingerprint and all points at up to ``flips`` changed bits."""
    masks = [0] + [sum(1 << bit for bit in bits) for n in range(1, flips + 1) for bits in combinations(range(64), n)]
    known = F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])
    return F.transform(known, lambda mask: mask.bitwiseXOR(value))


def links(prints: DataFrame, max_bits: int = 2, cell_limit: int = 48) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints that differ in at most ``max_bits`` bits.

    ``prints`` has one row per fingerprint, column ``fp``. Every pair in reach is connected by a path of
    returned links, and every returned link is in reach of ``2 * ceil(max_bits / 2)`` bits; with an even
    ``max_bits`` that is the limit itself. Pairs in sparse cells are all returned, members of crowded cells
    are linked to the smallest fingerprint around each shared point.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even, or crowded cells could not be linked exactly")
    cells = staged(prints.select("fp", F.inline(_cells(F.col("fp"), max_bits))), "simhash-cells")
    shared = cells.groupBy("grid", "counts").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = staged(shared, "simhash-shared")
    sparse = cells.join(shared.where(F.col("members") <= cell_limit).drop("members"), ["grid", "counts"])
    left, right = sparse.withColumnRenamed("fp", "a"), sparse.withColumnRenamed("fp", "b")
    near = (
        left.join(right, ["grid", "counts"]).where("a < b")
        .where(manhattan(popcounts(F.col("a")), popcounts(F.col("b"))) <= max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    crowded = cells.join(shared.where(F.col("members") > cell_limit).drop("members"), ["grid", "counts"], "left_semi")
    around = (
        crowded.select("fp").distinct().select("fp", F.explode(_points(F.col("fp"), max_bits // 2)).alias("point"))
        .groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("members"))
        .where(F.size("members") > 1).select("a", F.explode("members").alias("b")).where("a < b")
    )
    return near.unionByName(around).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Smallest reachable node (``root``) of every node that has an edge, by alternating star contraction.

    Each round joins edges with one minimum per node; a star's hub is an ordinary skewed join key, which
    adaptive execution splits. The number of rounds is logarithmic in the number of edges.
    """
    def star(df: DataFrame) -> DataFrame:
        both = df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        parent = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(parent, "b")
        return (
            joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
            .unionByName(parent.select(F.col("m").alias("a"), "b")).distinct()
        )

    stars = fixpoint(edges, star, "simhash-stars")
    return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def classes(prints: DataFrame, max_bits: int = 2, cell_limit: int = 48) -> DataFrame:
    """(fp, root) of every distinct fingerprint, ``root`` being the smallest fingerprint it can reach."""
    found = staged(links(prints, max_bits, cell_limit), "simhash-links")
    roots = connected(found)
    return prints.join(roots, prints.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, cell_limit: int = 48) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` differing bits. Texts
    without words have fingerprint zero and link like others. Repeated rows stay repeated. A null doc_id is
    larger than all others, so a component of null ids only has a null id. Extra columns are ignored, an
    empty table gives an empty result.
    """
    known = staged(with_fingerprint(docs.select("doc_id", "text"), shingle, name="fp").drop("text"), "simhash-docs")
    prints = staged(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    parts = prints.join(classes(prints.select("fp"), max_bits, cell_limit), "fp")
    named = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(parts.join(named, "root").select("fp", "component_id"), "simhash-named")
    return known.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, shingle: int = 3, max_bits: int = 2, cell_limit: int = 48) -> DataFrame:
    """Keep one document of every near-duplicate component, with all its columns.

    It is the one with the smallest doc_id; null ids come last, repeated ids are resolved by the text's hash
    and full ties arbitrarily, so exactly one row of a component stays.
    """
    keys = {"__doc": F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")),
            "__hash": F.xxhash64("text", F.col("doc_id").isNull())}
    marked = with_fingerprint(docs.select("doc_id", "text"), shingle, name="__fp").withColumns(keys)
    marked = staged(marked.select("doc_id", "__fp", "__doc", "__hash"), "simhash-docs")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "__doc", "__hash")
    prints = staged(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("least")), "simhash-prints")
    parts = prints.join(classes(prints.select("fp"), max_bits, cell_limit), "fp")
    kept = parts.groupBy("root").agg(F.min("least").alias("k"))
    kept = staged(kept.select("k.__doc", "k.__hash"), "simhash-kept")
    chosen = docs.withColumns(keys).join(kept, ["__doc", "__hash"])
    return chosen.dropDuplicates(["__doc", "__hash"]).select(*docs.columns)
