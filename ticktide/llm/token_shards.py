"""Training-order materialisation of token sequences as fixed-stride shards.

Texts are tokenised, each followed by a separator, and packed into sequences of equal length within their
input partition. Sequence number i, counted over all partitions, gets the slot P(i) of a keyed Feistel
permutation of the N numbers; numbers that fall outside of [0, N) walk on along their cycle. Slots are cut
into ranges of equal size, and each range becomes one file in which slot s lies at a computable place. A
reader therefore streams the training order sequentially and resumes at any slot without an index.

N must be known before the first slot, so the input is tokenised twice: once to count the sequences of every
partition, once to place them. Nothing but a count per partition is kept in between. Both passes must see the
same partitions, which holds for a scan of stored files; the second pass checks it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticktide.llm.tables import staged
from ticktide.llm.words import Words, mix, text_of, text_slices, words_of
from ticktide.session import prepare, scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The published pre-token pattern of the vocabulary and its free id.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
ROUNDS = 6
TOKEN = np.dtype("<u2")
KNOWN_PIECES = 500_000
SLICE_BYTES = 4 << 20
META = "meta.json"
MANIFEST = ("slot long, shard long, byte_offset long, sequence long, n_tokens int, doc_ids array<long>, "
            "token_crc32 long")


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(posixpath.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def permute(number: np.ndarray, size: int, key: str) -> np.ndarray:
    """Slots of the sequence numbers: a keyed bijection of [0, size)."""
    half = max(1, -(-max(size - 1, 1).bit_length() // 2))
    low = np.uint64((1 << half) - 1)
    digest = hashlib.shake_256(key.encode()).digest(8 * ROUNDS)
    keys = np.frombuffer(digest, "<u8")

    def once(value: np.ndarray) -> np.ndarray:
        left, right = value >> np.uint64(half), value & low
        for round_key in keys:
            left, right = right, left ^ (mix(right + round_key) & low)
        return (left << np.uint64(half)) | right

    slot = once(number.astype(np.uint64))
    outside = np.flatnonzero(slot >= size)
    while len(outside):
        slot[outside] = once(slot[outside])
        outside = outside[slot[outside] >= size]
    return slot.astype(np.int64)


class Packer:
    """Packs the token streams of consecutive texts into rows of equal length."""

    def __init__(self, length: int):
        self.length = length
        self.tokens = np.zeros(0, TOKEN)
        self.ids, self.ends = [], []  # documents of the pending tokens and where each ends

    def add(self, ids: list, streams: list) -> list[tuple]:
        at = len(self.tokens)
        for doc_id, stream in zip(ids, streams):
            at += len(stream)
            self.ids.append(doc_id)
            self.ends.append(at)
        self.tokens = np.concatenate([self.tokens, *streams])
        whole = len(self.tokens) // self.length
        return self._cut(whole)

    def _cut(self, count: int) -> list[tuple]:
        ends = np.array(self.ends)
        rows = []
        for at in range(count):
            low, high = at * self.length, (at + 1) * self.length
            first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, high, side="left")
            rows.append((self.tokens[low:high], self.ids[first:last + 1]))
        done = count * self.length
        gone = int(np.searchsorted(ends, done, side="right"))
        self.tokens, self.ids = self.tokens[done:], self.ids[gone:]
        self.ends = (ends[gone:] - done).tolist()
        return rows

    def rest(self) -> list[tuple]:
        return [(self.tokens, list(self.ids))] if len(self.tokens) else []


_NOT_WHITE = np.ones(256, bool)  # bytes that cannot begin a white-space character
_NOT_WHITE[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = False


def _pieces(column: pa.Array) -> Words:
    """Texts cut before every space that is followed by another character than white space.

    The pre-token pattern always starts a new pre-token there, so pieces can be encoded one by one. A piece mostly
    is a word with its space, and most pieces of a slice are repeated.
    """
    text = words_of(column)
    data, offsets = text.data, text.offsets
    cut = np.zeros(len(data), bool)
    cut[:-1] = (data[:-1] == 32) & _NOT_WHITE[data[1:]]
    full = offsets[1:] > offsets[:-1]
    cut[offsets[1:][full] - 1] = False
    cut[offsets[:-1][full]] = True
    start = np.flatnonzero(cut)
    return Words(data, start, np.append(start[1:], len(data))[:len(start)], np.searchsorted(start, offsets), offsets)


class Encoder:
    """Token ids of whole texts. Each distinct piece is encoded once, new pieces of a slice end to end as one text;
    up to KNOWN_PIECES are remembered, by the hash of their bytes."""

    def __init__(self, tokenizer: str):
        self.tokenizer = encoding(tokenizer)
        self.size = np.array([len(self.tokenizer.decode_single_token_bytes(i)) for i in range(self.tokenizer.n_vocab)])
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, TOKEN)

    def _learn(self, pieces: Words, hashes: np.ndarray, at: np.ndarray) -> None:
        """Encode and remember the pieces at ``at``, which are distinct and new."""
        long = np.flatnonzero(pieces.end[at] - pieces.start[at] > 1)
        spaced = np.zeros(len(at), bool)  # a space before another character: such a piece can follow any other
        first = pieces.start[at[long]]
        spaced[long] = (pieces.data[first] == 32) & _NOT_WHITE[pieces.data[first + 1]]
        alone, joined = at[~spaced], at[spaced]
        encode = self.tokenizer.encode_ordinary
        begin, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        ids = [encode(pieces.data[pieces.start[k]:pieces.end[k]].tobytes().decode()) for k in alone]
        size = pieces.end[joined] - pieces.start[joined]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        text = pieces.data[np.arange(total) + np.repeat(pieces.start[joined] - (stop - size), size)].tobytes().decode()
        tokens = np.array(encode(text), TOKEN)
        length[~spaced] = [len(x) for x in ids]
        begin[~spaced] = np.cumsum(length[~spaced]) - length[~spaced]
        edge = np.searchsorted(np.cumsum(self.size[tokens]), np.append(0, stop), side="left") + 1
        edge[0] = 0
        length[spaced] = np.diff(edge)
        begin[spaced] = edge[:-1] + length[~spaced].sum()
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.begin = np.insert(self.begin, place, begin + len(self.flat))
        self.length = np.insert(self.length, place, length)
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), TOKEN), tokens])

    def _distinct(self, pieces: Words) -> tuple[np.ndarray, np.ndarray]:
        """For every piece the place of its first token in ``flat`` and the number of its tokens."""
        hashes, at, back = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != hashes[inside]
        if new.any():
            self._learn(pieces, hashes[new], at[new])
            place = np.searchsorted(self.known, hashes)
        place = place[back]
        return self.begin[place], self.length[place]

    def count(self, column: pa.Array) -> int:
        """Tokens of all texts with their separators."""
        return int(self._distinct(_pieces(column))[1].sum()) + len(column)

    def streams(self, column: pa.Array) -> list[np.ndarray]:
        """Each text's tokens and its separator."""
        pieces = _pieces(column)
        begin, length = self._distinct(pieces)
        done = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=done[1:])
        tokens = self.flat[np.arange(done[-1]) + np.repeat(begin - done[:-1], length)]
        edges = done[pieces.first]
        return [np.append(tokens[low:high], TOKEN.type(SEPARATOR)) for low, high in zip(edges[:-1], edges[1:])]


@lru_cache(maxsize=2)
def encoder_of(tokenizer: str) -> Encoder:
    return Encoder(tokenizer)


def _counted(docs: DataFrame, length: int, tokenizer: str) -> dict[int, int]:
    """Sequences of each input partition; the driver holds one number per partition."""
    def work(batches):
        tokens, part, encoder = 0, None, encoder_of(tokenizer)
        for whole in batches:
            for batch in text_slices(whole, "text", SLICE_BYTES):
                if part is None:
                    part = batch.column(2)[0].as_py() >> 33
                tokens += encoder.count(text_of(batch, "text"))
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([-(-tokens // length)])], ["part", "n"])

    return {row["part"]: row["n"] for row in docs.mapInArrow(work, "part long, n long").collect()}


def _placed(docs: DataFrame, length: int, tokenizer: str, counts: dict[int, int], key: str, shard_rows: int) -> DataFrame:
    """(shard, slot, sequence, n_tokens, doc_ids, tokens) of every sequence."""
    parts = sorted(counts)
    sums = np.cumsum([0, *(counts[part] for part in parts)])
    size = int(sums[-1])
    base = docs.sparkSession.sparkContext.broadcast({part: (int(at), counts[part]) for part, at in zip(parts, sums)})

    def rows_of(rows: list[tuple], first: int) -> pa.RecordBatch:
        number = np.arange(first, first + len(rows))
        slot = permute(number, size, key)
        return pa.RecordBatch.from_arrays([
            pa.array(slot // shard_rows), pa.array(slot), pa.array(number),
            pa.array([len(tokens) for tokens, _ in rows], pa.int32()),
            pa.array([ids for _, ids in rows], pa.list_(pa.int64())),
            pa.array([tokens.tobytes() for tokens, _ in rows], pa.binary()),
        ], ["shard", "slot", "sequence", "n_tokens", "doc_ids", "tokens"])

    def work(batches):
        packer, encoder, done, start, expected = Packer(length), encoder_of(tokenizer), 0, None, 0
        for whole in batches:
            for batch in text_slices(whole, "text", SLICE_BYTES):
                if start is None:
                    start, expected = base.value[batch.column(2)[0].as_py() >> 33]
                rows = packer.add(batch.column(0).to_pylist(), encoder.streams(text_of(batch, "text")))
                if rows:
                    yield rows_of(rows, start + done)
                    done += len(rows)
        rows = packer.rest()
        if rows:
            yield rows_of(rows, start + done)
        if done + len(rows) != expected:
            raise RuntimeError("the input's partitions changed between counting and placing; stage it first")

    return docs.mapInArrow(
        work, "shard long, slot long, sequence long, n_tokens int, doc_ids array<long>, tokens binary")


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _written(placed: DataFrame, path: str, length: int, shard_rows: int) -> DataFrame:
    """Write each shard in slot order under a temporary name, then rename it: a repeated task replaces its file."""
    stride = length * TOKEN.itemsize

    def work(batches):
        store, root = _open(path)
        shard, out, temporary = None, None, None

        def close():
            if out is not None:
                out.close()
                store.move(temporary, posixpath.join(root, shard_name(shard)))

        for batch in batches:
            offsets, checks = [], []
            for number, slot, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(5)):
                if number != shard:
                    close()
                    shard, temporary = number, posixpath.join(root, f".{shard_name(number)}.{uuid.uuid4().hex}")
                    out = store.open_output_stream(temporary)
                raw = tokens.as_py()
                raw += TOKEN.type(SEPARATOR).tobytes() * (length - len(raw) // TOKEN.itemsize)
                out.write(raw)
                offsets.append((slot - number * shard_rows) * stride)
                checks.append(zlib.crc32(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), pa.array(offsets, pa.int64()), batch.column(2), batch.column(3),
                 batch.column(4), pa.array(checks, pa.int64())],
                ["slot", "shard", "byte_offset", "sequence", "n_tokens", "doc_ids", "token_crc32"])
        close()

    return placed.mapInArrow(work, MANIFEST)


def materialise(docs: DataFrame, path: str, length: int = 1024, key: str = "order-1", shard_rows: int = 4096,
                tokenizer: str = TOKENIZER) -> DataFrame:
    """Write all texts as shards below ``path`` (reachable by every executor) and return the manifest.

    One manifest row per sequence: slot, shard, byte_offset in the shard's file, sequence (number before the
    permutation), n_tokens (before padding), doc_ids (documents with a token or separator in it, in order)
    and token_crc32 of the stored bytes. Only the last sequence of an input partition is padded, with separators. A
    null or empty text contributes its separator only. Repeated rows are written each, a null id appears as
    null in doc_ids, extra columns are ignored; an empty table writes no shard. Each file holds ``shard_rows``
    sequences of ``length`` 16-bit little-endian ids, the last file what is left.
    """
    spark = prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    counts = _counted(narrow, length, tokenizer)
    size = sum(counts.values())
    shards = -(-size // shard_rows)
    store, root = _open(path)
    store.create_dir(root, recursive=True)
    if shards:
        placed = _placed(narrow, length, tokenizer, counts, key, shard_rows)
        ranged = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
        manifest = staged(_written(ranged, path, length, shard_rows), "token-manifest")
    else:
        manifest = spark.createDataFrame([], MANIFEST)
    with store.open_output_stream(posixpath.join(root, META)) as out:
        out.write(json.dumps({"sequences": size, "length": length, "shard_rows": shard_rows, "token": TOKEN.str}).encode())
    return manifest


def read(path: str, first: int = 0, count: int | None = None):
    """Stream the sequences of slots first, first + 1, ... as arrays; a trainer resumes with its next slot."""
    store, root = _open(path)
    meta = json.loads(store.open_input_stream(posixpath.join(root, META)).read())
    stride = meta["length"] * np.dtype(meta["token"]).itemsize
    slot, stop = first, meta["sequences"] if count is None else min(meta["sequences"], first + count)
    while slot < stop:
        shard = slot // meta["shard_rows"]
        with store.open_input_file(posixpath.join(root, shard_name(shard))) as data:
            data.seek((slot - shard * meta["shard_rows"]) * stride)
            for slot in range(slot, min(stop, (shard + 1) * meta["shard_rows"])):
                yield np.frombuffer(data.read(stride), meta["token"])
        slot += 1


def scan(spark: SparkSession, path: str, length: int, shard_rows: int) -> DataFrame:
    """(slot, tokens) of all shards as a frame, through Spark's binary file source."""
    stride = length * TOKEN.itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(path)
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin", 1).cast("long")
    rows = files.select(shard.alias("shard"), "content", F.explode(F.expr(
        f"sequence(0, cast(length div {stride} - 1 as int))")).alias("at"))
    return rows.select((F.col("shard") * shard_rows + F.col("at")).alias("slot"),
                       F.col("content").substr(F.col("at") * stride + 1, F.lit(stride)).alias("tokens"))


def shards_path(spark: SparkSession) -> str:
    return scratch_path(spark, "token-shards")
