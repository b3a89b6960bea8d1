"""Token ids in wavelet-matrix shard files.

A shard is one Parquet file that one task writes for a range of doc_ids in ascending order.  Its rows are blocks:
runs of whole documents with about `BLOCK` tokens (a longer document is a block by itself).  A block holds
- the wavelet matrix of its ids: `PLANES` bit planes from the highest bit down, each the packed bits of the
  sequence at that level, after which zeros move stably before ones; the number of zeros of each plane; and for
  rank a running count of ones every `RANK_BITS` bits.  Payload layout (little-endian):
  ``u32 planes, u64 n, then per plane: u64 zeros, u32 counts[ceil(n / RANK_BITS) + 1], u8 bits[ceil(n / 8)]``;
- its document index: doc_id and number of ids, in order.
Parquet compresses the file, and Spark's committer makes a retried or duplicated task harmless.

`Wavelet` gives access to single tokens, `rank` (how often a token stands before a place), `count` and `select`
(the place of its k-th occurrence) from the compressed planes alone; `decode` rebuilds the whole block, plane by plane.
`token_at`, `count` and `occurrences` answer for all ids of written files, block by block.

Defined edge cases: null and empty texts have only the end id; rows with equal doc_id stand next to each other,
ordered by their text; null doc_ids come first; an empty table writes no block; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.common import map_arrow
from panelspark.llm.words import slices
from panelspark.session import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"
END = 1
PLANES = 16
BLOCK = 1 << 18
RANK_BITS = 512


def encode(ids: np.ndarray, planes: int = PLANES) -> bytes:
    """Wavelet matrix of ids below 2**planes."""
    now = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    out = [struct.pack("<IQ", planes, len(now))]
    for plane in range(planes - 1, -1, -1):
        one = (now & (1 << plane)) != 0
        bits = np.packbits(one, bitorder="little")
        held = np.zeros(-(-len(now) // RANK_BITS) * (RANK_BITS // 8), np.uint8)
        held[: len(bits)] = bits
        ones = np.bitwise_count(held).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        counts = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        low = now.take(np.flatnonzero(~one))
        out += [struct.pack("<Q", len(low)), counts.tobytes(), bits.tobytes()]
        now = np.concatenate([low, now.take(np.flatnonzero(one))])
    return b"".join(out)


class Wavelet:
    """Reads a block's payload."""

    def __init__(self, payload: bytes):
        self.planes, self.n = struct.unpack_from("<IQ", payload)
        at, self.levels = 12, []
        n_counts, n_bits = -(-self.n // RANK_BITS) + 1, -(-self.n // 8)
        for _ in range(self.planes):
            (zeros,) = struct.unpack_from("<Q", payload, at)
            counts = np.frombuffer(payload, "<u4", n_counts, at + 8)
            at += 8 + 4 * n_counts
            self.levels.append((zeros, counts, np.frombuffer(payload, np.uint8, n_bits, at)))
            at += n_bits

    def decode(self) -> np.ndarray:
        """All ids: the moves of each plane undone, last plane first."""
        now = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane, (zeros, _, bits) in enumerate(reversed(self.levels)):
            one = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~one)] = now[:zeros]
            before[np.flatnonzero(one)] = now[zeros:] | now.dtype.type(1 << plane)
            now = before
        return now

    def _ones(self, level: int, at: int) -> int:
        """Ones of a level before `at`."""
        _, counts, bits = self.levels[level]
        block = at // RANK_BITS
        low, high = block * RANK_BITS // 8, at // 8
        total = int(counts[block]) + int(np.bitwise_count(bits[low:high]).sum())
        return total + (int(bits[high] & ((1 << at % 8) - 1)).bit_count() if at % 8 else 0)

    def __getitem__(self, at: int) -> int:
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level, (zeros, _, bits) in enumerate(self.levels):
            one = bits[at // 8] >> (at % 8) & 1
            ones = self._ones(level, at)
            value = value << 1 | int(one)
            at = zeros + ones if one else at - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before `end` stand after the last plane."""
        low, high = 0, end
        if token >> self.planes:
            return 0, 0
        for level, (zeros, _, _) in enumerate(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            low, high = (zeros + a, zeros + b) if token >> (self.planes - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before place `end`."""
        low, high = self._range(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token; -1 if there are fewer."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            return -1
        at = low + k
        for level in range(self.planes - 1, -1, -1):
            zeros, counts, bits = self.levels[level]
            one = at >= zeros
            want = at - zeros if one else at  # the bit that has this many equal bits before it
            before = counts if one else np.arange(len(counts), dtype=np.int64) * RANK_BITS - counts
            block = int(np.searchsorted(before[:-1], want, side="right")) - 1
            low_byte = block * RANK_BITS // 8
            part = np.unpackbits(bits[low_byte : low_byte + RANK_BITS // 8], bitorder="little")
            places = np.flatnonzero(part == one)
            at = block * RANK_BITS + int(places[want - int(before[block])])
        return at

    def places(self, token: int) -> np.ndarray:
        """Places of all occurrences of a token, ascending."""
        low, high = self._range(token, self.n)
        at = np.arange(low, high)
        for level in range(self.planes - 1, -1, -1) if len(at) else ():
            zeros, _, bits = self.levels[level]
            one = token >> (self.planes - 1 - level) & 1
            found = np.flatnonzero(np.unpackbits(bits, count=self.n, bitorder="little") == one)
            at = found[at - zeros if one else at]
        return at


_FIELDS = [("shard", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]


def _blocks(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        kind = None

        def block():
            nonlocal number
            ids = np.concatenate(held)
            values = [[shard], [number], [len(ids)], [sizes], [encode(ids)]]
            arrays = [pa.array(v, t) for v, (_, t) in zip(values, _FIELDS, strict=True)]
            number += 1
            out = pa.RecordBatch.from_arrays([*arrays, pa.array([names], pa.list_(kind))], names=[*[f for f, _ in _FIELDS], "doc_ids"])
            for part in (names, sizes, held):
                part.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in slices(batch, "text", 1 << 20):
                ids, off = tokens.with_end(*tokens.encode(vocabulary, part.column("text")), end_id)
                doc_ids = part.column("doc_id").to_pylist()
                at = 0
                while at < len(doc_ids):  # whole documents up to the size of a block
                    room = BLOCK - sum(map(len, held))
                    to = max(at + 1, int(np.searchsorted(off, off[at] + room, side="right")) - 1)
                    to = min(to, len(doc_ids))
                    names += doc_ids[at:to]
                    sizes += np.diff(off[at : to + 1]).tolist()
                    held.append(ids[off[at] : off[to]])
                    if to < len(doc_ids) or sum(map(len, held)) >= BLOCK:
                        yield block()
                    at = to
        if names:
            yield block()

    return run


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END, shards: int | None = None) -> None:
    """Tokenise and write; one range exchange on doc_id (and the text's hash, which splits a repeated doc_id)."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = f"shard int, block int, n_tokens long, lengths array<long>, payload binary, doc_ids array<{kind}>"
    rows.transform(map_arrow, _blocks(vocabulary, end_id), schema).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with the place of each block's first id among all ids (from the counts of the blocks)."""
    blocks = spark.read.parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    base = per_shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", "n_tokens").withColumn("at", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return starts.join(base, "shard").select("shard", "block", (F.col("shard_start") + F.col("at")).alias("block_start"))


def count(spark: SparkSession, path: str, token: int) -> int:
    """How often a token stands in all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = [Wavelet(payload.as_py()).count(token) for payload in batch.column("payload")]
            yield pa.RecordBatch.from_arrays([pa.array(times, pa.int64())], names=["n"])

    found = spark.read.parquet(path).select("payload").transform(map_arrow, run, "n long")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """place: every place, among all ids, at which a token stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column("block_start").to_pylist(), batch.column("payload"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(start + Wavelet(payload.as_py()).places(token), pa.int64())], names=["place"])

    blocks = spark.read.parquet(path).select("shard", "block", "payload").join(read_shards(spark, path), ["shard", "block"])
    return blocks.select("block_start", "payload").transform(map_arrow, run, "place long")


def token_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """place, token for every row of `places` (place long); null where no id stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, asked = batch.column("block_start")[i].as_py(), batch.column("places")[i].as_py()
                block = Wavelet(batch.column("payload")[i].as_py())
                found = [block[x - start] for x in asked]
                yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array(found, pa.int32())], names=["place", "token"])

    blocks = spark.read.parquet(path).select("shard", "block", "n_tokens", "payload").join(read_shards(spark, path), ["shard", "block"])
    inside = (F.col("place") >= F.col("block_start")) & (F.col("place") < F.col("block_start") + F.col("n_tokens"))
    # a block's list holds each of its places once, so its payload is read once however many places are asked for
    asked = places.select("place").distinct().join(F.broadcast(blocks.drop("payload")), inside)
    asked = asked.groupBy("shard", "block").agg(F.collect_list("place").alias("places"))
    found = blocks.join(asked, ["shard", "block"]).select("block_start", "payload", "places")
    return places.select("place").join(found.transform(map_arrow, run, "place long, token int"), "place", "left")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = Wavelet(batch.column("payload")[i].as_py()).decode().astype("<u4").tobytes()
            sizes = np.array(batch.column("lengths")[i].as_py(), np.int64)
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(ids[4 * (b - n) : 4 * b]) for n, b in zip(sizes, ends, strict=True)]
            names = batch.column("doc_ids")[i].values
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [names, pa.repeat(batch.column("shard")[i], n), pa.repeat(batch.column("block")[i], n), pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                names=["doc_id", "shard", "block", "at", "n_tokens", "ids_crc32"],
            )


def documents_in(spark: SparkSession, path: str) -> DataFrame:
    """Every document as read back from the files: doc_id, start, n_tokens, ids_crc32, shard, block."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    docs = blocks.select("shard", "block", "lengths", "payload", "doc_ids").transform(
        map_arrow, _digest, f"doc_id {kind}, shard int, block int, at long, n_tokens long, ids_crc32 long"
    )
    return docs.join(read_shards(spark, path), ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "block"
    )


def wavelet_round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END) -> DataFrame:
    """Write all documents under spark.checkpoint.dir and read them back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wavelet-{uuid.uuid4().hex}"
    write_shards(docs, path, vocabulary, end_id)
    return documents_in(spark, path)
