"""Sharding by jump consistent hashing, in DataFrame functions only.

A key's shard follows from the key and the shard count; no ring or table exists.  With one shard more,
1/(n+1) of the keys move, all of them into the new shard.

The 64-bit state of the hash's linear congruential generator is kept as two 32-bit halves, since Spark's
longs are signed and checked for overflow; every product below stays under 2**63.  The key is the first 64
bits of the md5 of its decimal text, so near-by ids are independent.  A key has at most n jumps, and the fold
runs n steps that do nothing once the next jump passes the last shard.

`slots` numbers the rows of every shard from 0 without gaps and without a sort of a whole shard in one task:
rows are counted by (shard, cell), cells are a hash of the row, a running sum over the small table of cells
gives each cell's first slot, and equal rows are counted before the shuffle and expanded after it.

Defined edge cases: a null key is one key of its own (the text ``null``); null texts have no bytes and crc32 0;
equal rows are numbered in any order, each with its own slot; an empty table gives an empty result; columns
other than the key and text are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import staged

SHARDS = 16
#: Cells a shard is cut into for numbering; a deployment sets about as many as it has cores.
CELLS = 256

_MULTIPLIER = 2862933555777941757  # of the generator, as published with the algorithm
_HIGH, _LOW = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_MASK = 0xFFFFFFFF


def _times(x: Column, k: int) -> Column:
    """x * k as (below 2**49, what exceeds 2**32 kept): x and k are below 2**32, k is cut into 16-bit halves."""
    return x * F.lit(k & 0xFFFF) + F.shiftleft((x * F.lit(k >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)


def key_halves(key: Column) -> tuple[Column, Column]:
    """High and low 32 bits of the md5 of the key's text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return half(1), half(9)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a key of any type that casts to string."""
    high, low = key_halves(key)
    zero = F.lit(0).cast("long")
    start = F.struct(high.alias("h"), low.alias("l"), (zero - 1).alias("b"), zero.alias("j"))

    def step(s: Column, _: Column) -> Column:
        low_sum = _times(s.l, _LOW) + F.lit(1)
        carry = F.shiftright(low_sum, 32) + F.shiftright(s.l * F.lit(_LOW >> 16), 16)
        next_low = low_sum.bitwiseAND(F.lit(_MASK))
        next_high = (_times(s.h, _LOW) + _times(s.l, _HIGH) + carry).bitwiseAND(F.lit(_MASK))
        jump = (s.j + 1) * (F.lit(2.0**31) / (F.shiftright(next_high, 1) + 1).cast("double"))
        moved = F.struct(
            next_high.alias("h"), next_low.alias("l"), s.j.alias("b"), F.floor(jump).cast("long").alias("j")
        )
        return F.when(s.j < F.lit(shards), moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s.b.cast("int"))


def assign_shards(df: DataFrame, key: str, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """df with its shard; map-only.  Write with ``.write.partitionBy(name)``."""
    return df.withColumn(name, jump_hash(F.col(key), shards))


def slots(rows: DataFrame, shard: str = "shard", name: str = "slot", cells: int = CELLS) -> DataFrame:
    """rows with a gapless number from 0 within each shard; rows are narrow (hashable, orderable columns)."""
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count("*").alias("__n"))
    counted = staged(counted.withColumn("__cell", F.pmod(F.xxhash64(*[c for c in columns if c != shard]), F.lit(cells))))
    sums = counted.groupBy(shard, "__cell").agg(F.sum("__n").alias("__cell_n"))
    before = Window.partitionBy(shard).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(shard, "__cell", F.coalesce(F.sum("__cell_n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(shard, "__cell").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__at", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    placed = placed.join(sums, [shard, "__cell"], "left")  # every cell has its sum
    first = F.col("__base") + F.col("__at")
    return placed.select(*columns, F.explode(F.sequence(first, first + F.col("__n") - 1)).alias(name))


def shard_documents(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """Ledger of where every document goes: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        jump_hash(F.col("doc_id"), shards).alias("shard"),
        jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    return slots(rows, cells=cells).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
