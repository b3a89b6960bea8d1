"""Exact top-k search by integer inner product over an impact-ordered, score-at-a-time index.

*Vectors* are quantised to integers, ``floor(256 * x)`` of every component.

*Index*: candidates are dealt to blocks by a hash of the row (`BLOCK_ROWS` rows on average).  A block's index holds,
for every component, its postings in order of value, so that for any query the postings of largest impact
(query component times value) are a prefix or a suffix.

*Search* of one query in one block, score at a time: an impact above the smallest one of its component counts as
gain.  Posting segments of all components are processed by falling quantised gain, level by level; a level adds
the gains between two thresholds to the accumulators.  After a level each candidate's score lies between its
accumulator and that plus, for each component not seen yet, the level's threshold.  A row is left out
only on proof, when its upper bound is below the k-th best lower bound.  Postings stop when the rows not proved
out are at most a share `RESCORE` of the block, or when no posting is left; all those possible members are scored
again exactly.

*Joining* queries and blocks: queries are a stated set; both sides are cut into blocks and every pair of blocks is
one row of the join, with a bounded payload.  Each pair returns at most k rows a query, and the k best of those
are taken by a grouped top-k.

Defined edge cases: vectors that are null, empty, of another length than the most common rows' would give no
product with a query of different length and are not compared with it; vectors with a null, NaN or infinite
component take no part, nor do rows with null vec_id; equal rows count once; rows that share a query's vec_id are
never its results; rows of one vec_id with different vectors compete with their best score; ties go to the
smaller vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow, ship_package, staged

K = 5
SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 512
#: Gains processed by the end of each level, as shares of the largest gain; after the last one no posting is left.
LEVELS = (0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05, 0.0)
#: Share of a block's rows that may be possible members when postings stop and exact scoring begins.
RESCORE = 0.5


class ImpactIndex:
    """Postings of a block of integer vectors: for every component, rows by rising value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)  # integers, exact far below 2**53
        self.docs = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.vectors, self.docs.T, axis=0).T.copy()
        self.scored = self.read = 0  # rows scored exactly and postings read by the last search

    def search(self, query: np.ndarray, own: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than the query's own."""
        n, query = len(self.ids), query.astype(np.float64)
        other = self.ids != own
        used = np.flatnonzero(query)
        ends = self.values[used][:, [0, -1]] * query[used, None]
        floor, gain = ends.min(axis=1), ends.max(axis=1) - ends.min(axis=1)
        low, high = np.zeros(len(used), np.int64), np.full(len(used), n)  # postings not processed yet
        score, seen = np.zeros(n), np.zeros(n)  # gains and number of components processed, by row
        possible = np.flatnonzero(other)
        self.read = 0
        for share in LEVELS:
            if not len(used) or len(possible) <= max(k, RESCORE * n):
                break
            bar = share * gain.max()
            rows, gains = [], []
            for i in np.flatnonzero(gain > bar):
                d, q = used[i], query[used[i]]
                values, edge = self.values[d], (floor[i] + bar) / q
                if q > 0:
                    first, last = int(np.searchsorted(values, edge, side="right")), high[i]
                    high[i] = first = min(first, last)
                else:
                    first, last = low[i], int(np.searchsorted(values, edge, side="left"))
                    low[i] = last = max(first, last)
                rows.append(self.docs[d, first:last])
                gains.append(values[first:last] * q - floor[i])
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            gains = np.concatenate(gains) if gains else np.zeros(0)
            self.read += len(rows)
            score += np.bincount(rows, weights=gains, minlength=n)
            seen += np.bincount(rows, minlength=n)
            # A component not seen adds at most the bar, or its whole gain if that is smaller; one that was seen
            # has a gain above the bar, so it takes exactly one bar out of the sum.
            upper = score + (np.minimum(gain, bar).sum() - bar * seen) + 1e-6 * (1.0 + gain.sum())
            lower = score[other]
            if len(lower) > k:
                kth = np.partition(lower, len(lower) - k)[len(lower) - k]
                possible = np.flatnonzero(other & (upper >= kth))
        self.scored = len(possible)
        exact = self.vectors[possible] @ query  # possible members, scored exactly
        best = np.lexsort((self.ids[possible], -exact))[:k]
        return self.ids[possible][best], exact[best].astype(np.int64)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int"))


def usable(vector: str) -> Column:
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def _payload(key: str):
    """Rows of one block -> one row: ids and vectors as arrays of bytes."""

    def run(keys: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy().astype("<i8")
        flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i4")
        out = {key: [keys[0].as_py()], "dim": [keys[1].as_py()], f"{key}_ids": [ids.tobytes()], f"{key}_vectors": [flat.tobytes()]}
        return pa.table(out, pa.schema([(key, pa.int32()), ("dim", pa.int32()), (f"{key}_ids", pa.binary()), (f"{key}_vectors", pa.binary())]))

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if of != (row["c"], row["dim"]):
                    ids = np.frombuffer(row["c_ids"], "<i8")
                    index, of = ImpactIndex(ids, np.frombuffer(row["c_vectors"], "<i4").reshape(len(ids), -1)), (row["c"], row["dim"])
                queries = np.frombuffer(row["q_ids"], "<i8")
                vectors = np.frombuffer(row["q_vectors"], "<i4").reshape(len(queries), -1)
                found = [index.search(v, own, k) for own, v in zip(queries, vectors, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(queries, [len(i) for i, _ in found]), pa.int64()),
                        pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                        pa.array(np.concatenate([s for _, s in found]), pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = K, column: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every row of `vectors` that `queries` selects."""
    ship_package(vectors.sparkSession)
    rows = vectors.where(usable(column) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col(column)).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    rows = staged(rows.distinct().withColumns({"dim": F.size("v"), "h": F.xxhash64("vec_id", "v")}))
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    n_c, n_q = max(1, -(-size.n // block_rows)), max(1, -(-size.q // QUERY_ROWS))

    c = rows.withColumn("c", F.pmod("h", F.lit(n_c)).cast("int"))
    c = c.groupBy("c", "dim").applyInArrow(_payload("c"), "c int, dim int, c_ids binary, c_vectors binary")
    q = rows.where("asks").withColumn("q", F.pmod("h", F.lit(n_q)).cast("int"))
    q = q.groupBy("q", "dim").applyInArrow(_payload("q"), "q int, dim int, q_ids binary, q_vectors binary")
    # every block of queries meets every block of rows: both sides are copied once for each block of the other
    c = c.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    q = q.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    found = c.join(q, ["c", "q", "dim"]).transform(map_arrow, _search(k), "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
