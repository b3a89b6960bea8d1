"""Token counts by a two-tier lookup on the map side: no piece of text is ever shuffled.

Tier 1 is a compact hash table (numpy arrays) of the token counts of frequent pieces, broadcast; it holds at most
`FREQUENT` pieces, about 50 bytes each, so its size is bounded whatever the input.  Which pieces are frequent is counted
over all texts: each task keeps a summary of at most `COUNTERS` pieces (`Summary`), and Spark adds the summaries.  A piece that
makes up more than 1 / `COUNTERS` of a task's pieces cannot be missing in that task's summary.  Tier 2 is each worker's own
table (`tokens.PieceTable`): a piece missing in tier 1 is encoded once by the library and remembered there.  The tiers
decide speed only: a piece's count is the library's in either, and every text is counted whole.

Defined edge cases: null and empty texts have no bytes and no tokens; repeated rows give repeated results;
an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.common import map_arrow
from panelspark.llm.words import slices

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
FREQUENT = 30_000
#: Pieces that a task's summary keeps.
COUNTERS = 8_192


class Summary:
    """Frequent items of a stream in bounded memory (Misra and Gries, batches merged as Agarwal et al. do).

    Counts are too low by at most (items seen) / (counters + 1), the same for every item of the summary.
    """

    def __init__(self, counters: int = COUNTERS):
        self.counters = counters
        self.hash, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.text = np.zeros(0, object)

    def add(self, pieces: tokens.Pieces) -> None:
        hashes, first, times = np.unique(pieces.hash[pieces.short], return_index=True, return_counts=True)
        if not len(hashes):
            return
        at = np.searchsorted(hashes, self.hash)
        known = hashes[np.minimum(at, len(hashes) - 1)] == self.hash
        self.count[known] += times[at[known]]
        new = np.ones(len(hashes), bool)
        new[at[known]] = False
        # The text of an item is read only if the item can stay.
        cut = np.concatenate([self.count, times[new]])
        less = int(np.partition(cut, -self.counters - 1)[-self.counters - 1]) if len(cut) > self.counters else 0
        stay, come = self.count > less, new & (times > less)
        places = np.arange(len(pieces.start))[pieces.short][first[come]]
        text = np.empty(len(places), object)
        text[:] = pieces.text(places)
        self.hash = np.concatenate([self.hash[stay], hashes[come]])
        self.count = np.concatenate([self.count[stay], times[come]]) - less
        self.text = np.concatenate([self.text[stay], text])


def frequent_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, counters: int = COUNTERS) -> DataFrame:
    """(piece, n): summed counts of the tasks' summaries; texts are read once, at most `counters` rows leave a task."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(counters)
        for part in (part for batch in batches for part in slices(batch, "text", 2 << 20)):
            summary.add(tokens.Pieces(vocabulary, part.column("text")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(summary.text.tolist(), pa.string()), pa.array(summary.count)], names=["piece", "n"]
        )

    found = docs.where("text is not null").select("text").transform(map_arrow, summarise, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_counts(docs: DataFrame, vocabulary: str = VOCABULARY, n: int = FREQUENT) -> tokens.PieceTable:
    """Token counts of the n most frequent pieces of all texts."""
    best = [r.piece for r in frequent_pieces(docs, vocabulary).orderBy(F.desc("n"), "piece").limit(n).collect()]
    pieces = tokens.Pieces(vocabulary, pa.array(best, pa.string()))
    at = np.flatnonzero(np.bincount(pieces.owner, minlength=pieces.n)[pieces.owner] == 1)
    coded = tokens.library(vocabulary).encode_batch_fast(pieces.text(at), add_special_tokens=False)
    table = tokens.PieceTable(max(1024, len(at)))
    table.add(pieces.hash[at], pieces.check[at], np.fromiter(map(len, coded), np.int32, len(coded)))
    return table


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document (map-only after the table of frequent pieces)."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_counts(docs, vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, frequent = tokens.coder(vocabulary, keep_ids=False), table.value
        for part in (part for batch in batches for part in slices(batch, "text", 2 << 20)):
            n = coder.count(part.column("text"), frequent)
            sizes = pc.binary_length(part.column("text")).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), sizes, pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").transform(
        map_arrow, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
