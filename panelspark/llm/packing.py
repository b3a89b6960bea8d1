"""Hierarchical packing of tokenised documents into sequences of several lengths.

Every input partition is packed where it lies: tokens are never shuffled, and a worker holds one window of
at most `WINDOW_DOCS` documents (and about 2 MB of text) with their tokens at a time.

1. *Route*: a document longer than the longest tier gives full sequences of that tier (one piece each, no
   padding); its end, or a whole shorter document, goes to the tier with the next length above its own.
2. *Pack each tier*, longest first: an end opens a sequence of its tier's length.
3. *Fill gaps*: the gap behind it takes the longest unused ends of shorter tiers that fit, then the one end that
   does not fit is cut, so the sequence is full.  Only when no shorter end is left does a sequence stay open;
   the open sequences of a window are concatenated and cut at full length, and what is left at the end of the
   partition is cut at powers of two.  So no sequence is padded.
4. *Balance*: sequences are dealt to step groups of `STEP` tokens; within a partition each group takes the next
   sequence of whichever length still fits, longest first, so groups hold equal tokens.  The last group of a window
   stays open and takes sequences of the next window; only the last group of a partition may hold fewer tokens.

Defined edge cases: null and empty texts are one end token; ties and repeated rows are separate documents in the
order of the partition's rows; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from panelspark.llm import tokens
from panelspark.llm.common import map_arrow
from panelspark.llm.words import slices

VOCABULARY = "byte_bpe_50k.json"
END = 0
TIERS = (1024, 512, 256, 128)
WINDOW_DOCS = 4096
STEP = 32 * 1024

Piece = tuple[int, int, int]  # document of the window, first token, tokens


def pack_window(lengths: Iterable[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of a window of documents, and the pieces left over (less than the longest tier in all)."""
    top = tiers[0]
    full: list[list[Piece]] = []
    ends: list[tuple[int, int, int]] = []  # (tokens, document, first), ascending
    for doc, n in enumerate(lengths):
        cut = n // top * top
        full += [[(doc, at, top)] for at in range(0, cut, top)]
        if n > cut:
            ends.append((n - cut, doc, cut))
    ends.sort()
    loose: list[Piece] = []
    for tier, shorter in zip(tiers, (*tiers[1:], 0), strict=True):
        while ends and ends[-1][0] > shorter:
            size, doc, first = ends.pop()
            sequence, gap = [(doc, first, size)], tier - size
            while gap and ends:
                at = bisect_right(ends, gap, key=lambda e: e[0]) - 1
                if at >= 0:  # the longest end that fits
                    size, doc, first = ends.pop(at)
                    sequence.append((doc, first, size))
                    gap -= size
                else:  # none fits: cut the shortest, its rest stays an end
                    size, doc, first = ends.pop(0)
                    sequence.append((doc, first, gap))
                    insort(ends, (size - gap, doc, first + gap))
                    gap = 0
            if gap:
                loose += sequence
            else:
                full.append(sequence)
    full += _cut(loose, top, rest := [])
    return full, rest


def _cut(pieces: list[Piece], size: int, rest: list[Piece]) -> list[list[Piece]]:
    """Concatenate pieces and cut at `size`; what does not fill a sequence goes to rest."""
    out, now, room = [], [], size
    for doc, first, n in pieces:
        while n:
            take = min(n, room)
            now.append((doc, first, take))
            first, n, room = first + take, n - take, room - take
            if not room:
                out.append(now)
                now, room = [], size
    rest += now
    return out


def close(pieces: list[Piece]) -> list[list[Piece]]:
    """Sequences of falling powers of two that hold the pieces exactly."""
    out = []
    while total := sum(n for _, _, n in pieces):
        rest: list[Piece] = []
        out += _cut(pieces, 1 << (total.bit_length() - 1), rest)
        pieces = rest
    return out


def step_groups(sizes: list[int], step: int = STEP) -> list[int]:
    """Group of each sequence: groups are filled one after another, longest sequences that fit first."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    queues: dict[int, list[int]] = {}
    for i in reversed(order):
        queues.setdefault(sizes[i], []).append(i)
    group, room, out = 0, step, [0] * len(sizes)
    while queues:
        size = next((s for s in sorted(queues, reverse=True) if s <= room), None)
        if size is None:
            group, room = group + 1, step
            continue
        out[queues[size].pop()] = group
        room -= size
        if not queues[size]:
            del queues[size]
    return out


def _pack(vocabulary: str, tiers: tuple[int, ...], step: int, with_ids: bool):
    """Arrow function: documents of a partition in, pieces out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        made = groups = 0
        kind = None
        left: list[tuple[object, int, int, memoryview]] = []  # document, its tokens, first, ids of what is left over
        waiting: list[tuple[int, list[tuple]]] = []  # sequences of the open group: tokens, rows without their group

        def emit(sequences, docs, last=False):
            nonlocal made, groups, waiting
            ready, waiting = waiting, []
            for number, sequence in enumerate(sequences):
                at, size, rows = 0, sum(n for _, _, n in sequence), []
                for doc, first, n in sequence:
                    doc_id, total, begin, data = docs[doc]
                    part = data[4 * first : 4 * (first + n)]
                    rows.append((doc_id, begin + first, n, zlib.crc32(part), total, base + made + number, at, size, part))
                    at += n
                ready.append((size, rows))
            dealt = step_groups([size for size, _ in ready], step)
            open_group = max(dealt, default=0) + last  # at the end of the partition no group stays open
            out = []
            for (size, rows), group in zip(ready, dealt, strict=True):
                if group < open_group:
                    out += [(*row[:-1], base + groups + group, row[-1]) for row in rows]
                else:  # copied, so that the window's ids can go
                    waiting.append((size, [(*row[:-1], bytes(row[-1]) if with_ids else b"") for row in rows]))
            made, groups = made + len(sequences), groups + open_group
            return out

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in slices(batch, "text", 2 << 20):
                for at in range(0, part.num_rows, WINDOW_DOCS):
                    window = part.slice(at, WINDOW_DOCS)
                    ids, off = tokens.with_end(*tokens.encode(vocabulary, window.column("text")), END)
                    data, off = memoryview(ids.astype("<u4").tobytes()), off.tolist()
                    names = window.column("doc_id").to_pylist()
                    docs = left + [(d, b - a, 0, data[4 * a : 4 * b]) for d, a, b in zip(names, off[:-1], off[1:], strict=True)]
                    sequences, rest = pack_window((len(d[3]) // 4 for d in docs), tiers)
                    left = [(docs[d][0], docs[d][1], docs[d][2] + f, memoryview(bytes(docs[d][3][4 * f : 4 * (f + n)]))) for d, f, n in rest]
                    yield from _batches(emit(sequences, docs), kind, with_ids)
        pieces = [(i, 0, len(d[3]) // 4) for i, d in enumerate(left)]
        yield from _batches(emit(close(pieces), left, last=True), kind, with_ids)

    return run


_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group", "ids"]


def _batches(rows: list[tuple], kind: pa.DataType, with_ids: bool, size: int = 8192) -> Iterator[pa.RecordBatch]:
    names = _COLUMNS if with_ids else _COLUMNS[:-1]
    types = {"ids": pa.binary(), "doc_id": kind}
    for at in range(0, len(rows), size):
        columns = list(zip(*rows[at : at + size], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.int64())) for n, c in zip(names, columns)], names=names)  # noqa: B905


def pack(
    docs: DataFrame, vocabulary: str = VOCABULARY, tiers: tuple[int, ...] = TIERS, step: int = STEP, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents: where each lies in its document and its sequence, with its ids (32-bit, little-endian)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, step_group long"
    rows = docs.select("doc_id", "text")
    return rows.transform(map_arrow, _pack(vocabulary, tiers, step, with_ids), schema + ", ids binary" * with_ids)


def packing_ledger(docs: DataFrame) -> DataFrame:
    """The pieces without their ids (digests are taken before they leave the worker)."""
    return pack(docs, with_ids=False)
