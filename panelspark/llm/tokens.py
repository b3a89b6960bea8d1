"""Tokenising whole texts with public vocabularies, through a table of known pieces in each worker.

Both vocabularies split a text before merging, and none of their splits crosses the place where white space begins
after a character that is no white space.  Texts are cut at such places; the tokens of a text are then the tokens of
its pieces in order, whatever characters the pieces hold.  A batch's pieces are hashed in one pass over the Arrow
bytes (`words`), looked up in an open-addressing table of numpy arrays, and only pieces that the worker has not seen go
to the library, in one call.  Pieces of more than `LONGEST` bytes (writing without blanks) are not kept: the library
encodes each where it occurs.  So results equal the library's for every text, and only the speed differs.  The table
has a fixed size and starts again when it is full.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from panelspark.llm.words import U64, buffers, hash_spans, spans

#: Pieces that a worker's table holds; it takes 40 bytes for each, and four for each of their ids.
PIECES = 1 << 21
#: Longest piece (bytes) that is kept in the table.
LONGEST = 200


def vocabulary(name: str) -> str:
    """Path of a public vocabulary on this machine (a file every executor has)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def library(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


# ---- pieces ---------------------------------------------------------------------------------------------------

#: First two bytes (UTF-8) of characters of three bytes that are, or may be taken for, white space -> ranges of the third.
_WIDE_SPACES = {
    (0xE1, 0x9A): [(0x80, 0x80)],
    (0xE1, 0xA0): [(0x8E, 0x8E)],
    (0xE2, 0x80): [(0x80, 0x8F), (0xA8, 0xAF)],
    (0xE2, 0x81): [(0x9F, 0xAF)],
    (0xE3, 0x80): [(0x80, 0x80)],
}
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_NO_LETTER = np.zeros(256, bool)  # bytes up to 127 that a split may take for white space
_NO_LETTER[:33] = _NO_LETTER[127] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _space_like(raw: np.ndarray) -> np.ndarray:
    """True at the bytes of every character that is white space in any reading."""
    out = _NO_LETTER[raw]
    lead = np.flatnonzero(_LEAD[raw])
    if not len(lead):
        return out
    two = lead[raw[lead] == 0xC2]
    two = two[raw[two + 1] <= 0xA0]
    out[two] = out[two + 1] = True
    three = lead[raw[lead] != 0xC2]
    if len(three):
        second, third = raw[three + 1], raw[three + 2]
        hit = np.zeros(len(three), bool)
        for (a, b), ranges in _WIDE_SPACES.items():
            same = (raw[three] == a) & (second == b)
            for low, high in ranges:
                hit |= same & (third >= low) & (third <= high)
        three = three[hit]
        out[three] = out[three + 1] = out[three + 2] = True
    return out


def _byte_bpe_pieces(raw: np.ndarray, off: np.ndarray):
    """Pieces begin with a text, and where a run of white space follows a character that is none."""
    begin = _BLANK[raw]
    begin[1:] &= ~_space_like(raw)[:-1]
    begin[off[:-1][off[:-1] < len(raw)]] = True
    start = np.flatnonzero(begin)
    return raw, start, np.append(start[1:], len(raw))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UNUSUAL = np.zeros(256, bool)
_UNUSUAL[:32] = _UNUSUAL[127] = _UNUSUAL[0xC4:] = True


def _word_bpe_pieces(raw: np.ndarray, off: np.ndarray):
    """Words: this vocabulary drops white space and never merges across it.

    Words of printable ASCII and Latin-1 are put in lower case, as the vocabulary does; others (and what might be a
    special token) stay as they are.
    """
    low = _LOWER[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    capital = second[(raw[second] <= 0x9E) & (raw[second] != 0x97)]
    low[capital] += 32
    start, end, _ = spans(raw, off)
    odd = _UNUSUAL[raw]
    two = np.flatnonzero(raw[:-1] == 0xC2)
    odd[two] |= raw[two + 1] <= 0xA0
    mark = np.flatnonzero(raw[:-1] == ord("<"))
    odd[mark] |= raw[mark + 1] == ord("|")
    places = np.flatnonzero(odd & ~_BLANK[raw])
    if len(places):
        words = np.unique(np.searchsorted(start, places, side="right") - 1)
        edge = np.zeros(len(raw) + 1, np.int8)
        edge[start[words]] += 1
        edge[end[words]] -= 1
        low = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, raw, low)
    return low, start, end


_KINDS = {"byte_bpe_50k.json": _byte_bpe_pieces, "word_bpe_49k.json": _word_bpe_pieces}


class Pieces:
    """Pieces of a batch of texts: their owners, places and keys, and which of them are too long for the table."""

    def __init__(self, name: str, texts: pa.Array):
        raw, off = buffers(texts)
        self.n = len(off) - 1
        if len(raw):
            raw, start, end = _KINDS[name](raw, off)
        else:
            raw = np.zeros(0, np.uint8)
            start = end = np.zeros(0, np.int64)
        self.raw, self.start, self.end = raw, start, end
        self.owner = np.searchsorted(off, start, side="right") - 1
        self.hash = hash_spans(raw, start, end) | U64(1)
        self.check = self._check()
        long = end - start > LONGEST
        self.long = np.flatnonzero(long)
        self.short = np.flatnonzero(~long) if len(self.long) else slice(None)

    def _check(self) -> np.ndarray:
        """The first eight bytes and the size: with the hash, the identity of a piece."""
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.raw) + 1,), "<u8", padded, strides=(1,))
        size = (self.end - self.start).astype(np.uint64)
        short = U64(64) - U64(8) * np.minimum(size, U64(8))
        return ((eight[self.start] << short) >> short) + size * U64(0x9E3779B97F4A7C15)

    def text(self, at: np.ndarray) -> list[str]:
        data = self.raw.tobytes()
        return [data[a:b].decode() for a, b in zip(self.start[at].tolist(), self.end[at].tolist(), strict=True)]


class PieceTable:
    """Open-addressing table: (hash, check) -> row; a row has a token count and, if kept, the tokens."""

    def __init__(self, pieces: int = PIECES):
        self.limit, self.slots = pieces, 1 << (2 * pieces - 1).bit_length()
        self.rows = 0
        self.hash, self.check = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64)
        self.row = np.zeros(self.slots, np.int32)
        self.count, self.first = np.zeros(1024, np.int32), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it is not there."""
        out = np.full(len(hashes), -1, np.int32)
        slot = (hashes >> U64(20)).astype(np.int64) & (self.slots - 1)
        left = np.arange(len(hashes))
        while len(left):
            held = self.hash[slot]
            same = (held == hashes[left]) & (self.check[slot] == checks[left])
            out[left[same]] = self.row[slot[same]]
            go = ~same & (held != 0)
            left, slot = left[go], (slot[go] + 1) & (self.slots - 1)
        return out

    def add(self, hashes: np.ndarray, checks: np.ndarray, counts: np.ndarray, ids: np.ndarray | None = None) -> None:
        """Rows for new distinct keys; there must be room."""
        n, rows = len(hashes), self.rows
        while rows + n > len(self.count):
            self.count, self.first = (np.concatenate([x, np.zeros_like(x)]) for x in (self.count, self.first))
        self.count[rows : rows + n] = counts
        if ids is not None:
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.first[rows : rows + n] = self.used + np.cumsum(counts) - counts
            self.used += len(ids)
        self.rows += n
        number = np.arange(rows, rows + n, dtype=np.int32)
        slot = (hashes >> U64(20)).astype(np.int64) & (self.slots - 1)
        left = np.arange(n)
        while len(left):
            free = np.flatnonzero(self.hash[slot] == 0)
            self.row[slot[free]] = number[left[free]]  # of several for one slot the last stays, and is the one found below
            won = np.zeros(len(left), bool)
            won[free] = self.row[slot[free]] == number[left[free]]
            self.hash[slot[won]], self.check[slot[won]] = hashes[left[won]], checks[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (self.slots - 1)


class Coder:
    """A worker's table for one vocabulary."""

    def __init__(self, name: str, keep_ids: bool = True, pieces: int = PIECES):
        self.name, self.keep_ids, self.limit = name, keep_ids, pieces
        self.tokenizer, self.table = library(name), PieceTable(pieces)

    def _library(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def rows(self, pieces: Pieces, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Table rows of pieces; those not known are encoded once and added."""
        hashes, checks = pieces.hash[at], pieces.check[at]
        found = self.table.find(hashes, checks)
        lost = np.flatnonzero(found < 0)
        if len(lost):
            _, one = np.unique(hashes[lost], return_index=True)
            new = lost[one]
            if self.table.rows + len(new) > self.table.limit:
                # start again; a single text with more distinct pieces than the limit makes a larger table
                self.table = PieceTable(max(self.limit, len(np.unique(hashes))))
                return self.rows(pieces, at)
            coded = self._library(pieces.text(np.arange(len(pieces.start))[at][new]))
            counts = np.fromiter(map(len, coded), np.int32, len(coded))
            ids = np.fromiter((i for e in coded for i in e.ids), np.uint32, int(counts.sum())) if self.keep_ids else None
            self.table.add(hashes[new], checks[new], counts, ids)
            found[lost] = self.table.find(hashes[lost], checks[lost])
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin: n + 1 places)."""
        pieces = Pieces(self.name, texts)
        rows = self.rows(pieces, pieces.short)
        found = self.table.count[rows].astype(np.int64)
        ends = np.cumsum(found)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.table.ids[np.repeat(self.table.first[rows] - (ends - found), found) + np.arange(total)]
        count = np.zeros(len(pieces.start), np.int64)
        count[pieces.short] = found
        if len(pieces.long):
            place = (np.cumsum(count) - count)[pieces.long]
            coded = [np.array(e.ids, np.uint32) for e in self._library(pieces.text(pieces.long))]
            count[pieces.long] = sizes = [len(c) for c in coded]
            ids = np.insert(ids, np.repeat(place, sizes), np.concatenate(coded))
        sizes = np.bincount(pieces.owner, weights=count, minlength=pieces.n).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def count(self, texts: pa.Array, frequent: PieceTable | None = None) -> np.ndarray:
        """Number of ids of each text; `frequent` is a fixed first tier."""
        pieces = Pieces(self.name, texts)
        count = np.zeros(len(pieces.start), np.int64)
        if frequent is None:
            rest = pieces.short
        else:
            row = frequent.find(pieces.hash, pieces.check)  # it holds no long piece
            count[:] = np.where(row < 0, 0, frequent.count[row])
            row[pieces.long] = 0
            rest = np.flatnonzero(row < 0)
        rows = self.rows(pieces, rest)  # may replace the table's arrays
        count[rest] = self.table.count[rows]
        if len(pieces.long):
            count[pieces.long] = [len(e) for e in self._library(pieces.text(pieces.long))]
        return np.bincount(pieces.owner, weights=count, minlength=pieces.n).astype(np.int64)


_CODERS: dict = {}


def coder(name: str, keep_ids: bool = True) -> Coder:
    """This worker's coder; it lives as long as the Python worker does."""
    key = (name, keep_ids)
    if key not in _CODERS:
        _CODERS[key] = Coder(name, keep_ids)
    return _CODERS[key]


def encode(name: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch of texts (null: none), without added special tokens, and where each text's ids begin."""
    return coder(name).encode(texts)


def with_end(ids: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an id appended to every text."""
    return np.insert(ids, off[1:], np.uint32(end)), off + np.arange(len(off))
