"""SentencePiece encoding and decoding over a relational lattice.

*Units.*  Blanks become ``▁`` and one is put in front, as the model does.  A text is cut before a ``▁`` that follows
another character, and between two characters that stand side by side in no piece: no piece and so no merge can
cross such a cut, and each unit is encoded by itself.

*Lattice.*  Distinct units are exploded into their substrings of at most the longest piece's length, which are
equi-joined to the piece table (broadcast; its size is the vocabulary's), and grouped by unit: one row per unit
with its edges ``(rank, start, end, id)``.

*Fold.*  A higher-order aggregate over the edges finds the path.
- `viterbi_path` (unigram models): best[i] = max over edges ending at i of best[start] + score.
- `merge_path` (BPE models, as the public vocabulary is): a maximum of summed scores is not what a BPE model
  means, so the fold keeps the boundaries of the current symbols and takes, while there is one, the edge of best
  rank (leftmost first) that spans two symbols.  That is the model's own result, id for id.  Boundaries are the
  bits of one long, so a step costs two bit operations an edge; edges are substrings of two characters or more, as
  a single character is where every symbol begins.
Characters without a piece become their UTF-8 byte pieces.

*Texts.*  Units are cut and hashed by numpy over whole batches.  The table of the most frequent units (at most
`FREQUENT`, counted over all texts by bounded summaries of `COUNTERS` units a task) with their ids is broadcast; it
decides speed only.  The other units of each text go through the same lattice and are joined back to their text.
A unit longer than `LONGEST` characters, the bits of a long, is encoded by the library in its task.

Defined edge cases: null and empty texts have no ids; the rare units of equal texts are listed once and joined to
every row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow, staged
from panelspark.llm.token_counts import Summary
from panelspark.llm.tokens import PieceTable
from panelspark.llm.words import U64, hash_spans, mix, slices

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
FREQUENT = 500_000
#: Units that a task's summary keeps.
COUNTERS = 262_144
LONGEST = 64


# ---- vocabulary -----------------------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _processor(model: str):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


def piece_rows(model: str = MODEL) -> list[tuple[str, int, float]]:
    """(piece, id, score) of every piece that can be in a lattice."""
    p = _processor(model)
    ids = range(p.get_piece_size())
    return [(p.id_to_piece(i), i, p.get_score(i)) for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


@lru_cache(maxsize=4)
def _neighbours(model: str) -> frozenset[str]:
    """Pairs of characters that stand side by side in some piece."""
    return frozenset(p[i : i + 2] for p, _, _ in piece_rows(model) for i in range(len(p) - 1))


def piece_table(spark: SparkSession, rows: list[tuple[str, int, float]]) -> DataFrame:
    """piece, id, score, rank (0 is the best score; equal scores share a rank)."""
    ranks = {s: i for i, s in enumerate(sorted({s for _, _, s in rows}, reverse=True))}
    return spark.createDataFrame([(p, i, float(s), ranks[s]) for p, i, s in rows], "piece string, id int, score double, rank int")


class Units:
    """Units of a batch of texts: code points of the joined texts, and each unit's owner, place and keys.

    Batches of Latin-1 texts are kept as bytes, with NUL for the blank; hashes are the same either way.
    """

    def __init__(self, texts: list[str | None], model: str):
        self.n = len(texts)
        whole = "".join(t for t in texts if t)
        self.blank = "\0" if _is_latin(whole) else BLANK
        parts = [self.blank + t.replace(" ", self.blank) if t else "" for t in texts]
        self.joined = "".join(parts)
        off = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        if self.blank == BLANK:
            code = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            values, plain = _code_values, code
            begin = self._begins(code, model)
        else:
            code = np.frombuffer(self.joined.encode("latin-1"), np.uint8)
            values, plain = _latin_values, None
            begin = np.ones(len(code), bool)
            begin[1:] = _latin_cuts(model)[code[:-1].astype(np.uint16) << 8 | code[1:]]
        begin[off[:-1][off[:-1] < len(code)]] = True
        self.start = np.flatnonzero(begin)
        self.end = np.append(self.start[1:], len(code))
        self.owner = np.repeat(np.arange(self.n), np.diff(np.searchsorted(self.start, off)))
        self.hash = hash_spans(code, self.start, self.end, values) | U64(1)
        ends = (code[self.start], code[self.end - 1])
        first, last = ends if plain is not None else (_LATIN_CODES[e] for e in ends)
        self.check = _check(first, last, self.end - self.start)
        self.long = self.end - self.start > LONGEST
        self.short = ~self.long

    def _begins(self, code: np.ndarray, model: str) -> np.ndarray:
        begin = np.ones(len(code), bool)
        if len(code) > 1:
            before, now = _symbol(code[:-1]), _symbol(code[1:])
            begin[1:] = ~_neighbour_table(model)[before, now] | (code[1:] == ord(BLANK)) & (code[:-1] != ord(BLANK))
            pairs = _neighbours(model)
            for i in np.flatnonzero((before == _OTHER) | (now == _OTHER)) + 1:  # beyond the table
                begin[i] = self.joined[i - 1 : i + 1] not in pairs or (code[i] == ord(BLANK) and code[i - 1] != ord(BLANK))
        return begin

    def text(self, at: np.ndarray) -> list[str]:
        return [self.joined[a:b].replace("\0", BLANK) if self.blank == "\0" else self.joined[a:b] for a, b in zip(self.start[at].tolist(), self.end[at].tolist(), strict=True)]


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "\0" not in text


_LATIN, _OTHER = 0x250, 0x251


def _symbol(code: np.ndarray) -> np.ndarray:
    """Code points below U+0250 as they are, the blank as U+0250, all others as one symbol."""
    return np.where(code == ord(BLANK), _LATIN, np.minimum(code, _OTHER) + (code == _LATIN)).astype(np.int64)


@lru_cache(maxsize=4)
def _neighbour_table(model: str) -> np.ndarray:
    out = np.zeros((_OTHER + 1, _OTHER + 1), bool)
    for pair in _neighbours(model):
        a, b = _symbol(np.array([ord(c) for c in pair], np.uint32))
        out[a, b] = True
    return out


def _code_values(code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) + U64(0x9E3779B97F4A7C15))


#: Code point of each byte of a Latin-1 batch.
_LATIN_CODES = np.arange(256, dtype=np.uint32)
_LATIN_CODES[0] = ord(BLANK)
_LATIN_VALUES = _code_values(_LATIN_CODES)


def _latin_values(code: np.ndarray) -> np.ndarray:
    return _LATIN_VALUES[code]


@lru_cache(maxsize=4)
def _latin_cuts(model: str) -> np.ndarray:
    """For two neighbouring bytes of a Latin-1 batch (first one high), whether a unit begins between them."""
    symbol = _symbol(_LATIN_CODES)
    cuts = ~_neighbour_table(model)[symbol[:, None], symbol[None, :]]
    cuts[1:, 0] = True
    return cuts.ravel()


def _check(first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
    """First and last character and size: with the hash, the identity of a unit."""
    return first.astype(np.uint64) | last.astype(np.uint64) << U64(21) | size.astype(np.uint64) << U64(42)


# ---- lattice (Spark) ------------------------------------------------------------------------------------------


def lattice(units: DataFrame, pieces: DataFrame, longest_piece: int) -> DataFrame:
    """unit, edges (rank, start, end, id, score) of every unit, best first; units are distinct."""
    n = F.length("unit")
    starts = units.select("unit", F.explode(F.sequence(F.lit(1), n)).alias("at"))
    spans = starts.select("unit", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest_piece), n - F.col("at") + 1))).alias("size"))
    edge = F.struct("rank", (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.col("size")).alias("end"), "id", "score")
    # single characters stay without a piece, so that every unit stays
    return _edges(spans, pieces, F.col("size") == 1, edge)


def merge_lattice(units: DataFrame, pieces: DataFrame, longest_piece: int) -> DataFrame:
    """unit, edges (start, inner, ends, id) of two characters or more of every unit, best first.

    Boundary b of a unit is bit b - 1 of a long; boundary 0 has no bit.  `inner` are the boundaries inside the edge,
    `ends` those at its ends.  Units are distinct and of at most 64 characters.  Edges are grouped and sorted as one
    long each: rank, start (6 bits), size (7 bits), id (24 bits).
    """
    n = F.length("unit")
    starts = units.select("unit", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1))).alias("at"))
    # the first character stays without an edge, so that every unit stays
    least = F.when(F.col("at") == 1, 1).otherwise(2)
    spans = starts.select("unit", "at", F.explode(F.sequence(least, F.least(F.lit(longest_piece), n - F.col("at") + 1))).alias("size"))
    edge = F.expr("shiftleft(cast(rank as long), 37) | shiftleft(cast(at - 1 as long), 31) | shiftleft(cast(size as long), 24) | id")
    packed = _edges(spans, pieces.where("length(piece) > 1"), (F.col("at") == 1) & (F.col("size") == 1), edge)
    fields = (
        "transform(edges, e -> struct(cast(shiftright(e, 31) & 63 as int) as start, cast(shiftright(e, 24) & 127 as int) as size, "
        "cast(e & 16777215 as int) as id))"
    )
    bits = (
        f"transform({fields}, e -> struct(e.start as start, shiftleft(shiftleft(1L, e.size - 1) - 1, e.start) as inner, "
        "shiftrightunsigned(shiftleft(1L, e.start), 1) | shiftleft(1L, e.start + e.size - 1) as ends, e.id as id))"
    )
    return packed.select("unit", F.expr(bits).alias("edges"))


def _edges(spans: DataFrame, pieces: DataFrame, stays: Column, edge: Column) -> DataFrame:
    """Spans (unit, at, size) joined to the pieces and grouped by unit, which keeps the units' partitioning.

    The key is a 64-bit hash, which Spark looks up several times faster than text; the texts are compared after it.
    """
    named = spans.select("unit", "at", "size", F.substring("unit", F.col("at"), F.col("size")).alias("text"))
    keyed = named.withColumn("key", F.xxhash64("text"))
    found = keyed.join(F.broadcast(pieces.withColumn("key", F.xxhash64("piece"))), "key", "left")
    same = F.coalesce(F.col("piece") == F.col("text"), F.lit(False))
    kept = found.where(same | stays).withColumn("edge", F.when(same, edge))
    return kept.groupBy("unit").agg(F.sort_array(F.collect_list("edge")).alias("edges"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda's argument is evaluated, an expression is copied."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_STATE = "struct<bounds:bigint,left:array<struct<inner:bigint,ends:bigint>>>"


def merge_path(unit: Column, edges: Column) -> Column:
    """Boundaries (bits) of the symbols that are left when the best merge is done again and again.

    edges: those of `merge_lattice`.  The state holds the boundaries and the edges that both begin and end at one;
    an edge spans two symbols when one boundary lies inside it.
    """
    no_edges = F.array().cast("array<struct<inner:bigint,ends:bigint>>")

    def step(state: Column, _: Column) -> Column:
        inside = lambda e: e.inner.bitwiseAND(state.bounds)
        best = F.get(F.filter(state.left, lambda e: F.bit_count(inside(e)) == 1), F.lit(0))

        def merge(middle: Column) -> Column:
            # edges that end where the symbols met are gone, and those that are one symbol now
            alive = F.filter(state.left, lambda e: (e.ends.bitwiseAND(middle) == 0) & (inside(e) != middle))
            return F.struct(state.bounds.bitwiseXOR(middle).alias("bounds"), alive.alias("left"))

        done = F.struct(state.bounds.alias("bounds"), no_edges.alias("left"))
        after = lambda middle: F.when(middle.isNull(), done).otherwise(merge(middle))
        return F.when(F.size(state.left) == 0, state).otherwise(_let(inside(best), after)).cast(_STATE)

    # every merge needs its edge, so there are no more merges than edges
    all_bounds = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(LONGEST) - F.length(unit))
    left = F.transform(edges, lambda e: F.struct(e.inner.alias("inner"), e.ends.alias("ends")))
    start = F.struct(all_bounds.alias("bounds"), left.alias("left")).cast(_STATE)
    most = F.least(F.length(unit) - 1, F.size(edges))
    folded = F.aggregate(F.sequence(F.lit(1), most), start, step, lambda state: state.bounds)
    return F.when(most < 1, all_bounds).otherwise(folded)


UNKNOWN_PENALTY = 10.0


def viterbi_path(unit: Column, edges: Column) -> Column:
    """Boundaries of the path of largest summed score; a character without an edge costs the worst score less 10."""
    worst = F.coalesce(F.array_min(F.transform(edges, lambda e: e.score)), F.lit(0.0)) - F.lit(UNKNOWN_PENALTY)
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("from")))

    def step(best: Column, end: Column) -> Column:
        arrive = lambda e: F.struct((F.get(best, e.start).score + e.score).alias("score"), e.start.alias("from"))
        ways = F.transform(F.filter(edges, lambda e: e.end == end), arrive)
        step_one = F.struct((F.get(best, end - 1).score + worst).alias("score"), (end - 1).alias("from"))
        has_one = F.exists(edges, lambda e: (e.end == end) & (e.start == end - 1))
        return F.concat(best, F.array(F.array_max(F.when(has_one, ways).otherwise(F.concat(ways, F.array(step_one))))))

    n = F.length(unit)
    best = F.aggregate(F.sequence(F.lit(1), n), start, step)
    back = F.aggregate(
        F.sequence(F.lit(1), n),
        F.array(n),
        lambda path, _: F.when(F.get(path, F.lit(0)) > 0, F.concat(F.array(F.get(best, F.get(path, F.lit(0)))["from"]), path)).otherwise(path),
    )
    return back


def _byte_ids(piece: Column, first_byte: int) -> Column:
    """Ids of the UTF-8 bytes of a piece."""
    digits = F.hex(F.encode(piece, "UTF-8"))
    number = lambda k: (F.conv(F.substring(digits, k * 2 - 1, F.lit(2)), 16, 10).cast("int") + F.lit(first_byte))
    return F.transform(F.sequence(F.lit(1), (F.length(digits) / 2).cast("int")), number)


def path_ids(unit: Column, edges: Column, bounds: Column, first_byte: int) -> Column:
    """Ids along the boundaries; a character without a piece gives the ids of its UTF-8 bytes."""

    def one(start: Column, end: Column) -> Column:
        found = F.filter(edges, lambda e: (e.start == start) & (e.end == end))
        coded = _byte_ids(F.substring(unit, start + 1, end - start), first_byte)
        return F.when(F.size(found) > 0, F.array(F.get(found, F.lit(0)).id)).otherwise(coded)

    size = F.size(bounds)
    return F.flatten(F.zip_with(F.slice(bounds, F.lit(1), size - 1), F.slice(bounds, F.lit(2), size - 1), one))


def merged_ids(unit: Column, edges: Column, bounds: Column, rows: list[tuple[str, int, float]], first_byte: int) -> Column:
    """Ids of the symbols between the boundaries (bits); characters are looked up in one constant string."""
    # in the order of their ids, so that common characters are found early
    single = sorted((i, p) for p, i, _ in rows if len(p) == 1)
    alphabet = F.lit("".join(p for _, p in single))
    numbers = F.split(F.lit(",".join(str(i) for i, _ in single)), ",").cast("array<int>")
    symbols = F.filter(edges, lambda e: (e.ends.bitwiseAND(bounds) == e.ends) & (e.inner.bitwiseAND(bounds) == 0))

    def character(c: Column) -> Column:
        coded = lambda at: F.when(at > 0, F.array(F.get(numbers, at - 1))).otherwise(_byte_ids(c, first_byte))
        return _let(F.call_function("instr", alphabet, c), coded)

    def ids(long_symbols: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.length(unit) - 1),
            lambda b: (b == 0) | (F.call_function("shiftrightunsigned", bounds, b - 1).bitwiseAND(F.lit(1)) == 1),
        )
        found = lambda b: F.get(F.filter(long_symbols, lambda e: e.start == b), F.lit(0)).id
        one = lambda b: _let(
            found(b), lambda i: F.when(i.isNull(), _let(F.substring(unit, b + 1, F.lit(1)), character)).otherwise(F.array(i))
        )
        return F.flatten(F.transform(begins, one))

    return _let(symbols, ids)


def encode_units(units: DataFrame, rows: list[tuple[str, int, float]], first_byte: int, kind: str = "bpe") -> DataFrame:
    """unit, ids of every (distinct, non-empty) unit; for "bpe" of at most `LONGEST` characters."""
    pieces, longest = piece_table(units.sparkSession, rows), max(len(p) for p, _, _ in rows)
    unit, edges, bounds = F.col("unit"), F.col("edges"), F.col("bounds")
    if kind == "bpe":
        placed = merge_lattice(units, pieces, longest).withColumn("bounds", merge_path(unit, edges))
        return placed.select("unit", merged_ids(unit, edges, bounds, rows, first_byte).alias("ids"))
    placed = lattice(units, pieces, longest).withColumn("bounds", viterbi_path(unit, edges))
    return placed.select("unit", path_ids(unit, edges, bounds, first_byte).alias("ids"))


# ---- texts ----------------------------------------------------------------------------------------------------


def _long_ids(unit: str, model: str) -> np.ndarray:
    """Ids of one unit by the library."""
    p = _processor(model)
    if unit.startswith(BLANK):
        return np.array(p.encode(unit[1:]), np.uint32)
    # The library puts a blank in front; a line feed, which merges with nothing, keeps it off the unit.
    ids = p.encode("\n" + unit)
    return np.array(ids[ids.index(p.piece_to_id("<0x0A>")) + 1 :], np.uint32)


class FrequentUnits:
    """At most `FREQUENT` units with their ids, as compact arrays; each worker makes its table once."""

    def __init__(self, coded: pa.Table):
        names, ids = coded["unit"].to_pylist(), coded["ids"].combine_chunks()
        # each name is a unit, hashed as one span
        code = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        end = np.cumsum([len(x) for x in names]).astype(np.int64)
        start = end - np.array([len(x) for x in names], np.int64)
        self.name = uuid.uuid4().hex
        self.hash = hash_spans(code, start, end, _code_values) | U64(1) if names else np.zeros(0, np.uint64)
        self.check = _check(code[start], code[end - 1], end - start) if names else np.zeros(0, np.uint64)
        self.sizes = np.diff(ids.offsets.to_numpy()).astype(np.uint16) if names else np.zeros(0, np.uint16)
        self.ids = (ids.flatten().to_numpy(zero_copy_only=False) if names else np.zeros(0)).astype(np.uint16)

    def table(self) -> PieceTable:
        if self.name not in _TABLES:
            _TABLES.clear()
            _TABLES[self.name] = table = PieceTable(max(1024, len(self.hash)))
            table.add(self.hash, self.check, self.sizes.astype(np.int32), self.ids.astype(np.uint32))
        return _TABLES[self.name]


_TABLES: dict[str, PieceTable] = {}


def encode_batch(texts: list[str | None], model: str, frequent: PieceTable, rare_hash: np.ndarray, rare_ids: list[np.ndarray]) -> list[bytes]:
    """Ids of each text; units that are not frequent are found among the rare ones by their hash."""
    units = Units(texts, model)
    row = frequent.find(units.hash, units.check)
    count, first = frequent.count[row].astype(np.int64), frequent.first[row]
    pool, base = [frequent.ids[: frequent.used]], frequent.used

    def more(at: np.ndarray, ids: list[np.ndarray], which: np.ndarray):
        nonlocal base
        sizes = np.array([len(x) for x in ids], np.int64)
        begin = base + np.cumsum(sizes) - sizes
        count[at], first[at] = sizes[which], begin[which]
        pool.extend(ids)
        base += int(sizes.sum())

    lost = np.flatnonzero((row < 0) & ~units.long)
    if len(lost):
        order = np.argsort(rare_hash, kind="stable")
        known = np.array([xxhash.xxh64_intdigest(u, 42) for u in units.text(lost)], np.uint64)
        place = np.searchsorted(rare_hash[order], known)
        which = order[np.minimum(place, len(order) - 1)]
        if not (rare_hash[which] == known).all():
            raise RuntimeError("a unit is neither frequent nor encoded")
        more(lost, rare_ids, which)
    long = np.flatnonzero(units.long)
    if len(long):
        more(long, [_long_ids(u, model) for u in units.text(long)], np.arange(len(long)))
    end = np.cumsum(count)
    ids = np.concatenate(pool)[np.repeat(first - (end - count), count) + np.arange(int(end[-1]) if len(end) else 0)]
    data = ids.astype("<u4").tobytes()
    off = 4 * np.concatenate([[0], np.cumsum(np.bincount(units.owner, weights=count, minlength=units.n).astype(np.int64))])
    return [data[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def frequent_units(docs: DataFrame, model: str = MODEL, n: int = FREQUENT, counters: int = COUNTERS) -> DataFrame:
    """At most n units, the most frequent of all texts by the summed counts of the tasks' summaries."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(counters)
        for part in (part for batch in batches for part in slices(batch, "text")):
            summary.add(Units(part.column("text").to_pylist(), model))
        for at in range(0, len(summary.text), 10_000):
            some = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(summary.text[some].tolist(), pa.string()), pa.array(summary.count[some])], names=["unit", "n"]
            )

    found = docs.where("text <> ''").select("text").transform(map_arrow, summarise, "unit string, n long")
    counted = found.groupBy("unit").agg(F.sum("n").alias("n"))
    return counted.where("n > 1").orderBy(F.desc("n"), "unit").limit(n).select("unit")


_SMALL = "array<smallint>"  # ids below 32768


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids (32-bit little-endian unsigned integers as binary) of every document.

    Texts cross one exchange, compressed, to meet the ids of their rare units; the key is a hash of the text, and a
    collision would only join two texts' lists of units.
    """
    spark = docs.sparkSession
    rows, first_byte = piece_rows(model), _processor(model).piece_to_id("<0x00>")
    if max(i for _, i, _ in rows) >= 1 << 15:
        raise ValueError("a vocabulary of more than 32768 pieces")
    # Units of a task that are grouped by hashing before grouping turns to sorting: some 100 MB.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "50000")
    units = frequent_units(docs, model).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit")
    frequent = spark.sparkContext.broadcast(FrequentUnits(staged(encode_units(units, rows, first_byte)).toArrow()))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where("text <> ''").select("doc_id", "text", F.xxhash64("text").alias("key"))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, "text")):
            units = Units(part.column("text").to_pylist(), model)
            lost = np.flatnonzero((frequent.value.table().find(units.hash, units.check) < 0) & ~units.long)
            _, one = np.unique(mix(units.hash[lost] + mix(units.owner[lost].astype(np.uint64))), return_index=True)
            lost = lost[one]
            keys = part.column("key").to_numpy()[units.owner[lost]]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(units.text(lost), pa.string())], names=["key", "unit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=6)
        for batch in batches:
            data = [t.encode() for t in batch.column("text").to_pylist()]
            packed = pa.array([codec.compress(x, asbytes=True) for x in data], pa.binary())
            sizes = pa.array([len(x) for x in data], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), packed, sizes], names=["doc_id", "key", "packed", "size"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, "packed", 1 << 20)):
            sizes = part.column("size").to_pylist()
            data = [pa.decompress(x, n, codec="zstd", asbytes=True).decode() for x, n in zip(part.column("packed").to_pylist(), sizes, strict=True)]
            rare = part.column("rare").flatten()
            hashes = rare.field("hash").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids = rare.field("ids")
            values, off = ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), ids.offsets.to_numpy()
            ids = np.split(values, (off - off[0])[1:-1]) if len(hashes) else []
            out = encode_batch(data, model, frequent.value.table(), hashes, ids)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    # copies of a text list its units once, so a list is bounded by one text
    rare = staged(texts.select("key", "text").transform(map_arrow, missing, "key long, unit string").distinct())
    # more and smaller groups of units than the default, so that a task's lattices stay small
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One exchange serves both sides of the join: the same rows and columns, so Spark reuses it (if not, only work is lost).
    placed = rare.where("key is not null and unit is not null").repartition(parts, "unit")
    distinct = placed.groupBy("unit").agg(F.max("key").alias("some")).where("some is not null").select("unit")
    coded = encode_units(distinct, rows, first_byte)
    # Worker and Spark know a rare unit by the same 64-bit hash; ids of this size of vocabulary fit 16 bits.
    found = placed.join(coded, "unit").select("key", F.struct(F.xxhash64("unit").alias("hash"), F.col("ids").cast(_SMALL).alias("ids")).alias("u"))
    own = found.groupBy("key").agg(F.collect_list("u").alias("rare"))
    packed = texts.transform(map_arrow, pack, f"doc_id {kind}, key long, packed binary, size int")
    nothing = F.array().cast(f"array<struct<hash:bigint,ids:{_SMALL}>>")
    full = packed.join(own.hint("merge"), "key", "left").withColumn("rare", F.coalesce("rare", nothing))
    done = full.select("doc_id", "packed", "size", "rare").transform(map_arrow, assemble, f"doc_id {kind}, ids binary")
    return done.unionByName(docs.where("text is null or text = ''").select("doc_id", F.lit(b"").alias("ids")))


def encoded_digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 of every document."""
    return encode(docs, model).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def decode(ids: DataFrame, key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """key, text of rows (key, ids array<int>): explode, equi-join to the pieces' bytes, put together in order.

    Keys are distinct.  Byte pieces give their byte; invalid UTF-8 becomes U+FFFD; null ids give a null text.
    """
    p = _processor(model)
    table = []
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        data = bytes([int(piece[3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else piece.replace(BLANK, " ").encode()
        table.append((i, data))
    pieces = ids.sparkSession.createDataFrame(table, "id int, data binary")
    each = ids.select(key, F.posexplode("ids").alias("at", "id")).join(F.broadcast(pieces), "id")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", F.hex("data").alias("data")))), lambda x: x.data)
    text = F.decode(F.unhex(F.array_join(parts, "")), "UTF-8")
    joined = each.groupBy(key).agg(F.regexp_replace(text, "^ ", "").alias("text"))
    return ids.select(key, F.col("ids").isNull().alias("none")).join(joined, key, "left").select(
        key, F.when(~F.col("none"), F.coalesce("text", F.lit(""))).alias("text")
    )
