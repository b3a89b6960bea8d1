"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (`DIM` components, seeded by the letter).  An n-gram of three
letters binds the vectors of its letters, each permuted by its place (a rotation), by multiplication; a text
bundles the vectors of all its n-grams by addition; a language's prototype bundles the texts of that language,
each scaled to the same length.  A text gets the language of the prototype with the largest cosine.

Letters are Unicode letters in lower case; a run of anything else is one blank, and a blank stands at both ends
of the text.  Counting n-grams is vectorised over a batch: distinct n-grams are numbered, their vectors are
made once, and the texts' bundles are one matrix product.

Learning covers every row with a text, a language and a fold other than the held-out one: each batch adds its
texts' scaled vectors as integers, so sums don't depend on order, and Spark adds them by (language, component).

`keep_identified` rejects a text only on evidence: how far below the cosines that texts of its language have at its
size its own cosine lies.  Size is the effective number of n-grams, (sum of counts)^2 / (sum of squared counts): a word
said a hundred times is no more evidence than the word.  Those cosines are learned (`learn_floors`): every learning text
gives one excerpt of 4, 8, ... 2,048 n-grams as far as it reaches, and each language and size gets as its floor
the mean less `DEVIATIONS` standard deviations, at most `SHARE` of the mean.  The spread of small excerpts is wide, so their floor is nought: a text of a
word or two is kept unless it has no letter.

Defined edge cases: a text that is null or has no letter is ``und`` with score 0; ties go to the first language
in order; with no labelled row every text is ``und``; repeated rows and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import held_out, map_arrow
from panelspark.llm.words import slices

DIM = 1024
NGRAM = 3
#: Letters beyond U+024F share this many vectors, by code point.
OTHERS = 64
#: Sizes are 2**k n-grams; a text belongs to the largest size its effective number reaches.
SIZES = tuple(range(2, 12))
#: A text this many standard deviations below its language's mean cosine is in none of the learned languages.
DEVIATIONS = 4.0
#: ... and with less than this share of that mean.
SHARE = 0.5
#: A language with fewer excerpts of a size rejects nothing of that size.
LEAST = 30
UND = "und"
#: Scale of a text's unit vector in the integer sums of learning.
SCALE = 1 << 20

_LATIN = 0x250
_SYMBOLS = _LATIN + OTHERS  # 0 is the blank


def _letter_table() -> np.ndarray:
    """Symbol of every code point below U+0250; 0 for what is no letter."""
    table = np.zeros(_LATIN, np.int64)
    for c in range(_LATIN):
        low = chr(c).lower()
        if chr(c).isalpha():
            table[c] = ord(low[0]) if ord(low[0]) < _LATIN else c
    return table


_TABLE = _letter_table()


def _letter_vectors(dim: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(7))
    return (rng.integers(0, 2, (_SYMBOLS, dim), dtype=np.int8) * 2 - 1).astype(np.int8)


def symbols(text: str) -> np.ndarray:
    """Blank, the text's letters with one blank for every other run, blank; empty if there is no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = _TABLE[np.minimum(points, _LATIN - 1)]
    if len(points) and points.max() >= _LATIN:
        out = out.copy()
        for at in np.flatnonzero(points >= _LATIN):
            c = chr(points[at])
            out[at] = _LATIN + ord(c.lower()[0]) % OTHERS if c.isalpha() else 0
    if not out.any():
        return out[:0]
    keep = out != 0
    keep[1:] |= out[:-1] != 0  # the first blank of a run
    out = out[keep]
    return np.concatenate([[0], out, [0] if out[-1] else []]).astype(np.int64)


def ngram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bound vector of each n-gram code (digits to the base of the letters' number, first letter highest)."""
    out = letters[grams % len(letters)]
    for place in range(1, NGRAM):
        grams = grams // len(letters)
        out = out * np.roll(letters, place, axis=1)[grams % len(letters)]
    return out


def profiles(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """Bundle of each text's n-grams (float32, exact integers); a zero row where there is no letter."""
    return bundles(_all_symbols(texts), dim)[0]


def _all_symbols(texts: list[str | None]) -> list[np.ndarray]:
    parts = [symbols(t) if t else np.zeros(0, np.int64) for t in texts]
    return [s if len(s) >= NGRAM else s[:0] for s in parts]


def bundles(parts: list[np.ndarray], dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """`profiles` of texts given as symbols, and the effective number of n-grams of each (0: none)."""
    n = len(parts)
    sizes = np.array([max(0, len(s) - NGRAM + 1) for s in parts], np.int64)
    out, squares = np.zeros((n, dim), np.float32), np.zeros(n)
    if not sizes.any():
        return out, squares
    # Symbols of the batch numbered densely, so that an n-gram is a small number and counting needs no sort.
    used = np.flatnonzero(np.bincount(np.concatenate(parts), minlength=_SYMBOLS))
    dense = np.zeros(_SYMBOLS, np.int64)
    dense[used] = np.arange(len(used))
    k = len(used)
    parts = [dense[s] for s in parts if len(s)]
    code = np.concatenate([(s[:-2] * k + s[1:-1]) * k + s[2:] for s in parts])
    if k**NGRAM <= 1 << 24:
        grams = np.flatnonzero(np.bincount(code, minlength=k**NGRAM))
        place = np.zeros(k**NGRAM, np.int64)
        place[grams] = np.arange(len(grams))
        number = place[code]
    else:
        grams, number = np.unique(code, return_inverse=True)
    row = np.repeat(np.arange(n), sizes)
    letters = _letter_vectors(dim)[used]
    step = 1 << 13  # n-grams a matrix product takes at a time
    for at in range(0, len(grams), step):
        part = grams[at : at + step]
        inside = slice(None) if len(grams) <= step else (number >= at) & (number < at + step)
        counts = np.bincount(row[inside] * len(part) + (number[inside] - at), minlength=n * len(part))
        counts = counts.reshape(n, len(part)).astype(np.float32)
        out += counts @ ngram_vectors(part, letters).astype(np.float32)
        squares += np.einsum("ij,ij->i", counts, counts, dtype=np.float64)
    return out, np.divide(sizes.astype(np.float64) ** 2, squares, out=np.zeros(n), where=squares > 0)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x, dtype=np.float64), where=size > 0)


@dataclass(frozen=True)
class Prototypes:
    """Learned languages in order, and their unit vectors (languages x DIM: small, broadcast with the task)."""

    languages: tuple[str, ...]
    vectors: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        best, score, _ = self.nearest(texts)
        return [UND if b < 0 else self.languages[b] for b in best], score

    def nearest(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest language (-1: no letter, or no language), its cosine, effective number of n-grams."""
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
        bundle, ngrams = bundles(_all_symbols(texts), self.vectors.shape[1])
        unit = _unit(bundle)
        none = ~unit.any(axis=1)
        cosine = unit @ self.vectors.T
        best = cosine.argmax(axis=1)
        score = np.where(none, 0.0, np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0))
        return np.where(none, -1, best), score, ngrams


def _size(ngrams: np.ndarray) -> np.ndarray:
    """Index in SIZES of texts with that effective number of n-grams; -1 below the smallest."""
    return np.searchsorted(1 << np.array(SIZES), ngrams, side="right") - 1


ROWS = 512


def _row_slices(batch: pa.RecordBatch, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text", max_bytes):
        for at in range(0, part.num_rows, ROWS):
            yield part.slice(at, ROWS)


def learn(docs: DataFrame, dim: int = DIM) -> Prototypes:
    """Prototypes of all languages that rows outside the held-out fold name.

    What reaches the driver is languages x dim numbers; texts are read once and never shuffled.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in _row_slices(batch):
                scaled = np.rint(_unit(profiles(part.column("text").to_pylist(), dim)) * SCALE).astype(np.int64)
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                for lang in set(langs):
                    sums[lang] = sums.get(lang, 0) + scaled[langs == lang].sum(axis=0)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dim, "component": np.arange(dim, dtype=np.int32), "total": total},
                pa.schema([("lang", pa.string()), ("component", pa.int32()), ("total", pa.int64())]),
            )

    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    totals = rows.transform(map_arrow, bundle, "lang string, component int, total long").groupBy("lang", "component")
    # Decimal sums cannot overflow, however many texts there are.
    table = totals.agg(F.sum(F.col("total").cast("decimal(28,0)")).cast("double").alias("total")).toPandas()
    if table.empty:
        return Prototypes((), np.zeros((0, dim)))
    wide = table.pivot(index="lang", columns="component", values="total").fillna(0.0).sort_index()
    wide = wide[(wide != 0).any(axis=1)]
    return Prototypes(tuple(wide.index), _unit(wide.to_numpy()))


def identify(docs: DataFrame, model: Prototypes) -> DataFrame:
    """doc_id, lang_pred, score of every document; map-only."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_slices(batch):
                names, score = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").transform(map_arrow, predict, f"doc_id {kind}, lang_pred string, score double")


_SUMS = pa.schema(
    [("lang", pa.int32()), ("size", pa.int32()), ("n", pa.int64()), ("total", pa.string()), ("squares", pa.string())]
)


def learn_floors(docs: DataFrame, model: Prototypes, deviations: float = DEVIATIONS) -> np.ndarray:
    """Least cosine (languages x SIZES) a text needs to be taken for a language; 0 where there is too little to learn from.

    Every learning row whose language is learned gives one excerpt of each size that fits in it.  Tasks add whole numbers
    by (language, size), so floors do not depend on the order of rows; languages x sizes rows reach the driver.
    """
    numbers = {lang: i for i, lang in enumerate(model.languages)}
    floors = np.zeros((len(numbers), len(SIZES)))
    if not numbers:
        return floors

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(numbers), len(SIZES), 3), object)
        for part in (part for batch in batches for part in _row_slices(batch)):
            own = np.array([numbers.get(lang, -1) for lang in part.column("lang").to_pylist()], np.int64)
            texts = part.column("text").to_pylist()
            parts = _all_symbols(texts)
            place = [crc32(t.encode("utf-8", "replace")) for t in texts]
            for size in SIZES:
                n = (1 << size) + NGRAM - 1
                rows = [i for i, s in enumerate(parts) if len(s) >= n and own[i] >= 0]
                if not rows:
                    break
                starts = [place[i] % (len(parts[i]) - n + 1) for i in rows]
                cut = [parts[i][a : a + n] for i, a in zip(rows, starts, strict=True)]
                bundle, ngrams = bundles(cut, model.vectors.shape[1])
                cosine = (_unit(bundle) * model.vectors[own[rows]]).sum(axis=1)
                for lang, at, c in zip(own[rows].tolist(), _size(ngrams).tolist(), np.rint(cosine * SCALE).tolist(), strict=True):
                    if at >= 0:
                        sums[lang, at] += [1, int(c), int(c) ** 2]
        for lang, k in zip(*np.nonzero(sums[:, :, 0]), strict=True):
            row = {"lang": [lang], "size": [k], "n": [sums[lang, k, 0]]}
            row |= {"total": [str(sums[lang, k, 1])], "squares": [str(sums[lang, k, 2])]}
            yield pa.RecordBatch.from_pydict(row, _SUMS)

    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    found = rows.transform(map_arrow, measure, "lang int, size int, n long, total string, squares string")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c)
    for r in found.groupBy("lang", "size").agg(F.sum("n").alias("n"), whole("total"), whole("squares")).collect():
        if r.n >= LEAST:
            mean = int(r.total) / r.n
            spread = max(0.0, (int(r.squares) - int(r.total) ** 2 / r.n) / (r.n - 1)) ** 0.5
            floors[r.lang, r.size] = max(0.0, min(mean - deviations * spread, SHARE * mean) / SCALE)
    return floors


def keep_identified(docs: DataFrame, model: Prototypes, floors: np.ndarray) -> DataFrame:
    """The documents, all columns, whose text has a letter and reaches the floor of its language and size."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_slices(batch):
                best, score, ngrams = model.nearest(part.column("text").to_pylist())
                size = _size(ngrams)
                least = floors[best, size] if len(floors) else np.zeros(len(best))
                good = (best >= 0) & ((size < 0) | (score >= least))
                yield part.filter(pa.array(good, pa.bool_()))

    return docs.transform(map_arrow, decide, docs.schema)
