"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

*Folding* makes one spelling of many: lower case, compatibility forms (full width and the like) as plain letters,
zero-width characters and loose accents removed, Greek and Cyrillic look-alikes and digits put for letters read as
the letters (``l0ser``, ``1d10t``), ``i`` and ``l`` as one, and ``@ $ ! |`` read as letters between letters.  Letters
with accents stay: they tell words apart in most languages.  What is not a letter then separates words.

*Lexicon*: folded words and beginnings of words (4 to 7 letters) with a weight, the log odds of being in a toxic
text.  Weights are learned from document counts over all labelled rows outside the held-out fold; a term enters
when a likelihood-ratio test says that its lean is no chance, even among millions of candidates (`EVIDENCE`), and
its log odds are at least `MIN_LOG_ODDS`.  At most `LEXICON` terms, those of most evidence: that bounds the
automaton that goes to the workers.

*Exception phrases*: a lexicon word together with the word before or after it, when that pair stands in more clean
than toxic texts beyond chance; a match inside an exception does not count.  They are learned with the same
counts and may be extended by hand.

*Score*: the largest matched weight, the matched weight, and the matched weight per word (the normalisation by
length) go through a logistic curve fitted to all learning rows.  Rows reach the fit as a histogram of fixed size, not one by one.

Defined edge cases: null and empty texts match nothing and get the score of a text without a match; without
labelled rows of both kinds every score is 0; ties in the lexicon go by the term; labels that repeat a doc_id
count once (the largest); documents that repeat a row are scored each; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import held_out, map_arrow, staged
from panelspark.llm.words import slices

LEXICON = 5_000
EXCEPTIONS = 2_000
#: Least likelihood-ratio statistic of a term.
EVIDENCE = 30.0
#: Standard errors by which a pair must stand in more clean than toxic texts to be an exception.
EXCEPTION_BOUND = 1.645
MIN_LOG_ODDS = 1.0
PREFIXES = (4, 5, 6, 7)
TOXIC_AT = 0.7
#: Bins of each feature in the histogram of the fit, and their widths.
BINS, WIDTH = 100, (0.2, 0.1, 0.1)
#: Ridge of the fit: keeps the curve finite when the features part the labels.
RIDGE = 1.0

# Letters that other characters are read as, fixed values.
_LOOKS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "l": "i",
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i",
}
_BETWEEN = {"@": "a", "$": "s", "!": "i", "|": "i"}
_BETWEEN_RE = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])")
_RUN = re.compile(r"[\W\d_]+")
_HIDDEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


class _Fold(dict):
    """Code point -> folded letters, made on first use."""

    def __missing__(self, point: int) -> str:
        c = unicodedata.normalize("NFKC", chr(point)).lower()
        c = "".join(x for x in c if not unicodedata.combining(x))
        self[point] = c = "".join(_LOOKS.get(x, x) for x in c)
        return c


_FOLD = _Fold(_HIDDEN)


def fold(text: str) -> str:
    """Folded words, one blank before, between and after them."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _BETWEEN_RE.sub(lambda m: _BETWEEN[m[0]], text)
    return _RUN.sub(" ", f" {text.translate(_FOLD)} ")


def _terms(folded: str) -> set[str]:
    """Lexicon candidates of a text: " word " and " beginning"."""
    words = set(folded.split())
    out = {f" {w} " for w in words if len(w) >= 3}
    for n in PREFIXES:
        out.update(" " + w[:n] for w in words if len(w) > n)
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]  # term (see _terms) -> weight
    exceptions: set[str] = field(default_factory=set)  # "word word", folded
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)  # constant, largest weight, weight, weight per word
    trained: bool = True

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            out.add_word(term, (len(term), weight))
        if len(out):
            out.make_automaton()
        return out

    def matches(self, automaton, folded: str) -> dict[int, float]:
        """Place of the blank before each matched word -> the largest weight of a term there."""
        found: dict[int, float] = {}
        if len(automaton):
            for end, (size, weight) in automaton.iter(folded):
                at = end - size + 1
                found[at] = max(weight, found.get(at, 0.0))
        return found

    def measure(self, automaton, folded: str) -> tuple[float, float, float]:
        """The three features of a text."""
        found = self.matches(automaton, folded)
        if self.exceptions and found:
            found = {at: w for at, w in found.items() if not self.exceptions.intersection(pairs(folded, at))}
        total = sum(found.values())
        per_word = 1000.0 * total / max(1, folded.count(" ") - 1)
        return max(found.values(), default=0.0), float(np.log1p(total)), float(np.log1p(per_word))

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(features))
        return 1.0 / (1.0 + np.exp(-np.clip(self.curve[0] + features @ np.array(self.curve[1:]), -500, 500)))


def pairs(folded: str, at: int) -> list[str]:
    """The matched word at `at` with the word after it, and with the word before it."""
    end = folded.find(" ", at + 1)
    after = folded.find(" ", end + 1)
    out = [folded[at + 1 : after]] if after > 0 else []
    before = folded.rfind(" ", 0, at) if at > 0 else -1
    return [*out, folded[before + 1 : end]] if before >= 0 and at > 0 else out


def _log_odds(n_toxic: int, n_clean: int):
    """Weight of a term, from the documents of either label that hold it."""
    return F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0))


def _evidence(n_toxic: int, n_clean: int):
    """Likelihood-ratio statistic of a term's counts against the same rate in both labels."""
    both = F.col("toxic") + F.col("clean")
    part = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * F.lit(float(n_toxic + n_clean)) / (both * F.lit(float(n))))).otherwise(0.0)
    return 2 * (part("toxic", n_toxic) + part("clean", n_clean))


def _counted(rows: DataFrame, terms) -> DataFrame:
    """Documents of either label that hold each term: counted within a task first, then summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen = (Counter(), Counter())
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    seen[toxic].update(terms(fold(text)))
                names = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_pydict(
                    {"term": names, "clean": [seen[0][x] for x in names], "toxic": [seen[1][x] for x in names]},
                    pa.schema([("term", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]),
                )

    rows = rows.transform(map_arrow, count, "term string, clean long, toxic long")
    return rows.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _fit(counts: np.ndarray, features: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Weighted ridge logistic regression on scaled features, by Newton steps that are halved until they improve."""
    mean = np.average(features, axis=0, weights=counts)
    scale = np.sqrt(np.average((features - mean) ** 2, axis=0, weights=counts)) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    ridge = np.array([1e-6, *[RIDGE] * features.shape[1]])

    def value(w):
        z = x @ w
        return (counts * (labels * z - np.logaddexp(0, z))).sum() - (ridge * w * w).sum() / 2

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (counts * (labels - p)) - ridge * w
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        size = 1.0
        while size > 1e-9 and value(w + size * step) < value(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = w[1:] / scale
    return (float(w[0] - (slope * mean).sum()), *map(float, slope))


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Lexicon, exceptions and curve from all labelled rows outside the held-out fold."""
    own = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels may cover much of a corpus and have no bound, so they are not broadcast at any size.
    own = own.where("toxic in (0, 1)").hint("merge")
    rows = docs.where(~held_out() & F.col("text").isNotNull()).select("doc_id", "text").join(own, "doc_id")
    rows = staged(rows.select("text", F.col("toxic").cast("int").alias("toxic")))  # read four times below
    size = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = size.get(0, 0), size.get(1, 0)
    if not n_clean or not n_toxic:
        return Lexicon({}, trained=False)

    terms = _counted(rows, _terms).withColumns({"weight": _log_odds(n_toxic, n_clean), "evidence": _evidence(n_toxic, n_clean)})
    terms = terms.where((F.col("weight") >= MIN_LOG_ODDS) & (F.col("evidence") >= EVIDENCE))
    best = terms.orderBy(F.desc("evidence"), "term").limit(LEXICON)
    lexicon = Lexicon({r.term: round(r.weight, 6) for r in best.select("term", "weight").collect()})

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)

    def phrases(folded: str, state={}) -> set[str]:  # noqa: B006  one automaton a task
        if not state:
            state["a"] = shared.value.automaton()
        return {p for at in shared.value.matches(state["a"], folded) for p in pairs(folded, at)}

    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    low = F.log(c / t) - F.lit(EXCEPTION_BOUND) * F.sqrt(1 / t + 1 / c)
    phrase = _counted(rows, phrases).withColumn("low", low).where("low > 0")
    lexicon.exceptions = {r.term for r in phrase.orderBy(F.desc("low"), "term").limit(EXCEPTIONS).collect()}

    shared = spark.sparkContext.broadcast(lexicon)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for part in (part for batch in batches for part in slices(batch, "text")):
            found = [shared.value.measure(automaton, fold(t)) for t in part.column("text").to_pylist()]
            at = np.minimum(np.array(found, float).reshape(-1, 3) / np.array(WIDTH), BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[pa.array(at[:, k]) for k in range(3)], part.column("toxic")], names=["x", "y", "z", "toxic"])

    found = rows.transform(map_arrow, bins, "x int, y int, z int, toxic int").groupBy("x", "y", "z", "toxic")
    table = found.agg(F.count("*").alias("n")).orderBy("x", "y", "z", "toxic").toPandas()
    at = table[["x", "y", "z"]].to_numpy(float)
    centre = (at + 0.5) * np.array(WIDTH) * (at > 0)
    lexicon.curve = _fit(table["n"].to_numpy(float), centre, table["toxic"].to_numpy(float))
    return lexicon


def _scores(shared):
    def run(batch: pa.RecordBatch, state={}) -> np.ndarray:  # noqa: B006  one automaton a task
        if not state:
            state["a"] = shared.value.automaton()
        found = [shared.value.measure(state["a"], fold(t or "")) for t in batch.column("text").to_pylist()]
        return shared.value.score(np.array(found, float).reshape(-1, 3))

    return run


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, predicted of every document; map-only."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    score = _scores(docs.sparkSession.sparkContext.broadcast(lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, "text")):
            found = score(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.float64()), pa.array((found >= TOXIC_AT).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").transform(map_arrow, run, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    score = _scores(docs.sparkSession.sparkContext.broadcast(lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, "text")):
            yield part.filter(pa.array(score(part) < TOXIC_AT, pa.bool_()))

    return docs.transform(map_arrow, run, docs.schema)
