"""Quality rules as a bitmask ledger.

`ledger` reads every text once and writes one row per document: the measurements, and one integer whose bit r is
set when rule r fails.  Decisions come later, from the ledger alone: a policy is a named, versioned set of rules
(a mask), a document passes when ``failures & mask == 0``, and `ablation` counts for every policy and rule what
the rule alone decides, from the few distinct bitmasks and their counts.

Measurements (whole text; a word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``):
n_words; word_chars, code points in words; n_symbols, characters of ``#*$%&|<>``; n_lines, ``\\n``-split lines with
a word; n_dup_lines, those equal to an earlier line; n_repeat_words, words in windows of three words that stand
twice or more in the text; n_letter_words, words with an ASCII letter or a character beyond ASCII; n_upper and
n_letters, ASCII letters.

Defined edge cases: null, empty and blank texts measure 0 everywhere and fail ``few_words``; repeated rows are
measured each; an empty table gives an empty ledger; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow
from panelspark.llm.words import U64, buffers, hash_spans, mix, slices, spans

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_upper", "n_letters")

#: Rule -> the condition of its failure, in integers.  A rule's bit is its place here; add rules at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "no_letters": "10 * n_letter_words < 6 * n_words",
    "shouting": "2 * n_upper > n_letters",
}

#: (policy, version) -> its rules.
POLICIES: dict[tuple[str, int], tuple[str, ...]] = {
    ("base", 1): ("few_words", "repeats"),
    ("clean", 1): ("few_words", "repeats", "symbols", "repeated_lines"),
    ("clean", 2): tuple(RULES),
}
CURRENT = ("clean", 2)


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of a per-byte (or per-word) array between consecutive offsets."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[off[1:]] - run[off[:-1]]


_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTERLIKE = _LETTER.copy()
_LETTERLIKE[128:] = True


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where (owner, hash) stands twice or more."""
    _, inverse, counts = np.unique(mix(hashes + mix(owner.astype(np.uint64))), return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    raw, off = buffers(texts)
    n = len(off) - 1
    start, end, first = spans(raw, off)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    hashes = hash_spans(raw, start, end)

    inside = np.zeros(len(raw) + 1, np.int64)  # 1 in words
    inside[start] += 1
    inside[end] -= 1
    inside = np.cumsum(inside)[:-1].astype(bool) if len(raw) else np.zeros(0, bool)
    points = inside & ((raw & 0xC0) != 0x80)
    letterlike = np.concatenate([[0], np.cumsum(_LETTERLIKE[raw])])

    covered = np.zeros(len(hashes), bool)
    if len(hashes) >= 3:
        window = np.flatnonzero(owner[2:] == owner[:-2])
        if len(window):
            gram = mix(mix(hashes[window] * U64(3) + hashes[window + 1]) * U64(5) + hashes[window + 2])
            again = window[_repeats(owner[window], gram)]
            for k in range(3):
                covered[again + k] = True

    # Lines: between line feeds and text borders, those that hold a word.
    feeds = np.flatnonzero(raw == 10)
    opens = np.union1d(off[:-1], feeds + 1)
    text_of = np.searchsorted(off, opens, side="right") - 1
    opens, text_of = opens[opens < off[np.minimum(text_of + 1, n)]], text_of[opens < off[np.minimum(text_of + 1, n)]]
    nearest = np.searchsorted(feeds, opens)
    feed_at = np.append(feeds, len(raw))[nearest]
    closes = np.minimum(feed_at, off[text_of + 1]) if len(opens) else opens
    holds = np.searchsorted(start, closes) > np.searchsorted(start, opens)
    opens, closes, text_of = opens[holds], closes[holds], text_of[holds]
    lines = np.bincount(text_of, minlength=n)
    key = mix(hash_spans(raw, opens, closes) + mix(text_of.astype(np.uint64)))
    _, one = np.unique(key, return_index=True)
    distinct = np.bincount(text_of[one], minlength=n)

    return {
        "n_words": words,
        "word_chars": _per_text(points, off),
        "n_symbols": _per_text(_SYMBOL[raw], off),
        "n_lines": lines,
        "n_dup_lines": lines - distinct,
        "n_repeat_words": _per_text(covered, first),
        "n_letter_words": _per_text(letterlike[end] > letterlike[start], first),
        "n_upper": _per_text(_UPPER[raw], off),
        "n_letters": _per_text(_LETTER[raw], off),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = measure(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(found[m], pa.int64()) for m in MEASURES]], names=["doc_id", *MEASURES]
            )


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `failures` (bit r: rule r failed); map-only, every rule evaluated once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").transform(map_arrow, _measure, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " | ".join(f"IF({rule}, {1 << r}L, 0L)" for r, rule in enumerate(RULES.values()))
    return rows.withColumn("failures", F.expr(bits))


def passes(policy: tuple[str, int] = CURRENT) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def apply_policy(book: DataFrame, policy: tuple[str, int] = CURRENT) -> DataFrame:
    """The ledger with base_failed and the policy's verdict."""
    base = ~passes(("base", 1))
    return book.withColumns({"base_failed": base, "kept": ~base & passes(policy)})


def ablation(book: DataFrame) -> DataFrame:
    """For every policy and rule of it: documents that fail the rule, that fail it alone, and that pass without it.

    The ledger shrinks to its distinct bitmasks with counts (2**rules rows at most) before rules are applied.
    """
    masks = book.groupBy("failures").agg(F.count("*").alias("n"))
    rows = [(p, v, r, mask(rules), mask((r,))) for (p, v), rules in POLICIES.items() for r in rules]
    rules = book.sparkSession.createDataFrame(rows, "policy string, version int, rule string, policy_mask long, rule_mask long")
    each = masks.withColumn("__rules", F.lit(1)).join(F.broadcast(rules.withColumn("__rules", F.lit(1))), "__rules")
    hit = F.col("failures").bitwiseAND(F.col("rule_mask")) != 0
    left = F.col("failures").bitwiseAND(F.col("policy_mask"))
    rest = left.bitwiseAND(F.bitwise_not("rule_mask"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return each.groupBy("policy", "version", "rule").agg(
        total(hit)("fails"),
        total(left == F.col("rule_mask"))("fails_alone"),
        total(rest == 0)("kept_without"),
        total(left == 0)("kept"),
        F.bit_or(F.when(hit, F.col("failures"))).alias("fails_with"),
        F.bit_and(F.when(hit, F.col("failures"))).alias("always_with"),
    )
