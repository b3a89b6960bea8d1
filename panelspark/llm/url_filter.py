"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

*Parts.*  The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; the
path is what follows up to ``?``, ``#`` or the end.  Both are empty for a null url or one without ``://``.

*Rules* (`Rule`, a small list given by the caller) fit a host and all its subdomains if the path starts with theirs; of
those that fit, the longest written rule decides (ties: the one with the longer host).  They are column expressions.

*Model.*  Host and path are padded with a border character and cut into n-grams of three to five characters; each is
hashed with its part's seed into one of `BINS` bins, and its weight is one over the root of the number of n-grams of that
part, so long paths say little more than short ones.  A weight for each bin is fitted to labelled urls by logistic regression with an L2
penalty (full-batch accelerated gradient steps, a fixed number, so fitting is deterministic).  `LABELLED` is the small
labelled table the query learns from; `learn` takes any other.  At most `MAX_LABELLED` of its rows are used, those with the
smallest hashes: a bounded sample of labelled rows for fitting.  Scoring covers every url, in whole length, map-only.

Defined edge cases: a url without host and path has no n-gram, its score is the model's intercept; equal urls get equal
verdicts; very long urls are scored whole; an empty table gives an empty result; labelled rows with a null url or label
are left out, and a model of no row or of one label scores every url with that label's share (no row: 0); extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow
from panelspark.llm.words import U64, mix, slices

BINS = 1 << 16
GRAMS = (3, 4, 5)
#: Urls scored at this probability or above are blocked.
BLOCK_AT = 0.5
#: Labelled rows that a fit uses at most.
MAX_LABELLED = 20_000
PENALTY = 2e-5
STEPS = 600
_BORDER = 1  # code point that no url holds as text
_PART_SEED = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# The words of the small labelled table, by what their hosts serve.
BLOCKED_WORDS = (
    "adult", "adults-only", "xxx", "porn", "porno", "sexcam", "hotsex", "nude", "escort", "casino", "casinos", "slots",
    "poker", "roulette", "jackpot", "bets", "betting", "sportsbet", "gamble", "lottery", "pills", "viagra", "cialis", "pharma-cheap",
    "weightloss", "steroids", "spam", "spammer", "link-farm", "farmlinks", "ads", "adserver", "ad-track", "tracker", "clicktrack", "popunder",
    "phish", "malware", "trojan", "keygen", "warez", "cracked", "torrents", "free-money", "win-cash", "bigwin", "cheap-meds", "payday-loans",
)
ALLOWED_WORDS = (
    "news", "library", "university", "school", "museum", "weather", "science", "history", "travel", "garden", "recipes", "music",
    "theatre", "books", "parliament", "health", "hospital", "research", "journal", "chess", "football", "software", "docs", "wiki",
    "station", "nation", "national", "other", "weathering", "brother", "thinking", "there", "thing", "table", "truth", "north",
    "mother", "father", "gathering", "earth", "traditions", "question", "solutions", "theory", "rhythm", "author", "method", "archive",
    "bakery", "cinema", "railway", "hotel", "radio", "village", "island", "physics", "language", "energy", "climate", "kitchen",
    "another", "whether", "together", "further", "athlete", "fashion", "region", "mission", "vision", "pension", "edition", "motion",
    "thread", "threshold", "thermal", "thesis", "thatch", "thorn", "thistle", "tablet", "stable", "cable", "noble", "marble",
    "bank", "insurance", "council", "court", "police", "embassy", "church", "orchestra", "gallery", "camping", "cycling", "sailing",
)


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table (url, blocked 0 or 1): each word in three kinds of host, with everyday paths."""
    paths = ("/", "/en/1204.html", "/de/331/", "/fr/88", "/es/7015.html", "/about")
    out = []
    for blocked, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for i, word in enumerate(words):
            hosts = (f"{word}.example.org", f"www.{word}-{i}.example.net", f"blog.my{word}.example.com")
            out += [(f"https://{h}{paths[(i + k) % len(paths)]}", blocked) for k, h in enumerate(hosts)]
    return out


def labelled_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_urls(), "url string, blocked int")


# ---- parts and rules --------------------------------------------------------------------------------------------


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    rest = F.when(url.contains("://"), F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the rule that decides, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


# ---- features (numpy, inside tasks) -----------------------------------------------------------------------------


def features(texts: list[str], part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, bin, weight) of every n-gram of padded texts; an empty text has none."""
    owners, bins, ends = [], [], np.zeros(len(texts), np.int64)
    points = [np.frombuffer(f"{chr(_BORDER)}{t}{chr(_BORDER)}".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(p) if t else 0 for p, t in zip(points, texts, strict=True)], np.int64)
    joined = np.concatenate([p for p, t in zip(points, texts, strict=True) if t] or [np.zeros(0, np.uint32)]).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends[:] = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(joined))  # characters from here to the end of the text
    state = np.full(len(joined), U64(_PART_SEED[part]))
    for n in range(1, max(GRAMS) + 1):
        state = state[: len(joined) - n + 1] if n > 1 else state
        state = mix(state * U64(0xD1342543DE82EF95) + joined[n - 1 : n - 1 + len(state)])
        if n in GRAMS:
            here = np.flatnonzero(left[: len(state)] >= n)
            owners.append(owner[here])
            bins.append((mix(state[here] + U64(n)) % U64(BINS)).astype(np.int64))
    who, which = np.concatenate(owners), np.concatenate(bins)
    count = np.bincount(who, minlength=len(texts))
    return who, which, 1.0 / np.sqrt(count[who])


@dataclass(frozen=True)
class UrlModel:
    intercept: float
    weights: np.ndarray  # of the bins, and BINS of them: small, sent with the task

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability that each url is to be blocked."""
        total = np.full(len(hosts), self.intercept)
        for part, texts in enumerate((hosts, paths)):
            who, which, weight = features(texts, part)
            total += np.bincount(who, weights=self.weights[which] * weight, minlength=len(hosts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def fit_logistic(hosts: list[str], paths: list[str], labels: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> UrlModel:
    """Logistic regression on the rows' n-grams: accelerated gradient steps of fixed size on the penalised mean loss."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return UrlModel(500.0 if share else -500.0, np.zeros(BINS))
    parts = [features(texts, part) for part, texts in enumerate((hosts, paths))]
    who, which, weight = (np.concatenate(c) for c in zip(*parts, strict=True))
    used, slot = np.unique(which, return_inverse=True)
    n = len(labels)
    cells, cell = np.unique(who * np.int64(BINS) + which, return_inverse=True)
    length = np.bincount(cells // BINS, weights=np.bincount(cell, weights=weight) ** 2, minlength=n)
    step = 1.0 / (0.25 * (1.0 + length.max()) + penalty)  # 1 stands for the intercept
    w = at = np.zeros(len(used) + 1)
    momentum = 1.0
    for _ in range(steps):
        margin = at[-1] + np.bincount(who, weights=at[slot] * weight, minlength=n)
        error = (1.0 / (1.0 + np.exp(-margin)) - labels) / n
        slope = np.append(np.bincount(slot, weights=error[who] * weight, minlength=len(used)) + penalty * at[:-1], error.sum())
        new = at - step * slope
        follow = (1.0 + np.sqrt(1.0 + 4.0 * momentum * momentum)) / 2.0
        at, w, momentum = new + (momentum - 1.0) / follow * (new - w), new, follow
    weights = np.zeros(BINS)
    weights[used] = w[:-1]
    return UrlModel(float(w[-1]), weights)


# ---- Spark ------------------------------------------------------------------------------------------------------


def learn(labelled: DataFrame, url: str = "url", label: str = "blocked", most: int = MAX_LABELLED) -> UrlModel:
    """A model of a labelled table (url, 0 or 1)."""
    host, path = url_parts(F.col(url))
    rows = labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull()).select(
        host.alias("host"), path.alias("path"), F.col(label).cast("int").alias("label"), F.xxhash64(url, label).alias("at")
    )
    taken = rows.orderBy("at", "host", "path").limit(most).collect()
    return fit_logistic([r.host for r in taken], [r.path for r in taken], np.array([r.label for r in taken], np.float64))


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url",
          block_at: float = BLOCK_AT) -> DataFrame:
    """key, host, path, rule, verdict, score of every row: the deciding rule's verdict, else the model's; map-only."""
    kind = pages.schema[key].dataType.simpleString()
    host, path = url_parts(F.col(url))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "path", 1 << 20):
                found = model.score(part.column("host").to_pylist(), part.column("path").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, "score"])

    rows = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))
    rows = rows.transform(map_arrow, score, f"{key} {kind}, host string, path string, score double")
    decided = longest_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= block_at, "block").otherwise("allow")
    return rows.withColumn("__rule", decided).select(
        key, "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", learned).alias("verdict"), "score"
    )


def allowed(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key) of the rows whose url is allowed: what a crawl filter joins on."""
    return judge(pages, model, rules, key, url).where(F.col("verdict") == "allow").select(key)
