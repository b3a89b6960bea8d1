"""Embedding whitening, URL filter and Merkle manifest against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import merkle, queries, url_filter, whitening

SF = "/root/testdata/sf0.01"


# ---- whitening --------------------------------------------------------------------------------------------------


def grid(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def exact_polynomial(matrix):
    """Faddeev and LeVerrier, in fractions; constant first."""
    d = len(matrix)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        trace = sum(sum(matrix[i][t] * m[t][i] for t in range(d)) for i in range(d))
        out.append(-trace / k)
    return [int(c) for c in reversed(out)]


def test_polynomial_equals_fractions(spark):
    a = np.random.default_rng(5).integers(-400, 400, (7, 30))
    a[4] = 0  # a null row and column: the reduction meets columns without a pivot
    matrix = (a @ a.T).tolist()
    assert whitening.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)


def test_roots_are_counted_and_narrowed_exactly():
    poly = [1]  # (x - 3)^2 (x - 3 - 2^-40) (x - 1) scaled to integers by x = z / 2^40
    for root in (3 << 40, 3 << 40, (3 << 40) + 1, 1 << 40, 0):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [whitening.roots_above(poly, a) for a in (0, 1 << 40, 2 << 40, 3 << 40, 4 << 40)] == [4, 3, 3, 1, 0]
    roots = whitening.largest_roots(poly, 10 << 40, 4)
    assert [c for _, _, c in roots] == [0, 1, 1, 2]
    for (mantissa, bits, _), root in zip(roots, ((3 << 40) + 1, 3 << 40, 3 << 40, 1 << 40), strict=True):
        assert abs(Fraction(mantissa, 1 << bits) - root) <= Fraction(root, 1 << (whitening.PRECISION - 2))


def test_whitening_equals_dense_linear_algebra(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    vectors = {r.vec_id: grid(r.embedding) for r in rows}
    fit = np.array(sorted(set(vectors.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - 1_000_000).astype(float) - np.array([s - 1_000_000 * n for s in sums], float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    white = {}
    for r in got:
        assert r.deviation == sum((n * x - s) ** 2 for x, s in zip(vectors[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[r.component - 1] * n / (centred**2).sum(), rel=1e-9)
        white.setdefault(r.component, {})[r.vec_id] = r.whitened
    for component, of in white.items():
        mine = np.array([of[v] for v in vectors])
        x = np.array([[float(Fraction(a * n - int(s), n)) for a, s in zip(vectors[v], sums, strict=True)] for v in vectors])
        want = x @ axes[:, component - 1] / np.sqrt(values[component - 1])
        assert np.abs(mine - want * np.sign(mine @ want)).max() < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_equal_eigenvalues_get_orthonormal_components(spark):
    """Unit steps along six axes: one eigenvalue, six times."""
    steps = [tuple((s / 64 if i == k else 0.0) for i in range(6)) for k in range(6) for s in (-40, 40)]
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(steps)], "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    assert len(model.values) == 6 and len(set(model.values)) == 1 and model.identity_error < 1e-12
    assert np.abs(model.vectors.T @ model.vectors - np.eye(6)).max() < 1e-14


def test_nearly_equal_eigenvalues_are_parted():
    """Eigenvalues that differ by 1 in 10**15: beyond doubles, not beyond the exact polynomial."""
    big = 10**15
    matrix = [[2 * big + 1, 1, 0], [1, 2 * big + 1, 0], [0, 0, 2 * big]]  # 2 big + 2, 2 big, 2 big
    matrix[2][2] += 1  # 2 big + 1
    roots = whitening.largest_roots(exact_polynomial(matrix), 6 * big + 3, 3)
    assert [round(Fraction(m, 1 << b)) for m, b, _ in roots] == [2 * big + 2, 2 * big + 1, 2 * big]
    axes = np.abs(whitening.components(matrix, roots))
    half = math.sqrt(0.5)
    assert np.abs(axes - np.array([[half, 0, half], [half, 0, half], [0, 1, 0]])).max() < 1e-15


def test_gram_of_large_entries_is_exact():
    y = np.array([[2**40, -3], [2**61, 5], [7, 2**30]], np.int64)
    want = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(2)] for i in range(2)]
    assert whitening.gram(y).tolist() == want and whitening.gram(y[2:3] % 100).tolist() == [[49, 7 * 24], [7 * 24, 24 * 24]]
    assert whitening.deviations(whitening.centred(y, 3, [1, 2]))[1] is None


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<double>, n int, component string, x int"
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-0.5, 0.1]), (None, [0.1, -0.9]), (3, [9.0, 9.0])]
    bad = [(4, None), (5, []), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0, "c", 1) for i, v in good + bad], schema)
    got = whitening.whiten(df, whitening.fit(df)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i or 0, k) for i, _ in good for k in (1, 2))
    assert {r.n for r in got} == {4}
    for rows in ([], good[:2], bad[:5]):  # no row, no variance, no vector
        few = spark.createDataFrame([(i, v, 0, "c", 1) for i, v in rows], schema)
        assert whitening.whiten(few, whitening.fit(few)).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 0.0], 0, "c", 1), (2, [0.0, 1.0], 0, "c", 1)], schema)
    got = whitening.whiten(huge, whitening.fit(huge)).collect()
    assert [r.component for r in got] == [1, 1] and {r.deviation for r in got} == {None}


# ---- URL filter -------------------------------------------------------------------------------------------------


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):], re.S).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com", "http://example.com/en/?x", "https://a.example.com/en/",
    "http://www.example.com/en", "https://xexample.com/en/", "ftp://net/es/1", "http://evilnet/es/", "http://b.net/fr/a#b?c", "http://ÀB.net/fr/",
    "x://y://z.com/", "http://casino.org/a\nb", "http://casino.org/a\nb", "http://h.org?u=/en/", "http://h.org#/en/", "http://h.org/" + "ab/" * 50_000,
]


def test_urls_are_cut_and_ruled_like_brute_force(spark):
    df = spark.createDataFrame([(i, u, 0.5, "r") for i, u in enumerate(URLS)], "page_id int, url string, score double, rule string")
    model = url_filter.learn(url_filter.labelled_frame(spark))
    got = url_filter.judge(df, model).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = parts(URLS[r.page_id])
        rule = rule_of(host, path)
        learned = "block" if r.score >= 0.5 else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule and rule.text, rule.verdict if rule else learned)
    assert url_filter.allowed(df, model).count() == sum(r.verdict == "allow" for r in got)
    assert url_filter.judge(df.limit(0), model).collect() == []


def test_features_are_padded_ngrams():
    texts = ["", "ab", "a", "ünï/x"]
    who, which, weight = url_filter.features(texts, 0)
    for i, t in enumerate(texts):
        padded = f"\x01{t}\x01" if t else ""
        grams = [padded[k : k + n] for n in url_filter.GRAMS for k in range(len(padded) - n + 1)]
        mine = which[who == i]
        assert len(mine) == len(grams) and len(set(mine)) == len(set(grams))
        assert np.allclose(weight[who == i], 1 / math.sqrt(len(grams) or 1))
    assert not set(which[who == 1]) & set(url_filter.features(["ab"], 1)[1])  # host and path have bins of their own


def test_logistic_fit_reaches_the_minimum():
    """The penalised loss has no slope left: every weight's penalty is its n-grams' errors."""
    hosts = [re.sub(r"\W", "", u)[:20] for u, _ in url_filter.labelled_urls()[::9]]
    labels = np.array([b for _, b in url_filter.labelled_urls()[::9]], float)
    model = url_filter.fit_logistic(hosts, hosts, labels, penalty=1e-2, steps=4000)
    error = (model.score(hosts, hosts) - labels) / len(labels)
    slope = 1e-2 * model.weights
    for part in (0, 1):
        who, which, weight = url_filter.features(hosts, part)
        np.add.at(slope, which, error[who] * weight)
    assert abs(error.sum()) < 1e-6 and np.abs(slope).max() < 1e-6


def test_url_model_on_held_out_hosts(spark):
    """Learn from two kinds of host, judge the third; then the whole table against hosts with other words."""
    labelled = url_filter.labelled_urls()
    rest = spark.createDataFrame([x for i, x in enumerate(labelled) if i % 3], "url string, blocked int")
    model = url_filter.learn(rest)
    held = [x for i, x in enumerate(labelled) if i % 3 == 0]
    found = model.score(*zip(*(parts(u) for u, _ in held), strict=True)) >= 0.5
    assert np.mean(found == np.array([b for _, b in held], bool)) > 0.97
    pages = queries.QUERIES["op12_url_filter"](spark, "/root/testdata/sf0.1").collect()
    unwanted = re.compile("adult|casino|pills|bets|ads-|spam")
    right = [(r.score >= 0.5) == bool(unwanted.search(r.host)) for r in pages]
    assert len(right) == 2500 and np.mean(right) > 0.99


def test_url_model_edges(spark):
    few = lambda rows: url_filter.learn(spark.createDataFrame(rows, "url string, blocked int"))
    assert few([]).score(["a"], [""])[0] < 1e-9
    assert few([("http://a.b/", 1), (None, 0), ("http://c.d/", None)]).score(["a"], ["/"])[0] > 1 - 1e-9
    many = spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int")
    assert np.array_equal(url_filter.learn(many, most=50).weights, url_filter.learn(many.repartition(5), most=50).weights)


# ---- Merkle manifest --------------------------------------------------------------------------------------------


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return digest(field(r.doc_id), field(r.source), field(r.lang), field(r.n_chars), field(text))


def tree(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([digest(*rows[-1][i : i + 3]) for i in range(0, len(rows[-1]), 3)])
    return rows


def beside(rows, at):
    out = []
    for row in rows[:-1]:
        first = at - at % 3
        out.append((row[first:at], row[at + 1 : first + 3]))
        at //= 3
    return out


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {g: tree([leaf(r, r.text) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order]) if order else []
    out = []
    for place, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            around = beside(trees[g], at) + beside(top, place)
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            x = leaf(r, text)
            for left, right in around:
                x = digest(*left, x, *right)
            proof = digest(*[d for left, right in around for d in left + right])
            out.append((r.doc_id, trees[g][0][at], trees[g][-1][0], top[-1][0], proof, x, x == top[-1][0]))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_manifest(docs.collect())
    assert as_rows(queries.QUERIES["op13_merkle_manifest"](spark, SF)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)
    assert as_rows(merkle.manifest(docs, levels=2)) == want  # blocks of 9: several rounds


@pytest.mark.parametrize("levels", [1, 7])
def test_manifest_edges(spark, levels):
    schema = "doc_id long, source string, lang string, n_chars long, text string, gid int, pos int, digest string, tampered int"
    rows = [
        (1, None, None, None, None), (2, None, "en", 3, "a\nb"), (None, None, "en", 0, ""), (None, None, "en", 0, ""),
        (3, "b", "é", 5, "é\n" * 70_000), (3, "b", "é", 5, "other"), (3, "b", "é", 5, "é\n" * 70_000), (4, "a", None, 1, "x"), (5, "", "fr", 1, "\n"),
        *[(i, "hot", "de", i, f"line {i % 3}\nend") for i in range(6, 90)],
    ]
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], schema)
    assert as_rows(merkle.manifest(df, levels=levels)) == brute_manifest(df.collect())
    one = df.where("source = 'a'")
    assert as_rows(merkle.manifest(one, levels=levels)) == brute_manifest(one.collect())
    assert merkle.manifest(df.limit(0), levels=levels).collect() == []


def test_folding_resumes_the_state_of_the_slot(monkeypatch):
    """A fold hashes the replacement and what stands to its right, nothing to its left."""
    nodes = [digest(str(i)).encode() for i in range(20)]
    block = merkle.Block(nodes, merkle.levels_of(20))
    hashed = []

    class State:
        def __init__(self, real):
            self.real = real

        def copy(self):
            return State(self.real.copy())

        def update(self, data):
            hashed.append(len(data))
            self.real.update(data)

        def hexdigest(self):
            return self.real.hexdigest()

    block.states = [[State(s) for s in row] for row in block.states]
    new = digest("new").encode()
    for at in range(20):
        hashed.clear()
        want = tree([n.decode() for n in nodes[:at] + [new] + nodes[at + 1 :]])[-1][0]
        assert block.fold(at, new).decode() == want
        assert sum(hashed) == sum(64 + len(right) for _, right in block.siblings(at))


def test_hot_group_is_cut_over_blocks_and_tasks(spark):
    """One group of 2,000 rows in blocks of 9: its numbering and its blocks use many tasks."""
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit("en").alias("lang"),
                                  F.col("id").alias("n_chars"), F.concat(F.lit("a\n"), "id").alias("text"))
    placed = merkle.numbered(df.select("source", "doc_id"), "source", ["doc_id"])
    assert placed.where("pos <> doc_id or n <> 2000").count() == 0
    assert as_rows(merkle.manifest(df, levels=2)) == brute_manifest(df.collect())
