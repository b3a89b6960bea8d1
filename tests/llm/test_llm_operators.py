"""Every training-data operator against a brute-force version, and its edge cases on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm import sentencepiece_lattice as lattice
from panelspark.llm import langid, minhash, packing, quality_rules, queries, sharding, token_counts, tokens, topk, toxicity, wavelet

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Nulls, empty, blank and very long texts, ties, repeated rows, null ids; extra columns whose names operators use.
EDGE = [
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "one two"),
    (None, None),
    (6, "x" * 200_000),
    (7, "12345 !!! ###"),
    (8, "word " * 60_000),
    (9, "Café ÉTÉ  naïve 漢字  x <|endoftext|> don't"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [r for r in docs.orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def edge(spark):
    schema = "doc_id long, text string, lang string, score double, shard int, node string, class_id int, bands string, h1 int"
    return spark.createDataFrame([(i, t, "en", None, 1, "n", 0, "b", 5) for i, t in EDGE], schema)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, score double")


def held(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# ---- 1 near-duplicates ----------------------------------------------------------------------------------------


def windows(text):
    w = WORD.findall(text or "")
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute_classes(pairs, threshold=0.8):
    """Class (smallest id) of every (id, text), by comparing all pairs that share a window."""
    bags = [windows(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, b in enumerate(bags):
        for g in b:
            holders[g].append(i)
    tried = set()
    for members in holders.values():
        for x in range(len(members)):
            for y in range(x):
                a, b = members[y], members[x]
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                low = sum((bags[a] & bags[b]).values())
                high = sum((bags[a] | bags[b]).values())
                if low >= threshold * high - 1e-9:
                    parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        ids = [d for d in (least.get(find(i)), doc) if d is not None]
        least[find(i)] = min(ids) if ids else None
    return [least[find(i)] if bags[i] else doc for i, (doc, _) in enumerate(pairs)]


def test_near_duplicates_equal_brute_force(docs, rows):
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    want = dict(zip([r.doc_id for r in rows], brute_classes([(r.doc_id, r.text) for r in rows]), strict=True))
    assert found == want
    assert len(set(want.values())) < len(want)


def test_near_duplicate_edges(edge, empty):
    found = sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.near_duplicates(edge).collect())
    want = sorted((d or 0, c or 0) for (d, _), c in zip(EDGE, brute_classes(EDGE), strict=True))
    assert found == want
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.keep_one(empty).count() == 0


def test_bag_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    for share, repeats in ((0.9, 1), (0.6, 5), (0.5, 40)):
        keys = rng.integers(1, 2**63, 400, dtype=np.uint64)
        count = rng.integers(1, repeats + 1, 400)
        other = np.where(rng.random(400) < share, count, rng.integers(1, 2 * repeats + 1, 400))
        m = 2000
        s = minhash.bag_signatures([(keys, count), (keys, other)], m)
        want = np.minimum(count, other).sum() / np.maximum(count, other).sum()
        assert abs((s[0] == s[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m) + 1e-3
    one = minhash.bag_signatures([(np.array([5], np.uint64), np.array([1]))], 150)
    assert np.isfinite(one.view(np.float64)).all()


def test_dense_group_is_one_class_and_unlinked_texts_stay_apart(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(vocabulary, 300))
    pairs = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, 300, int(rng.integers(0, 12))):
            words[at] = str(rng.choice(vocabulary))
        pairs.append((i, " ".join(words)))
    frame = spark.createDataFrame(pairs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame).collect()}
    assert [found[i] for i in range(120)] == brute_classes(pairs)


def near_copies(n, seed=0):
    """Copies of one text of 200 words with up to 13 changed: most pairs are near the threshold, many below."""
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    base = rng.choice(vocabulary, 200)
    out = []
    for i in range(n):
        words = base.copy()
        at = rng.integers(0, 200, int(rng.integers(0, 14)))
        words[at] = rng.choice(vocabulary, len(at))
        out.append((i, " ".join(words)))
    return out


def test_rows_of_a_group_of_near_copies_grow_with_the_group(spark, monkeypatch):
    """Twice the copies: at most 2.1 times the stars, the rows that fetch signatures and texts, and those of signature tiles."""
    counts = []
    real, cut = minhash.map_arrow, minhash._tiles

    def counted(df, function, schema):
        out = real(df, function, schema)
        if schema == f"a {minhash.NODE}, b {minhash.NODE}":
            out = minhash.staged(out)
            counts[-1].append(out.count())
        return out

    def fetched(members):
        members = minhash.staged(members)
        if "text" in members.columns:
            counts[-1].append(members.count())
        else:
            counts[-1].append(members.select("node").distinct().count())
        return cut(members)

    monkeypatch.setattr(minhash, "map_arrow", counted)
    monkeypatch.setattr(minhash, "_tiles", fetched)
    for n in (1000, 2000):  # fewer copies do not yet share most of their buckets
        counts.append([])
        frame = spark.createDataFrame(near_copies(n), "doc_id long, text string")
        assert minhash.near_duplicates(frame).count() == n
    assert len(counts[0]) == len(counts[1]) == 5  # the last are the links themselves
    assert all(b <= 2.1 * a for a, b in zip(counts[0][:4], counts[1][:4], strict=True)), counts


def test_near_copy_recall(spark):
    """Links of planted near copies against brute force, by similarity: what is missed is below the threshold."""
    pairs = near_copies(300, seed=4)
    bags = [windows(t) for _, t in pairs]
    frame = spark.createDataFrame(pairs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame).collect()}
    linked = [(i, j) for i in range(300) for j in range(i)
              if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()) - 1e-9]
    assert len(linked) > 300 and all(found[i] == found[j] for i, j in linked)
    assert [found[i] for i in range(300)] == brute_classes(pairs)


def test_parts_of_a_tile():
    rng = np.random.default_rng(2)
    for n, m in ((1, 0), (50, 20), (400, 300), (60, 59)):
        x, y = (rng.integers(0, n, m), rng.integers(0, n, m)) if m != 59 else (np.arange(59), np.arange(1, 60))
        low = minhash.parts(n, x, y)
        want = np.arange(n)
        for _ in range(n):
            for a, b in zip(x, y, strict=True):
                want[a] = want[b] = min(want[a], want[b])
        assert (low == want).all()


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    frame = spark.createDataFrame(edges, "a long, b long").selectExpr("cast(a as decimal(38,0)) a", "cast(b as decimal(38,0)) b")
    found = {int(r.node): int(r.comp) for r in minhash.connected_components(frame).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert found == {x: find(x) for x in parent}


# ---- 2 sharding -----------------------------------------------------------------------------------------------


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def key_of(doc_id) -> int:
    return int(hashlib.md5(("null" if doc_id is None else str(doc_id)).encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_sharding(request, table):
    frame = request.getfixturevalue(table)
    found = sharding.shard_documents(frame, cells=7).collect()
    assert len(found) == frame.count()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in frame.collect())
    assert want == Counter((r.doc_id, r.size, r.text_crc32) for r in found)
    slots = defaultdict(list)
    for r in found:
        k = key_of(r.doc_id)
        assert (r.shard, r.grown_shard, r.law) == (jump(k, 16), jump(k, 17), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_jump_hash_of_large_counts(spark, empty):
    frame = spark.range(300).select("id", sharding.jump_hash(F.col("id"), 1000).alias("s"))
    assert all(r.s == jump(key_of(r.id), 1000) for r in frame.collect())
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_runs_no_python(docs):
    plan = sharding.shard_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 3 toxicity -----------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lexicon = toxicity.learn(big, labels)
    found = toxicity.score_toxicity(big, lexicon).join(labels, "doc_id").collect()
    test = [r for r in found if held(r.doc_id)]
    hit = sum(r.toxic and r.predicted for r in test)
    assert hit >= 0.9 * sum(r.toxic for r in test)
    assert sum(not r.toxic and r.predicted for r in test) <= 0.01 * len(test)
    assert all(0 <= r.score <= 1 for r in found)
    assert len(lexicon.weights) <= toxicity.LEXICON


def test_toxicity_folding_and_exceptions():
    assert toxicity.fold("Ｌ0ser!! 1D10T, сlown @ $5 id!ot") == " ioser idiot ciown s idiot "
    assert toxicity.fold("") == " " and toxicity.fold("l​o­ser") == " ioser "
    lexicon = toxicity.Lexicon({" idiot ": 4.0, " ioser ": 5.0, " iose": 2.0}, {"sore ioser", "idiot proof"}, (-4.0, 1.0, 1.0, 0.5))
    automaton = lexicon.automaton()
    value = lambda t: lexicon.measure(automaton, toxicity.fold(t))[0]
    assert value("a loser here") == 5.0
    assert value("a sore loser here") == 0 and value("an idiot proof plan") == 0
    assert value("losing closer") == 0 and value("losers") == 2.0
    short, long = (lexicon.measure(automaton, toxicity.fold("loser " + "word " * n)) for n in (5, 500))
    assert short[:2] == long[:2] and short[2] > long[2]


def test_toxicity_learns_exceptions(spark):
    texts = [(i, "you are a stupid man today", 1) for i in range(40)]
    texts += [(100 + i, "a fine day with words", 0) for i in range(400)]
    texts += [(600 + i, "this is stupid simple work", 0) for i in range(15)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert " stupid " in lexicon.weights and "stupid simpie" in lexicon.exceptions


def test_toxicity_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    untrained = toxicity.learn(edge, none)
    assert {r.score for r in toxicity.score_toxicity(edge, untrained).collect()} == {0.0}
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score_toxicity(edge, toxicity.learn(edge, labels)).collect()
    assert len(found) == len(EDGE) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score_toxicity(empty, untrained).count() == 0
    assert toxicity.keep_clean(edge, untrained).count() == len(EDGE)


# ---- 4 top-k --------------------------------------------------------------------------------------------------


def brute_top(rows, divisor, k=5):
    good = {}
    for vec_id, v in rows:
        if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good[(vec_id, tuple(np.float32(v)))] = np.floor(256 * np.array(np.float32(v), float)).astype(np.int64)
    out = []
    for q in sorted({i for i, _ in good if i % divisor == 0}):
        best = {}
        for (a, _), u in ((x, u) for x, u in good.items() if x[0] == q):
            for (b, _), w in good.items():
                if b != q and len(w) == len(u):
                    best[b] = max(best.get(b, -(10**18)), int(u @ w))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r + 1, b, s) for r, (b, s) in enumerate(ranked)]
    return out


def test_top_k_equals_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute_top([(r.vec_id, r.embedding) for r in frame.collect()], 50)
    for block_rows in (8192, 100):
        found = topk.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=block_rows).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == want


def test_top_k_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4]) for i in range(60)]
    rows += [(60 + i, [0.25, 0.5, -0.25, 0.0]) for i in range(30)] + [(200, [0.25, 0.5, -0.25, 0.0])] * 3
    rows += [(300, None), (310, []), (320, [None, 1.0, 1.0, 1.0]), (330, [float("nan"), 0.0, 0.0, 0.0]), (340, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (20, [1.0, 1.0, 0.0, 0.0]), (400, [0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(a, b, 7, 1) for a, b in rows], "vec_id long, embedding array<float>, score int, c int")
    found = topk.top_k(frame, F.col("vec_id") % 10 == 0, block_rows=25).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute_top(rows, 10)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 400"), F.col("vec_id") % 10 == 0).count() == 0


def test_impact_index_proves_what_it_leaves_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 30, (20, 32))
    vectors = np.rint(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 6, (3000, 32))).astype(np.int64)
    ids = rng.permutation(3000)
    index = topk.ImpactIndex(ids, vectors)
    for t in range(50):
        q = vectors[t] * (rng.random(32) > 0.3)
        got, score = index.search(q, int(ids[t]))
        s, m = vectors @ q, ids != ids[t]
        order = np.lexsort((ids[m], -s[m]))[:5]
        assert (got == ids[m][order]).all() and (score == s[m][order]).all()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_impact_index_leaves_rows_out(sf):
    import pyarrow.parquet as pq

    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    ids = table["vec_id"].to_numpy()
    vectors = np.floor(256 * np.array(table["embedding"].to_pylist(), np.float64)).astype(np.int64)
    index = topk.ImpactIndex(ids, vectors)
    for t in np.flatnonzero(ids % 50 == 0):
        got, score = index.search(vectors[t], int(ids[t]))
        s, m = vectors @ vectors[t], ids != ids[t]
        order = np.lexsort((ids[m], -s[m]))[:5]
        assert (got == ids[m][order]).all() and (score == s[m][order]).all()
        assert index.scored <= topk.RESCORE * len(ids)


# ---- 5 SentencePiece ------------------------------------------------------------------------------------------


PIECE_HARD = ["a  b", " a ", "▁x ▁▁ y", "   ", "\n\t x", "漢字 x", "<s> </s> <unk> <0x41>", "aaaaaaaa aaaaaaaaa", "..... !!!! ----", "e\u0301", "x" * 500 + " y", "🙂🙂 a🙂b", "0123456789 3.14159", "a" * 70 + "é" * 70]


def test_lattice_encoding_equals_library(spark, rows):
    texts = PIECE_HARD + [r.text for r in rows[:150]] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(1, "a  b")], "doc_id long, text string")
    library = lattice._processor(lattice.MODEL)
    found = Counter((r.doc_id, bytes(r.ids)) for r in lattice.encode(frame).collect())
    want = Counter((i, np.array(library.encode(t or ""), "<u4").tobytes()) for i, t in [*enumerate(texts), (1, "a  b")])
    assert found == want


def test_copies_of_a_long_text_list_their_rare_units_once(spark, monkeypatch):
    end = [f"qz{i}xk" for i in range(40)]
    text = "the cat sat on a mat " * 200 + " ".join(end)
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    kept = []
    # room for the six words of the sentence only
    monkeypatch.setattr(lattice, "frequent_units", lambda docs, model, f=lattice.frequent_units: f(docs, model, 6))
    monkeypatch.setattr(lattice, "staged", lambda df, f=lattice.staged: kept.append(f(df)) or kept[-1])
    coded = lattice.encode(frame)
    (rare,) = (x for x in kept if x.columns == ["key", "unit"])
    found = [r.unit for r in rare.collect()]
    assert len(found) == len(set(found)) and 0 < len(found) <= 3 * len(end)
    want = np.array(lattice._processor(lattice.MODEL).encode(text), "<u4").tobytes()
    assert Counter(bytes(r.ids) for r in coded.select("ids").collect()) == {want: 3000}


def test_decoding_gives_the_texts_back(spark, rows):
    texts = [t for t in PIECE_HARD if "▁" not in t] + [r.text for r in rows[:60]] + [""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in lattice.encode(frame).collect()]
    coded += [(-1, None)]
    back = {r.doc_id: r.text for r in lattice.decode(spark.createDataFrame(coded, "doc_id long, ids array<int>")).collect()}
    assert back == {**dict(enumerate(texts)), -1: None}


def brute_viterbi(word, scores, worst):
    """Best segmentation by trying all of them."""
    if not word:
        return 0.0, []
    best = None
    for k in range(1, len(word) + 1):
        head = word[:k]
        if head in scores or k == 1:
            score, rest = brute_viterbi(word[k:], scores, worst)
            total = score + scores.get(head, worst)
            if best is None or total > best[0] + 1e-12:
                best = (total, [head, *rest])
    return best


def test_frequent_units_count_whole_texts(spark):
    texts = ["x " * 5000 + "lastword"] * 3 + ["once"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.unit for r in lattice.frequent_units(frame).collect()} == {"▁x", "▁lastword"}
    # the summary of a task is bounded, and the commonest unit is never lost
    many = " ".join(f"w{i}q common" for i in range(500))
    few = lattice.frequent_units(spark.createDataFrame([(1, many)], "doc_id long, text string"), counters=8)
    assert "▁common" in {r.unit for r in few.collect()} and few.count() <= 8


def test_merge_fold_equals_library_on_random_units(spark):
    rng = np.random.default_rng(11)
    letters = list("etaoinshrdlu") + list("éßжд漢字🙂0.,-")
    words = {"".join(rng.choice(letters[: int(rng.integers(3, len(letters)))], int(rng.integers(1, 65)))) for _ in range(600)}
    words |= {"e" * n for n in (1, 2, 63, 64)} | {"the" * 21 + "t"}
    units = sorted({lattice.BLANK + w[:63] for w in words} | {lattice.BLANK})
    first_byte = lattice._processor(lattice.MODEL).piece_to_id("<0x00>")
    coded = lattice.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), lattice.piece_rows(), first_byte)
    found = {r.unit: r.ids for r in coded.collect()}
    assert sorted(found) == units and max(map(len, units)) == lattice.LONGEST
    p = lattice._processor(lattice.MODEL)
    for u in units:
        if len(u) > 1:
            assert found[u] == p.encode(u[1:]), u
    assert found[lattice.BLANK] == [p.piece_to_id(lattice.BLANK)]


def test_viterbi_fold_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    pieces = {c: -8.0 - i for i, c in enumerate("abcd")}
    for _ in range(40):
        pieces["".join(rng.choice(list("abcd"), int(rng.integers(2, 5))))] = -float(rng.integers(1, 2000)) / 100
    rows = [(p, i, s) for i, (p, s) in enumerate(pieces.items())]
    words = sorted({"".join(rng.choice(list("abcdz"), int(rng.integers(1, 9)))) for _ in range(80)})
    units = spark.createDataFrame([(w,) for w in words], "unit string")
    edges = lattice.lattice(units, lattice.piece_table(spark, rows), 4)
    found = edges.withColumn("bounds", lattice.viterbi_path(F.col("unit"), F.col("edges"))).collect()
    for r in found:
        worst = min((e.score for e in r.edges), default=0.0) - lattice.UNKNOWN_PENALTY
        cut = [r.unit[a:b] for a, b in zip(r.bounds, r.bounds[1:], strict=False)]
        assert "".join(cut) == r.unit
        assert sum(pieces.get(c, worst) for c in cut) == pytest.approx(brute_viterbi(r.unit, pieces, worst)[0])


def test_sentencepiece_edges(edge, empty):
    library = lattice._processor(lattice.MODEL)
    found = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in lattice.encoded_digest(edge).collect())
    ids = [(i, np.array(library.encode(t or ""), "<u4")) for i, t in EDGE]
    assert found == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    assert lattice.encoded_digest(empty).count() == 0


# ---- 6 quality rules ------------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_letter_words": sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in x) for x in w),
        "n_upper": sum("A" <= c <= "Z" for c in text),
        "n_letters": sum(c.isascii() and c.isalpha() for c in text),
    }


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_quality_ledger(request, table):
    frame = request.getfixturevalue(table)
    want = Counter((r.doc_id, *brute_measures(r.text).values()) for r in frame.collect())
    book = quality_rules.ledger(frame)
    assert want == Counter(tuple(r[c] for c in ("doc_id", *quality_rules.MEASURES)) for r in book.collect())
    for r in quality_rules.apply_policy(book).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_lines_at_text_borders(spark):
    texts = ["a\na\n", "a", "\n\na\n \nb\na", "", None, "x y\n", "x y", "\n", "a\r\na\r\n", " a\na"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: (r.n_lines, r.n_dup_lines) for r in quality_rules.ledger(frame).collect()}
    for i, t in enumerate(texts):
        m = brute_measures(t)
        assert found[i] == (m["n_lines"], m["n_dup_lines"]), t


def test_quality_ablation(docs, empty):
    book = quality_rules.ledger(docs)
    bits = [r.failures for r in book.collect()]
    for r in quality_rules.ablation(book).collect():
        policy = quality_rules.mask(quality_rules.POLICIES[(r.policy, r.version)])
        rule = quality_rules.mask((r.rule,))
        assert r.fails == sum(b & rule != 0 for b in bits)
        assert r.fails_alone == sum(b & policy == rule for b in bits)
        assert r.kept == sum(b & policy == 0 for b in bits)
        assert r.kept_without == sum(b & policy & ~rule == 0 for b in bits)
    assert quality_rules.ledger(empty).count() == 0 and quality_rules.ablation(quality_rules.ledger(empty)).count() == 0


# ---- 7, 8, 9 tokens -------------------------------------------------------------------------------------------


def library_ids(name, texts):
    return [e.ids for e in tokens.library(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


HARD = [
    "a  b", " a", "a ", "a \n b", "a\n\n b", "a\nb", "\na", "a\n", "a\n b c\nd.", "ÀÖ×ØÞßÿ ÉÈ", "a\0b", "\0", " ", "\ta\tb", "it's we'll I'M", "x y", "x y", "é́", "ﬁ Ⅷ ½", "İstanbul",
    "<|endoftext|>", "a <|startoftext|> b", "<|", "漢字 かな", "🙂 ok", "\x1c\x1d a", "\x85", "a" * 300, "1234567 89", "...!!! ???", "",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_table_encoding_equals_library(name, rows):
    texts = HARD + [r.text for r in rows[:200]] + [None, ""]
    want = library_ids(name, texts)
    for limit in (20_000, 1 << 16):
        coder = tokens.Coder(name, pieces=limit)
        for _ in range(2):
            ids, off = coder.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == want
            assert coder.count(pa.array(texts)).tolist() == list(map(len, want))


ATOMS = [*" \n\t\r\x0b\x0c\x1c\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u205f\u3000\ufeff\0", "  ", "\n\n", "<|endoftext|>", "<|ENDOFTEXT|>",
         "<|", "'s", "a", "Zb", "\u0301", "é", "É", "ß", "İ", "ΑΣ", "漢字", "かな。", "、", "🙂", "‘q’", "—", "½", "12", ".", "क्", "ﬁ", "x" * 201, "ö" * 150]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_mixture_of_characters_equals_library(name):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randrange(15))) for _ in range(4000)]
    coder = tokens.Coder(name)
    ids, off = coder.encode(pa.array(texts))
    want = library_ids(name, texts)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == want
    assert coder.count(pa.array(texts)).tolist() == list(map(len, want))


def test_odd_characters_leave_the_other_pieces_in_the_table():
    text = "First line.\n\nSecond “line” with  two blanks — and\ttabs 漢字 here"
    pieces = tokens.Pieces("byte_bpe_50k.json", pa.array([text, "x" * 500 + " y"]))
    assert len(pieces.start) == len(text.split()) + 2 and pieces.long.tolist() == [len(text.split())]


def test_summary_bounds_its_error(rows):
    summary, seen = token_counts.Summary(counters=300), Counter()
    for at in range(0, len(rows), 7):
        pieces = tokens.Pieces("byte_bpe_50k.json", pa.array([r.text for r in rows[at : at + 7]], pa.string()))
        seen.update(t for t, n in zip(pieces.text(np.arange(len(pieces.start))), pieces.end - pieces.start) if n <= tokens.LONGEST)
        summary.add(pieces)
        assert len(summary.hash) <= 300
    found, error = dict(zip(summary.text, summary.count.tolist())), seen.total() / 301
    assert all(seen[t] - error <= found.get(t, 0) <= seen[t] for t in seen)
    assert set(found) <= set(seen)


def test_frequent_pieces_come_from_all_texts(docs):
    late = docs.unionByName(docs.limit(300).withColumn("text", F.concat(F.repeat(F.lit("x "), 3000), F.repeat(F.lit(" rareatfirst"), 40))))
    table = token_counts.frequent_counts(late, n=50)
    pieces = tokens.Pieces("byte_bpe_50k.json", pa.array(["x rareatfirst"]))
    assert (table.find(pieces.hash[1:], pieces.check[1:]) >= 0).all() and table.rows <= 50


def test_piece_table_starts_again_when_full(rows):
    coder = tokens.Coder("byte_bpe_50k.json", pieces=3_000)
    for r in rows[:60]:
        ids, _ = coder.encode(pa.array([r.text]))
        assert ids.tolist() == library_ids("byte_bpe_50k.json", [r.text])[0]
        assert coder.table.rows <= max(3_000, len(set(r.text.split())) * 2)


def test_piece_table_with_many_collisions():
    table = tokens.PieceTable(64)
    keys = (np.arange(1, 61, dtype=np.uint64) << np.uint64(40)) | np.uint64(1)  # all want the same few slots
    table.add(keys, keys + np.uint64(1), np.arange(60, dtype=np.int32))
    assert table.count[table.find(keys, keys + np.uint64(1))].tolist() == list(range(60))
    assert (table.find(keys, keys) == -1).all()


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_token_counts(request, table):
    frame = request.getfixturevalue(table)
    all_rows = frame.collect()
    ids = library_ids("byte_bpe_50k.json", [r.text for r in all_rows])
    want = Counter((r.doc_id, len((r.text or "").encode()), len(x), len(x) > 512) for r, x in zip(all_rows, ids, strict=True))
    assert want == Counter(tuple(r) for r in token_counts.count_tokens(frame).collect())


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_wavelet_files(request, table):
    frame = request.getfixturevalue(table)
    all_rows = frame.collect()
    ids = [np.array([*x, 1], "<u4") for x in library_ids("word_bpe_49k.json", [r.text for r in all_rows])]
    found = sorted(wavelet.wavelet_round_trip(frame).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, len(x), zlib.crc32(x.tobytes())) for r, x in zip(all_rows, ids, strict=True)) == Counter(
        (r.doc_id, r.n_tokens, r.ids_crc32) for r in found
    )
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -1 for r in found]
    assert order == sorted(order)


def test_wavelet_access_rank_select():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.zipf(1.3, n).clip(0, 49407).astype(np.uint32)
        w = wavelet.Wavelet(wavelet.encode(ids))
        assert (w.decode() == ids).all()
        for i in {0, n // 2, n - 1} & set(range(n)):
            assert w[i] == ids[i]
        for token in (1, 2, 9, 40000, 70000):
            places = np.flatnonzero(ids == token)
            assert w.count(token) == len(places) and w.rank(token, n // 3) == (places < n // 3).sum()
            for k in (0, len(places) // 2, len(places) - 1):
                assert w.select(token, k) == (places[k] if 0 <= k < len(places) else -1)
            assert w.select(token, len(places)) == -1


@pytest.mark.parametrize("shards", [1, 5])
def test_written_shards_answer_access_count_and_occurrences(spark, docs, rows, empty, tmp_path, shards):
    ids = np.concatenate([[*x, wavelet.END] for x in library_ids("word_bpe_49k.json", [r.text for r in rows])])
    path = str(tmp_path / "shards")
    wavelet.write_shards(docs, path, shards=shards)
    assert spark.read.parquet(path).count() > 1  # several blocks
    values, times = np.unique(ids, return_counts=True)
    for token in (int(values[times.argmax()]), int(values[times.argmin()]), wavelet.END, 70_000):
        assert wavelet.count(spark, path, token) == (ids == token).sum()
        found = sorted(r.place for r in wavelet.occurrences(spark, path, token).collect())
        assert found == np.flatnonzero(ids == token).tolist()
    places = [0, 0, len(ids) - 1, len(ids), -1, *range(7, len(ids), 4999)]
    asked = spark.createDataFrame([(p,) for p in places], "place long")
    want = Counter((p, int(ids[p]) if 0 <= p < len(ids) else None) for p in places)
    assert Counter((r.place, r.token) for r in wavelet.token_at(spark, path, asked).collect()) == want
    wavelet.write_shards(empty, f"{path}-empty", shards=shards)
    assert wavelet.count(spark, f"{path}-empty", 1) == wavelet.occurrences(spark, f"{path}-empty", 1).count() == 0


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_packing(request, table):
    frame = request.getfixturevalue(table)
    all_rows = frame.collect()
    pieces = packing.pack(frame).collect()
    whole = Counter((r.doc_id, np.array([*x, 0], "<u4").tobytes()) for r, x in zip(all_rows, library_ids("byte_bpe_50k.json", [r.text for r in all_rows]), strict=True))
    if table == "docs":  # unique ids: pieces put together again are the documents
        parts = defaultdict(dict)
        for p in pieces:
            parts[p.doc_id][p.start] = bytes(p.ids)
        assert whole == Counter((d, b"".join(x[s] for s in sorted(x))) for d, x in parts.items())
    assert sum(p.length for p in pieces) == sum(len(x) // 4 * n for (_, x), n in whole.items())
    sequences = defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and 4 * p.length == len(p.ids)
        sequences[p.sequence_id].append((p.offset, p.length, p.sequence_length))
    for s in sequences.values():
        at = 0
        for offset, length, total in sorted(s):
            assert offset == at
            at += length
        assert at == total and total <= 1024 and total & (total - 1) == 0  # no padding at all
    assert np.mean([s[0][2] for s in sequences.values()]) > 100


def test_packing_balances_steps():
    sizes = [1024] * 50 + [512] * 30 + [256] * 21 + [128] * 9
    groups = packing.step_groups(sizes, 4096)
    load = Counter()
    for g, s in zip(groups, sizes, strict=True):
        load[g] += s
    assert sorted(load.values())[1:] == [4096] * (len(load) - 1)


def test_step_groups_go_on_from_window_to_window(spark, rows):
    texts = [(i, r.text) for i, r in enumerate(rows * 2)]  # several windows in one partition
    frame = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    load, size = Counter(), {}
    for p in packing.pack(frame, with_ids=False).collect():
        load[p.step_group] += p.length
        size.setdefault(p.sequence_id, (p.step_group, p.sequence_length))
        assert size[p.sequence_id][0] == p.step_group
    assert sum(n for _, n in size.values()) == sum(load.values())
    assert sorted(load) == list(range(len(load))) and len(load) > 3
    assert all(load[g] == packing.STEP for g in range(len(load) - 1)) and load[len(load) - 1] <= packing.STEP


def test_token_operators_on_empty_tables(empty):
    for found in (token_counts.count_tokens(empty), wavelet.wavelet_round_trip(empty), packing.pack(empty)):
        assert found.count() == 0


# ---- 10 language ID -------------------------------------------------------------------------------------------


def test_language_id_on_held_out_rows(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = langid.identify(frame, langid.learn(frame)).join(frame.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in found if held(r.doc_id)]
    assert sum(r.lang_pred == r.lang for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 for r in found)


def test_profiles_equal_bundled_ngrams():
    letters = langid._letter_vectors(64).astype(int)
    for text in ("Ab c", "éÉ-x", "a", "", "漢字 ab", "  x  "):
        s = langid.symbols(text)
        want = np.zeros(64, int)
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            want += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        assert (langid.profiles(["zz", text, None], 64)[1] == want).all()


def test_floors_equal_brute_force(docs):
    model = langid.learn(docs)
    found = {}
    for r in docs.collect():
        if held(r.doc_id) or r.lang is None or not r.text:
            continue
        s, own = langid.symbols(r.text), model.languages.index(r.lang)
        for size in langid.SIZES:
            n = 2**size + 2
            if len(s) < n:
                break
            at = zlib.crc32(r.text.encode()) % (len(s) - n + 1)
            cut = s[at : at + n]
            times = Counter(zip(cut, cut[1:], cut[2:], strict=False))
            effective = sum(times.values()) ** 2 / sum(c * c for c in times.values())
            bundle = langid.bundles([cut])[0][0].astype(float)
            cosine = float(bundle @ model.vectors[own] / np.linalg.norm(bundle))
            inside = [k for k, m in enumerate(langid.SIZES) if 2**m <= effective]
            if inside:
                found.setdefault((own, inside[-1]), []).append(cosine)
    want = np.zeros((len(model.languages), len(langid.SIZES)))
    for key, cosines in found.items():
        if len(cosines) >= langid.LEAST:
            mean = np.mean(cosines)
            want[key] = max(0, min(mean - langid.DEVIATIONS * np.std(cosines, ddof=1), langid.SHARE * mean))
    assert want.any() and np.allclose(langid.learn_floors(docs, model), want, atol=1e-4)


UNLEARNED = [  # Italian, Dutch, Turkish, no language
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti essi sono dotati di ragione e di coscienza e devono agire",
    "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren zij zijn begiftigd met verstand en geweten en behoren",
    "Bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik",
    "xq zvkw jrrpt qgh wzzk vlbq xjt pwkq zzrt hqvk xwpl qqjz kvwt zxrp bqhj wlkz qxv tjzk pqwr zhvx kjqb wxzt rqpl vkzj xhqw bzkq",
]


def test_language_floor_keeps_short_texts_and_repetitions(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.learn(frame)
    floors = langid.learn_floors(frame, model)

    def kept(texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return langid.keep_identified(rows, model, floors).count() / len(texts)

    words = [r.text.split() for r in frame.where("text is not null").limit(1500).collect()]
    for n in (1, 2, 3, 10, 40):
        texts = [" ".join(w[len(w) // 3 :][:n]) for w in words]
        texts = [t for t in texts if any(c.isalpha() for c in t)]
        assert kept(texts) >= (1 if n < 10 else 0.999)
    assert kept([f"{w[0]} " * 500 + w[-1] for w in words if w[0][0].isalpha()]) == 1  # a word said 500 times
    assert kept([x * k for x in UNLEARNED[2:] for k in (1, 5)]) == 0
    whole = langid.keep_identified(frame, model, floors)
    assert whole.count() >= 0.9995 * frame.where(F.col("text").rlike(r"\p{L}")).count()


def test_language_id_edges(edge, empty):
    model = langid.learn(edge)
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(edge, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "und"), (1, "en")} <= found
    assert langid.keep_identified(edge, model, langid.learn_floors(edge, model)).columns == edge.columns
    nothing = langid.learn(empty)
    assert langid.learn_floors(empty, nothing).shape == (0, len(langid.SIZES))
    assert langid.keep_identified(edge, nothing, langid.learn_floors(empty, nothing)).count() == 0
    assert {r.lang_pred for r in langid.identify(edge, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    done = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in done.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == Counter(done.fetchall())


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert isinstance(T.LongType(), T.DataType)
