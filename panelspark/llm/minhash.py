"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset overlap.

Two texts are linked when the weighted Jaccard similarity of their bags of five-word windows
(``sum(min counts) / sum(max counts)``) is at least ``threshold``; a class is a connected component of links.

1. *Signatures* (`signatures`, one map-side pass, no shuffle of text).  Each window's count is a weight on the
   integer grid.  The weight axis is cut into dyadic nodes [0,1) [1,2) [2,4) [4,8) ...; every (window, node) has
   its own Poisson process over (time, weight, register) seeded by its hash.  A point counts when its weight
   coordinate lies below the count, so a register's first point is shared by two bags with probability equal to
   their weighted Jaccard similarity.  Times are produced in ascending order and stop at a bound below which
   every register is filled: most windows cost one hash and one comparison.
2. *Exact copies* collapse onto one node per distinct text (two 64-bit hashes, 125 bits kept), so a group of
   copies of any size costs one node afterwards.
3. *Banding*: ``BANDS`` bands of ``ROWS`` registers.  At similarity 0.8 a pair misses every band with
   probability (1 - 0.8**5)**30 = 7e-6.
4. *Stars*: each bucket links its members to its smallest node; stars are verified and merged into components.
5. *Clusters*: only buckets that still hold several components go on.  Their nodes get their signatures once each; then
   a bucket's members are cut into blocks of about `TILE`, and two blocks meet in a tile, a bounded group of rows.  A tile
   compares signatures across components and names, for every member with a possible partner (``threshold - 5 sigma`` of
   the registers agree), one member of its connected part: one row a member, not one a pair.  The parts of all tiles make
   clusters of nodes that may be linked.
6. *Links*: a cluster's nodes get their signatures and texts once each, however many buckets they share.  Blocks of about
   `TEXT_TILE` meet in tiles as before; a tile verifies its possible pairs, likeliest first, and returns the links that join
   components.  All pairs are decided; no pairs are ever written.
7. *Verification* rehashes both texts and compares whole multisets.  The texts of nodes that share a bucket with
   another are fetched once, in one shuffle.

Defined edge cases: null, empty and blank texts have no window, are never duplicates, and form classes of one
row (class_id = their doc_id).  Texts of one to four words have one window, the whole text.  Equal texts are
always one class, also with equal or null doc_id (null is ignored by the minimum).  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow, staged
from panelspark.llm.words import U64, mix, shingles, slices, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 30
ROWS = 5
REGISTERS = BANDS * ROWS
#: Members of a bucket that stand on one side of a tile of signatures, on average, and of a tile of texts.
TILE = 1024
TEXT_TILE = 256
NODE = "decimal(38,0)"


# ---- BagMinHash (numpy, inside tasks) -------------------------------------------------------------------------


def bag(words: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window hashes of a text and their counts."""
    return np.unique(shingles(words, n), return_counts=True)


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1) from 53 bits."""
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """One row of m registers for every non-empty bag (first point of each register, as 64-bit patterns)."""
    sizes = np.array([len(h) for h, _ in bags])
    doc = np.repeat(np.arange(len(bags)), sizes)
    key = np.concatenate([h for h, _ in bags])
    count = np.concatenate([c for _, c in bags]).astype(np.int64)
    total = np.bincount(doc, weights=count, minlength=len(bags))

    # Processes: dyadic node 0 is [0, 1); node k is [2**(k-1), 2**k).  Only nodes that start below the count.
    seeds, owners, low, size, weight = [], [], [], [], []
    node = 0
    while len(key):
        begin = 0 if node == 0 else 1 << (node - 1)
        keep = count > begin
        key, doc, count = key[keep], doc[keep], count[keep]
        seeds.append(mix(key + U64(0x9E3779B97F4A7C15 * (node + 1) % 2**64)))
        owners.append(doc)
        low.append(np.full(len(key), begin, np.int64))
        size.append(np.full(len(key), max(begin, 1), np.int64))
        weight.append(count)
        node += 1
    state, owner, low, size, weight = map(np.concatenate, (seeds, owners, low, size, weight))

    first = np.full(len(bags) * m, np.inf)
    bound = (np.log(m) + 2.0) / total  # of the time scale of each bag
    rate = m * size.astype(np.float64)
    state = mix(state + U64(1))
    time = -np.log(_unit(state)) / rate
    while True:
        live = np.flatnonzero(time <= bound[owner])
        while len(live):
            s = state[live]
            place = mix(s ^ U64(0xA0761D6478BD642F))
            at = (low[live] + ((place >> U64(32)).astype(np.int64) * size[live] >> 32)) < weight[live]
            slot = owner[live] * m + ((place & U64(0xFFFFFFFF)) * U64(m) >> U64(32)).astype(np.int64)
            np.minimum.at(first, slot[at], time[live][at])
            state[live] = s = mix(s + U64(0xD6E8FEB86659FD93))
            time[live] -= np.log(_unit(s)) / rate[live]
            live = live[time[live] <= bound[owner[live]]]
        open_ = np.isinf(first.reshape(-1, m)).any(axis=1)
        if not open_.any():
            return first.view(np.uint64).reshape(-1, m)
        bound[open_] *= 2.0
        left = open_[owner]
        state, owner, low, size, weight, rate, time = (x[left] for x in (state, owner, low, size, weight, rate, time))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of smaller counts, sum of larger counts) of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common, int(a[1].sum() + b[1].sum()) - common


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words, first = word_hashes(part.column("text"))
            bags = [bag(words[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            full = [i for i, b in enumerate(bags) if len(b[0])]
            if not full:
                continue
            part = part.take(pa.array(full))
            regs = mix(bag_signatures([bags[i] for i in full]))
            band = np.zeros((len(full), BANDS), np.uint64)
            for r in range(ROWS):
                band = mix(band * U64(0xD1342543DE82EF95) + regs[:, r::ROWS] + U64(r))
            band = mix(band + np.arange(BANDS, dtype=np.uint64))
            ends = np.arange(0, len(full) + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("h1"),
                    part.column("h2"),
                    pa.ListArray.from_arrays(pa.array(ends * BANDS, pa.int32()), pa.array(band.view(np.int64).ravel())),
                    pa.ListArray.from_arrays(
                        pa.array(ends * REGISTERS, pa.int32()),
                        pa.array((regs >> U64(32)).astype(np.uint32).view(np.int32).ravel()),
                    ),
                ],
                names=["doc_id", "h1", "h2", "bands", "sig"],
            )


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b"):
                seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}

                def bags(column: str, part=part, seen=seen):
                    words, first = word_hashes(part.column(column))
                    for i, t in enumerate(part.column(column).to_pylist()):
                        if t not in seen:
                            seen[t] = bag(words[first[i] : first[i + 1]])
                        yield seen[t]

                linked = []
                for x, y in zip(list(bags("text_a")), list(bags("text_b")), strict=True):
                    low, high = similarity(x, y)
                    linked.append(low >= threshold * high - 1e-9)
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, of rows sorted by them."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        if open_ and last != tuple(c[0] for c in columns):
            yield pa.Table.from_batches(open_)
            open_ = []
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for at, to in zip(edges[:-2], edges[1:-1], strict=True):
            yield pa.Table.from_batches([*open_, batch.slice(at, to - at)])
            open_ = []
        open_.append(batch.slice(edges[-2]))
        last = tuple(c[-1] for c in columns)
    if open_:
        yield pa.Table.from_batches(open_)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for c in column.chunks])


def tile_pairs(group: pa.Table, need: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (x, y) of a tile that may be links across components, and the registers in which they agree, in pieces.

    A tile of two blocks compares across them, a tile of one block within it.
    """
    sig = _matrix(group["sig"], REGISTERS)
    _, comp = np.unique(np.array([str(c) for c in group["comp"].to_pylist()]), return_inverse=True)
    block = group["block"].to_numpy()
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    step = max(1, (1 << 23) // (max(1, len(right)) * REGISTERS))
    for at in range(0, len(left), step):
        rows, others = left[at : at + step], right if i != j else right[at:]
        agree = (sig[rows, None, :] == sig[None, others, :]).sum(axis=2)
        x, y = np.nonzero(agree >= need)
        many = agree[x, y]
        x, y = rows[x], others[y]
        keep = (comp[x] != comp[y]) & ((i != j) | (x < y))
        yield x[keep], y[keep], many[keep]


_TILE_KEYS = ("bucket", "i", "j")


def parts(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest member of the connected part of each of n members under the pairs (x, y)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        np.minimum.at(new, low[x], new[x])  # a part's former smallest member hears of a smaller one
        np.minimum.at(new, low[y], new[y])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _possible(need: int):
    """(a, b) for every member of a tile with a possible partner: b stands for its connected part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, _TILE_KEYS):
            low = np.arange(group.num_rows)
            for x, y, _ in tile_pairs(group, need):
                low = low[parts(len(low), low[x], low[y])] if len(x) else low
            at = np.flatnonzero(low != np.arange(len(low)))
            if len(at):
                nodes = group["node"].combine_chunks()
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(at)), nodes.take(pa.array(low[at]))], names=["a", "b"])

    return run


def _tile_links(need: int, threshold: float):
    """Links of a tile that join components, verified on the whole texts, likeliest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, _TILE_KEYS):
            found = [p for p in tile_pairs(group, need) if len(p[0])]
            if not found:
                continue
            x, y, agree = (np.concatenate(c) for c in zip(*found, strict=True))
            words, first = word_hashes(group["text"].combine_chunks())
            bags = [bag(words[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            weight = np.array([b[1].sum() for b in bags])
            comps = group["comp"].to_pylist()
            root: dict = {c: c for c in comps}

            def find(c, root=root):
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            links = []
            for k in np.lexsort((y, x, -agree)):
                a, b = int(x[k]), int(y[k])
                if min(weight[a], weight[b]) < threshold * max(weight[a], weight[b]) - 1e-9:
                    continue
                ra, rb = find(comps[a]), find(comps[b])
                if ra == rb:
                    continue
                low, high = similarity(bags[a], bags[b])
                if low >= threshold * high - 1e-9:
                    root[ra] = rb
                    links.append((a, b))
            if links:
                nodes = group["node"].combine_chunks()
                a, b = (nodes.take(pa.array([link[k] for link in links])) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return run


# ---- Spark ----------------------------------------------------------------------------------------------------


def _node(h1=None, h2=None):
    """125 bits of two hashes of the text as one decimal: its identity, and a key that hash aggregates can hold."""
    h1 = F.xxhash64("text") if h1 is None else F.col(h1)
    h2 = F.xxhash64(F.lit("panelspark"), "text") if h2 is None else F.col(h2)
    wide = h1.cast(NODE) * F.lit(2**62).cast("decimal(20,0)") + h2.bitwiseAND(F.lit(2**62 - 1)).cast(NODE)
    return wide.cast(NODE)


def _node_of_words():
    """The node of a text that has a word, else null."""
    return F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), _node())


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, node, bands, sig) of every document that has a word."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where("text is not null").select(
        "doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("panelspark"), "text").alias("h2")
    )
    rows = rows.transform(map_arrow, _sign, f"doc_id {kind}, h1 long, h2 long, bands array<long>, sig array<int>")
    return rows.select("doc_id", _node("h1", "h2").alias("node"), "bands", "sig")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the undirected edges (a, b); comp is the component's smallest node.

    Alternating large-star and small-star rounds: logarithmically many, each two aggregations with map-side
    combine and two joins that adaptive execution can split; every round is written to shared storage.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        ).select("col.*").where("u <> v").distinct()
        edges = staged(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.union(nodes.select("comp", "comp").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose whole multisets overlap enough."""
    full = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a"
    )
    return full.select("a", "b", "text_a", "text_b").transform(map_arrow, _verify(threshold), f"a {NODE}, b {NODE}")


def _tiles(members: DataFrame) -> DataFrame:
    """Members (bucket, blocks, node, ...) copied to the tiles of their bucket: a bucket of one block has one tile."""
    placed = members.withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")),
    )
    rest = [c for c in members.columns if c not in ("bucket", "blocks")]
    dealt = placed.withColumn("t", F.explode(meets)).select("bucket", "t.i", "t.j", "block", *rest)
    return dealt.repartition(*_TILE_KEYS).sortWithinPartitions(*_TILE_KEYS, "node")


def _blocks(size: int):
    return F.ceil(F.count("*") / size).cast("int").alias("blocks")


def _clusters(member: DataFrame, nodes: DataFrame, need: int) -> DataFrame:
    """(node, cluster): nodes of mixed buckets that may have a link to another component."""
    mixed = member.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), _blocks(TILE)).where("x <> y")
    # A node's buckets in one row: its signature is fetched once.
    held = member.join(mixed.select("bucket", "blocks"), "bucket").groupBy("node", "comp").agg(
        F.collect_list(F.struct("bucket", "blocks")).alias("held")
    )
    rows = held.join(nodes.select("node", "sig"), "node").select("node", "comp", "sig", F.explode("held").alias("at"))
    rows = rows.select("at.bucket", "at.blocks", "node", "comp", "sig")
    edges = staged(_tiles(rows).transform(map_arrow, _possible(need), f"a {NODE}, b {NODE}"))
    return connected_components(edges).select("node", F.col("comp").alias("cluster"))


def _links_across(member: DataFrame, comp: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join components which share a bucket."""
    need = max(0, int(np.ceil(REGISTERS * threshold - 5 * np.sqrt(REGISTERS * threshold * (1 - threshold)))))
    clusters = _clusters(member, nodes, need)
    size = clusters.groupBy("cluster").agg(_blocks(TEXT_TILE))
    rows = clusters.join(size, "cluster").select(F.xxhash64("cluster").alias("bucket"), "blocks", "node")
    rows = rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    full = rows.join(nodes.select("node", "sig"), "node").join(texts.hint("merge"), "node")
    return _tiles(full).transform(map_arrow, _tile_links(need, threshold), f"a {NODE}, b {NODE}")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, doc_id, comp, class_id) of every distinct text that has a word; doc_id: smallest of its documents."""
    signed = staged(signatures(docs))
    nodes = staged(
        signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    )
    rows = nodes.select(F.explode("bands").alias("bucket"), "node")
    heads = rows.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    crowded = staged(rows.join(heads, "bucket").select("bucket", "head", "node"))
    # The texts of all nodes that share a bucket, once for both verifications.  Their number has no bound, so the
    # join is a shuffle at every size.
    need = crowded.select("node").distinct().hint("merge")
    # Copies are reduced in the tasks that read them, before anything is exchanged.
    texts = docs.where("text is not null").select(_node().alias("node"), "text").groupBy("node").agg(F.first("text").alias("text"))
    texts = staged(texts.join(need, "node", "left_semi"))

    stars = crowded.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = staged(_verified(stars, texts, threshold))
    comp = staged(connected_components(links))

    member = crowded.join(comp, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    more = staged(_links_across(member, comp, nodes, texts, threshold))
    if not more.isEmpty():
        comp = staged(connected_components(links.union(more)))

    label = nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = label.groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    return staged(label.join(lowest, "comp").select("node", "doc_id", "comp", "class_id"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, node (identity of its text, null without a word), class_id (smallest doc_id)."""
    of_node = classes(docs, threshold).select("node", "class_id")
    own = docs.select("doc_id", _node_of_words().alias("node"))
    with_words = own.where("node is not null").join(of_node, "node", "left").select("doc_id", "node", "class_id")
    # Rows without a word have no node: they are classes of their own and meet in no task.
    return with_words.union(own.where("node is null").select("doc_id", "node", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class with all its columns; rows without a word all stay.

    The smallest doc_id stays (null last, then the smallest text identity; of rows equal in both, one).
    Copies of a text are reduced before the shuffle, so a large group of copies costs one row a task.
    """
    found = classes(docs, threshold)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    best = found.groupBy("comp").agg(F.min(order).alias("best")).select(F.col("best.node").alias("__node"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (
        docs.withColumn("__node", _node_of_words())
        .where("__node is not null")
        .groupBy("__node")
        .agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id")).alias("__row"))
        .join(best, "__node", "left_semi")
        .select("__row.*")
    )
    return one.unionByName(docs.where(_node_of_words().isNull()))
