"""Merkle manifest of a dataset, with proofs folded from retained SHA-256 midstates.

A row's *leaf* is the digest of its fields.  The leaves of a group (source) in order of their key form a tree: while several
nodes remain, every run of `ARITY` consecutive nodes becomes the digest of their digests in hex.  The groups' subroots, in
order of the group, form the top tree the same way.

*Midstates.*  A parent is hashed child by child; before each child slot its hash state is copied and kept.  To fold a
replaced child, the state of its slot is resumed with the replacement and with the siblings to its right; what stands to its
left is never hashed again.  States are kept as long as their block is in work; a block below another one gets the digests
on its way up once, and rebuilds the states of that way once for all its rows.

*Blocks.*  No group is ever in one task.  Leaves are numbered within their group by one range exchange (rows are cut
wherever a partition is full) and a small table of partition counts.  A block is `ARITY ** LEVELS` consecutive nodes, the
subtree of one node `LEVELS` levels up; a round of blocks makes the nodes of the next round, a few thousand times fewer, until
every group has one.  Going back down, each round's blocks meet the one row that holds their way to the root, so the way is
sent once for each block and not once for each row.  Texts are read once and hashed in the JVM; only digests are exchanged,
and every round is written to shared storage.

Defined edge cases: null fields are ``-``; a null group comes first; null keys come first, and rows with the same key are in
order of their leaf, then of what replaces it; a group of one row has that row's leaf as subroot, one group's subroot is the
root; a row without any sibling up to the root has the digest of the empty text as proof; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow, staged

ARITY = 3
#: Levels of a block: 3 ** 7 = 2187 nodes.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---- trees of one block (inside tasks) --------------------------------------------------------------------------


def levels_of(n: int, arity: int = ARITY) -> int:
    """Levels above n nodes: the least h with arity**h >= n."""
    h, room = 0, 1
    while room < n:
        h, room = h + 1, room * arity
    return h


class Block:
    """The tree over consecutive nodes (digests in hex), `levels` high, with the states before every child slot."""

    def __init__(self, nodes: list[bytes], levels: int, arity: int = ARITY):
        self.arity = arity
        self.rows = [nodes]
        self.states: list[list] = []  # of a level, by child: the parent's state before it
        for _ in range(levels):
            below, states, parents = self.rows[-1], [], []
            for at in range(0, len(below), arity):
                h = hashlib.sha256()
                for child in below[at : at + arity]:
                    states.append(h.copy())
                    h.update(child)
                parents.append(h.hexdigest().encode())
            self.states.append(states)
            self.rows.append(parents)

    @property
    def top(self) -> bytes:
        return self.rows[-1][0]

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """(digests to the left, digests to the right) of a node and of its ancestors, level by level."""
        out = []
        for row in self.rows[:-1]:
            first = at - at % self.arity
            out.append((b"".join(row[first:at]), b"".join(row[at + 1 : first + self.arity])))
            at //= self.arity
        return out

    def fold(self, at: int, node: bytes) -> bytes:
        """The top with another node at a place."""
        for row, states in zip(self.rows[:-1], self.states, strict=True):
            h = states[at].copy()
            h.update(node)
            h.update(b"".join(row[at + 1 : at - at % self.arity + self.arity]))
            node = h.hexdigest().encode()
            at //= self.arity
        return node


class Way:
    """The way from a node to the root: siblings of every level, and the states before the node's slots."""

    def __init__(self, left: list[bytes], right: list[bytes]):
        self.right = right
        self.text = b"".join(a + b for a, b in zip(left, right, strict=True))
        self.states = [hashlib.sha256(a) for a in left]

    def fold(self, node: bytes) -> bytes:
        for state, right in zip(self.states, self.right, strict=True):
            h = state.copy()
            h.update(node)
            h.update(right)
            node = h.hexdigest().encode()
        return node


# ---- leaves -----------------------------------------------------------------------------------------------------


def encoded(value: Column) -> Column:
    """`-` for null, else byte count, colon and text of a field."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def tampered_here(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 2 == 0, F.lit(False))


# ---- Spark ------------------------------------------------------------------------------------------------------


def numbered(nodes: DataFrame, group: str, order: list[str], names: DataFrame | None = None) -> DataFrame:
    """nodes with their place `pos` in their group (from 0) and its size `n`; no group is in one task.

    `names` (group, more columns) adds its columns; it meets the small table of counts, not the rows.
    """
    rule = [F.col(c).asc_nulls_first() for c in (group, *order)]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, *rule).sortWithinPartitions(*rule)
    # Written once: partition and place in it are settled before anything is counted.
    ranged = staged(ranged.withColumn("__at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    counts = ranged.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__p")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )  # a row for each partition and each group at most
    along = Window.partitionBy("__group").orderBy("__p")
    before = F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")
    total = F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counts = counts.select("__group", "__p", (before - F.col("__first")).alias("__base"), total.alias("n"))
    if names is not None:
        names = names.withColumnRenamed(group, "__name")
        counts = counts.join(names, F.col("__group").eqNullSafe(F.col("__name"))).drop("__name")
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__p"))
    return ranged.join(counts, same).withColumn("pos", F.col("__at") + F.col("__base")).drop(
        "__at", "__part", "__group", "__p", "__base"
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one block (`gid`, `block`), of batches sorted by them; a block has ARITY**LEVELS rows and one at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gid, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("gid", "block"))
        if held:
            last = held[-1]
            end = last.num_rows - 1
            if (last.column("gid")[end].as_py(), last.column("block")[end].as_py()) != (gid[0], block[0]):
                yield pa.Table.from_batches(held)
                held = []
        edges = np.flatnonzero((gid[1:] != gid[:-1]) | (block[1:] != block[:-1])) + 1
        at = 0
        for to in edges.tolist():
            yield pa.Table.from_batches([*held, batch.slice(at, to - at)])
            held, at = [], to
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a block side by side, the block's way first (pos -1), then its nodes in order."""
    return rows.repartition("gid", "block").sortWithinPartitions("gid", "block", "pos")


def _height(n: int, done: int, levels: int) -> int:
    return max(0, min(levels, levels_of(n) - done))


def _hex(column: pa.ChunkedArray) -> list[bytes]:
    return [v.hex().encode() for v in column.to_pylist()]


def _up(done: int, levels: int):
    """Blocks of a round to nodes of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            n = rows["n"][0].as_py()
            top = Block(_hex(rows["digest"]), _height(n, done, levels)).top
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows["gid"][0].as_py()], pa.int64()), pa.array([rows["block"][0].as_py()], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([bytes.fromhex(top.decode())], pa.binary())],
                names=["gid", "pos", "n", "digest"],
            )

    return run


_WAY = "left array<binary>, right array<binary>"


def _ways(done: int, levels: int):
    """The way to the root of every node of a round: up to its block's top, then on from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            left, right, nodes = _above(rows)
            block = Block(_hex(nodes["digest"]), _height(nodes["n"][0].as_py(), done, levels))
            pairs = [block.siblings(at) for at in range(nodes.num_rows)]
            kind = pa.list_(pa.binary())
            lefts = pa.array([[a for a, _ in p] + left for p in pairs], kind)
            rights = pa.array([[b for _, b in p] + right for p in pairs], kind)
            columns = [nodes[c].combine_chunks() for c in ("gid", "pos")] + [lefts, rights]
            yield pa.RecordBatch.from_arrays(columns, names=["gid", "pos", "left", "right"])

    return run


def _rows(root: bytes, levels: int, key: str):
    """The result rows of a block of leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            subroot = rows["subroot"][0].as_py()
            left, right, nodes = _above(rows)
            leaves = _hex(nodes["digest"])
            block, way = Block(leaves, _height(nodes["n"][0].as_py(), 0, levels)), Way(left, right)
            proofs, folded = [], []
            for at, changed in enumerate(nodes["tampered"].to_pylist()):
                proof = hashlib.sha256(b"".join(a + b for a, b in block.siblings(at)))
                proof.update(way.text)
                proofs.append(proof.hexdigest())
                folded.append(way.fold(block.fold(at, changed.hex().encode() if changed else leaves[at])).decode())
            text = root.hex()
            many = [pa.array(c, pa.string()) for c in ([v.decode() for v in leaves], [subroot.hex()] * len(leaves),
                                                       [text] * len(leaves), proofs, folded)]
            yield pa.RecordBatch.from_arrays(
                [nodes["key"].combine_chunks(), *many, pa.array([f == text for f in folded])],
                names=[key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return run


def _above(rows: pa.Table) -> tuple[list[bytes], list[bytes], pa.Table]:
    """Left and right siblings above a block, from its first row, and its nodes."""
    return rows["left"][0].as_py(), rows["right"][0].as_py(), rows.slice(1)


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(ARITY**levels)).cast("long"))


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The nodes (gid, pos, n, digest) of every round; in the last one every gid has one."""
    rounds = [nodes]
    highest = levels_of(nodes.agg(F.max("n")).first()[0] or 0)
    for done in range(0, highest, levels):
        dealt = _dealt(_with_block(rounds[-1].select("gid", "pos", "n", "digest"), levels))
        rounds.append(staged(dealt.transform(map_arrow, _up(done, levels), "gid long, pos long, n long, digest binary")))
    return rounds


def _meet(nodes: DataFrame, ways: DataFrame, levels: int) -> DataFrame:
    """Nodes, and before those of a block the way (gid, pos, left, right, ...) of the node above them."""
    head = ways.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))
    return _dealt(_with_block(nodes, levels).unionByName(head, allowMissingColumns=True))


def _ways_of(nodes: DataFrame, ways: DataFrame, done: int, levels: int) -> DataFrame:
    dealt = _meet(nodes.select("gid", "pos", "n", "digest"), ways, levels)
    return staged(dealt.transform(map_arrow, _ways(done, levels), f"gid long, pos long, {_WAY}"))


def descend(rounds: list[DataFrame], ways: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The ways of the tops of the first round's blocks, from those of the last round's nodes."""
    for at in range(len(rounds) - 2, 0, -1):
        ways = _ways_of(rounds[at], ways, at * levels, levels)
    return ways


def manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             text: str = "text", levels: int = LEVELS) -> DataFrame:
    """One row per row of docs: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proof is the digest of all siblings' digests, level by level up to the root, left to right.  Where 2 divides the
    crc32 of the key's text, the folded leaf is one of the row with all line feeds deleted from its text.
    """
    spark = docs.sparkSession
    result = (f"{key} {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string, verified boolean")
    damaged = [F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == text else F.col(f) for f in fields]
    leaves = staged(
        docs.select(
            F.col(group).cast("string").alias("group"),
            F.col(key).alias("key"),
            F.unhex(leaf(*[F.col(f) for f in fields])).alias("digest"),
            F.when(tampered_here(F.col(key)), F.unhex(leaf(*damaged))).alias("tampered"),
        )
    )
    # The groups' places in their order are the places of the top tree's leaves, and stand for the groups below.
    groups = leaves.select("group", F.lit(0).cast("long").alias("top")).distinct()
    groups = staged(numbered(groups, "top", ["group"]).select("group", F.col("pos").alias("gid"), F.col("n").alias("groups")))
    placed = staged(
        numbered(leaves, "group", ["key", "digest", "tampered"], groups).select("gid", "pos", "n", "groups", "key", "digest", "tampered")
    )
    rounds = climb(placed, levels)
    subroots = rounds[-1].select("gid", F.col("digest").alias("subroot"))
    tops = groups.select("gid", "groups").join(subroots, "gid").select(
        F.lit(0).cast("long").alias("gid"), F.col("gid").alias("pos"), F.col("groups").alias("n"), F.col("subroot").alias("digest")
    )
    tops = climb(staged(tops), levels)
    root = tops[-1].select("digest").first()  # one digest
    if root is None:
        return spark.createDataFrame([], result)
    end = tops[-1].select("gid", "pos", *[F.array().cast("array<binary>").alias(c) for c in ("left", "right")])
    ways = _ways_of(tops[0], descend(tops, end, levels), 0, levels)
    ways = ways.select(F.col("pos").alias("gid"), F.lit(0).cast("long").alias("pos"), "left", "right")
    ways = descend(rounds, ways, levels).join(subroots, "gid")
    dealt = _meet(placed.select("gid", "pos", "n", "key", "digest", "tampered"), ways, levels)
    return dealt.transform(map_arrow, _rows(bytes(root.digest), levels, key), result)
