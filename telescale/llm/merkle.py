"""A Merkle manifest of a table: one tree for each source, and a tree over their roots.

A node is the SHA-256 of its children's digests, taken as hex text; up to 16 consecutive nodes have a parent. Leaves
are cut into aligned subtrees of three levels (blocks of 4096 leaves). A block is built by one task and stored as one
row, its nodes in the van Emde Boas order: the upper half of the levels first, then each subtree of the lower half,
every part laid out in the same way. The roots of the blocks are the leaves of the next round, so a tree of any size
takes a few rounds, and no task holds more than a block. Proofs go down again: the siblings above a block are worked
out once for the block, those inside it are read from its layout.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.llm.places import numbered

FANOUT = 16
#: Levels of a block below its root.
HEIGHT = 3
DIGEST = 64
#: Digests left and right of a node among its siblings, one step for each level up to the root.
STEPS = "array<struct<left: string, right: string>>"


# --- leaves ----------------------------------------------------------------------------------------------


def field(column: str | Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else its length in bytes, a colon and the value."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*columns: str | Column) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def tree_key(source: str) -> Column:
    """A source as text that sorts as sources do, null first."""
    return F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(source)))


# --- the layout of a block ---------------------------------------------------------------------------------


def size(levels: int) -> int:
    """Nodes of a full subtree."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index):
    """Place of the nodes ``index`` of a depth in the layout of a subtree of ``levels`` levels."""
    at = 0 * index
    while levels > 1:
        top = (levels + 1) // 2
        if depth < top:
            levels = top
            continue
        width = FANOUT ** (depth - top)
        at = at + size(top) + index // width * size(levels - top)
        levels, depth, index = levels - top, depth - top, index % width
    return at


@lru_cache(maxsize=64)
def addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(FANOUT**depth))


def height_of(n: int) -> int:
    """Least height of a tree with ``n`` leaves."""
    height = 0
    while FANOUT**height < n:
        height += 1
    return height


@dataclass
class Block:
    """An aligned subtree: ``n`` leaves, ``height`` levels above them, nodes by address."""

    height: int
    n: int
    nodes: np.ndarray

    @classmethod
    def over(cls, leaves: Sequence[str], height: int) -> Block:
        block = cls(height, len(leaves), np.zeros(size(height + 1), f"S{DIGEST}"))
        block.nodes[addresses(height + 1, height)[:len(leaves)]] = np.array(leaves, f"S{DIGEST}")
        for depth in range(height - 1, -1, -1):
            for i in range(block.width(depth)):
                block.nodes[address(height + 1, depth, i)] = sha256(block.run(depth, i)).hexdigest()
        return block

    @classmethod
    def stored(cls, height: int, n: int, raw: bytes) -> Block:
        return cls(height, n, np.frombuffer(raw.hex().encode(), f"S{DIGEST}"))

    def raw(self) -> bytes:
        return bytes.fromhex(self.nodes.tobytes().replace(b"\0", b"0").decode())

    @property
    def root(self) -> str:
        return self.nodes[0].decode()

    def width(self, depth: int) -> int:
        return -(-self.n // FANOUT ** (self.height - depth))

    def run(self, depth: int, index: int) -> bytes:
        """Digests of the children of a node, one after the other."""
        first, last = FANOUT * index, min(FANOUT * index + FANOUT, self.width(depth + 1))
        return self.nodes[addresses(self.height + 1, depth + 1)[first:last]].tobytes()

    def steps(self):
        """For each leaf its siblings at each level, from the bottom to the block's root: (left, right)."""
        runs = {}
        for leaf in range(self.n):
            found, index = [], leaf
            for depth in range(self.height - 1, -1, -1):
                index, place = divmod(index, FANOUT)
                if (depth, index) not in runs:
                    runs[depth, index] = self.run(depth, index)
                run = runs[depth, index]
                found.append((run[:DIGEST * place], run[DIGEST * place + DIGEST:]))
            yield found


def fold(leaf: str, steps: Sequence[tuple[bytes, bytes]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in steps:
        leaf = sha256(left + leaf.encode() + right).hexdigest()
    return leaf


def proof_digest(steps: Sequence[tuple[bytes, bytes]]) -> str:
    return sha256(b"".join(left + right for left, right in steps)).hexdigest()


# --- rounds ------------------------------------------------------------------------------------------------


BLOCKS = "tree string, block long, n_blocks long, height int, n int, root string, nodes binary"


_BLOCK_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary())


def block_of(height: int) -> Column:
    """Which block of ``height`` levels a leaf is in."""
    return F.floor(F.col("place") / FANOUT**height).cast("long").alias("block")


def build(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The blocks of all trees, round by round, from leaves (tree, place, n_tree, digest)."""
    most = FANOUT**height

    def make(key, group):
        tree, block, n_tree = (k.as_py() for k in key)
        digests = group.sort_by("place")["digest"].to_pylist()
        made = Block.over(digests, height if n_tree > most else height_of(n_tree))
        row = (tree, block, -(-n_tree // most), made.height, made.n, made.root, made.raw())
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        return pa.table([pa.array([v], t) for v, t in zip(row, _BLOCK_TYPES, strict=True)], names)

    rounds = []
    while True:
        blocks = leaves.select("tree", block_of(height), "n_tree", "place", "digest")
        blocks = blocks.groupBy("tree", "block", "n_tree").applyInArrow(make, BLOCKS).checkpoint()
        rounds.append(blocks)
        open_blocks = blocks.filter("n_blocks > 1")
        if open_blocks.isEmpty():
            return rounds
        leaves = open_blocks.select(
            "tree", F.col("block").alias("place"), F.col("n_blocks").alias("n_tree"), F.col("root").alias("digest"))


PATHS = f"tree string, place long, steps {STEPS}, roots array<string>"


_STEPS_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _opened(blocks: DataFrame, height: int) -> DataFrame:
    """The leaves of blocks, each with the siblings on its way to the uppermost root."""

    def leaves(key, group):
        row = group.to_pylist()[0]
        above, block = row["steps"], Block.stored(row["height"], row["n"], row["nodes"])
        steps = [[{"left": a.decode(), "right": b.decode()} for a, b in own] + above for own in block.steps()]
        first = row["block"] * FANOUT**height
        return pa.table({
            "tree": pa.array([row["tree"]] * block.n, pa.string()),
            "place": pa.array(range(first, first + block.n), pa.int64()),
            "steps": pa.array(steps, _STEPS_TYPE),
            "roots": pa.array([row["roots"]] * block.n, pa.list_(pa.string())),
        })

    return blocks.groupBy("tree", "block").applyInArrow(leaves, PATHS)


def _with_paths(rounds: Sequence[DataFrame], above: DataFrame | None, height: int) -> DataFrame:
    """Blocks of the first round with the siblings above their roots.

    ``above`` has (tree, steps, roots) of each tree's root where the trees hang in another one.
    """
    down = None
    for blocks in reversed(rounds):
        top = blocks.filter("n_blocks = 1")
        if above is None:
            top = top.withColumns({"steps": F.array().cast(STEPS), "roots": F.array("root")})
        else:
            top = top.join(above, "tree").withColumn("roots", F.array_append("roots", F.col("root")))
        if down is not None:
            inner = blocks.filter("n_blocks > 1").join(down.withColumnRenamed("place", "block"), ["tree", "block"])
            top = top.select(*inner.columns).unionByName(inner)
        if blocks is rounds[0]:
            return top
        down = _opened(top, height)
    raise ValueError("no rounds")


@dataclass
class Manifest:
    """Leaves with their places, the blocks of the sources' trees, and those of the tree over their roots."""

    leaves: DataFrame
    sources: list[DataFrame]
    top_leaves: DataFrame
    top: list[DataFrame]
    height: int

    def blocks(self) -> DataFrame:
        """All stored blocks: the columns of ``BLOCKS`` and ``round``, those of the upper tree below zero."""
        parts = [b.withColumn("round", F.lit(i)) for i, b in enumerate(self.sources)]
        parts += [b.withColumn("round", F.lit(-1 - i)) for i, b in enumerate(self.top)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole


def build_manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """Manifest of leaves (tree, order, digest, and any columns to keep); see ``documents_leaves``.

    In a tree, leaves ascend by ``order``, nulls first; equal ones by digest, so that repeated rows have one result.
    Trees ascend by their name. Empty input gives a manifest without blocks.
    """
    leaves = numbered(rows, ["order", "digest"])
    sources = build(leaves.select("tree", "place", "n_tree", "digest"), height)
    roots = sources[0].filter("n_blocks = 1")
    for blocks in sources[1:]:
        roots = roots.unionByName(blocks.filter("n_blocks = 1"))
    roots = roots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("root").alias("digest"))
    top_leaves = numbered(roots, ["source_tree"])
    top = build(top_leaves.select("tree", "place", "n_tree", "digest"), height)
    return Manifest(leaves, sources, top_leaves, top, height)


def blocks_with_paths(manifest: Manifest) -> DataFrame:
    """The blocks that hold leaves, each with the siblings above its root (``steps``) and ``roots``: root, subroot."""
    top = _opened(_with_paths(manifest.top, None, manifest.height), manifest.height)
    hung = manifest.top_leaves.join(top, ["tree", "place"]).select(F.col("source_tree").alias("tree"), "steps", "roots")
    return _with_paths(manifest.sources, hung, manifest.height)


PROVEN = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(leaves, blocks):
    row = blocks.to_pylist()[0]
    block, (root, subroot) = Block.stored(row["height"], row["n"], row["nodes"]), row["roots"]
    above = [(s["left"].encode(), s["right"].encode()) for s in row["steps"]]
    leaves = leaves.sort_by("place")
    proofs, folded = [], []
    for leaf, own in zip(leaves["claimed"].to_pylist(), block.steps(), strict=True):
        steps = own + above
        proofs.append(proof_digest(steps))
        folded.append(fold(leaf, steps))
    n = leaves.num_rows
    return pa.table({
        "doc_id": leaves["order"], "leaf": leaves["digest"], "subroot": pa.array([subroot] * n), "root": pa.array([root] * n),
        "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == root for f in folded]),
    })


def prove(manifest: Manifest) -> DataFrame:
    """Each leaf with its roots, the digest of its proof, and the root that its column ``claimed`` folds to."""
    blocks = blocks_with_paths(manifest).select("tree", "block", "height", "n", "nodes", "steps", "roots")
    leaves = manifest.leaves.select("tree", block_of(manifest.height), "place", "order", "digest", "claimed")
    pairs = leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return pairs.applyInArrow(_prove, PROVEN)


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves of documents: of doc_id, source, lang, n_chars and text, in a tree for each source.

    ``claimed`` is the digest that a reader of the rows would work out. Where ``tampered`` holds it is that of the
    text with A-Z in lower case, else the leaf itself. Nulls are fields of their own; other columns are not read.
    """
    from string import ascii_lowercase, ascii_uppercase

    fields = ("doc_id", "source", "lang", "n_chars")
    leaf = digest(*fields, "text")
    changed = digest(*fields, F.translate(F.col("text"), ascii_uppercase, ascii_lowercase))
    claimed = leaf if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), changed)
    rows = docs.select(tree_key("source").alias("tree"), F.col("doc_id").cast("long").alias("order"),
                       leaf.alias("digest"), claimed.alias("claimed"))
    return rows.withColumn("claimed", F.coalesce("claimed", "digest"))


def verify_documents(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row for each document: its leaf, roots, proof, the root its claimed content folds to, and if that is right.

    Rows without doc_id come first in their source; equal rows are leaves of their own. Long texts are hashed in the
    JVM and not kept. An empty table gives no rows.
    """
    return prove(build_manifest(document_leaves(docs, tampered), height))
