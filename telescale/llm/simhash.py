"""SimHash near duplicates through a hierarchical index of fingerprints in Gray order.

Fingerprints are sorted by Gray rank, which brings those with common patterns together. Groups of neighbours become
nodes that hold the bits all members share (a mask and their values); groups of nodes become upper nodes in the same
way, up to a few top nodes. Nodes are matched against nodes from the top down: if the bits that two share differ in more
than four places, no fingerprints below them are linked, and the pair is dropped with all below it; what is left is
compared bit by bit. A pair of nodes that already hangs together is not looked at again.

An index holds at most ``PART`` fingerprints, one task's worth. More of them are dealt to cells first, so that an index
of some thousands does the search in each: of five blocks of bits, two fingerprints that differ in four bits at most
agree in one, so each fingerprint goes to five cells, by the hash of a block over as many cells as bring them down to
size. A cell that is still too large is refined in the same way by its other bits; only what even that leaves crowded is
cut into parts, and each pair of parts gets an index. Every linked pair meets in a cell, so links are exact at every size.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.llm.graph import components
from telescale.llm.texts import map_texts, set_checkpoint_dir

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Fingerprints of a leaf, and nodes below a node.
LEAF = 2
FAN_OUT = 4
#: Fingerprints of an index, at most, and what refining aims at.
PART = 16_384
AIM = 6_000
#: Pairs of nodes that are unfolded at once.
PAIRS_AT_ONCE = 1 << 14

#: The bits of each byte, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(raw: bytes | None) -> int:
    """SimHash of a text: a bit is set if it is set in over half of the hashes of its shingles."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    lanes = hashes.view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """The fingerprint of each text as a long, one row for each row of ``docs``; zero without words."""
    return map_texts(docs, keep, "fp long", lambda: lambda texts: [[fingerprint(x) for x in texts]])


# --- the index of a cell ------------------------------------------------------------------------------


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in Gray order: each bit is the parity of itself and those above it."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(masks: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes over groups of ``size``: a mask of the bits in which all members agree, and those bits."""
    starts = np.arange(0, len(values), size)
    ones = np.bitwise_and.reduceat(values | ~masks, starts)
    any_one = np.bitwise_or.reduceat(values & masks, starts)
    mask = np.bitwise_and.reduceat(masks, starts) & ~(ones ^ any_one)
    return mask, any_one & mask


class Forest:
    """Sets of linked places; ``root`` holds the smallest place of each set once settled."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (lower := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = lower


def search(fps: np.ndarray, distance: int = DISTANCE, seen: Counter | None = None) -> np.ndarray:
    """For distinct fingerprints in Gray order: the place of the first one that each hangs together with.

    ``seen`` counts, for each level, pairs of nodes that were tested, dropped for their differences, and passed over.
    """
    n = len(fps)
    forest = Forest(n)
    levels = [(np.full(n, ~np.uint64(0)), fps, 1)]
    while len(levels) < 2 or len(levels[-1][1]) > FAN_OUT:
        masks, values, rows = levels[-1]
        fan = LEAF if len(levels) == 1 else FAN_OUT
        levels.append((*shared_bits(masks, values, fan), rows * fan))
    top = len(levels[-1][1])
    a, b = np.triu_indices(top)
    _descend(np.stack([a, b], axis=1), len(levels) - 1, levels, forest, distance, Counter() if seen is None else seen)
    return forest.root


def _descend(pairs: np.ndarray, depth: int, levels: list, forest: Forest, distance: int, seen: Counter) -> None:
    """Match pairs of nodes of one level, then those below the pairs that are left, some at a time."""
    masks, values, rows = levels[depth]
    a, b = pairs[:, 0], pairs[:, 1]
    near = np.bitwise_count((values[a] ^ values[b]) & masks[a] & masks[b]) <= distance
    seen[depth, "tested"] += len(pairs)
    seen[depth, "dropped"] += len(pairs) - int(near.sum())
    pairs = pairs[near]
    if depth == 0:
        forest.link(pairs[:, 0], pairs[:, 1])
        return
    for at in range(0, len(pairs), PAIRS_AT_ONCE):
        some = pairs[at:at + PAIRS_AT_ONCE]
        below = _unfold(some, forest, rows, levels[depth - 1], len(levels[0][1]), seen, depth)
        if len(below):
            _descend(below, depth - 1, levels, forest, distance, seen)


def _unfold(pairs: np.ndarray, forest: Forest, rows: int, below: tuple, n: int, seen: Counter, depth: int) -> np.ndarray:
    """Pairs of the nodes below; none where all fingerprints of both nodes hang together already."""
    starts = np.arange(0, n, rows)
    low, high = np.minimum.reduceat(forest.root, starts), np.maximum.reduceat(forest.root, starts)
    a, b = pairs[:, 0], pairs[:, 1]
    one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
    seen[depth, "passed"] += int(one.sum())
    a, b = a[~one], b[~one]
    fan = rows // below[2]
    left = (a[:, None] * fan + np.arange(fan))[:, :, None] + np.zeros((1, 1, fan), np.int64)
    right = (b[:, None] * fan + np.arange(fan))[:, None, :] + np.zeros((1, fan, 1), np.int64)
    left, right = left.ravel(), right.ravel()
    good = (left < len(below[1])) & (right < len(below[1])) & (left <= right if below[2] > 1 else left < right)
    return np.stack([left[good], right[good]], axis=1)


# --- links ---------------------------------------------------------------------------------------------


def _block_starts(width: int) -> list[int]:
    """Where the blocks of a pattern of ``width`` bits start, one block more than fingerprints may differ in, and its end."""
    return [width * i // (DISTANCE + 1) for i in range(DISTANCE + 2)]


def _blocks(pattern: Column, width: int) -> list[Column]:
    starts = _block_starts(width)
    return [F.shiftrightunsigned(pattern, a).bitwiseAND((1 << b - a) - 1) for a, b in zip(starts, starts[1:])]


def _without(pattern: Column, i: int) -> tuple[Column, int]:
    """The bits outside block ``i`` of a fingerprint, moved together, and how many they are."""
    a, b = _block_starts(64)[i:i + 2]
    high = F.shiftleft(F.shiftrightunsigned(pattern, b), a) if b < 64 else F.lit(0).cast("long")
    return high.bitwiseOR(pattern.bitwiseAND((1 << a) - 1)), 64 - (b - a)


def _buckets(n: Column | int, aim: int):
    """Over how many cells ``n`` fingerprints of a block are dealt."""
    return F.greatest(F.lit(1), F.ceil(F.lit(n) / aim) if isinstance(n, int) else F.ceil(n / aim)).cast("long")


def cells(nodes: DataFrame, part: int = PART, aim: int = AIM) -> DataFrame:
    """Fingerprints by cell; ``parts`` says into how many a cell is cut at last.

    All are in one cell if they fit into one index. Else a fingerprint is dealt by the hash of each of its five blocks;
    in a crowded cell of a block, by the hash of that block and of each of five blocks of the other bits.
    """
    n = nodes.count()
    if n <= part:
        return nodes.select("fp", "id", F.lit("").alias("cell"), F.lit(1).alias("parts"))
    fp, buckets = F.col("fp"), _buckets(n, aim)
    copies = [F.struct(F.lit(i).alias("i"), F.pmod(F.xxhash64(F.lit(i), b), buckets).alias("bucket"), b.alias("block"))
              for i, b in enumerate(_blocks(fp, 64))]
    placed = nodes.select("fp", "id", F.inline(F.array(*copies)))
    held = placed.groupBy("i", "bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > part)
    placed = placed.join(held, ["i", "bucket"], "left")
    named = [F.concat_ws("/", "i", "bucket")]
    again = None
    for i in range(DISTANCE + 1):
        rest, width = _without(fp, i)
        buckets = _buckets(F.col("_n"), aim)
        finer = F.array(*[F.concat_ws("/", F.lit(i), F.lit(j), F.pmod(F.xxhash64(F.lit(j), "block", b), buckets))
                          for j, b in enumerate(_blocks(rest, width))])
        again = F.when(F.col("i") == i, finer) if again is None else again.when(F.col("i") == i, finer)
    names = F.when(F.col("_n").isNull(), F.array(*named)).otherwise(again)
    # A bucket of the finer cells may be that of several crowded cells: nothing is lost, they are searched together.
    placed = placed.select("fp", "id", F.explode(names).alias("cell")).distinct()
    held = placed.groupBy("cell").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    return placed.join(held.filter("parts > 1"), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def links(nodes: DataFrame, part: int = PART, aim: int = AIM) -> DataFrame:
    """Links (u, v) between the ``id`` of distinct fingerprints ``fp`` that hang together within a cell.

    Followed from one to the next, they join just the fingerprints that are joined by differences of four bits.
    """
    placed = cells(nodes, part, aim)
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    placed = placed.select("cell", "fp", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    place = F.concat_ws("/", "cell", F.lit("p"), F.least("own", "other"), F.greatest("own", "other"))
    placed = placed.select(F.xxhash64(place).alias("h"), place.alias("place"), "fp", "id")
    sorted_cells = placed.repartition("h").sortWithinPartitions("h", "place").select("place", "fp", "id")

    def run(batches):
        for table in _whole_groups(batches):
            yield from _search_group(table)

    return sorted_cells.mapInArrow(run, _LINK).distinct()


#: A node is the smallest id of a fingerprint's documents; one without any is named by the fingerprint and comes last.
NODE = "struct<no_id: boolean, key: long>"
_LINK = f"u {NODE}, v {NODE}"


def _whole_groups(batches):
    """Tables of one group each, by the first column; a group fits into memory."""
    kept = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0)
        coded = names.dictionary_encode()
        borders = np.flatnonzero(np.diff(coded.indices.to_numpy())) + 1
        starts = [0, *borders.tolist()]
        for start, end in zip(starts, [*borders.tolist(), batch.num_rows]):
            part = batch.slice(start, end - start)
            if kept and kept[-1].column(0)[0].as_py() != part.column(0)[0].as_py():
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(part)
    if kept:
        yield pa.Table.from_batches(kept)


def _search_group(table: pa.Table):
    fps = table.column("fp").to_numpy().view(np.uint64)
    if len(fps) < 2:
        return
    order = np.argsort(gray_rank(fps), kind="stable")
    root = search(fps[order])
    linked = np.flatnonzero(root != np.arange(len(root)))
    if len(linked):
        ids = table.column("id").combine_chunks()
        u, v = ids.take(pa.array(order[linked])), ids.take(pa.array(order[root[linked]]))
        yield pa.RecordBatch.from_arrays([u, v], ["u", "v"])


def groups(marked: DataFrame) -> DataFrame:
    """(fp, component_id) for rows of (doc_id, fp): the smallest doc_id that a fingerprint is linked with.

    Fingerprints are known by the smallest id of their documents, so the root of a component is its smallest id, and no
    step gathers a component.
    """
    first = F.min("doc_id").cast("long")
    nodes = marked.groupBy("fp").agg(F.struct(first.isNull().alias("no_id"), F.coalesce(first, F.col("fp")).alias("key")).alias("id"))
    nodes = nodes.checkpoint()
    roots = components(links(nodes)).select(F.col("node").alias("id"), "root")
    rooted = nodes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    return rooted.select("fp", F.when(~F.col("root.no_id"), F.col("root.key")).alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and group of each text, one row for each row of ``docs``.

    Words are runs of other bytes than white space, A-Z lowered; shingles are four words, repeats included, and a
    shorter text is one shingle. Texts without words, null ones too, have fingerprint zero and are linked like any
    other. ``component_id`` is the smallest doc_id of the group; null ids do not count, and a group without any id
    has a null component. Repeated rows stay. An empty table gives no rows.
    """
    set_checkpoint_dir(docs.sparkSession)
    marked = fingerprints(docs).checkpoint()
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(groups(marked), "fp").select("doc_id", digits, "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each group the rows of its smallest doc_id stay; rows without id stay."""
    found = near_duplicates(docs)
    dropped = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
