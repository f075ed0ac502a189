"""Substring dedup: passages that repeat across documents, found level by level, each twice as long as the one before.

A window of the asked length can only repeat where its parts of half the length do. The first level takes windows of
half the asked length, and of those only the minimizer of each asked window: the one with the least hash among its
parts, which is the same wherever the window stands. Windows are extended to the next length only where what was
found at this one repeats in another document. ``longest_repeats`` goes on from the asked length to twice that
length and so on until no candidates survive.

Rows of the shuffle are one for each hash and batch of texts: where a batch holds a window in several documents, all
but the one of the smallest id are settled there and then. So a passage of a third of all documents gives no more
rows for one key than there are batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telescale.llm.texts import covered, set_checkpoint_dir, window_hashes, word_hashes

WINDOW = 13
#: doc_id, hash of the window and a second one; settled: it starts in this batch in a document of a smaller id; shared:
#: in another one. Windows are the same if all 88 bits are; candidates, which are looked at again, go by 48 of them.
ROWS = "doc_id long, hash long, check int, settled boolean, shared boolean"
#: Bytes of the texts whose hashes a task holds at the same time, about.
BYTES_AT_ONCE = 16 << 20
CANDIDATE_SHIFT = np.uint64(16)
CHECK_BASE = np.uint64(0xD6E8FEB86659FD93)


def half_of(length: int) -> int:
    return (length + 1) // 2


def minimizers(halves: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` words the place of its half window of least hash, the first of equal ones."""
    parts = length - half_of(length) + 1
    if len(halves) < parts:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(halves, parts)
    return views.argmin(axis=1) + np.arange(len(views))


def check_hashes(words: Sequence[bytes], length: int) -> np.ndarray:
    """A second hash of each window, of 24 bits, made from other hashes of its words than the first."""
    hashes = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(max(0, len(hashes) - length + 1), np.uint64)
    for i in range(length if len(mixed) else 0):
        mixed = (mixed + hashes[i:i + len(mixed)] + np.uint64(1)) * CHECK_BASE
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(40)).astype(np.int32)


def batch_rows(ids: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> pa.RecordBatch:
    """One row for each window of a batch that is not settled, and one for each document where it is."""
    order = np.lexsort((ids, checks, hashes))
    ids, hashes, checks = ids[order], hashes[order], checks[order]
    new = np.ones(len(ids), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
    first = new.copy()
    first[1:] |= ids[1:] != ids[:-1]
    ids, hashes, checks, new = ids[first], hashes[first], checks[first], new[first]
    alone = new & np.append(new[1:], True)
    back = np.argsort(ids, kind="stable")  # rows of a document together compress better
    arrays = [pa.array(x[back]) for x in (ids, hashes.view(np.int64), checks, ~new, ~alone)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "hash", "check", "settled", "shared"])


def _parts(batch: pa.RecordBatch):
    """A batch of (id, text, ...) cut where its texts exceed ``BYTES_AT_ONCE``."""
    sizes = np.nan_to_num(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(float))
    part = (np.cumsum(sizes) // BYTES_AT_ONCE).astype(np.int64)
    borders = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a)


def _rows_of(docs: DataFrame, columns: Sequence[str], hashes_of) -> DataFrame:
    """Rows of the hashes that ``hashes_of(words, *other columns)`` gives for each document with all of them.

    It gives hashes, and second ones or None. Texts are taken ``BYTES_AT_ONCE`` at a time, or one that is longer.
    """

    def run(batches):
        for batch in (part for b in batches for part in _parts(b)):
            ids, texts, *others = batch.columns
            found, seconds, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            values = zip(ids.to_pylist(), texts.cast(pa.binary()).to_pylist(), *(x.to_pylist() for x in others),
                         strict=True)
            for doc_id, raw, *rest in values:
                if doc_id is None or raw is None or None in rest:
                    continue
                hashes, checks = hashes_of(raw.split(), *rest)
                hashes, at = np.unique(hashes, return_index=True)
                found.append(hashes)
                seconds.append(np.zeros(len(hashes), np.int32) if checks is None else checks[at])
                owners.append(np.full(len(hashes), doc_id, np.int64))
            yield batch_rows(np.concatenate(owners), np.concatenate(found), np.concatenate(seconds))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *columns).mapInArrow(run, ROWS)


def repeated(rows: DataFrame) -> DataFrame:
    """(doc_id, hash, later) of windows in two documents or more; ``later``: a smaller id holds it too."""
    # Settled rows need no company; each goes to a key of its own.
    window = Window.partitionBy("hash", "check", F.when(F.col("settled"), F.col("doc_id")))
    met = rows.select(
        "doc_id", "hash", "settled", F.min("doc_id").over(window).alias("_least"),
        F.max("doc_id").over(window).alias("_most"), F.max("shared").over(window).alias("_shared"),
    )
    found = met.filter("settled or _shared or _least < _most")
    return found.select("doc_id", "hash", (F.col("settled") | (F.col("_least") < F.col("doc_id"))).alias("later"))


def _by_document(found: DataFrame, name: str) -> DataFrame:
    """The hashes of each document in one array; at most one for each of its words."""
    return found.groupBy(F.col("doc_id").alias("_owner")).agg(F.collect_list("hash").alias(name))


def _among(hashes: np.ndarray, known: Sequence[int] | None) -> np.ndarray:
    if known is None or not len(known) or not len(hashes):
        return np.zeros(len(hashes), bool)
    return np.isin(hashes, np.array(known, np.int64).view(np.uint64))


def _joined(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """All texts with their hashes or null. Always the same left side, so that Spark shuffles the texts once."""
    packed = _by_document(found, name)
    return docs.select("doc_id", "text").join(packed, F.col("doc_id") == F.col("_owner"), "left").drop("_owner")


def repeated_windows(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """(doc_id, hash, later) of the windows of ``length`` words that two documents or more hold.

    Rows without id or text hold none.
    """
    half = half_of(length)

    def first_level(words):
        halves = window_hashes(word_hashes(words), half) >> CANDIDATE_SHIFT
        return halves[np.unique(minimizers(halves, length))], None

    def second_level(words, known):
        hashes = word_hashes(words)
        halves = window_hashes(hashes, half) >> CANDIDATE_SHIFT
        candidate = _among(halves, known)[minimizers(halves, length)]
        return window_hashes(hashes, length)[candidate], check_hashes(words, length)[candidate]

    candidates = repeated(_rows_of(docs, [], first_level))
    return repeated(_rows_of(_joined(docs, candidates, "_known"), ["_known"], second_level))


def longest_repeats(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """(doc_id, longest): the greatest length, ``length`` doubled over and over, of a window that a document shares.

    Only windows both halves of which repeat are extended; it ends when no candidates survive. Documents without a
    shared window of ``length`` words are left out.
    """
    set_checkpoint_dir(docs.sparkSession)
    found = repeated_windows(docs, length).checkpoint()
    best = None
    while not found.isEmpty():
        level = found.select("doc_id").distinct().withColumn("longest", F.lit(length))
        best = level if best is None else best.union(level)

        def extend(words, known, n=length):
            hashes = word_hashes(words)
            survive = _among(window_hashes(hashes, n), known)
            twice = window_hashes(hashes, 2 * n)
            survive = survive[:len(twice)] & survive[n:n + len(twice)]
            return twice[survive], check_hashes(words, 2 * n)[survive]

        found = repeated(_rows_of(_joined(docs, found, "_known"), ["_known"], extend)).checkpoint()
        length *= 2
    if best is None:
        return found.select("doc_id", F.lit(0).alias("longest"))
    return best.groupBy("doc_id").agg(F.max("longest").alias("longest"))


def remove_repeats(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """What is left of each text, one row for each row of ``docs``: doc_id, n_words, n_removed, kept (the words left).

    Words are runs of other bytes than white space, unchanged. A word goes if a window of ``length`` words covers it
    that also starts in a document of a smaller id; the document of the smallest id keeps it, and windows are judged
    on the texts as they came. Null texts have no words; rows without id neither lose words nor cost others any.
    Rows that share an id count as one document. An empty table gives no rows.
    """
    later = repeated_windows(docs, length).filter("later")

    def cut(batches):
        for batch in batches:
            ids, texts, known = batch.columns
            rows = []
            for raw, hashes in zip(texts.cast(pa.binary()).to_pylist(), known.to_pylist(), strict=True):
                words = raw.split() if raw else []
                if hashes:
                    starts = np.flatnonzero(_among(window_hashes(word_hashes(words), length), hashes))
                    gone = covered(starts, length, len(words))
                    left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    left = words
                rows.append((len(words), len(words) - len(left), b" ".join(left)))
            n_words, n_removed, kept = list(zip(*rows, strict=True)) if rows else [[]] * 3
            made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([ids, *made], ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _joined(docs, later, "_gone").mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")
