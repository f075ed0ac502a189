"""Benchmark decontamination: windows of words that documents share with the items of a benchmark.

The windows of all items become a set of 64-bit hashes that each task holds, behind a bitmap that rules most
windows out. Windows of a text that pass are compared word by word. A benchmark of more than ``most_windows``
windows does not fit into a task: its windows then stay on Spark, and only a bitmap of fixed size of their hashes goes to
the tasks. Windows of texts that pass it are joined with those of the items, by hash and by their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import (
    covered, fields, free_prefix, map_texts, set_checkpoint_dir, window_hashes, word_hashes,
)

WINDOW = 13
#: Bound on the windows that a task holds as a set, some 150 bytes each.
MOST_WINDOWS = 500_000
BITMAP_BITS = 22
#: Bits of the bitmap of a benchmark that is joined (16 MB), as a power of two.
JOINED_BITS = 27

#: Letters and digits of ASCII, capitals lowered, and all bytes of other characters; the rest separates words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_FOLD).split() if raw else []


class WindowSet:
    """The windows of some items, by length and hash."""

    def __init__(self, items: Sequence[tuple[str, bytes | None]], window: int = WINDOW) -> None:
        self.ids: list[str] = []
        self.windows: dict[int, dict[int, list[tuple[tuple[bytes, ...], list[int]]]]] = {}
        for item_id, raw in items:
            words = words_of(raw)
            if not words:
                continue
            number, length = len(self.ids), min(window, len(words))
            self.ids.append(item_id)
            by_hash = self.windows.setdefault(length, {})
            for start, h in enumerate(window_hashes(word_hashes(words), length).tolist()):
                of_hash, ws = by_hash.setdefault(h, []), tuple(words[start:start + length])
                held = next((numbers for known, numbers in of_hash if known == ws), None)
                if held is None:
                    of_hash.append((ws, [number]))
                elif held[-1] != number:
                    held.append(number)
        self.bitmaps: dict[int, np.ndarray] = {}
        for length, by_hash in self.windows.items():
            bitmap = np.zeros(1 << BITMAP_BITS, bool)
            bitmap[np.fromiter(by_hash, np.uint64, len(by_hash)) >> np.uint64(64 - BITMAP_BITS)] = True
            self.bitmaps[length] = bitmap

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in a window of an item, and the numbers of the items with such windows."""
        hit, found = np.zeros(len(words), bool), set()
        if not words or not self.windows:
            return hit, found
        hashes = word_hashes(words)
        for length, by_hash in self.windows.items():
            of_windows = window_hashes(hashes, length)
            starts = []
            maybe = np.flatnonzero(self.bitmaps[length][of_windows >> np.uint64(64 - BITMAP_BITS)])
            for start, h in zip(maybe.tolist(), of_windows[maybe].tolist(), strict=True):
                for ws, numbers in by_hash.get(h, ()):
                    if ws == tuple(words[start:start + length]):
                        starts.append(start)
                        found.update(numbers)
            if starts:
                hit |= covered(np.array(starts), length, len(words))
        return hit, found


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _verdict(n_words: int, n_hit: int, items: list[str]) -> tuple:
    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n_words


def fits_a_task(items: DataFrame, most_windows: int) -> bool:
    """Whether the items have at most so many windows, by their bytes: an item has at most half as many."""
    size = items.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0
    return size <= most_windows


def _collect(items: DataFrame) -> list[tuple[str, bytes]]:
    rows = items.filter("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").collect()
    return [(r.item_id or "", r.text.encode()) for r in rows]


def decontaminate(
    docs: DataFrame, items: DataFrame, keep: Sequence[str] = ("doc_id",), prefix: str = "",
    most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """Overlap of each text with the items, one row for each row of ``docs``; names of results get ``prefix``.

    Words are runs of ASCII letters and digits, capitals lowered, and of other characters from U+0080 on. A window
    is 13 consecutive words of an item; an item with fewer words is one window, an item without words none. Every
    word of a text inside an occurrence of a window is hit. A text is contaminated if a twentieth of its words or
    more are hit. Null and empty texts have no words and are clean. Items of the same id count once; a null id
    counts as empty. Repeated rows give repeated results; columns of ``docs`` outside ``keep`` are not read.
    """
    result = fields(", ".join(prefix + f for f in RESULT.split(", ")))
    if fits_a_task(items, most_windows):
        listed = _collect(items)

        def make():
            known = WindowSet(listed)

            def scan(texts):
                rows = []
                for raw in texts:
                    words = words_of(raw)
                    hit, found = known.hits(words)
                    rows.append(_verdict(len(words), int(hit.sum()), sorted({known.ids[i] for i in found})))
                return list(zip(*rows, strict=True)) if rows else [[]] * 5

            return scan

        return map_texts(docs, keep, result, make)
    return _joined(docs, items, keep, result)


# --- a benchmark of any size -----------------------------------------------------------------------------


def _mixed(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of windows told apart by the number of their words."""
    return hashes ^ np.uint64(length * 0x9E3779B97F4A7C15 % 2**64)


def _said(words: list[bytes], starts: np.ndarray, length: int) -> list[bytes]:
    return [b" ".join(words[s:s + length]) for s in starts.tolist()]


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, said, n, item) of each window of the items, each once."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")

    def make():
        def scan(texts):
            found = []
            for raw in texts:
                words = words_of(raw)
                n = min(window, len(words))
                hashes = _mixed(window_hashes(word_hashes(words), n), n) if words else np.zeros(0, np.uint64)
                said = _said(words, np.arange(len(hashes)), n)
                found.append([{"h": h, "said": x, "n": n} for h, x in zip(hashes.view(np.int64).tolist(), said, strict=True)])
            return [found]

        return scan

    found = map_texts(named, ["item"], "windows array<struct<h: long, said: binary, n: int>>", make)
    return found.select("item", F.inline("windows")).distinct()


def bitmap_of(windows: DataFrame, bits: int = JOINED_BITS) -> np.ndarray:
    """Which leading bits the hashes have, one bit for each pattern; its size does not depend on the windows."""
    place = F.shiftrightunsigned("h", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    held = windows.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = np.zeros(1 << bits - 6, np.uint64)
    table = held.toArrow()  # at most 2 ** (bits - 6) rows
    bitmap[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return bitmap


def _passes(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def text_windows(docs: DataFrame, bitmap: np.ndarray, lengths: Sequence[int], bits: int) -> DataFrame:
    """(text_key, start, h, said) of the windows of texts that pass the bitmap; equal texts have one key."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        def scan(texts):
            found = []
            for raw in texts:
                words, windows = words_of(raw), []
                hashes = word_hashes(words)
                for n in lengths:
                    of_windows = _mixed(window_hashes(hashes, n), n)
                    starts = np.flatnonzero(_passes(shared.value, bits, of_windows))
                    windows += [{"start": s, "h": h, "said": x} for s, h, x in zip(
                        starts.tolist(), of_windows[starts].view(np.int64).tolist(), _said(words, starts, n), strict=True)]
                found.append(windows)
            return [found]

        return scan

    keyed = docs.select(F.sha2("text", 256).alias("text_key"), "text").filter("text is not null")
    found = map_texts(keyed, ["text_key"], "windows array<struct<start: int, h: long, said: binary>>", make)
    return found.select("text_key", F.inline("windows")).distinct()


def _joined(docs: DataFrame, items: DataFrame, keep: Sequence[str], result, bits: int = JOINED_BITS) -> DataFrame:
    """``decontaminate`` by a join of windows; only the hits of one text meet in one row."""
    set_checkpoint_dir(docs.sparkSession)
    windows = item_windows(items).checkpoint()
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most 13
    of_texts = text_windows(docs, bitmap_of(windows, bits), lengths, bits)
    # One row for each window first: a passage of many texts then meets its items by array, not row by row.
    of_items = windows.groupBy("h", "said", "n").agg(F.collect_set("item").alias("items"))
    hits = of_texts.join(of_items, ["h", "said"])
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    covered_words = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto")))
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    found = hits.groupBy("text_key").agg(spans.alias("spans"), names.alias("items"))
    found = found.select("text_key", covered_words["n"].cast("long").alias("hit"), "items")

    stem = free_prefix(docs, "_t")
    counted = map_texts(docs.withColumn(stem, F.sha2("text", 256)), [*keep, stem], f"{stem}n long",
                        lambda: lambda texts: [[len(words_of(x)) for x in texts]])
    marked = counted.join(found.withColumnsRenamed({"text_key": stem, "hit": f"{stem}h", "items": f"{stem}i"}), stem, "left")
    n_words, n_hit = F.col(f"{stem}n"), F.coalesce(f"{stem}h", F.lit(0).cast("long"))
    listed = F.coalesce(f"{stem}i", F.array().cast("array<string>"))
    values = (n_words, n_hit, F.size(listed).cast("long"), F.sha2(F.array_join(listed, ","), 256),
              (n_hit > 0) & (20 * n_hit >= n_words))
    return marked.select(*keep, *(v.alias(n) for v, n in zip(values, result.names, strict=True)))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows."""
    prefix = free_prefix(docs, "_hit_")
    marked = decontaminate(docs, items, docs.columns, prefix)
    return marked.filter(~F.col(f"{prefix}contaminated")).select(*docs.columns)
