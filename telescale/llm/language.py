"""Language identification: the nearest of several clustered centroids per language, by cosine.

A text is a vector of hashed n-grams of its letters (2 and 3 bytes of UTF-8, lower case), weighted by TF-IDF and
brought to length one. Inverse document frequencies come from all texts to learn from; centroids are clustered
from a bounded sample of each language, so that a rare one is learned at every size of the table. A text that is long
enough to tell, and whose best cosine is far below what nearly all sampled texts of that language reach with centroids
that they are not part of, is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescale.llm.texts import free_prefix, held_out, map_texts

DIMENSIONS = 4096
#: Bound on the texts of a language that its centroids are clustered from.
SAMPLE = 3000
CENTROIDS = 4
#: Languages that are learned, the most frequent ones: a bound on what comes to the driver (64 kB for each).
MOST_LANGUAGES = 1000
UNKNOWN = "und"
#: The share of a language's sampled texts that the threshold of rejection may lie above, halved for safety.
REJECTED_SHARE = 0.002
#: For cosines of texts with centroids of others, those of a language are dealt into so many parts.
PARTS = 4
#: Thresholds of a language of n texts are multiplied by n / (n + FEW): a few texts do not show how far others lie.
FEW = 16
#: A text with fewer n-grams is too short for its distance to say anything and is not rejected.
LEAST_NGRAMS = 128

#: Bytes that are no letters become spaces.
_FOLD = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def ngram_counts(raw: bytes) -> np.ndarray:
    """Counts of the hashed n-grams of a text: each pair and each triple of neighbouring bytes."""
    folded = b" ".join(raw.decode().lower().encode().translate(_FOLD).split())
    x = np.frombuffer(b" " + folded + b" ", np.uint8).astype(np.uint32)
    pairs = x[:-1] * np.uint32(257) + x[1:]
    triples = pairs[:-1] * np.uint32(263) + x[2:]
    spread = np.concatenate([pairs, triples]) * np.uint32(2654435761)
    return np.bincount(spread >> np.uint32(20), minlength=DIMENSIONS)


def has_letter(raw: bytes | None) -> bool:
    if not raw:
        return False
    if raw[:16].isalpha():
        return True
    return any(map(str.isalpha, raw.decode()))


def vectors(texts: Sequence[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF vectors of length one, and the number of n-grams of each text."""
    out, sizes = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts), np.int64)
    for i, raw in enumerate(texts):
        counts = ngram_counts(raw)
        out[i], sizes[i] = np.log1p(counts) * idf, counts.sum()
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9), sizes


@dataclass
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray  # one row each, of length one
    languages: list[str]  # of each centroid
    thresholds: np.ndarray  # of each centroid: a lower cosine is rejected

    def predict(self, texts: Sequence[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        some = [i for i, x in enumerate(texts) if has_letter(x)] if len(self.languages) else []
        for block in range(0, len(some), 256):
            rows = some[block:block + 256]
            found, sizes = vectors([texts[i] for i in rows], self.idf)
            cosines = found @ self.centroids.T
            best = cosines.argmax(axis=1)
            for i, j, n, c in zip(rows, best, sizes, cosines[np.arange(len(rows)), best], strict=True):
                names[i], scores[i] = self.languages[j], float(min(1.0, max(0.0, c)))
                rejected[i] = bool(c < self.thresholds[j] and n >= LEAST_NGRAMS)
        return names, scores, rejected


def document_frequencies(learned: DataFrame) -> tuple[np.ndarray, int]:
    """Of each hashed n-gram the number of texts that hold it, and the number of texts. Summed on the executors."""

    def count(batches):
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                seen += ngram_counts(raw) > 0
                n += 1
        bins = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bins, -1), pa.int32()), pa.array(np.append(seen[bins], n), pa.int64())], ["bin", "n"]
        )

    counted = learned.select("text").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    seen, total = np.zeros(DIMENSIONS, np.int64), 0
    for row in counted.collect():  # DIMENSIONS rows and one at most
        if row.bin < 0:
            total = row.n
        else:
            seen[row.bin] = row.n
    return seen, total


def cluster(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means by cosine; starts from the point nearest to the mean and then from the farthest ones."""
    mean = points.mean(axis=0)
    chosen = [int((points @ mean).argmax())]
    nearest = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(rounds):
        member = (points @ centres.T).argmax(axis=1)
        centres = np.stack([points[member == j].sum(axis=0) if (member == j).any() else centres[j]
                            for j in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


def threshold(points: np.ndarray, centroids: int) -> float:
    """The cosine below which a text of the language of ``points`` is rejected; 0, so none, for a single point."""
    n = len(points)
    if n < 2:
        return 0.0
    part = np.arange(n) % PARTS
    apart = [points[part == i] @ cluster(points[part != i], centroids).T for i in range(min(n, PARTS))]
    best = np.concatenate([x.max(axis=1) for x in apart])
    return 0.5 * float(np.quantile(best, REJECTED_SHARE)) * n / (n + FEW)


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from the rows of ``docs`` with text and lang.

    Frequencies cover all of them. Clustering takes about ``sample`` texts of each of the ``MOST_LANGUAGES`` most frequent
    languages, those lowest by a hash, and all of a language with fewer; repeated rows count once. The driver gets no
    more than the centroids. Without such rows nothing is learned.
    """
    learned = docs.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    seen, total = document_frequencies(learned)
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + np.float32(0.05)
    sizes = learned.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)  # so it may be broadcast
    some = learned.withColumn("at", F.xxhash64("doc_id", "text")).join(F.broadcast(sizes), "lang")
    some = some.filter(F.col("at").cast("double") / 2.0**64 + 0.5 <= F.lit(float(sample)) / F.col("n"))
    found = some.select("lang", "at", "text").mapInArrow(_sample_vectors(idf), "lang string, at long, v binary")
    found = found.dropDuplicates(["lang", "at"]).groupBy("lang").applyInArrow(
        _centroids_of(centroids), "lang string, number int, centre binary, threshold double"
    )
    rows = sorted(found.collect(), key=lambda r: (r.lang, r.number))
    centres = [np.frombuffer(r.centre, np.float32) for r in rows]
    stacked = np.stack(centres) if centres else np.zeros((0, DIMENSIONS), np.float32)
    return LanguageModel(idf, stacked, [r.lang for r in rows], np.array([r.threshold for r in rows]))


def _centroids_of(centroids: int):
    def run(table: pa.Table) -> pa.Table:
        packed = [table.column("v")[i].as_py() for i in np.argsort(table.column("at").to_numpy(), kind="stable")]
        points = np.stack([np.frombuffer(v, np.float16) for v in packed]).astype(np.float32)
        points = points[np.linalg.norm(points, axis=1) > 0.5]
        found = cluster(points, centroids).astype(np.float32) if len(points) else points
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * len(found), pa.string()),
            "number": pa.array(range(len(found)), pa.int32()),
            "centre": pa.array([x.tobytes() for x in found], pa.binary()),
            "threshold": pa.array([threshold(points, centroids)] * len(found), pa.float64()),
        })

    return run


def _sample_vectors(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                found, _ = vectors(part.column(2).cast(pa.binary()).to_pylist(), idf)
                packed = [x.tobytes() for x in found.astype(np.float16)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(packed, pa.binary())], ["lang", "at", "v"]
                )

    return run


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), prefix: str = "") -> DataFrame:
    """Language of each text, one row for each row of ``docs``.

    ``lang_pred`` is the nearest language, ``und`` if the text is null or has no letter or if nothing was learned;
    ``score`` is the cosine to the nearest centroid, 0 for ``und``; ``rejected`` says that it is too low to trust.
    Of equal cosines the first centroid's language counts, by name and number. Texts of any length are counted whole, in
    memory that their length does not raise but for the text itself. Columns of ``docs`` outside ``keep`` are not read;
    repeated rows give repeated results, and an empty table gives no rows.
    """
    found = f"{prefix}lang_pred string, {prefix}score double, {prefix}rejected boolean"
    return map_texts(docs, keep, found, lambda: model.predict)


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those that are not held out."""
    return docs.filter(~held_out(4, 2))


def known_language_only(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language is rejected or ``und``; learned from all of these rows."""
    prefix = free_prefix(docs, "_lid_")
    scored = identify(docs, fit(docs), docs.columns, prefix)
    return scored.filter(~F.col(f"{prefix}rejected")).select(*docs.columns)
