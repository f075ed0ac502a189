"""Toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks.

The kernel compares two strings by the subsequences of four letters that both hold within seven characters; each
gap costs a factor. So ``idxiot`` and ``1diot`` are still near to ``idiot``. Letters that stand alone, with marks
between each and the next, are put together first: ``i.d.i.o.t`` and ``i - d - i - o - t`` are ``idiot``. Landmarks are words of
the labelled sentences: those that mark either label most, and frequent ones. A sentence becomes its kernel values
with the landmarks, multiplied by the inverse root of the kernel matrix of the landmarks, and a linear machine is
trained on these vectors.

The machine is linear in kernel values, and these are sums over subsequences. So its value for a string is a sum of
one weight for each subsequence, which a table holds: a text is scored exactly without kernel values.

Labels are of documents, and some are wrong. Sentences of a toxic document start out as toxic; after each round of
training only those that the machine finds toxic stay so, and the others of these documents are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import held_out, map_texts, set_checkpoint_dir

LENGTH, SPAN = 4, 7
GAP_COST = 0.6
LETTERS = 27  # a to z, and what is no letter
#: Bounds of what is learned from: documents and sentences of each label, and characters of a sentence.
SAMPLE_DOCS = {0: 4000, 1: 2000}
SAMPLE_SENTENCES = {0: 14_000, 1: 10_000}
SENTENCE_CHARS = 2000
LANDMARKS = 96
ROUNDS = 6
MARGIN_COST = 1000.0

SENTENCE = re.compile(rb"[.!?]+(?=\s)|\n")
#: Four letters or more that stand alone, each with one to eight bytes that are no letters before the next.
SPACED = re.compile(
    rb"(?<![A-Za-z0-9])[A-Za-z0-9](?:[^A-Za-z0-9]{1,8}[A-Za-z0-9](?![A-Za-z0-9])){3,}"
)
STRETCH = 1 << 15  # characters scored at once
WORD = re.compile(rb"[a-z0-9]{3,24}")
_APART = bytes([0]) * SPAN
_DIGITS = b"0123456789"
_ALNUM = [c < 128 and chr(c).isalnum() for c in range(256)]
#: Digits that stand for letters.
_CODES = np.full(256, LETTERS - 1, np.int32)
_CODES[[*range(97, 123)]] = _CODES[[*range(65, 91)]] = np.arange(26)
_CODES[[ord(c) for c in "013457"]] = [ord(c) - 97 for c in "oieast"]

#: Places of the other letters of a subsequence behind its first, and its weight.
PATTERNS = [(p, GAP_COST ** (p[-1] + 1 - LENGTH)) for p in combinations(range(1, SPAN), LENGTH - 1)]


def coded(raw: bytes) -> np.ndarray:
    return np.concatenate([_CODES[np.frombuffer(raw, np.uint8)], np.full(SPAN, LETTERS - 1, np.int32)])


def subsequences(codes: np.ndarray):
    """For each pattern its weight and the subsequence that starts at each place, as a number."""
    n = max(0, len(codes) - SPAN)
    at = [codes[i:i + n] for i in range(SPAN)]
    for (i, j, k), weight in PATTERNS:
        yield weight, ((at[0] * LETTERS + at[i]) * LETTERS + at[j]) * LETTERS + at[k]


def letters_only(numbers: np.ndarray) -> np.ndarray:
    """Whether no place of a subsequence is a separator."""
    gap = LETTERS - 1
    digits = [numbers // LETTERS**i % LETTERS for i in range(LENGTH)]
    return np.logical_and.reduce([d != gap for d in digits])


def feature_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Weighted subsequences of a string, without its separators."""
    parts = [(x, np.full(len(x), w)) for w, x in subsequences(coded(raw))]
    numbers = np.concatenate([x for x, _ in parts])
    weights = np.concatenate([w for _, w in parts])
    good = letters_only(numbers)
    unique, which = np.unique(numbers[good], return_inverse=True)
    return unique, np.bincount(which, weights[good], minlength=len(unique))


def together(raw: bytes) -> bytes:
    """The text without the marks between letters that stand alone; numbers with few letters among them stay apart."""

    def put(found: re.Match) -> bytes:
        alone = bytes(c for c in found[0] if _ALNUM[c])
        return alone if 2 * sum(map(_DIGITS.__contains__, alone)) <= len(alone) else found[0]

    return SPACED.sub(put, raw)


def sentences(raw: bytes) -> list[bytes]:
    """Sentences in pieces of at most ``SENTENCE_CHARS``, for learning."""
    found = [s.strip() for s in SENTENCE.split(together(raw))]
    return [s[i:i + SENTENCE_CHARS] for s in found for i in range(0, len(s), SENTENCE_CHARS)]


def size_of(n_letters: np.ndarray | int) -> np.ndarray:
    """What kernel values of a string are divided by."""
    return np.sqrt(np.maximum(n_letters, 16))


@dataclass
class ToxicityModel:
    table: np.ndarray  # weight of each subsequence
    bias: float
    scale: tuple[float, float]  # margin of a text to log odds

    def margin(self, raw: bytes | None) -> float:
        """The greatest margin of a sentence of the text; that of an empty sentence if there is none."""
        if not raw:
            return self.bias
        best = self.bias
        codes, borders = _coded_sentences(raw)
        for a, b in _stretches(borders, STRETCH):
            stretch = codes[borders[a]:borders[b] + SPAN]
            starts = borders[a:b] - borders[a]
            sums = np.add.reduceat(self._values(stretch), starts)
            n_letters = np.add.reduceat((stretch[:-SPAN] < LETTERS - 1).astype(np.int32), starts)
            best = max(best, float((sums / size_of(n_letters)).max()) + self.bias)
        return best

    def _values(self, codes: np.ndarray) -> np.ndarray:
        """Summed weights of the subsequences that start at each place, the shorter spans first."""
        n = len(codes) - SPAN
        digits = [codes * (LETTERS ** (LENGTH - 1 - i)) for i in range(LENGTH)]
        total, number, weight = np.zeros(n, np.float32), np.empty(n, np.int32), np.empty(n, np.float32)
        for last in range(LENGTH - 1, SPAN):
            of_span = np.zeros(n, np.float32)
            for i, j in combinations(range(1, last), 2):
                np.add(digits[0][:n], digits[1][i:i + n], out=number)
                number += digits[2][j:j + n]
                number += digits[3][last:last + n]
                np.take(self.table, number, out=weight, mode="clip")
                of_span += weight
            of_span *= np.float32(GAP_COST ** (last + 1 - LENGTH))
            total += of_span
        return total

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale[0] * margin + self.scale[1], -30, 30))))


def _coded_sentences(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text with separators between sentences, and where sentences start, with the end."""
    spread = SENTENCE.sub(_APART, together(raw))
    codes = coded(spread)
    gaps = np.frombuffer(spread, np.uint8) == 0
    starts = np.flatnonzero(gaps[:-1] & ~gaps[1:]) + 1
    return codes, np.unique(np.concatenate([[0], starts, [len(spread)]]))


def _stretches(borders: np.ndarray, most: int):
    """Runs of sentences of about ``most`` characters, so that memory does not follow the text."""
    a = 0
    while a < len(borders) - 1:
        b = max(a + 1, int(np.searchsorted(borders, borders[a] + most, side="right")) - 1)
        yield a, b
        a = b


# --- learning ------------------------------------------------------------------------------------------


def choose_landmarks(found: Sequence[bytes], toxic: np.ndarray, n: int = LANDMARKS) -> list[bytes]:
    """Words that mark either label most (log odds times evidence), then frequent ones."""
    in_toxic, in_clean = Counter(), Counter()
    for sentence, label in zip(found, toxic, strict=True):
        (in_toxic if label else in_clean).update(set(WORD.findall(sentence.lower())))
    total = {True: max(1, int(toxic.sum())), False: max(1, int((~toxic).sum()))}
    gain = {}
    for word in in_toxic.keys() | in_clean.keys():
        p = (in_toxic[word] + 0.5) / (total[True] + 1)
        q = (in_clean[word] + 0.5) / (total[False] + 1)
        gain[word] = (p - q) * np.log(p / q) * (1 if p > q else -1)
    by_gain = sorted(gain, key=lambda w: (-gain[w], w))
    frequent = sorted(gain, key=lambda w: (-in_clean[w] - in_toxic[w], w))
    return list(dict.fromkeys([*by_gain[:n // 2], *by_gain[::-1][:n // 4], *frequent]))[:n]


def train_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps over the rows inside the margin; last weight: bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (x @ w) < 1
        xa = x[inside] * weight[inside, None]
        new = np.linalg.solve(ridge + x[inside].T @ xa, xa.T @ y[inside])
        if np.allclose(new, w, rtol=1e-5, atol=1e-8):
            break
        w = new
    return w


def learn(found: Sequence[bytes], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """The table and the bias from sentences and the labels of the documents that they are of."""
    table = np.zeros(LETTERS**LENGTH, np.float32)
    if not len(toxic) or toxic.all() or not toxic.any():
        return table, 1.0 if len(toxic) and toxic.all() else -1.0
    marks = choose_landmarks(found, toxic)
    parts = [feature_counts(m) for m in marks]
    known = np.unique(np.concatenate([u for u, _ in parts]))
    phi = np.zeros((len(marks), len(known)))
    for row, (u, c) in zip(phi, parts, strict=True):
        row[np.searchsorted(known, u)] = c
    column = np.full(LETTERS**LENGTH, len(known), np.int32)
    column[known] = np.arange(len(known))
    kernel = np.zeros((len(found), len(marks)))
    for i, sentence in enumerate(found):
        codes = coded(sentence)
        counts = sum(w * np.bincount(column[x], minlength=len(known) + 1) for w, x in subsequences(codes))
        kernel[i] = phi @ counts[:-1] / size_of(int((codes < LETTERS - 1).sum()))
    values, axes = np.linalg.eigh(phi @ phi.T)
    good = values > values.max() * 1e-6
    root = axes[:, good] / np.sqrt(values[good]) @ axes[:, good].T
    x, positive = kernel @ root, toxic.copy()
    w = np.zeros(x.shape[1] + 1)
    for _ in range(ROUNDS):
        used = positive | ~toxic
        y = np.where(positive, 1.0, -1.0)[used]
        share = MARGIN_COST * np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
        w = train_machine(x[used], y, share)
        found_toxic = toxic & (x @ w[:-1] + w[-1] > 0)
        if not found_toxic.any():
            break
        positive = found_toxic
    table[known] = (root @ w[:-1]) @ phi
    return table, float(w[-1])


def fit_scale(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[float, float]:
    """Logistic regression of the label on the margin of a text, held a little to the middle.

    A weight says for how many texts a sampled one stands.
    """
    if not len(margins):
        return 1.0, 0.0
    weights = np.ones(len(margins)) if weights is None else weights
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (weights * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weights * (labels - p)) - 1e-3 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.0)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from documents with a label 0 or 1 in ``toxic``, a bounded number of each, lowest by a hash of the id.

    The scale corrects for the bounds by the numbers of both labels over all of these documents, so that a score means
    the same at every size. Labels of the same id that differ count as toxic; rows without id, text or label are not learned from.
    """
    marked = labels.filter("doc_id is not null and toxic in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.filter("text is not null")
    present = marked.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r.toxic: r["count"] for r in present.groupBy("toxic").count().collect()}
    chosen = None
    for label, n in SAMPLE_DOCS.items():
        some = present.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = some if chosen is None else chosen.union(some)
    # The ids are as many as SAMPLE_DOCS allows, so they may be broadcast; the texts stay where they are.
    sample = texts.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    set_checkpoint_dir(docs.sparkSession)
    sample = sample.repartition(8, "doc_id").checkpoint()

    def cut(batches):
        for batch in batches:
            ids, texts, toxic = batch.columns
            rows = [(i, y, s) for i, raw, y in zip(ids.to_pylist(), texts.cast(pa.binary()).to_pylist(),
                                                   toxic.to_pylist(), strict=True) for s in sentences(raw) if s]
            made = list(zip(*rows, strict=True)) if rows else [[]] * 3
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(made, kinds, strict=True)], ["doc_id", "toxic", "sentence"]
            )

    found = sample.select(F.col("doc_id").cast("long"), "text", "toxic").mapInArrow(
        cut, "doc_id long, toxic int, sentence binary"
    )
    ordered = found.orderBy(F.xxhash64("doc_id", "sentence"), "doc_id", "sentence")
    found = [r for y, n in SAMPLE_SENTENCES.items() for r in ordered.filter(F.col("toxic") == y).limit(n).collect()]
    toxic = np.array([r.toxic == 1 for r in found], bool)
    table, bias = learn([bytes(r.sentence) for r in found], toxic)
    model = ToxicityModel(table, bias, (1.0, 0.0))
    margins = map_texts(sample, ["toxic"], "margin double", lambda: lambda xs: [[model.margin(x) for x in xs]]).collect()
    stands_for = {label: n / min(n, SAMPLE_DOCS[label]) for label, n in total.items()}
    weights = np.array([stands_for[r.toxic] for r in margins])
    model.scale = fit_scale(np.array([r.margin for r in margins]), np.array([r.toxic for r in margins]), weights)
    return model


def toxicity(docs: DataFrame, model: ToxicityModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Score and prediction of each text, one row for each row of ``docs``.

    The score is the probability of label 1 by the most toxic sentence of the whole text. Null and empty texts get
    the score of an empty sentence. Texts of any length are scored whole, a stretch at a time; of equal margins it does
    not matter which sentence gave them. Repeated rows give repeated results; columns of ``docs`` outside ``keep`` are
    not read; an empty table gives no rows.
    """

    def scan(texts):
        scores = [model.score(model.margin(x)) for x in texts]
        return scores, [int(s >= 0.5) for s in scores]

    return map_texts(docs, keep, "score double, predicted int", lambda: scan)


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those that are not held out."""
    return docs.filter(~held_out(5, 0))
