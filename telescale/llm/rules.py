"""Quality of texts by a sparse ensemble of rules.

Statistics of a text come from one pass over its bytes. On a bounded sample of labelled texts small trees are grown,
each on what those before it got wrong; every path from a root to a node is a rule, a conjunction of comparisons. A
logistic regression with a lasso penalty keeps the few rules that matter, and these are compiled to one Spark expression
over the statistics, so scoring is a plain projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import islice
from operator import eq
from string import ascii_uppercase, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import free_prefix, held_out, map_texts

#: Labelled documents learned from, at most, for each label.
SAMPLE_DOCS = {0: 4000, 1: 4000}
TREES, DEPTH, RATE = 60, 3, 0.3
#: Thresholds tried for each statistic, and the least share of the sample in a node.
CUTS, LEAST_SHARE = 24, 0.005
#: Weight of the lasso penalty, and steps of the descent.
PENALTY, STEPS = 2e-3, 600

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, above, threshold), all of which hold

NAMES = (
    "n_words", "word_chars", "symbols_per_word", "marks_per_word", "upper_share", "digit_share", "distinct_words",
    "repeats_per_word", "distinct_lines", "words_per_line")


def _class_of(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


_SYMBOLS, _MARKS = _class_of(b"#*$%&|<>"), _class_of(b".,;:!?\"'()-/")
_UPPER, _DIGITS, _WHITE = _class_of(ascii_uppercase.encode()), _class_of(digits.encode()), _class_of(b" \t\n\x0b\x0c\r")
_STARTS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a character
STRETCH = 100


def statistics(raw: bytes | None) -> tuple[float, ...]:
    """Statistics of a whole text, in the order of ``NAMES``; zeros if it has no word.

    Shares do not fall with the length of a text: distinct words are counted in stretches of 100 words.
    """
    words = (raw or b"").split()
    if not words:
        return (0.0,) * len(NAMES)
    n, counts = len(words), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n_chars = counts[_STARTS].sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = sum(len(set(words[i:i + STRETCH])) for i in range(0, n, STRETCH))
    return tuple(map(float, (
        n, (n_chars - counts[_WHITE].sum()) / n, counts[_SYMBOLS].sum() / n, counts[_MARKS].sum() / n,
        counts[_UPPER].sum() / n_chars, counts[_DIGITS].sum() / n_chars, distinct / n,
        sum(map(eq, words, islice(words, 1, None))) / n, len(set(lines)) / len(lines), n / len(lines))))


def measured(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of each row and the statistics of its text, a structure ``_s`` (or ``_s_``, ...)."""
    name = free_prefix(docs.select(*keep), "_s")
    found = f"{name} struct<{', '.join(f'{n}: double' for n in NAMES)}>"
    kind = pa.struct([(n, pa.float64()) for n in NAMES])

    def make():
        return lambda texts: [pa.array([dict(zip(NAMES, statistics(x), strict=True)) for x in texts], kind)]

    return map_texts(docs, keep, found, make)


# --- rules from trees --------------------------------------------------------------------------------------


def holds(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    found = np.ones(len(x), bool)
    for name, above, threshold in rule:
        column = x[:, names.index(name)]
        found &= (column > threshold) if above else (column <= threshold)
    return found


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Thresholds for each column: between neighbouring quantiles that differ."""
    out = []
    for column in x.T:
        seen = np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 1), method="lower"))
        out.append((seen[1:] + seen[:-1]) / 2)
    return out


def grow(x: np.ndarray, residual: np.ndarray, curve: np.ndarray, cuts: Sequence[np.ndarray], names: Sequence[str]):
    """A tree by Newton gain: yields (rule, rows, value) for each node; the leaves are those of full depth or pure."""
    least = LEAST_SHARE * len(x)

    def value(rows):
        return residual[rows].sum() / (curve[rows].sum() + 1.0)

    def gain(rows):
        return residual[rows].sum() ** 2 / (curve[rows].sum() + 1.0)

    def split(rule: Rule, rows: np.ndarray, depth: int):
        best = (1e-9, None)
        if depth < DEPTH:
            whole = gain(rows)
            for j, thresholds in enumerate(cuts):
                for threshold in thresholds:
                    above = rows & (x[:, j] > threshold)
                    below = rows & ~above
                    if min(above.sum(), below.sum()) >= least:
                        best = max(best, (gain(above) + gain(below) - whole, (j, threshold)), key=lambda b: b[0])
        if best[1] is None:
            yield rule, rows, value(rows), True
            return
        if rule:
            yield rule, rows, value(rows), False
        j, threshold = best[1]
        for above in (False, True):
            side = rows & ((x[:, j] > threshold) == above)
            yield from split((*rule, (names[j], above, float(threshold))), side, depth + 1)

    yield from split((), np.ones(len(x), bool), 0)


def find_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: Sequence[str]) -> list[Rule]:
    """All paths of boosted trees, each once."""
    cuts, odds = _cuts(x), np.zeros(len(x))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        for rule, rows, step, leaf in grow(x, weight * (y - p), weight * p * (1 - p), cuts, names):
            if rule:
                rules[tuple(sorted(rule))] = None
            if leaf:
                odds[rows] += RATE * step
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with a lasso penalty, by accelerated proximal steps."""
    z = np.hstack([z, np.ones((len(z), 1))])
    weight = weight / weight.sum()
    rate = 4 / np.linalg.eigvalsh((z * weight[:, None]).T @ z)[-1]
    w = ahead = np.zeros(z.shape[1])
    pace = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        new = ahead - rate * (z.T @ (weight * (p - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - w)
        w, pace = new, faster
    return w[:-1], float(w[-1])


# --- the model -----------------------------------------------------------------------------------------------


@dataclass
class RuleModel:
    rules: list[tuple[Rule, float]]
    intercept: float

    def odds(self, measured: Column) -> Column:
        """Log odds of label 1 over a structure of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, above, threshold in rule:
                column = measured[name]
                holds = holds & ((column > F.lit(threshold)) if above else (column <= F.lit(threshold)))
            total = total + F.when(holds, F.lit(weight)).otherwise(0.0)
        return total

    def said(self) -> list[str]:
        """Rules and weights as text, the weightiest first."""
        return [f"{weight:+.3f}  " + " and ".join(f"{n} {'>' if above else '<='} {t:.4g}" for n, above, t in rule)
                for rule, weight in sorted(self.rules, key=lambda r: -abs(r[1]))]


def learn(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: Sequence[str] = NAMES) -> RuleModel:
    """A model from statistics, labels and the number of texts that each row stands for."""
    if not len(y) or y.min() == y.max():
        return RuleModel([], 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1))
    weight = weight * len(weight) / weight.sum()
    rules = find_rules(x, y, weight, names)
    weights, intercept = lasso(np.stack([holds(r, x, names) for r in rules], axis=1).astype(float), y, weight)
    return RuleModel([(r, float(w)) for r, w in zip(rules, weights, strict=True) if w != 0], intercept)


def fit(docs: DataFrame, labels: DataFrame) -> RuleModel:
    """Learn from documents with a label 0 or 1 in ``quality``, at most ``SAMPLE_DOCS`` of each, lowest by a hash of the id.

    Rows are weighted by the numbers of both labels over all of these documents, so that a score means the same at every
    size. Labels of the same id that differ count as 0; rows without id, text or label are not learned from. Only the
    statistics of the sample come to the driver.
    """
    marked = labels.filter("doc_id is not null and quality in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_label"))
    texts = docs.filter("text is not null").select("doc_id", "text")
    present = marked.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r["_label"]: r["count"] for r in present.groupBy("_label").count().collect()}
    chosen = None
    for label, n in SAMPLE_DOCS.items():
        some = present.filter(F.col("_label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = some if chosen is None else chosen.union(some)
    # The ids are as many as SAMPLE_DOCS allows, so they may be broadcast; the texts stay where they are.
    sample = texts.join(F.broadcast(chosen), "doc_id")
    found = measured(sample, ["doc_id", "_label"]).select("doc_id", "_label", "_s.*").orderBy("doc_id", *NAMES)
    rows = found.limit(2 * sum(SAMPLE_DOCS.values())).collect()
    y = np.array([r["_label"] for r in rows], float)
    x = np.array([[r[n] for n in NAMES] for r in rows], float).reshape(-1, len(NAMES))
    stands_for = {label: n / min(n, SAMPLE_DOCS[label]) for label, n in total.items()}
    return learn(x, y, np.array([stands_for[r["_label"]] for r in rows], float))


def score(docs: DataFrame, model: RuleModel, least: float = 0.3, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``score`` and ``predicted`` of each whole text: the probability of label 1, and whether it is ``least`` or more.

    One row for each row of ``docs``; null and empty texts have statistics of zero and are scored like others. Columns
    outside ``keep`` are not read, so their names do not matter. Repeated rows and ties give equal results.
    """
    found = measured(docs, keep)
    scored = found.select(*keep, (1 / (1 + F.exp(-model.odds(F.col(found.columns[-1]))))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those that are not held out."""
    return docs.filter(~held_out(5, 0))
