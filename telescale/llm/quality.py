"""Quality rules as a short-circuit cascade, cheapest rejection first.

Each rule looks at measures of one text. On a sample of the texts every measure is timed and every rule run. The order is
then built up rule by rule: next comes the one that rejects most of the texts still kept for each second that it adds,
where a measure costs nothing once an earlier rule has taken it. Over all texts a rule runs, and its measures are taken,
only if the rules before it passed. The order changes the time, never the verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property
from string import ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import map_texts, window_hashes, word_hashes

#: Texts that costs and selectivity are estimated on, about.
SAMPLE = 400
SYMBOLS = re.compile(rb"[#*$%&|<>]")


class Measured:
    """A text and what rules ask of it, each worked out when first asked for."""

    def __init__(self, raw: bytes | None) -> None:
        self.raw = raw or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that start a character, without those of white space."""
        held = np.frombuffer(b"".join(self.words), np.uint8)
        return int(np.count_nonzero((held & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.raw))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three that the text holds twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        windows = window_hashes(word_hashes(self.words), 3)
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        inside = np.zeros(n, bool)
        for offset in range(3):
            inside[offset:offset + len(twice)] |= twice
        return int(np.count_nonzero(inside))

    @cached_property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < 50 or 100 * self.n_repeat_words > 50 * n

    @cached_property
    def n_letter_words(self) -> int:
        """Words that hold a letter."""
        return sum(any(map(str.isalpha, w.decode())) for w in self.words)

    @cached_property
    def n_capitals(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, ascii_uppercase.encode()))

    @cached_property
    def n_commonest(self) -> int:
        """How often the commonest word stands in the text."""
        return max(Counter(self.words).values(), default=0)


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a text goes; it looks at the measures ``needs``."""

    needs: tuple[str, ...]
    rejects: Callable[[Measured], bool]


#: Rules by name. Limits are wide: a clean text stays far from them. The first two make up ``base_failed``.
RULES: dict[str, Rule] = {
    "few_words": Rule(("words",), lambda x: len(x.words) < 50),
    "repeated_words": Rule(("words", "n_repeat_words"), lambda x: 100 * x.n_repeat_words > 50 * len(x.words)),
    "word_length": Rule(("words", "word_chars"), lambda x: not 2 * len(x.words) <= x.word_chars <= 15 * len(x.words)),
    "symbols": Rule(("words", "n_symbols"), lambda x: 4 * x.n_symbols > len(x.words)),
    "duplicate_lines": Rule(("lines", "n_dup_lines"), lambda x: 10 * x.n_dup_lines > 3 * len(x.lines)),
    "words_without_letters": Rule(("words", "n_letter_words"), lambda x: 5 * x.n_letter_words < 3 * len(x.words)),
    "capitals": Rule(("words", "word_chars", "n_capitals"), lambda x: 2 * x.n_capitals > x.word_chars),
    "one_word": Rule(("words", "n_commonest"), lambda x: 3 * x.n_commonest > len(x.words)),
}
#: Measures in an order in which each follows those that it is made from.
MEASURES = ("words", "lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_capitals",
            "n_commonest")


def best_order(seconds: np.ndarray, rejected: np.ndarray, measures: Sequence[str], rules: Sequence[str]) -> list[str]:
    """Names of the rules in the order that pays, from the cost of each measure and the verdict of each rule by text."""
    kept, taken, order = np.ones(len(seconds), bool), set(), []
    left = list(rules)
    while left:
        def gain(name):
            new = [measures.index(m) for m in RULES[name].needs if m not in taken]
            cost = float(seconds[kept][:, new].sum()) + 1e-9
            return int(rejected[kept, rules.index(name)].sum()) / cost, -cost

        best = max(left, key=gain)
        left.remove(best)
        order.append(best)
        taken |= set(RULES[best].needs)
        kept &= ~rejected[:, rules.index(best)]
    return order


def rule_order(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """``best_order`` on about ``sample`` texts, each of which comes to the driver as one row of numbers."""
    total = docs.count()
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < (1_000_000 * min(1.0, sample / max(1, total)))
    names = list(RULES)

    def measure(batches):
        for batch in batches:
            seconds, rejected = [], []
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                text, spent = Measured(raw), []
                for name in MEASURES:
                    began = time.perf_counter()
                    getattr(text, name)
                    spent.append(time.perf_counter() - began)
                seconds.append(spent)
                rejected.append([bool(RULES[name].rejects(text)) for name in names])
            yield pa.RecordBatch.from_arrays(
                [pa.array(seconds, pa.list_(pa.float64())), pa.array(rejected, pa.list_(pa.bool_()))], ["s", "rejected"])

    measured = docs.filter(F.coalesce(share, F.lit(False))).select("text")
    found = measured.mapInArrow(measure, "s array<double>, rejected array<boolean>").collect()
    seconds = np.array([r.s for r in found], float).reshape(-1, len(MEASURES))
    rejected = np.array([r.rejected for r in found], bool).reshape(-1, len(names))
    return best_order(seconds, rejected, MEASURES, names)


def passes(text: Measured, order: Sequence[str]) -> bool:
    """Run the rules in turn until one rejects."""
    return not any(RULES[name].rejects(text) for name in order)


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean"
)


def quality(docs: DataFrame, keep: Sequence[str] = ("doc_id",), order: Sequence[str] | None = None) -> DataFrame:
    """Measures and verdict of each text, one row for each row of ``docs``.

    The cascade comes first; of the measures listed here those that it skipped are then taken, the others are not. A null
    text counts as an empty one: no words, base_failed, not kept. Texts of any length are measured whole. Repeated rows
    give repeated results, columns of ``docs`` outside ``keep`` are not read, and an empty table gives no rows.
    """
    order = rule_order(docs) if order is None else list(order)

    def scan(texts):
        rows = []
        for raw in texts:
            x = Measured(raw)
            kept = passes(x, order)
            rows.append((len(x.words), x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed, kept))
        return list(zip(*rows, strict=True)) if rows else [[]] * 7

    return map_texts(docs, keep, RESULT, lambda: scan)


def kept_documents(docs: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """``docs`` without the rows that a rule rejects; rules after the first rejection do not run, nor their measures."""
    from telescale.llm.texts import free_prefix

    order = rule_order(docs) if order is None else list(order)
    name = free_prefix(docs, "_kept")
    marked = map_texts(docs, docs.columns, f"{name} boolean",
                       lambda: lambda texts: [[passes(Measured(x), order) for x in texts]])
    return marked.filter(name).select(*docs.columns)
