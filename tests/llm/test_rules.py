"""The rule ensemble: its statistics and scores against a plain version, and its accuracy on held-out labels."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest

from telescale.llm import rules
from telescale.llm.queries import QUERIES
from tests.llm import plain

SF_MORE = "/root/testdata/sf0.01"


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return dict.fromkeys(rules.NAMES, 0.0)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    parts = [words[i:i + 100] for i in range(0, len(words), 100)]
    return {
        "n_words": len(words), "word_chars": len("".join(words)) / len(words),
        "symbols_per_word": len(re.findall(r"[#*$%&|<>]", text)) / len(words),
        "marks_per_word": len(re.findall(r"""[.,;:!?"'()/-]""", text)) / len(words),
        "upper_share": len(re.findall("[A-Z]", text)) / len(text), "digit_share": len(re.findall("[0-9]", text)) / len(text),
        "distinct_words": sum(len(set(p)) for p in parts) / len(words),
        "repeats_per_word": sum(a == b for a, b in zip(words, words[1:])) / len(words),
        "distinct_lines": len(set(lines)) / len(lines), "words_per_line": len(words) / len(lines),
    }


def plain_score(model, text):
    found = plain_statistics(text)
    odds = model.intercept
    for rule, weight in model.rules:
        odds += weight * all((found[n] > t) if above else (found[n] <= t) for n, above, t in rule)
    return 1 / (1 + math.exp(-odds))


LONG = [(50, "Word after word, and so on.\n" * 40_000)]


def test_statistics():
    for _, text in [*plain.ODD, *LONG]:
        got = dict(zip(rules.NAMES, rules.statistics(None if text is None else text.encode()), strict=True))
        assert got == pytest.approx(plain_statistics(text))


@pytest.fixture(scope="module")
def taught():
    rng = np.random.default_rng(2)
    x = rng.random((600, len(rules.NAMES)))
    y = ((x[:, 2] <= 0.6) & (x[:, 6] > 0.3)).astype(float)
    return x, y, rules.learn(x, y, np.ones(600))


def test_rules_are_found_and_few(taught):
    """A conjunction is learned as such."""
    x, y, model = taught
    assert 0 < len(model.rules) < 40
    odds = model.intercept + sum(w * rules.holds(r, x, rules.NAMES) for r, w in model.rules)
    assert ((odds > 0) == (y > 0)).mean() > 0.97
    weightiest = max(model.rules, key=lambda r: abs(r[1]))[0]
    assert {n for n, _, _ in weightiest} & {"symbols_per_word", "distinct_words"}


def test_the_lasso_is_at_its_optimum():
    """No weight moves: the gradient of a kept rule equals the penalty, that of a dropped one stays below it."""
    rng = np.random.default_rng(4)
    z = (rng.random((400, 12)) > 0.5).astype(float)
    y = (z[:, 0] + 0.5 * z[:, 1] + rng.random(400) > 1).astype(float)
    w, b = rules.lasso(z, y, np.ones(400), 0.01)
    slope = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / 400
    assert (w == 0).any() and (w != 0).any()
    assert np.allclose(slope[w != 0], -0.01 * np.sign(w[w != 0]), atol=1e-5)
    assert (np.abs(slope[w == 0]) <= 0.01 + 1e-5).all()


def test_scores_equal_the_plain_ones(spark, taught):
    model = taught[2]
    rows = [*plain.ODD, *LONG]
    docs = plain.docs_of(spark, rows).withColumnRenamed("fp", "_s")
    got = rules.score(docs, model, keep=("doc_id", "_s", "hash")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, round(r.score, 12)) for r in got) == sorted(
        (i is not None, i or 0, round(plain_score(model, t), 12)) for i, t in rows)
    assert all(r.predicted == (r.score >= 0.3) and r["_s"] == "x" for r in got)
    assert rules.score(plain.docs_of(spark, []), model).collect() == []


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = plain.docs_of(spark, plain.ODD)
    assert [r.score for r in rules.score(docs, rules.fit(docs, none)).collect()] == [0.5] * len(plain.ODD)
    ones = spark.createDataFrame([(1, 1, 0), (5, 1, None), (None, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 1 for r in rules.score(docs, rules.fit(docs, ones)).collect())


def test_held_out(spark):
    got = QUERIES["op12_rules"](spark, SF_MORE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MORE}/labels.parquet").collect() if r.quality is not None}
    held = [(r.predicted, good[r.doc_id]) for r in got if r.held_out and r.doc_id in good]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)
    assert sum(p for p, q in held if q) >= 0.98 * sum(q for _, q in held)


def test_long_clean_texts_stay_clean(spark):
    """Words that come back over a long text are no sign of bad quality."""
    docs = spark.read.parquet(f"{SF_MORE}/documents.parquet")
    model = rules.fit(rules.learning_rows(docs), spark.read.parquet(f"{SF_MORE}/labels.parquet"))
    rng = random.Random(1)
    words = [r.text.split() for r in docs.filter("lang = 'en'").join(
        spark.read.parquet(f"{SF_MORE}/labels.parquet").filter("quality = 1"), "doc_id").limit(30).collect()]
    words = [w for part in words for w in part]
    long = "\n".join(" ".join(rng.choices(words, k=40)) for _ in range(1000))
    assert rules.score(plain.docs_of(spark, [(1, long)]), model).first().predicted == 1
