"""Languages that are rare among the documents."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from telescale.llm import language
from tests.llm import plain

COMMON = "the river of stone and light over green fields with a quiet morning in the old town by water".split()
RARE = "съешь же ещё этих мягких французских булок да выпей чаю река камень свет над полем тихое утро город вода".split()


def made(rng, words, n):
    return " ".join(rng.choices(words, k=n))


def test_rare_language_is_learned(spark):
    rng = random.Random(5)
    rows = [(i, made(rng, COMMON, 40)) for i in range(2000)] + [(9000 + i, made(rng, RARE, 40)) for i in range(3)]
    docs = plain.docs_of(spark, rows).selectExpr("doc_id", "text", "if(doc_id < 9000, 'en', 'ru') as lang")
    model = language.fit(docs, sample=50)
    assert set(model.languages) == {"en", "ru"}
    short = made(rng, RARE, 12).encode()  # correct, and just long enough to be judged
    assert language.ngram_counts(short).sum() >= language.LEAST_NGRAMS
    names, _, rejected = model.predict([short, made(rng, COMMON, 40).encode()])
    assert names == ["ru", "en"] and rejected == [False, False]
    kept = language.known_language_only(spark, docs)
    assert kept.count() == docs.count()


def test_single_text_rejects_nothing():
    point = np.eye(1, language.DIMENSIONS, dtype=np.float32)
    assert language.threshold(point, 4) == 0
    assert language.threshold(np.repeat(point, 4, axis=0), 4) < 0.2


def plain_cosines(model, raw):
    """Cosines of a text with all centroids, one n-gram after the other."""
    letters = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in raw.decode().lower())
    data = (" " + " ".join(x for x in letters.split(" ") if x) + " ").encode()
    bins = Counter()
    for n in (2, 3):
        for i in range(len(data) - n + 1):
            h = data[i] * 257 + data[i + 1]
            h = h * 263 + data[i + 2] if n == 3 else h
            bins[h % 2**32 * 2654435761 % 2**32 >> 20] += 1
    weights = {b: math.log1p(k) * float(model.idf[b]) for b, k in bins.items()}
    length = math.sqrt(sum(w * w for w in weights.values()))
    return [sum(w * float(c[b]) for b, w in weights.items()) / length for c in model.centroids], sum(bins.values())


def test_predictions_equal_the_plain_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.learning_rows(docs))
    texts = [r.text.encode() for r in docs.filter("text is not null and length(text) < 3000").limit(60).collect()]
    texts += [x.encode() for _, x in plain.ODD if x and any(map(str.isalpha, x)) and len(x) < 6000]
    names, scores, rejected = model.predict(texts)
    for raw, name, score, bad in zip(texts, names, scores, rejected, strict=True):
        cosines, n = plain_cosines(model, raw)
        best = int(np.argmax(cosines))
        assert score == pytest.approx(max(0.0, cosines[best]), abs=1e-4)
        assert name == model.languages[best] or sorted(cosines)[-1] - sorted(cosines)[-2] < 1e-5
        assert bad == (cosines[best] < model.thresholds[best] and n >= language.LEAST_NGRAMS)


def test_idf_and_centroids_equal_the_plain_ones(spark):
    """Frequencies over all learning rows, counted one by one."""
    docs = language.learning_rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    model = language.fit(docs)
    texts = [r.text for r in docs.filter("text is not null and lang is not null").collect()]
    seen = Counter()
    for text in texts:
        seen.update(np.flatnonzero(language.ngram_counts(text.encode())).tolist())
    want = [math.log((1 + len(texts)) / (1 + seen[b])) + 0.05 for b in range(language.DIMENSIONS)]
    assert model.idf.tolist() == pytest.approx(want, abs=1e-5)
    assert np.linalg.norm(model.centroids, axis=1) == pytest.approx(1, abs=1e-3)


def test_a_dirty_column_of_languages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rng = random.Random(6)
    rows = [(i, made(rng, COMMON, 20)) for i in range(60)]
    docs = plain.docs_of(spark, rows).selectExpr("doc_id", "text", "if(doc_id < 40, concat('l', doc_id % 2), concat('x', doc_id)) as lang")
    assert len(set(language.fit(docs).languages)) == 3


def test_a_very_long_text(spark):
    rng = random.Random(7)
    docs = plain.docs_of(spark, [(1, made(rng, COMMON, 60)), (2, made(rng, RARE, 60))]).selectExpr(
        "doc_id", "text", "if(doc_id = 1, 'en', 'ru') as lang")
    model = language.fit(docs)
    long = plain.docs_of(spark, [(7, made(rng, RARE, 200_000))])
    assert [r.lang_pred for r in language.identify(long, model).collect()] == ["ru"]
