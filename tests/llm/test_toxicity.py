"""Toxicity scores that do not depend on the bounds of learning."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from telescale.llm import toxicity
from tests.llm import plain

WORDS = "the river of stone and light over green fields with a quiet morning in the old town by water".split()


@pytest.mark.parametrize("bounds", [{0: 4000, 1: 2000}, {0: 60, 1: 50}])
def test_scores_hold_when_the_bounds_are_full(spark, monkeypatch, bounds):
    """Labels are partly noise, so that the mean score is the share of the label only if the scale is right."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        words = rng.choices(WORDS, k=12)
        if rng.random() < 0.1:
            words[rng.randrange(12)] = "blorfnak"
        toxic = rng.random() < (0.6 if "blorfnak" in words else 0.03)
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", bounds)
    docs = plain.docs_of(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = [model.score(model.margin(text.encode())) for _, text in rows]
    share = sum(y for *_, y in labels) / len(labels)
    assert sum(scores) / len(scores) == pytest.approx(share, abs=0.05)


INSULTS = ("blorfnak", "grimzot")


def taught():
    rng = random.Random(8)
    found, toxic = [], []
    for i in range(1200):
        words = rng.choices(WORDS, k=10)
        if i % 5 == 0 and rng.random() < 0.6:
            words[rng.randrange(10)] = rng.choice(INSULTS)
        found.append(" ".join(words).encode())
        toxic.append(i % 5 == 0)
    return toxicity.ToxicityModel(*toxicity.learn(found, np.array(toxic)), (1.0, 0.0))


def test_marks_between_letters_hide_nothing():
    model = taught()
    clean = model.margin(b"the old river by the green water")
    for insult in INSULTS:
        for mark in (".", "-", " ", "..", " - ", ". ", "...", "*_*", " · "):
            said = f"the old {mark.join(insult)} by the water".encode()
            assert model.margin(said) > clean + 0.3, said
            assert toxicity.together(said) == f"the old {insult} by the water".encode()
    assert toxicity.sentences(b"it is b. l. o. r. f. n. a. k. here. And so on") == [b"it is blorfnak", b"here", b"And so on"]
    for same in (b"1 2 3 4 5 6", b"a b c", b"the u.s.a. of", b"one two three four", b""):
        assert toxicity.together(same) == same


LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


def plain_features(text):
    """Weights of all subsequences of four letters within seven characters, tuple of places by tuple of places."""
    letters = [LEET.get(c, c) if c.isascii() and (c.isalpha() or c in LEET) else None for c in text.lower()]
    out = defaultdict(float)
    for places in combinations(range(len(letters)), 4):
        said = [letters[i] for i in places]
        if places[3] - places[0] < 7 and None not in said:
            out["".join(said)] += 0.6 ** (places[3] - places[0] - 3)
    return out


def plain_kernel(a, b):
    return sum(w * b.get(said, 0.0) for said, w in a.items())


def test_the_machine_is_one_of_the_kernel():
    """A margin is a sum of kernel values with the landmarks, each worked out from all tuples of places."""
    rng = random.Random(4)
    found, toxic = [], []
    for i in range(200):
        words = rng.choices(WORDS[:12], k=4)
        if i % 4 == 0:
            words[rng.randrange(4)] = rng.choice(INSULTS)
        found.append(" ".join(words).encode())
        toxic.append(i % 4 == 0)
    toxic = np.array(toxic)
    model = toxicity.ToxicityModel(*toxicity.learn(found, toxic), (1.0, 0.0))
    marks = [plain_features(m.decode()) for m in toxicity.choose_landmarks(found, toxic)]
    known = sorted(set().union(*marks))
    phi = np.array([[m.get(said, 0.0) for said in known] for m in marks])

    def number(said):
        out = 0
        for c in said:
            out = out * 27 + ord(c) - 97
        return out

    table = np.array([model.table[number(said)] for said in known])
    assert np.count_nonzero(model.table) <= len(known)
    parts, *_ = np.linalg.lstsq(phi.T, table, rcond=None)
    assert phi.T @ parts == pytest.approx(table, abs=1e-4 * float(np.abs(table).max()))  # the table is made of landmarks
    for text in ("the old grimzot", "gri-mzot", "gr1mz0t by water", "a blxorfnak of", "river stone and light", "xyz", "GRIMZOT!"):
        value = sum(p * plain_kernel(m, plain_features(text)) for p, m in zip(parts, marks))
        letters = sum(c.isalpha() or c in LEET for c in text)
        want = max(model.bias, value / max(letters, 16) ** 0.5 + model.bias)
        assert model.margin(text.encode()) == pytest.approx(want, abs=2e-3 * max(1, abs(want))), text


def test_nystrom_keeps_the_kernel_of_landmarks():
    """Vectors of two landmarks have their kernel value as product."""
    marks = [b"blorfnak", b"grimzot", b"river", b"stone", b"light", b"fields"]
    parts = [plain_features(m.decode()) for m in marks]
    kernel = np.array([[plain_kernel(a, b) for b in parts] for a in parts])
    counts = [dict(zip(*(x.tolist() for x in toxicity.feature_counts(m)))) for m in marks]
    own = np.array([[sum(w * b.get(u, 0.0) for u, w in a.items()) for b in counts] for a in counts])
    assert own == pytest.approx(kernel)


def test_held_out_documents(spark):
    """Labels that were not learned from, near half of which are noise: toxic documents are caught, clean ones left alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(toxicity.learning_rows(docs), labels)
    rows = docs.filter(toxicity.held_out(5, 0)).join(labels, "doc_id")
    got = toxicity.toxicity(rows, model, ("doc_id", "toxic")).collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert len(toxic) > 50 and sum(r.predicted for r in toxic) >= 0.5 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_a_very_long_text(spark):
    model = taught()
    long = "the quiet morning by the water. " * 60_000
    docs = plain.docs_of(spark, [(1, long), (2, long + "the old blorfnak"), (3, "x" * 1_000_000)])
    margins = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert margins[2] > margins[1] and margins[3] <= margins[2]
