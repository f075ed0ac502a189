"""Operators with learned or chosen results: held-out accuracy, awkward documents, and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from telescale.llm import language, pieces, secrets, toxicity
from telescale.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm import plain

SF_MORE = "/root/testdata/sf0.01"


def test_novel_secrets():
    rng = random.Random(4)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(40))
    scan = secrets.scanner()
    text = f"curl -H 'Authorization: Bearer {key}' http://localhost"
    start = text.index(key)
    assert scan(text) == [(start, 3, start + len(key))]
    assert scan(f"some words and {key} without context") == []
    for known in ("the credential is authorization_access_token_here", f"{key[:10]} bearer tokentokentokentokentoken",
                  "private key example-placeholder-changeme"):
        assert scan(known) == [], known
    twice = f"seen {key} before\nbearer {key}"  # a second copy hides nothing
    assert [twice[a:b] for a, _, b in scan(twice)] == [key, key]


def test_redaction(spark):
    rows = [(1, "a password=12345678 b AKIA" + "Z" * 16), (2, None), (3, ""), (4, "clean é text")]
    docs = plain.docs_of(spark, rows)
    got = secrets.redact_secrets(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    found = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
    assert found == {1: ("a [SECRET] b [SECRET]", 21), 2: (None, 0), 3: ("", 0), 4: ("clean é text", 12)}


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(language.learning_rows(spark.read.parquet(f"{SF_MORE}/documents.parquet")))


def test_language_held_out(spark):
    got = QUERIES["op5_language"](spark, SF_MORE).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MORE}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.98 * len(held)
    assert sum(r.rejected for r in got) < 0.01 * len(got)


def test_language_of_odd_texts(spark, model):
    got = language.identify(plain.docs_of(spark, plain.ODD), model).collect()
    assert len(got) == len(plain.ODD)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {2, 3, 4, 10}
    assert all(r.rejected for r in got if r.doc_id in und)
    foreign = model.predict(["Съешь же ещё этих мягких французских булок да выпей чаю ".encode() * 5])
    assert foreign[2] == [True]


def test_language_without_examples(spark):
    empty = plain.docs_of(spark, [])
    found = language.fit(empty)
    assert found.languages == []
    assert [r.lang_pred for r in language.identify(plain.docs_of(spark, [(1, "text")]), found).collect()] == ["und"]
    assert language.identify(empty, found).collect() == []


def test_toxicity_held_out(spark):
    got = QUERIES["op8_toxicity"](spark, SF_MORE).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MORE}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.score, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    pairs = [(b > g) + 0.5 * (b == g) for b in bad for g in good]
    assert sum(pairs) > 0.7 * len(pairs)  # some labels are noise
    assert sum(r.predicted for r in got) < 0.2 * len(got)


WORDS = "the river of stone and light over green fields with a quiet morning in the old town by water".split()
INSULTS = ("blorfnak", "grimzot")


@pytest.fixture(scope="module")
def taught():
    rng = random.Random(8)
    found, toxic = [], []
    for i in range(300):
        for _ in range(4):
            words = rng.choices(WORDS, k=10)
            if i % 5 == 0 and rng.random() < 0.6:
                words[rng.randrange(10)] = rng.choice(INSULTS)
            found.append(" ".join(words).encode())
            toxic.append(i % 5 == 0)
    return toxicity.ToxicityModel(*toxicity.learn(found, np.array(toxic)), (1.0, 0.0))


def test_toxicity_tolerates_gaps(taught):
    clean = taught.margin(b"the old river by the green water")
    assert clean < 0
    for insult in (b"blorfnak", b"BLORFNAK", b"bl0rfnak", b"blorxfnak", b"b.l.o.r.f.n.a.k", b"grim-zot", b"gr1mz0t"):
        assert taught.margin(b"the old " + insult + b" by the water") > clean + 0.3, insult
    far = b"the quiet morning. " * 20_000 + b"the old blorfnak by the water"
    assert taught.margin(far) == pytest.approx(taught.margin(b"the old blorfnak by the water"), abs=1e-4)


def test_table_holds_the_kernel(taught):
    """The margin of a sentence is the sum of its subsequences' weights, gaps paid for."""
    text = b"a grimzot, blorf nak"
    total = sum(w * float(taught.table[x].sum()) for w, x in toxicity.subsequences(toxicity.coded(text)))
    letters = sum(c in b"abcdefghijklmnopqrstuvwxyz" for c in text)
    assert taught.margin(text) == pytest.approx(max(taught.bias, total / 4 + taught.bias), abs=1e-4)
    assert letters < 17  # short texts are all divided by four
    assert taught.margin(None) == taught.margin(b"") == taught.bias


def test_toxicity_of_odd_texts(spark, taught):
    got = toxicity.toxicity(plain.docs_of(spark, plain.ODD), taught).collect()
    assert len(got) == len(plain.ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(plain.docs_of(spark, []), taught).collect() == []


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = toxicity.fit(plain.docs_of(spark, [(1, "x")]), labels)
    assert toxicity.toxicity(plain.docs_of(spark, [(1, "x"), (2, None)]), found).count() == 2


def test_pipeline(spark):
    """Each stage against a plain version on the rows that the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("hash").selectExpr("*", "'x' as _lid_rejected", "'y' as _hit_n_hit")
    extra = plain.docs_of(spark, [(9000, None), (9001, ""), (9002, "x password=abcdefgh1 " * 9)]).select(
        "doc_id", "text", "lang", "source", "n_chars"
    ).selectExpr("*", "'x' as _lid_rejected", "'y' as _hit_n_hit")
    docs = docs.unionByName(extra)
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language"](spark, docs, SF)
    assert kept.columns == columns
    left = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) - set(left) == {9000, 9001}

    single = stages["near_duplicates"](spark, kept, SF)
    assert single.columns == columns
    ids = sorted(left)
    root = plain.joined_places([plain.simhash(left[i]) for i in ids])
    left = {i: left[i] for i, r in zip(ids, root) if ids[r] == i}
    assert {r.doc_id for r in single.collect()} == set(left)

    clean = stages["decontamination"](spark, single, SF)
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in plain.contamination(left.items(), items) if r[-1]}
    assert bad
    left = {i: t for i, t in left.items() if i not in bad}
    assert {r.doc_id for r in clean.collect()} == set(left)

    redacted = stages["secrets"](spark, clean, SF)
    assert redacted.columns == columns
    texts = {r.doc_id: r.text for r in redacted.collect()}
    assert set(texts) == set(left)
    scan = secrets.scanner(secrets.learn_identifiers(clean))
    for i, text in texts.items():
        assert not plain.secrets(text)[1]
        if not scan(left[i]):
            assert text == left[i]

    tokens = {r.doc_id: r for r in stages["tokens"](spark, redacted, SF).collect()}
    assert set(tokens) == set(left)
    own = pieces.load(pieces.read_model(corpus_pipeline.TOKENIZER))
    assert all(r.decodes and r.n_tokens == len(r.ids) and list(r.ids) == own.encode(texts[i]) for i, r in tokens.items())


def test_pipeline_runs_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decodes"]
    assert 0 < got.count() <= spark.read.parquet(f"{SF}/documents.parquet").count()


def folder_of(spark, folder, rows):
    plain.docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "a passage of the benchmark that is long enough to be a window of its own words")],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    got = corpus_pipeline.run(spark, folder_of(spark, tmp_path, []))
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decodes"] and got.collect() == []


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Repeated rows, missing ids and texts, clashing columns, one very long text: stage by stage, none is lost unasked."""
    rng = random.Random(3)
    words = "the of and in to for with that this from over under river stone light water morning field old town".split()

    def said(n):
        return " ".join(rng.choice(words) + rng.choice(["", "s", "ing", "ed", "er"]) for _ in range(n))

    long, twice, alone = said(150_000), said(80), said(90)
    copied = "a passage of the benchmark that is long enough to be a window of its own words"
    rows = [(1, long), (2, twice), (2, twice), (5, twice), (3, None), (4, ""), (None, alone), (6, copied), (7, said(70) + " token=abcdefgh1"),
            (8, said(60)), (8, said(61))]
    got = corpus_pipeline.run(spark, folder_of(spark, tmp_path, rows)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [
        (False, 0), (True, 1), (True, 2), (True, 2), (True, 7), (True, 8), (True, 8)]
    assert all(r.decodes and r.n_tokens == len(r.ids) > 0 and r.source == "s" for r in got)
    assert max(r.n_tokens for r in got) > 150_000
