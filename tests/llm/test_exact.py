"""Operators with exact results against plain versions: on the small test tables, and on awkward documents."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from telescale.llm import chat, decontaminate, pieces, quality, secrets, simhash, substring, url_lists
from telescale.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm import plain

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = [(100 + i, " ".join(f"w{(i * j) % 7}" for j in range(60))) for i in range(1, 5)]
KEY = "AKIA" + "Z9" * 8


def cases(spark):
    small = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return {"table": small, "odd": [*plain.ODD, *LONG], "none": []}


@pytest.fixture(scope="module", params=["table", "odd", "none"])
def rows(request, spark):
    return cases(spark)[request.param]


def in_order(values):
    return sorted(values, key=lambda r: tuple((x is not None, x) for x in r))


def test_secrets(spark, rows):
    rows = [*rows, *([(900, f"x token={'a' * 7} TOKEN : '{'b' * 9}' {KEY} {'0f' * 20}"), (901, "secret:token:abcdefgh")] if rows else [])]
    got = secrets.secret_scan(plain.docs_of(spark, rows)).collect()
    want = []
    for i, text in rows:
        counts, listed = plain.secrets(text)
        want.append((i, *counts, plain.sha(listed)))
    assert in_order([tuple(r[:5]) for r in got]) == in_order(want)
    for r in got:
        base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("novel"))
        assert plain.sha(base) == r.base_sha256


def test_substring(spark, rows):
    rows = [*rows, (1000, "shared " + " ".join(f"p{i}" for i in range(30))), (1001, " ".join(f"p{i}" for i in range(40)))]
    got = substring.remove_repeats(plain.docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    want = plain.without_repeats([r for r in rows if r[0] is not None])
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, plain.sha(r.kept)) == want[r.doc_id]
        else:
            assert r.n_removed == 0


def test_substring_passage_in_many_documents(spark):
    """One passage in all documents: each loses it but the first; rows of a batch settle among themselves."""
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(400)]
    docs = plain.docs_of(spark, rows).repartition(5)
    got = {r.doc_id: r.n_removed for r in substring.remove_repeats(docs).collect()}
    assert got == {i: 20 if i else 0 for i in range(400)}


def test_longest_repeats(spark):
    long = [f"t{i}" for i in range(130)]
    rows = [(1, " ".join(long)), (2, "x " + " ".join(long[:110])), (3, "y " + " ".join(long[:30])), (4, "alone " * 3), (5, None)]
    got = {r.doc_id: r.longest for r in substring.longest_repeats(plain.docs_of(spark, rows)).collect()}
    assert got == {1: 104, 2: 104, 3: 26}


def test_simhash(spark, rows):
    got = simhash.near_duplicates(plain.docs_of(spark, rows)).collect()
    fps = [plain.simhash(t) for _, t in rows]
    assert in_order([(r.doc_id, r.fingerprint) for r in got]) == in_order([(i, f"{f:016x}") for (i, _), f in zip(rows, fps)])
    root = plain.joined_places(fps)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = in_order([(i, least.get(r)) for (i, _), r in zip(rows, root)])
    assert in_order([(r.doc_id, r.component_id) for r in got]) == want


@given(st.integers(0, 2**32), st.integers(2, 400), st.integers(1, 12))
@settings(max_examples=40, deadline=None)
def test_index_of_a_cell(seed, n, flips):
    """The index joins what brute force joins, in tight clusters too."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = set()
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    fps = fps[np.argsort(simhash.gray_rank(fps), kind="stable")]
    assert simhash.search(fps).tolist() == plain.joined_places([int(x) for x in fps])


@pytest.mark.parametrize("part, aim", [(10, 4), (40, 10), (60, 3), (2048, 600)])
def test_links_of_crowded_cells(spark, part, aim):
    """One index, cells, refined cells and cells cut into parts give the same groups."""
    rng = random.Random(3)
    fps = set()
    for n in (300, 40, 1, 1, 1):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(n)}
    fps = sorted(x - (x >> 63 << 64) for x in fps)
    nodes = spark.createDataFrame([(x, (False, i)) for i, x in enumerate(fps)], f"fp long, id {simhash.NODE}")
    tree = simhash.components(simhash.links(nodes, part, aim)).collect()
    want = plain.joined_places([x % 2**64 for x in fps])
    assert {(r.node.key, r.root.key) for r in tree} == {(i, r) for i, r in enumerate(want) if i != r}


def test_cells_are_refined_before_they_are_cut(spark):
    """The cell of a block that all fingerprints share is dealt by their other bits, and needs no parts."""
    rng = random.Random(5)
    same = rng.getrandbits(13)
    fps = sorted({(rng.getrandbits(50) << 13) + same for _ in range(2000)})
    nodes = spark.createDataFrame([(x, (False, i)) for i, x in enumerate(fps)], f"fp long, id {simhash.NODE}")
    placed = simhash.cells(nodes, 200, 60).groupBy("cell", "parts").count().collect()
    assert max(r["count"] for r in placed) <= 200 and {r.parts for r in placed} == {1}


def test_nodes_prune(spark):
    """On the test table the search is the index: upper nodes drop pairs, and few fingerprints are compared."""
    marked = simhash.fingerprints(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    fps = np.array(sorted({r.fp % 2**64 for r in marked.select("fp").distinct().collect()}), np.uint64)
    nodes = marked.groupBy("fp").agg({"doc_id": "min"}).selectExpr("fp", "struct(false as no_id, `min(doc_id)` as key) as id")
    assert simhash.cells(nodes).select("cell").distinct().count() == 1
    order = np.argsort(simhash.gray_rank(fps), kind="stable")
    seen = Counter()
    simhash.search(fps[order], seen=seen)
    n = len(fps)
    every = n * (n - 1) / 2
    assert n > 9000 and seen[1, "dropped"] > 0.9 * seen[1, "tested"] and seen[2, "dropped"] > 0.3 * seen[2, "tested"]
    assert seen[0, "tested"] < 0.01 * every and sum(k for (_, what), k in seen.items() if what == "tested") < 0.2 * every


def test_near_copies_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(7, text), (3, text), (3, text), (5, "quite another text of some words"), (None, text)]
    left = simhash.one_of_each(plain.docs_of(spark, rows))
    assert in_order([(r.doc_id,) for r in left.collect()]) == [(None,), (3,), (3,), (5,)]
    assert left.columns == plain.docs_of(spark, rows).columns


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_decontaminate(spark, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "alpha BETA"), (901, ""), (902, None), (903, "word " * 20), (904, "é"), (905, "alpha, beta")]
    docs = plain.docs_of(spark, rows)
    want = in_order(plain.contamination(rows, items))
    assert in_order([tuple(r) for r in decontaminate.decontaminate(docs, items_of(spark, items)).collect()]) == want
    joined = decontaminate.decontaminate(docs, items_of(spark, items), most_windows=100)
    assert in_order([tuple(r) for r in joined.collect()]) == want


def test_a_large_benchmark_stays_on_spark(spark, monkeypatch):
    """What comes to the driver is a bitmap of fixed size, however many windows the benchmark has."""
    monkeypatch.setattr(decontaminate, "_collect", None)
    sizes = []
    for n in (40, 800):
        items = items_of(spark, [(i, " ".join(f"w{(i * j) % 9973}" for j in range(1, 60))) for i in range(n)])
        windows = decontaminate.item_windows(items)
        bitmap = decontaminate.bitmap_of(windows, 14)
        sizes.append(bitmap.nbytes)
        docs = [(i, f"a b {' '.join(f'w{(i * j) % 9973}' for j in range(5, 30))} c") for i in range(0, n, 7)] + [(9000, "x y " * 20)]
        want = plain.contamination(docs, [(r.item_id, r.text) for r in items.collect()])
        # A bitmap of few bits lets many windows through; the words decide.
        got = decontaminate._joined(plain.docs_of(spark, docs * 2), items, ("doc_id",), decontaminate.fields(decontaminate.RESULT), 14)
        assert in_order([tuple(r) for r in got.collect()]) == in_order(want * 2)
    assert sizes == [2048, 2048]


def test_decontaminate_without_items(spark):
    got = decontaminate.decontaminate(plain.docs_of(spark, [(1, "a b c")]), items_of(spark, [])).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(3, 0, False)]


def test_pieces_of_unbroken_texts():
    """A million letters, digits or spaces in a row are encoded exactly, in proportion to their number."""
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.load(pieces.read_model(MODEL))
    rng = random.Random(2)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "a", " ", "0é", "a ", "日本語ab"):
        seconds = []
        for n in (100_000, 1_000_000):
            text = "".join(rng.choices(alphabet, k=n))
            start = time.process_time()
            ids = model.encode(text)
            seconds.append(time.process_time() - start)
            assert ids == library.encode(text) and model.decode(ids) == library.decode(ids)
        assert seconds[1] < 20 * max(seconds[0], 0.05)


def test_pieces(spark, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.read_model(MODEL)
    got = pieces.round_trip(plain.docs_of(spark, rows), model).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "")
        want.append((i, len(ids), plain.sha(",".join(map(str, ids))), plain.sha(library.decode(ids))))
    assert in_order([tuple(r) for r in got]) == in_order(want)
    encoded = pieces.encode_texts(plain.docs_of(spark, rows), model)
    back = pieces.decode_ids(encoded, model).collect()
    assert in_order([(r.doc_id, r.text) for r in back]) == in_order([(i, (t or "")) for i, t in rows])


ALPHABET = st.sampled_from(["a", "th", "ing", " ", "  ", "     ", "\n", "é", "日本", "😀", "▁", "!", "12", "\x00", "²", "².", " the"])


@given(st.lists(ALPHABET, max_size=30).map("".join))
@settings(max_examples=400, deadline=None)
def test_pieces_as_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = pieces.load(pieces.read_model(MODEL))
    assert own.encode(text) == library.encode(text)


@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 270)), max_size=12))
@settings(max_examples=400, deadline=None)
def test_any_ids_decode_as_library(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert pieces.load(pieces.read_model(MODEL)).decode(ids) == library.decode(ids)


def test_quality(spark, rows):
    got = quality.quality(plain.docs_of(spark, rows)).collect()
    assert in_order([tuple(r) for r in got]) == in_order([(i, *plain.quality(t)) for i, t in rows])


def test_cascade_order_changes_no_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = list(quality.RULES)
    assert sorted(quality.rule_order(docs)) == sorted(names)
    kept = [quality.kept_documents(docs, order).select("doc_id").collect() for order in (names, names[::-1])]
    assert kept[0] == kept[1]


def test_order_that_pays():
    """The next rule is the one that rejects most of what is left for what it adds; shared measures cost once."""
    measures, rules = list(quality.MEASURES), list(quality.RULES)
    seconds = np.full((100, len(measures)), 1.0)
    seconds[:, measures.index("n_repeat_words")] = 50.0
    rejected = np.zeros((100, len(rules)), bool)
    rejected[:40, rules.index("few_words")] = True  # cheap and frequent
    rejected[:60, rules.index("repeated_words")] = True  # more, but dear
    rejected[40:60, rules.index("word_length")] = True
    rejected[:39, rules.index("symbols")] = True  # nothing that is left once few_words has run
    order = quality.best_order(seconds, rejected, measures, rules)
    assert order[:2] == ["few_words", "word_length"] and order[-1] == "repeated_words"
    assert quality.best_order(seconds[:0], rejected[:0], measures, rules) and sorted(order) == sorted(rules)


def test_the_cascade_skips_work(monkeypatch):
    """Rules behind the first rejection do not run, and measures that only they need are not taken."""
    ran = []
    counted = {name: quality.Rule(r.needs, lambda x, name=name, r=r: ran.append(name) or r.rejects(x)) for name, r in quality.RULES.items()}
    monkeypatch.setattr(quality, "RULES", counted)
    order = ["few_words", "symbols", "capitals", "one_word", "word_length", "duplicate_lines", "words_without_letters", "repeated_words"]
    short = quality.Measured(b"only a few words")
    assert not quality.passes(short, order) and ran == ["few_words"] and set(vars(short)) == {"raw", "words"}
    ran.clear()
    loud = quality.Measured(" ".join(f"LOUD{i}" for i in range(80)).encode())
    assert not quality.passes(loud, order) and ran == order[:3]
    assert not {"n_commonest", "lines", "n_repeat_words", "n_letter_words"} & set(vars(loud))
    ran.clear()
    clean = quality.Measured(" ".join(f"word{i}" for i in range(80)).encode())
    assert quality.passes(clean, order) and ran == order


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),
    (3, 2, "user", "bye"), (4, 0, "user", "hi"), (4, 1, "assistant", "hello"), (4, 2, "user", "bye"), (5, 0, None, "hi"),
    (6, None, "user", None), (6, None, "user", ""), (7, 0, "user", ""), (None, 0, "user", "lost"), (8, 0, "user", "x"),
    (8, 0, "user", "x"), (8, 0, "user", "a"), (9, 0, "user", "hi"), (9, 1, "user", "hi"),
]


def test_chat(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in chat.format_conversations(turns).collect()} == plain.conversations(TURNS)
    assert chat.format_conversations(turns.filter("false")).collect() == []


def test_chat_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op10_chat"](spark, SF).collect()} == plain.conversations(rows)


def test_url_lists(spark):
    rng = random.Random(2)
    hosts = ["a.example.com", "b.a.example.com", "example.org", "C.Example.com.", "localhost", "x.localhost"]
    captures = [(i, f"http://u@{rng.choice(hosts)}:80/p?q", rng.choice([None, *range(100)])) for i in range(60)]
    captures += [(900, None, 5), (901, "no url", 5), (902, "http://a.example.com", 50), (902, "http://a.example.com", 50)]
    entries = [(rng.choice(["ads", "spam"]), rng.choice([*hosts, "example.com", "com"]), rng.randrange(100), rng.random() < 0.6)
               for _ in range(120)]
    entries += [(None, "example.com", 1, True), ("ads", None, 1, True), ("ads", "example.com", None, True)]
    got = url_lists.judge(
        spark.createDataFrame(captures, "page_id long, url string, day long"),
        spark.createDataFrame(entries, "list string, domain string, day long, added boolean"),
    ).collect()
    want = plain.url_lists(captures, [e for e in entries if e[1] != "com"])
    assert len(got) == len(want)
    assert {(r.page_id, r.url, r.day): r.lists for r in got} == want
    assert all(r.blocked == bool(r.lists) for r in got)


def test_clashing_columns(spark):
    """Further columns, named like those that the operators make, change nothing."""
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    names = ("_n", "_h1", "_turns", "n_turns", "n_snapshots", "rendered", "said", "_hash")
    clashing = turns.selectExpr("*", *(f"'x' as {n}" for n in names))
    assert {tuple(r) for r in chat.format_conversations(clashing).collect()} == plain.conversations(TURNS)
    captures = spark.createDataFrame([(1, "http://a.b.com/x", 5), (2, None, 5)], "page_id long, url string, day long")
    entries = spark.createDataFrame([("ads", "b.com", 1, True), ("ads", "b.com", 1, True)], "list string, domain string, day long, added boolean")
    names = ("lists", "_lists", "host", "_host", "domain", "period", "since", "until", "blocked", "_page_id", "_url", "_day")
    got = url_lists.judge(captures.selectExpr("*", *(f"'x' as {n}" for n in names)), entries.selectExpr(
        "*", *(f"'x' as {n}" for n in ("lists", "since", "until", "period", "_lists", "was", "next"))))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "http://a.b.com/x", 5, "a.b.com", "ads", True), (2, None, 5, None, "", False)]


def test_turn_marks_in_a_text_are_kept(spark):
    rows = [(1, 0, "user", "a<|end|>\n<|user|>\nb")]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert got.rendered == "<|user|>\na<|end|>\n<|user|>\nb\n<|end|>\n" and got.n_turns == 1


def test_texts_of_a_million_characters(spark):
    """Operators on one very long text, against the plain versions."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    long = "\n".join(" ".join(rng.choices(words, k=25)) for _ in range(7000)) + f" token=abcdefgh1 {KEY}"
    assert len(long) > 900_000
    rows = [(1, long), (2, long[:500_000]), (3, "x" * 1_000_000)]
    docs = plain.docs_of(spark, rows)
    got = {r.doc_id: tuple(r[1:5]) for r in secrets.secret_scan(docs).collect()}
    assert got == {i: (*plain.secrets(t)[0], plain.sha(plain.secrets(t)[1])) for i, t in rows}
    left = {r.doc_id: (r.n_words, r.n_removed, plain.sha(r.kept)) for r in substring.remove_repeats(docs).collect()}
    assert left == plain.without_repeats(rows)
    items = [(1, " ".join(long.split()[100:130])), (2, "x" * 1_000_000), (3, long)]
    hit = decontaminate.decontaminate(docs, items_of(spark, items)).collect()
    assert in_order([tuple(r) for r in hit]) == in_order(plain.contamination(rows, items))
    assert in_order([tuple(r) for r in quality.quality(docs).collect()]) == in_order([(i, *plain.quality(t)) for i, t in rows])
    found = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: f"{plain.simhash(t):016x}" for i, t in rows}


def test_url_lists_empty(spark):
    captures = spark.createDataFrame([], "page_id long, url string, day long")
    entries = spark.createDataFrame([], "list string, domain string, day long, added boolean")
    assert url_lists.judge(captures, entries).collect() == []
