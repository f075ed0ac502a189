"""Merkle manifests against plain trees, in blocks of one level and of three, and the layout of a block."""

from __future__ import annotations

import random
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pytest

from telescale.llm import merkle
from telescale.llm.texts import held_out
from tests.llm import plain


def layers(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([plain.sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def beside(tree, i):
    out = []
    for layer in tree[:-1]:
        first = i // 16 * 16
        out.append(("".join(layer[first:i]), "".join(layer[i + 1:first + 16])))
        i //= 16
    return out


def leaf(row):
    return plain.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_manifest(rows, tampered):
    """Rows of the operator from documents (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [layers([leaf(r) for r in sources[name]]) for name in names]
    top = layers([t[-1][0] for t in trees])
    out = []
    for k, name in enumerate(names):
        for i, row in enumerate(sources[name]):
            steps, claimed = beside(trees[k], i) + beside(top, k), row
            if tampered(row) and row[4] is not None:
                claimed = (*row[:4], row[4].translate(str.maketrans(ascii_uppercase, ascii_lowercase)))
            folded = leaf(claimed)
            for before, behind in steps:
                folded = plain.sha(before + folded + behind)
            root = top[-1][0]
            proof = plain.sha("".join(a + b for a, b in steps))
            out.append((row[0], leaf(row), trees[k][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def test_layout():
    """Addresses are a numbering of all nodes, and halves of the levels lie together."""
    for levels in range(1, 5):
        all_of = np.concatenate([merkle.addresses(levels, d) for d in range(levels)])
        assert sorted(all_of) == list(range(merkle.size(levels)))
    top = np.concatenate([merkle.addresses(4, d) for d in (0, 1)])
    assert sorted(top) == list(range(17))
    below = [merkle.address(4, 2, 16 * 3 + 5), *merkle.address(4, 3, np.arange(16) + 16 * (16 * 3 + 5))]
    assert sorted(below) == list(range(min(below), min(below) + 17))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_block(n):
    leaves = [plain.sha(str(i)) for i in range(n)]
    tree = layers(leaves)
    block = merkle.Block.over(leaves, merkle.height_of(n))
    assert block.root == tree[-1][0]
    again = merkle.Block.stored(block.height, block.n, block.raw())
    for i, steps in enumerate(again.steps()):
        assert [(a.decode(), b.decode()) for a, b in steps] == beside(tree, i)
        assert merkle.fold(leaves[i], steps) == block.root


ODD = [
    (1, "a", "en", 3, "Abc"), (1, "a", "en", 3, "Abc"), (1, "a", "en", 3, "abc"), (None, "a", None, None, None), (2, None, "en", 0, ""),
    (3, "", "en", 5, "É ü Z"), (None, None, None, None, "Null id"), (5, "é", "de", 9, "1:2-3:4"), (10, "alone", "en", 1, "X" * 300_000),
]


@pytest.mark.parametrize("height", [1, merkle.HEIGHT])
@pytest.mark.parametrize("sources", ["odd", "hot", "many"])
def test_manifest(spark, height, sources):
    rng = random.Random(sources)
    rows = list(ODD)
    if sources == "hot":  # trees of several rounds, one of them with most rows
        rows += [(rng.randint(0, 10**6), rng.choice(["a", "big", "big", "big"]), "en", i, f"Text {i}") for i in range(700)]
    if sources == "many":  # an upper tree of several rounds
        rows += [(i, f"s{i % 300}", "en", i, f"Text {i}") for i in range(450)]
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, digest string"
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    got = merkle.verify_documents(docs, held_out(5, 0), height).collect()
    tampered = {r.doc_id for r in docs.filter(held_out(5, 0)).collect()}
    assert sorted((tuple(r) for r in got), key=str) == plain_manifest(rows, lambda r: r[0] in tampered)


def test_stored_blocks(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    blocks = merkle.build_manifest(merkle.document_leaves(docs), 1).blocks().collect()
    sizes = {(r["round"], r["block"]): r["n"] for r in blocks}
    assert sizes == {(0, 0): 16, (0, 1): 16, (0, 2): 8, (1, 0): 3, (-1, 0): 1}


def test_empty_manifest(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.verify_documents(docs).collect() == []
