"""Plain versions of the operators, one document at a time, to hold the operators against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCHMARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: Awkward documents: nulls, empty and blank ones, ties, repeated rows, long words, non-ASCII white space.
ODD = [
    (1, "alpha beta gamma"), (2, None), (3, ""), (4, " \t\n "), (5, "alpha beta gamma"), (6, "x" * 5000),
    (7, "é ü ſecret Token: Ünïcødé_12345678\x1fend"), (8, "one\ntwo\none\n\n \none"), (9, "word " * 3000), (9, "word " * 3000),
    (None, "no id here at all " * 5), (10, "12 34 56 !!! ###"), (11, "日本語 テキスト。 日本語"), (12, "a\x00b \x0bc\x0cd"),
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, rows):
    """A table of documents with further columns named like those that operators make."""
    clash = "hash string, fp string, n_words string, score string, ids string, kept string, lang_pred string, _owner string"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + clash
    full = [(i, t, "en", "s", len(t or ""), *("x" * 8)) for i, t in rows]
    return spark.createDataFrame(full, schema)


def secrets(text):
    text = text or ""
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    names = ("assign", "access", "hex")
    return [sum(k == i for _, k, _ in found) for i in range(3)], ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))


def without_repeats(docs):
    """doc_id -> (n_words, n_removed, digest of what is left)."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def simhash(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def joined_places(fps, distance=4):
    """For each place the first one that it hangs together with."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def contamination(docs, items):
    windows = {}
    for item_id, text in items:
        w = BENCHMARK_WORD.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(item_id))
    lengths = {len(w) for w in windows}
    rows = []
    for i, text in docs:
        w = BENCHMARK_WORD.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k:k + n]))) is not None:
                    hit[k:k + n] = [True] * n
                    found |= ids
        rows.append((i, len(w), sum(hit), len(found), sha(",".join(sorted(found))), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return rows


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    threes = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    inside = set()
    for k in range(len(words) - 2):
        if threes[tuple(words[k:k + 3])] > 1:
            inside |= {k, k + 1, k + 2}
    n = len(words)
    base = n < 50 or 100 * len(inside) > 50 * n
    chars, symbols = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    lettered = sum(any(c.isalpha() for c in w) for w in words)
    capitals, commonest = len(re.findall("[A-Z]", text)), max(Counter(words).values(), default=0)
    bad = (base or not 2 * n <= chars <= 15 * n or 4 * symbols > n or 10 * dup > 3 * len(lines) or 5 * lettered < 3 * n
           or 2 * capitals > chars or 3 * commonest > n)
    return n, chars, symbols, dup, len(inside), base, not bad


def conversations(turns):
    """Rows (conv_id, turn, role, text) -> {(conv_id, n_turns, n_snapshots, rendered)}."""
    low = lambda x: (x is not None, x or "")
    by = {}
    for c, t, r, x in turns:
        if c is not None:
            by.setdefault(c, []).append(((t is not None, t or 0), low(r), low(x), r, x))
    said = {c: tuple((r, x) for *_, r, x in sorted(rows, key=lambda row: row[:3])) for c, rows in by.items()}
    prefixes = {s[:k] for s in said.values() for k in range(1, len(s))}
    out = set()
    for s in set(said.values()) - prefixes:
        same = [c for c, other in said.items() if other == s]
        out.add((min(same), len(s), len(same), "".join(f"<|{r or ''}|>\n{x or ''}\n<|end|>\n" for r, x in s)))
    return out


def url_lists(captures, entries):
    """Rows (page_id, url, day) and (list, domain, day, added) -> {row: names of the lists active}."""
    out = {}
    for row in set(captures):
        page, url, day = row
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
        host = m[1].lower().rstrip(".") if m else None
        active = set()
        for name in {e[0] for e in entries if None not in e}:
            for domain in {e[1].lower().rstrip(".") for e in entries if None not in e}:
                if day is None or not host or not (host == domain or "." in domain and host.endswith("." + domain)):
                    continue
                on = False
                past = sorted({e[2] for e in entries if None not in e and e[0] == name and e[1].lower().rstrip(".") == domain and e[2] <= day})
                for d in past:
                    on = any(e[3] for e in entries if e[0] == name and (e[1] or "").lower().rstrip(".") == domain and e[2] == d)
                if on:
                    active.add(name)
        out[row] = ",".join(sorted(active))
    return out
