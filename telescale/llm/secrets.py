"""Secret scans: fixed patterns, and strings in a sensitive context that a primed compressor cannot shorten.

The patterns give the kinds ``assign``, ``access`` and ``hex``. The method adds the kind ``novel``: a candidate is
any run of 16 key characters or more near a sensitive word, on its line or another. Its marginal size is what it adds to the
compressed size of the text around it, with a zstandard dictionary of identifiers as history. Words, paths and
names made of what the dictionary or the surrounding text hold cost little; keys cost nearly their length. Other
copies of the same string are left out of the surrounding text, and each string of a text is judged once.

The dictionary holds fixed identifiers and those that come back in the corpus. A name that neither holds (a
host, a path) is as novel to a compressor as a key, so what is novel is also held against a like run of identifiers: if
it falls apart at its separators, digits and capitals into parts as long as theirs, whose letter pairs are those of the
dictionary's words, it is a name. Numbers and UUIDs are names by their form.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Sequence

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import free_prefix, map_texts

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: What makes the text around it sensitive.
SENSITIVE = re.compile(
    r"passw(?:or)?d|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|bearer|"
    r"authorization|signature",
    re.IGNORECASE | re.ASCII,
)
#: A candidate is a run of at least ``LEAST_CHARS``; a sign of equality belongs to it only at its end.
RUN = re.compile(r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]*(?:=+(?![A-Za-z0-9+/_.=-]))?", re.ASCII)
LEAST_CHARS = 12
RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")
#: What makes a run that holds a sensitive word a name with a value behind it, and what such names are made of.
VALUE = re.compile(r"""["']?\x20*[:=]""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+", re.ASCII)
PART = re.compile(r"[A-Za-z0-9+_=-]{12,}", re.ASCII)
#: Characters before and behind a sensitive word, over the ends of lines, in which candidates are measured.
NEAR_CHARS = 256
#: A run at most so far behind a secret, without a word between, goes on with it (the lines of a key file).
GOES_ON_CHARS = 8
CONTEXT_WORDS = (
    "passw", "passphrase", "pwd", "secret", "token", "key", "credential", "bearer", "authorization", "signature",
)

#: Fixed text that primes the compressor: identifiers of code and of configuration files.
IDENTIFIERS = """
password passwd secret token api_key apikey access_key private_key public_key client_secret client_id credential
credentials authorization bearer signature session_token refresh_token access_token auth_token secret_key
encryption_key example placeholder changeme undefined null true false none default production development staging
localhost username user_name database connection string environment variable config configuration settings options
public private protected static final class function method return import export module package interface struct
int float double boolean object array list dict map key value name type self this super init main index length
request response header content application json text html charset utf-8 https http www com org net path file
src lib bin test tests build dist node_modules site-packages usr local etc var home tmp opt mail web proxy server
client cluster broker service gateway internal external compute amazonaws east west north south central region cache
queue worker agent runner monitor storage bucket data warehouse log access error debug version release snapshot beta
alpha linux python java spark spring apache nginx kafka postgres jackson manager controller handler filter factory
provider resource execution customer account address order number maximum feature timeout project
0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
"""

CONTEXT_CHARS = 512
LEAST_NOVELTY = 0.5

#: How many identifiers are learned, the most frequent, and how many texts each must be in.
LEARNED, IN_DOCS = 2000, 3

UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
#: A name is made of pieces between separators, a piece of words in one case and numbers.
SEPARATORS = re.compile("[._/+:=-]+")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+", re.ASCII)
#: Parts of a long piece are so long on average; of a name's characters at most so many lie in other pieces, and of its
#: pairs of letters, in words of more than three, at least so many are known.
LEAST_PART, MOST_BROKEN, LEAST_KNOWN_PAIRS = 3.5, 0.34, 0.7
#: A pair of letters that is learned is so frequent among learned words, measured by pairs of any letters.
USUAL_PAIR = 0.5

FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _words_of_texts(docs: DataFrame) -> DataFrame:
    """The words of each different text, joined by spaces: copies in a task are put together before the shuffle.

    A joined string takes half the shuffle of an array.
    """
    words = F.filter(F.array_distinct(F.split(F.col("text"), r"[^A-Za-z_]+")), lambda w: w.rlike("^[A-Za-z]?[a-z_]{3,23}$"))
    texts = docs.filter("text is not null").select(F.xxhash64("text").alias("h"), F.array_join(words, " ").alias("words"))
    return texts.dropDuplicates(["h"])


def learn_identifiers(docs: DataFrame, most: int = LEARNED) -> str:
    """The fixed identifiers and the ``most`` frequent words of the corpus, lower-case, that several texts hold.

    All texts are counted. Copies of a text, found by its hash, count once; a secret is no word, or in one text.
    """
    some = _words_of_texts(docs).select(F.explode(F.split("words", " ")).alias("word")).filter("word <> ''")
    found = some.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= IN_DOCS)
    found = found.orderBy(F.desc("n"), "word").limit(most).collect()
    # The most frequent last: a compressor reaches near history more cheaply.
    return " ".join(r.word for r in reversed(found)) + IDENTIFIERS


def _pairs(identifiers: str) -> Counter:
    """How often the words of a dictionary have each pair of letters."""
    words = [w for w in re.findall("[a-z]+", identifiers.lower()) if len(w) < 24]
    return Counter(a + b for w in words for a, b in zip(w, w[1:]))


def name_of(identifiers: str) -> Callable[[str], bool]:
    """Whether a run is like a run of identifiers, by the letter pairs of the fixed and the usual learned ones."""
    known = set(_pairs(IDENTIFIERS))
    counts = _pairs(identifiers)
    # Pairs that are rare in a large dictionary are no sign of a word.
    known |= {pair for pair, n in counts.items() if n >= USUAL_PAIR * counts.total() / 26**2}

    def is_name(run: str) -> bool:
        if UUID.fullmatch(run) or not any(c.isalpha() for c in run):
            return True
        pieces = [NAME_PART.findall(piece) for piece in SEPARATORS.split(run)]
        lengths = [sum(map(len, parts)) for parts in pieces]
        broken = sum(n for n, parts in zip(lengths, pieces) if len(parts) > 2 and n < LEAST_PART * len(parts))
        pairs = [a + b for parts in pieces for w in map(str.lower, parts)
                 if w.isalpha() and len(w) > 3 for a, b in zip(w, w[1:])]
        return broken <= MOST_BROKEN * sum(lengths) and sum(p in known for p in pairs) >= LEAST_KNOWN_PAIRS * len(pairs)

    return is_name


def scanner(
    identifiers: str = IDENTIFIERS, context_chars: int = CONTEXT_CHARS, least_novelty: float = LEAST_NOVELTY
) -> Callable[[str], list[tuple[int, int, int]]]:
    """A function from a text to its findings (start, index in ``KINDS``, end), sorted."""
    is_name = name_of(identifiers)
    primed = zstandard.ZstdCompressionDict((identifiers.upper() + identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_dict_id=False)

    def size(text: str) -> int:
        return len(compressor.compress(text.encode("utf-8", "surrogatepass")))

    def novelty(text: str, start: int, end: int) -> float:
        """Compressed bytes that text[start:end] adds to those of the text around it, for each of its characters.

        The text around it is taken without other copies of the same string.
        """
        length, string = end - start, text[start:end]
        # Other copies must not make it cheap; room for one more copy, so that none is cut where the context ends.
        before = text[max(0, start - context_chars - length):start].replace(string, " " * length)
        after = text[end:end + context_chars + length].replace(string, " " * length)
        around = before[-context_chars:] + after[:context_chars]
        return (size(around + string) - size(around)) / length

    def alone(string: str) -> float:
        return (size(string) - size("")) / len(string)

    def is_novel(text: str, start: int, end: int) -> bool:
        """Whether the run, or one of its parts between dots and slashes, is hard to shorten and no name."""
        parts = [(start, end)]
        parts += [(start + m.start(), start + m.end()) for m in PART.finditer(text[start:end]) if len(m[0]) < end - start]
        return any(not is_name(text[a:b]) and novelty(text, a, b) >= least_novelty for a, b in parts)

    def novel_runs(text: str):
        """Novel runs in a sensitive context, and those that go on behind one."""
        judged: dict[str, bool] = {}
        for near, until in _contexts(text):
            last = None  # where the secret before ended
            for m in RUN.finditer(text, near):
                start, end = m.start(), m.start() + len(m[0].rstrip("."))
                behind = last is not None and start - last <= GOES_ON_CHARS
                if start >= until and not behind:
                    break
                if end - start < LEAST_CHARS or _is_name(text, start, end):
                    continue
                string = text[start:end]
                if string not in judged:
                    judged[string] = is_novel(text, start, end)
                # Among the lines of a key the text around may make one of them cheap.
                if judged[string] or behind and "\n" in text[last:start] and alone(string) >= least_novelty:
                    last = end
                    yield start, end

    def scan(text: str) -> list[tuple[int, int, int]]:
        found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        if any(w in low for w in CONTEXT_WORDS):
            fixed = _joined((a, b) for a, _, b in found)
            found += [(a, 3, b) for a, b in novel_runs(text) if not _inside(fixed, a, b)]
        return sorted(set(found))

    return scan


def _joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps, sorted."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _inside(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether start to end lies in one of sorted spans without overlaps."""
    at = bisect_right(spans, start, key=lambda s: s[0]) - 1
    return at >= 0 and end <= spans[at][1]


def _is_name(text: str, start: int, end: int) -> bool:
    """Whether a run is the name of a secret (AWS_SECRET_ACCESS_KEY=) and not one: a sensitive word in words."""
    name = text[start:end].rstrip("=")
    if not VALUE.match(text, start + len(name)) or not SENSITIVE.search(name):
        return False
    return len(name) >= 3 * len(NAME_WORD.findall(name))


def _contexts(text: str) -> list[tuple[int, int]]:
    """Stretches of the text around sensitive words; none begins inside a run."""
    found = _joined((max(0, m.start() - NEAR_CHARS), m.end() + NEAR_CHARS) for m in SENSITIVE.finditer(text))
    out = []
    for a, b in found:
        while a and text[a - 1] in RUN_CHARS:
            a -= 1
        out.append((a, b))
    return _joined(out)


def _listed(found: Sequence[tuple[int, int, int]], kinds: int = len(KINDS)) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found if k < kinds)


def secret_scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), identifiers: str = IDENTIFIERS) -> DataFrame:
    """Findings in each text, one row for each row of ``docs``; positions in code points, end exclusive.

    A null text is scanned as an empty one and has no findings. ``base_sha256`` digests the kinds of the fixed
    patterns; ``spans`` lists all findings as kind:start:end, by start and then by kind. Repeated rows give repeated
    results, columns of ``docs`` outside ``keep`` are not read, and an empty table gives no rows. Texts of any length
    are scanned whole; time grows with the text, and with the runs near sensitive words.
    """

    def make():
        scan = scanner(identifiers)

        def run(texts):
            rows = []
            for raw in texts:
                found = scan(raw.decode()) if raw else []
                counts = [sum(k == kind for _, k, _ in found) for kind in range(3)]
                rows.append((*counts, hashlib.sha256(_listed(found, 3).encode()).hexdigest(), _listed(found)))
            return list(zip(*rows, strict=True)) if rows else [[]] * 5

        return run

    return map_texts(docs, keep, FOUND, make)


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", identifiers: str = IDENTIFIERS) -> DataFrame:
    """``docs`` with each finding replaced by ``mark``, overlapping ones by a single one; n_chars follows the text.

    Rows without findings, and null and empty texts, stay as they are. Repeated rows are treated alike, an empty table
    gives no rows. Texts of any length are scanned whole; a text is one row, so it must fit into a task.
    """
    name = free_prefix(docs, "_clean")

    def make():
        scan = scanner(identifiers)

        def clean(raw: bytes | None) -> str | None:
            if not raw:
                return None if raw is None else ""
            text = raw.decode()
            parts, at = [], 0
            for start, _, end in scan(text):
                if start >= at:
                    parts += [text[at:start], mark]
                at = max(at, end)
            return "".join([*parts, text[at:]]) if parts else text

        return lambda texts: [[clean(x) for x in texts]]

    others = [c for c in docs.columns if c != "text"]
    cleaned = map_texts(docs, others, f"{name} string", make)
    out = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        changed = F.length(name).cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(changed)
    return cleaned.select(*(out[c].alias(c) if c in out else F.col(c) for c in docs.columns))
