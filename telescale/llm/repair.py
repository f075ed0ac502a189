"""Repair of the structure of conversations: the cheapest edits after which roles follow ``(s?(ua)+)?``.

Rows may be kept, deleted or given the other role, and empty turns may be inserted. A row is seen as one letter for
its role and faults, so the search never touches a text. It is a depth-first branch-and-bound on an explicit stack: a
node is a prefix of edits; children are taken in the order of their letters, so that prefixes are met in ASCII order; a
prefix goes no further if its cost and a lower bound of the rest exceed the incumbent (cost, audit), or if its node (row,
last role) was reached at no greater cost before. The search ends when the stack is empty: the incumbent is then optimal.

Long conversations are cut: a piece of 16 letters is searched for each role it may begin and end with, pieces are chained
to blocks of 4096 rows, one row of a table each, and blocks to conversations. A chain keeps the order of (cost, audit):
audits over the same rows from one role to two others differ before either ends. So no task holds more of a
conversation than a block and a few letters for each row, which its audit needs anyway.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.llm.places import numbered

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: Letters searched at once, and rows of a conversation in one task.
PIECE = 16
BLOCK = 4096

# --- the search ------------------------------------------------------------------------------------------

#: What stands before: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
PLACES = (START, SYSTEM, USER, ASSISTANT)
WHOLE = frozenset({START, ASSISTANT})
#: The turn that an insertion or a new role gives, and what a kept role leads to.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}

# A letter is ``d`` for a row that must go, else the initial of its role (``x`` if it has no turn), in upper case
# if its text is truncated.


def steps(letter: str, place: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in the order of their letters: (edit, cost, place)."""
    yield "D", DELETE, place
    if letter == "d":
        return
    extra = TRUNCATED if letter.isupper() else 0
    kept = KEPT.get((letter.lower(), place))
    if kept is not None:
        yield "K", KEEP + extra, kept
    yield "R", REROLE + extra, TURN[place]


@lru_cache(maxsize=None)
def least(letters: str) -> int:
    """The least cost of a row or two, whatever stands before and after."""
    cost = dict.fromkeys(PLACES, 0)
    for letter in letters:
        for _ in range(2):
            for place, before in list(cost.items()):
                cost[TURN[place]] = min(cost[TURN[place]], before + INSERT)
        new = dict.fromkeys(PLACES, math.inf)
        for place, before in cost.items():
            for _, c, to in steps(letter, place):
                new[to] = min(new[to], before + c)
        cost = new
    return min(cost.values())


def lower_bounds(letters: str) -> list[int]:
    """For each suffix, what its rows cost at least, taken one by one or in pairs."""
    n = len(letters)
    bounds = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bounds[i] = least(letters[i]) + bounds[i + 1]
        if i + 2 <= n:
            bounds[i] = max(bounds[i], least(letters[i:i + 2]) + bounds[i + 2])
    return bounds


def _children(letters: str, node: tuple, last: bool) -> list[tuple]:
    i, place, cost, audit = node
    n = len(letters)
    out = []
    if i < n:
        edits = list(steps(letters[i], place))
        out = [(i + 1, to, cost + c, audit + e) for e, c, to in edits]
    if i < n or last:
        out.insert(1 if i < n else 0, (i, TURN[place], cost + INSERT, audit + "I"))
    return out


def _dive(letters: str, root: tuple, goals: frozenset, last: bool, bounds: list[int]) -> tuple:
    """A first solution: always the child that looks cheapest."""
    node, inserted = root, 0
    while node[0] < len(letters) or (last and node[1] not in goals and inserted < 2):
        children = _children(letters, node, last)
        if inserted == 2:
            children = [c for c in children if c[0] > node[0]]
        node, before = min(children, key=lambda c: (c[2] + bounds[c[0]], c[3])), node
        inserted = inserted + 1 if node[0] == before[0] else 0
    return (node[2], node[3]) if node[1] in goals else (math.inf, "")


@lru_cache(maxsize=100_000)
def search(letters: str, start: int = START, goals: frozenset = WHOLE, last: bool = True) -> tuple[float, str]:
    """The least (cost, audit) from a place over all letters to one of ``goals``; the cost is infinite if there is none.

    Turns may be inserted before each row, and behind the last one if ``last``.
    """
    n, bounds = len(letters), lower_bounds(letters)
    root = (0, start, 0, "")
    incumbent = _dive(letters, root, goals, last, bounds)
    reached = [[math.inf] * len(PLACES) for _ in range(n + 1)]  # by node, the cost of the best prefix so far
    stack = [root]
    while stack:
        node = stack.pop()
        i, place, cost, audit = node
        bound = cost + bounds[i]
        if bound > incumbent[0] or (bound == incumbent[0] and audit > incumbent[1]) or cost >= reached[i][place]:
            continue
        reached[i][place] = cost
        if i == n and place in goals:
            incumbent = min(incumbent, (cost, audit))
        stack.extend(reversed(_children(letters, node, last)))
    return incumbent


# --- chains ----------------------------------------------------------------------------------------------

Table = dict[tuple[int, int], tuple[float, str]]
DONE = len(PLACES)


def chain(tables: Sequence[Table], start: int, goal: int) -> tuple[float, str]:
    """The least (cost, audit) through all tables, from ``start`` to ``goal``."""
    rest = [{goal: 0.0}]
    for table in reversed(tables):
        before: dict[int, float] = {}
        for (a, b), (cost, _) in table.items():
            if b in rest[-1]:
                before[a] = min(before.get(a, math.inf), cost + rest[-1][b])
        rest.append(before)
    rest.reverse()
    if start not in rest[0]:
        return math.inf, ""
    audit, place = [], start
    for table, here, there in zip(tables, rest, rest[1:]):
        best = min((said, b) for (a, b), (cost, said) in table.items()
                   if a == place and b in there and cost + there[b] == here[place])
        audit.append(best[0])
        place = best[1]
    return rest[0][start], "".join(audit)


def table_of(letters: str, last: bool) -> Table:
    """Costs and audits of a block for each place it may begin and end with; the end of a conversation is ``DONE``."""
    pieces = [letters[i:i + PIECE] for i in range(0, len(letters), PIECE)] or [""]
    tables = []
    for k, piece in enumerate(pieces):
        ends = last and k == len(pieces) - 1
        goals = [(DONE, WHOLE)] if ends else [(b, frozenset({b})) for b in PLACES]
        found = {(a, b): search(piece, a, goal, ends) for a in PLACES for b, goal in goals}
        tables.append({ab: x for ab, x in found.items() if x[0] < math.inf})
    if len(tables) == 1:
        return tables[0]
    goals = [DONE] if last else PLACES
    found = {(a, b): chain(tables, a, b) for a in PLACES for b in goals}
    return {ab: x for ab, x in found.items() if x[0] < math.inf}


def solve(letters: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    cost, audit = search(letters) if len(letters) <= PIECE else chain([table_of(letters, True)], START, DONE)
    return int(cost), audit


def roles(audit: str, initials: str) -> Iterator[tuple[str, str | None]]:
    """For each letter of an audit, the edit and the role of the turn that it leaves (None: that of the row)."""
    place, rows = START, iter(initials)
    for edit in audit:
        letter = None if edit == "I" else next(rows)
        if edit in "IR":
            place = TURN[place]
            yield edit, "user" if place == USER else "assistant"
        else:
            place = KEPT[letter, place] if edit == "K" else place
            yield edit, None


# --- conversations -----------------------------------------------------------------------------------------

FOUND = "array<struct<a: int, b: int, cost: long, audit: string>>"
_FOUND = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def conversation_key() -> Column:
    return F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))


def digest_of(text: str) -> Column:
    """128 bits of the SHA-256 of a column."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def lettered(rows: DataFrame) -> DataFrame:
    """Rows (tree, turn, role, said, place, n_tree) with their first fault and their letter; texts are left behind.

    ``said`` is a digest of the text. Rows of one turn are ordered by role and digest.
    """
    body = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    narrow = rows.select(
        conversation_key().alias("tree"), F.col("turn").cast("long").alias("turn"), "role", digest_of("text").alias("said"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    placed = numbered(narrow, ["turn", "role", "said"])
    first = placed.groupBy("tree", "role", "said").agg(F.min("place").alias("_first"), F.count("*").alias("_n"))
    first = first.filter("_n > 1").drop("_n")
    marked = placed.join(first, ["tree", "role", "said"], "left")
    fault = (F.when(F.col("blank"), "blank").when(F.col("place") > F.col("_first"), "duplicate")
             .when(F.col("cut"), "truncated"))
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper("initial"))
    marked = marked.withColumn("fault", fault).withColumn("initial", initial)
    return marked.withColumn("letter", F.coalesce(letter, "initial")).drop("_first", "blank", "cut")


def _joined(column: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", column))), lambda x: x[column]), "")


def _packed(rows: Iterable[tuple], fields: Sequence[tuple[str, pa.DataType]], most: int) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of at most ``most`` rows."""
    rows = iter(rows)
    while part := list(islice(rows, most)):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)],
                                         [name for name, _ in fields])


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, 64).columns), strict=True)


_BLOCK_FIELDS = [("tree", pa.string()), ("block", pa.int64()), ("initials", pa.string()), ("found", _FOUND)]


def _search_blocks(blocks: DataFrame) -> DataFrame:
    def run(batches):
        def found():
            for tree, block, initials, letters, last, only in _tuples(batches):
                table = {(START, DONE): solve(letters)} if only else table_of(letters, last)
                yield tree, block, initials, [
                    {"a": a, "b": b, "cost": int(cost), "audit": audit} for (a, b), (cost, audit) in table.items()]

        yield from _packed(found(), _BLOCK_FIELDS, 256)

    columns = ("tree", "block", "initials", "letters", "last", "only")
    return blocks.select(*columns).mapInArrow(run, f"tree string, block long, initials string, found {FOUND}")


LEGAL = {"su", "ua", "au"}


def _chained(parts: list[dict]) -> tuple[int, str, str]:
    """Cost, audit and initials of a conversation from its blocks in order."""
    tables = [{(f["a"], f["b"]): (f["cost"], f["audit"]) for f in p["found"]} for p in parts]
    cost, audit = chain(tables, START, DONE)
    return int(cost), audit, "".join(p["initials"] for p in parts)


_SOLVED_FIELDS = [("tree", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("initials", pa.string()),
                  ("illegal", pa.int64())]


def solved(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(tree, cost, audit, initials, illegal) of each conversation, from ``lettered`` rows."""
    grouped = rows.withColumn("block", F.floor(F.col("place") / block).cast("long")).groupBy("tree", "block", "n_tree").agg(
        _joined("initial").alias("initials"), _joined("letter").alias("letters"))
    last = (F.col("block") + 1) * block >= F.col("n_tree")
    blocks = _search_blocks(grouped.withColumns({"last": last, "only": F.col("n_tree") <= block}))
    parts = blocks.groupBy("tree").agg(
        F.array_sort(F.collect_list(F.struct("block", "initials", "found"))).alias("parts"))

    def run(batches):
        def found():
            for tree, parts in _tuples(batches):
                cost, audit, initials = _chained(parts)
                illegal = sum(initials[k:k + 2] not in LEGAL for k in range(len(initials) - 1))
                yield tree, cost, audit, initials, illegal

        yield from _packed(found(), _SOLVED_FIELDS, 1000)

    return parts.mapInArrow(run, "tree string, cost long, audit string, initials string, illegal long")


_EDIT_FIELDS = [("tree", pa.string()), ("n", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("new_role", pa.string())]


def edits(solutions: DataFrame) -> DataFrame:
    """The turns that audits leave: (tree, n, place, edit, new_role), ``place`` null for an inserted turn, by ``n``."""

    def run(batches):
        def left():
            for tree, audit, initials in _tuples(batches):
                place = -1
                for n, (edit, role) in enumerate(roles(audit, initials)):
                    place += edit != "I"
                    if edit != "D":
                        yield tree, n, None if edit == "I" else place, edit, role

        yield from _packed(left(), _EDIT_FIELDS, 10_000)

    return solutions.select("tree", "audit", "initials").mapInArrow(
        run, "tree string, n long, place long, edit string, new_role string")


def repaired_turns(rows: DataFrame, marked: DataFrame, solutions: DataFrame) -> DataFrame:
    """The turns of repaired conversations: (tree, n, edit, role, text), in the order of ``n``.

    A row that stays is the first of its role and text, so its text is looked up by those.
    """
    left = edits(solutions)
    stays = marked.filter("letter <> 'd'").select("tree", "place", "role", "said")
    stays = left.filter("place is not null").join(stays, ["tree", "place"])
    texts = rows.select(conversation_key().alias("tree"), "role", digest_of("text").alias("said"), "text")
    texts = texts.groupBy("tree", "role", "said").agg(F.first("text").alias("text"))
    turns = stays.join(texts, ["tree", "role", "said"]).select(
        "tree", "n", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    inserted = left.filter("place is null").select("tree", "n", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return turns.unionByName(inserted)


def turns_digest(turns: DataFrame) -> DataFrame:
    """SHA-256 of the turns of each conversation as lines ``role:text``.

    The digest is a chain over the conversation, so its turns pass one task, in order and one batch at a time.
    """
    ordered = turns.repartition("tree").sortWithinPartitions("tree", "n").select("tree", "role", "text")

    def run(batches):
        def digests():
            for tree, turns in groupby(_tuples(batches), key=itemgetter(0)):
                state = sha256()
                for i, (_, role, text) in enumerate(turns):
                    state.update(f"{chr(10) if i else ''}{role}:{text}".encode())
                yield tree, state.hexdigest()

        yield from _packed(digests(), [("tree", pa.string()), ("repaired_sha256", pa.string())], 10_000)

    return ordered.mapInArrow(run, "tree string, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults, cost, audit and digest of the repair of each conversation.

    ``rows`` has conv_id, turn, role and text; of ``conversations``, which may hold more, only conv_id is read. Nulls in
    role or text are one space; rows without conv_id are one conversation; those without turn come first and count for
    no gap. Rows of one turn are ordered by role and by a digest of the text; repeated rows are duplicates. A conversation
    without rows has zeros, an empty audit and the digest of nothing. Other columns are not read.
    """
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    marked = lettered(rows).checkpoint()
    solutions = solved(marked, block).checkpoint()
    faults = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    turn = F.col("turn")
    counts = marked.groupBy("tree", "turn").agg(*faults).groupBy("tree").agg(
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")),
        (F.max(turn) - F.min(turn) + 1 - F.count(turn)).alias("gaps"))
    digests = turns_digest(repaired_turns(rows, marked, solutions))
    every = conversations.select("conv_id").distinct().withColumn("tree", conversation_key())
    found = every.join(counts, "tree", "left").join(solutions.drop("initials"), "tree", "left").join(digests, "tree", "left")
    whole = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *whole, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with made-up damage, by the hash of ``conv_id:turn``: lost, emptied, cut, repeated, renamed rows."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind"))
    kind = F.col("_kind")
    rows = rows.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return rows.drop("_copy")
