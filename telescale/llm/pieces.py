"""SentencePiece encoding and decoding of merge-type models, exact, by backtracking.

A text is the merge encoding of a sequence of pieces if and only if each adjacent pair of them is: joined and
merged anew, the pair must come out as it was. So the encoder takes the longest piece at each position (found in
one pass of an Aho-Corasick automaton), checks it against the piece before it, falls back to the next shorter
prefix, and steps back where none fits. A bitfield marks positions from which the rest of the text was not
reached, so that each is left only once; it holds one bit for each position, so the time stays linear in the text.

A space and what follows it, up to the next space or the end of a word, form a segment: no piece crosses its border
(checked when the model is loaded), so segments are encoded alone and recent ones are kept. Runs of several spaces, whose
pieces share one score, are merged directly, leftmost first, in time n log n: a million spaces take some seconds.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from telescale.llm.texts import map_texts

SPACE = "▁"  # stands for a space in pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in the model file
LETTER = re.compile(r"[^\W\d_²³¹]")
#: Stretches that merge apart: spaces and what follows up to the next space, or up to the border of a word.
BY_SPACES = f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
BY_LETTERS = rf"{SPACE}*[^\W\d_²³¹]+|{SPACE}*(?:[^\w{SPACE}]|[\d_²³¹])+|{SPACE}+"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
PIECE_BITS = 24  # bits of an id in the key of a pair
KEPT_SEGMENTS = 200_000  # bound on the segments that a worker keeps, about 45 MB


class PieceModel:
    """Pieces, scores and kinds of a merge-type model with byte fallback, read from its file."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("not a merge-type model with byte fallback")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that leave the text as it is and add a space before it")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = [p.score for p in proto.pieces]
        self.bytes = {int(m[1], 16): i for i, p in enumerate(proto.pieces)
                      if p.type == BYTE and (m := BYTE_PIECE.fullmatch(p.piece))}
        if any(SPACE in p[1:] and p.strip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space behind another character")
        self._fits: dict[int, bool] = {}  # by the ids of two pieces
        self._segments: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        # Pieces that merging can make, and for each the next shorter one that starts it.
        made = {p for p in self.ids if self.merge(p) == [self.ids[p]]}
        self.automaton = ahocorasick.Automaton()
        for p in made:
            self.automaton.add_word(p, self.ids[p])
        self.automaton.make_automaton()
        self.shorter = {
            self.ids[p]: next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in made), -1) for p in made
        }
        self.lengths = [len(p) for p in self.pieces]
        self.longest = max(map(len, made))
        self.segments = re.compile(BY_LETTERS if self._letters_apart() else BY_SPACES)
        self.known = frozenset(c for c in self.ids if len(c) == 1)
        # Text of the pieces that decode alone: a byte below 0x80 is a character whatever stands beside it.
        self.plain: list[str | None] = [
            p.replace(SPACE, " ") if kind == NORMAL else
            chr(int(p[3:5], 16)) if kind == BYTE and int(p[3:5], 16) < 0x80 else None
            for p, kind in zip(self.pieces, self.kinds, strict=True)
        ]
        # Scores from best to worst as ranks, and the two pieces that each piece is merged from.
        self.ranks = [len(self.pieces)] * len(self.pieces)
        for rank, i in enumerate(sorted((self.ids[p] for p in made), key=lambda i: -self.scores[i])):
            self.ranks[i] = rank
        self.halves = {self.ids[p]: self._halves(p) for p in made if len(p) > 1}

    def _letters_apart(self) -> bool:
        """Whether no piece holds a letter beside another character than a letter or a space."""
        letters = {c: bool(LETTER.match(c)) for p in self.ids for c in p}
        return all(a == SPACE or letters[a] == letters[b] for p in self.ids for a, b in zip(p, p[1:], strict=False))

    # --- merging ------------------------------------------------------------------------------------

    def merge(self, text: str, short_of: str | None = None) -> list[int]:
        """Merge adjacent symbols, best score first and then leftmost. Characters without a piece become bytes.

        ``short_of`` is a piece that is not made, so that merging stops with its two halves.
        """
        parts: list[str | None] = list(text)
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts) and (both := parts[i] + parts[after[i]]) in self.ids and both != short_of:
                heapq.heappush(queue, (-self.scores[self.ids[both]], i, both))

        for i in range(len(parts)):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            j = after[i]
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [x for p in parts if p is not None for x in ([self.ids[p]] if p in self.ids else self._as_bytes(p))]

    def _as_bytes(self, text: str) -> list[int]:
        return [self.bytes[b] for b in text.encode()]

    def _halves(self, piece: str) -> tuple[int, int]:
        """The two pieces of the last merge that makes a piece."""
        left, right = self.merge(piece, short_of=piece)
        return left, right

    def _remerged(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are if their joined text is merged anew.

        Merges inside a piece go on in the order of their ranks until one across the border comes first. So the
        symbols at the border are taken apart again, last merge first; if those that then meet would merge before
        the merges undone so far, the pieces do not stay.
        """
        ids, pieces, ranks, halves = self.ids, self.pieces, self.ranks, self.halves
        undone = len(pieces)  # rank of the earliest merge taken back; a merge on the left wins a tie
        while True:
            both = ids.get(pieces[left] + pieces[right])
            if both is not None and ranks[both] < undone:
                return False
            from_left = left in halves and (right not in halves or ranks[left] > ranks[right])
            if from_left:
                undone, left = ranks[left], halves[left][1]
            elif right in halves:
                undone, right = ranks[right] + 1, halves[right][0]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        known = self._fits.get(left << PIECE_BITS | right)
        if known is None:
            known = self._remerged(left, right)
            if len(self._fits) >= KEPT_SEGMENTS:
                self._fits.clear()
            self._fits[left << PIECE_BITS | right] = known
        return known

    # --- encoding -----------------------------------------------------------------------------------

    def _backtrack(self, text: str) -> list[int]:
        """Encode characters that all have pieces."""
        n, lengths, shorter, fits = len(text), self.lengths, self.shorter, self._fits
        longest = [-1] * (n + 1)
        for end, piece in self.automaton.iter_long(text):  # the longest at 0, the longest behind it, and so on
            longest[end + 1 - lengths[piece]] = piece
        failed = b""  # once something failed, a bit for each position: the rest of the text is not reached from there
        out: list[int] = []
        at, piece, last = 0, longest[0], -1
        while at < n:
            while piece >= 0:
                end = at + lengths[piece]
                if not (failed and failed[end >> 3] >> (end & 7) & 1):
                    if last < 0:
                        break
                    fit = fits.get(last << PIECE_BITS | piece)
                    if fit is None:
                        fit = self.fits(last, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                last, at = piece, end
                piece = longest[at]
                if piece < 0 and at < n and not (failed and failed[at >> 3] >> (at & 7) & 1):
                    piece = longest[at] = next(self.automaton.iter_long(text[at:at + self.longest]))[1]
            else:
                failed = failed or bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= lengths[last]
                piece = shorter[out.pop()]
                last = out[-1] if out else -1
        return out

    def _segment(self, text: str) -> list[int]:
        """Encode stretches of known characters; the others, which no piece holds, become bytes."""
        if text.startswith(SPACE * 2):
            return self.merge(text)
        if self.known.issuperset(text):
            return self._backtrack(text)
        out: list[int] = []
        for known, stretch in itertools.groupby(text, self.known.__contains__):
            stretch = "".join(stretch)
            out += self._backtrack(stretch) if known else self._as_bytes(stretch)
        return out

    def segment(self, text: str) -> tuple[int, ...]:
        """The ids of a segment, kept for its next occurrence. Of full stores, the older half goes."""
        found = self._segments.get(text)
        if found is None:
            found = self._older.get(text)
            if found is None:
                found = tuple(self._segment(text))
            if len(text) <= 64:
                if len(self._segments) >= KEPT_SEGMENTS // 2:
                    self._segments, self._older = {}, self._segments
                self._segments[text] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without begin or end; none for an empty text."""
        if not text:
            return []
        out: list[int] = []
        recent = self._segments.get
        for segment in self.segments.findall(SPACE + text.replace(" ", SPACE)):
            found = recent(segment)
            if found is None:
                found = self.segment(segment)
                recent = self._segments.get  # the store may have been set anew
            out += found
        return out

    # --- decoding -----------------------------------------------------------------------------------

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: one space before it goes, control pieces give nothing, bytes outside UTF-8 U+FFFD each."""
        texts = list(map(self.plain.__getitem__, ids))
        if None not in texts:
            text = "".join(texts)
            return text[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else text
        parts: list[str] = []
        waiting = bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                waiting.append(int(BYTE_PIECE.fullmatch(self.pieces[i])[1], 16))
                continue
            if waiting:
                parts.append(_utf8(bytes(waiting)))
                waiting.clear()
            if self.kinds[i] == UNKNOWN:
                parts.append(" ⁇ ")
            elif self.kinds[i] != CONTROL:
                parts.append(self.pieces[i].replace(SPACE, " ") if parts else _unspaced(self.pieces[i]))
        if waiting:
            parts.append(_utf8(bytes(waiting)))
        return "".join(parts)


def _unspaced(piece: str) -> str:
    return piece.removeprefix(SPACE).replace(SPACE, " ")


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out = []
        while raw:
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[:n].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            raw = raw[n:]
        return "".join(out)


def read_model(path: str) -> bytes:
    """The model file, some 500 kB, read once where the query is built and sent along with it."""
    with open(path, "rb") as file:
        return file.read()


_LOADED: dict[bytes, PieceModel] = {}


def load(model: bytes) -> PieceModel:
    """The model of these bytes; one is kept in each worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceModel(model)
    return _LOADED[key]


def encode_texts(docs: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",), into: str = "ids") -> DataFrame:
    """One row for each row of ``docs`` with the ids of its whole text. Null and empty texts have none."""

    def make():
        pieces = load(model)
        return lambda texts: [[pieces.encode(x.decode()) if x else [] for x in texts]]

    return map_texts(docs, keep, f"{into} array<int>", make)


def decode_ids(encoded: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",), column: str = "ids") -> DataFrame:
    """One row for each row of ``encoded`` with the text of its ids. Null ids give a null text."""
    from pyspark.sql.types import StringType, StructType

    schema = StructType([encoded.schema[c] for c in keep]).add("text", StringType())

    def run(batches):
        pieces = load(model)
        for batch in batches:
            *kept, ids = batch.columns
            texts = [None if x is None else pieces.decode(x) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], schema.names)

    return encoded.select(*keep, column).mapInArrow(run, schema)


def checked_ids(docs: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """As ``encode_texts``, with the number of ids and whether they decode to the text (null: to an empty one)."""

    def make():
        pieces = load(model)

        def scan(texts):
            texts = [x.decode() if x else "" for x in texts]
            ids = [pieces.encode(x) for x in texts]
            # A space sign in a text cannot be told from a space once it is encoded.
            same = [pieces.decode(i) == x.replace(SPACE, " ") for i, x in zip(ids, texts, strict=True)]
            return ids, [len(i) for i in ids], same

        return scan

    return map_texts(docs, keep, "ids array<int>, n_tokens long, decodes boolean", make)


def round_trip(docs: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Digests of the ids of each text and of the text decoded from them, one row for each row of ``docs``.

    Null counts as an empty text: no ids, and an empty text decoded. Repeated rows give repeated results, columns of
    ``docs`` outside ``keep`` are not read, and an empty table gives no rows.
    """

    def make():
        pieces = load(model)
        digits = [str(i) for i in range(len(pieces.pieces))]

        def scan(texts):
            counts, of_ids, of_texts = [], [], []
            for raw in texts:
                ids = pieces.encode(raw.decode()) if raw else []
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                of_texts.append(hashlib.sha256(pieces.decode(ids).encode()).hexdigest())
            return counts, of_ids, of_texts

        return scan

    return map_texts(docs, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
