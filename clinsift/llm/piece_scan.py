"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is cut into vocabulary pieces so that the sum of the pieces' scores is greatest (a character
without a piece becomes its UTF-8 bytes).  A giant document is split into chunks of ``CHUNK``
characters, wherever they fall.  The state at a chunk border is how far the piece that crosses it
reaches into the next chunk; a chunk yields the max-plus matrix of best scores from each
entry to each exit state.  Matrix products are associative: products of ``FAN`` chunks are
formed first, the border states of these groups follow from one short row of products per
document, those of the chunks from the matrices of one group, and then every chunk is traced
back by itself between its two states.  Documents of one chunk are traced back right away.

Blanks are the piece mark U+2581, one is put in front, and no piece has a mark after another
character, so there is a cut before each run of marks; words with the marks before them are
solved once and remembered (in a bounded table).  New words are solved in sorted order, so that
the beginning a word shares with the one before it is solved once.  Scores below ``FLOOR``, which
stand for "last resort", count as ``FLOOR``.  Of equally good cuts, the one with the least
sum of fixed weights of its cut positions within the word is taken, so that the result does
not depend on where chunks end.

The vocabulary's own scores decide.  For a vocabulary learnt by merging, the library's default
encoder repeats the merges instead; both are valid encodings that decode to the same text.

Defined cases: null and empty texts have no ids; rows are never dropped and repeated rows get
equal ids; U+2581 in a text reads as a blank, as in the library.  An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.llm.staging import staged

MARK = "▁"
CHUNK = 65_536
FAN = 64
FLOOR = -1e6
_UNKNOWN = -50_000  # no choice depends on it: such a character is in no piece
_SCALE = 1 << 30  # scores come before cut weights
_LOW = -(1 << 200)
_NEVER = np.int64(-(1 << 61))
_WORDS = 250_000  # words remembered by one worker, some 60 MB
_TOGETHER = 1 << 20  # characters whose new words are solved together
_CUTS = [int(x) for x in np.random.default_rng(11).integers(1, 1 << 14, 4096)]


def _with_marks(words: list[str]) -> list[str]:
    out, marks = [], 0
    for word in words:
        if word:
            out.append(MARK * marks + word)
            marks = 0
        else:
            marks += 1
    return [*out, MARK * (marks - 1)] if marks else out


def _first_cut(text: str) -> int:
    """The first place with a mark after another character, -1 if there is none."""
    rest = text.lstrip(MARK)
    at = rest.find(MARK)
    return at if at < 0 else at + len(text) - len(rest)


def _last_cut(text: str) -> int:
    """The last place with a mark after another character, -1 if there is none."""
    return len(text[: text.rfind(MARK) + 1].rstrip(MARK)) or -1


class Pieces:
    """The lattice of a vocabulary."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, int]] = {}
        self.bytes: dict[int, int] = {}
        self.shown: list[bytes] = []
        self.scores = np.zeros(model.get_piece_size(), np.int64)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.shown.append(bytes([int(piece[3:-1], 16)]))
                continue
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            self.shown.append(b"" if special else piece.replace(MARK, " ").encode())
            if not special:
                score = round(max(model.get_score(i), FLOOR))
                self.pieces[piece] = (i, score * _SCALE)
                self.scores[i] = score
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has the word mark inside")
        self.longest = max(map(len, self.pieces), default=1)
        # a trie: character -> (next level, id, score), id and score None inside pieces only
        self.root: dict[str, tuple[dict, int | None, int | None]] = {}
        for piece, (i, score) in self.pieces.items():
            level = self.root
            for char in piece[:-1]:
                level = level.setdefault(char, ({}, None, None))[0]
            below = level.get(piece[-1], ({}, None, None))[0]
            level[piece[-1]] = (below, i, score)
        # the same from behind: last character first
        self.tails: dict[str, tuple[dict, int | None, int | None]] = {}
        for piece, (i, score) in self.pieces.items():
            level = self.tails
            for char in piece[:0:-1]:
                level = level.setdefault(char, ({}, None, None))[0]
            below = level.get(piece[0], ({}, None, None))[0]
            level[piece[0]] = (below, i, score)
        self.sizes = {i: len(piece) for piece, (i, _) in self.pieces.items()}
        self.packed = [struct.pack("<i", i) for i in range(len(self.scores))]
        self.shown = np.array([*self.shown, None], object)[:-1]
        # neighbours that some piece holds together; between any others there is a cut
        self.joined = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self._words: dict[str, bytes] = {}

    def forward(
        self, text: str, start: int, stop: int, last: int, lead: int
    ) -> tuple[list[int | None], list[tuple[int, int] | None]]:
        """Best value of each place from ``start`` on, pieces beginning before ``last`` and
        ending by ``stop``; and the piece (start, id) that leads there.  ``lead`` is added
        to a place to get its distance from the beginning of the word."""
        value: list[int | None] = [None] * (stop + 1)
        back: list[tuple[int, int] | None] = [None] * (stop + 1)
        value[start] = 0
        for i in range(start, min(last, stop)):
            base = value[i]
            if base is None:
                continue
            level = self.root
            for j in range(i, stop):
                step = level.get(text[j])
                if step is None:
                    break
                level, piece, score = step
                if piece is not None:
                    new = base + score - _CUTS[(lead + j + 1) & 4095]
                    if value[j + 1] is None or new > value[j + 1]:
                        value[j + 1], back[j + 1] = new, (i, piece)
            if text[i] not in self.pieces:
                new = base + _UNKNOWN * _SCALE - _CUTS[(lead + i + 1) & 4095]
                if value[i + 1] is None or new > value[i + 1]:
                    value[i + 1], back[i + 1] = new, (i, -1)
        return value, back

    def _solve(self, words: list[str]) -> Iterator[bytes]:
        """Ids of sorted words, each with its mark: ``trace`` for the case where every place is reached.

        The best value of a place depends on what is before it only, so the values of the
        beginning that a word shares with the one before it are kept.
        """
        tails, cuts, pieces, sizes, packed = self.tails, _CUTS, self.pieces, self.sizes, self.packed
        value, how = [0], [-1]
        before = ""
        for word in words:
            unit = MARK + word
            n, shared = len(unit), 0
            for x, y in zip(before, unit, strict=False):
                if x != y:
                    break
                shared += 1
            del value[shared + 1 :], how[shared + 1 :]
            before = unit
            for j in range(shared, n):
                best, by = (_LOW, -1) if unit[j] in pieces else (value[j] + _UNKNOWN * _SCALE, -1)
                level = tails
                for i in range(j, -1, -1):
                    step = level.get(unit[i])
                    if step is None:
                        break
                    level, piece, score = step
                    if piece is not None:
                        new = value[i] + score
                        if new >= best:
                            best, by = new, piece
                value.append(best - cuts[(j + 1) & 4095])
                how.append(by)
            ids: list[bytes] = []
            at = n
            while at:
                by = how[at]
                if by >= 0:
                    ids.append(packed[by])
                    at -= sizes[by]
                else:
                    at -= 1
                    ids.append(b"".join(packed[self.bytes[b]] for b in unit[at].encode()))
            ids.reverse()
            yield b"".join(ids)

    def _learn(self, words: set[str]) -> None:
        """Solve and remember the words that are not known yet."""
        known = self._words
        if len(known) > _WORDS:
            known.clear()
        whole, ended = set(), []
        for word in words.difference(known):
            if len(word) > 1 and word[-2:] not in self.joined:  # often a comma: the rest may be known
                ended.append(word)
                if word[:-1] not in known:
                    whole.add(word[:-1])
            else:
                whole.add(word)
        ordered = sorted(whole)
        known.update(zip(ordered, self._solve(ordered), strict=True))
        for word in ended:
            char = word[-1]
            last = self.pieces.get(char)
            end = self.packed[last[0]] if last else b"".join(self.packed[self.bytes[b]] for b in char.encode())
            known[word] = known[word[:-1]] + end

    def trace(self, text: str, start: int, stop: int, last: int, lead: int) -> list[int]:
        """Ids of the best path from ``start`` to ``stop``."""
        back = self.forward(text, start, stop, last, lead)[1]
        ids: list[list[int]] = []
        at = stop
        while at != start:
            before, piece = back[at]
            ids.append([piece] if piece >= 0 else [self.bytes[b] for b in text[before:at].encode()])
            at = before
        return [i for some in reversed(ids) for i in some]

    def words(self, words: list[str]) -> bytes:
        """Ids, as little-endian 32-bit numbers, of words that each follow a blank.

        Empty words (between two blanks) become marks of the word after them.
        """
        if "" in words:
            words = _with_marks(words)
        self._learn(set(words))
        return b"".join(map(self._words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; the new words of some ``_TOGETHER`` characters are solved together."""
        held: list[list[str]] = []
        size = 0
        for k, text in enumerate(texts):
            words = text.replace(MARK, " ").split(" ") if text else []
            held.append(_with_marks(words) if "" in words else words)
            size += len(text)
            if size >= _TOGETHER or k + 1 == len(texts):
                self._learn(set().union(*held))
                known = self._words.__getitem__
                for words in held:
                    yield b"".join(map(known, words))
                held, size = [], 0

    # chunks -------------------------------------------------------------------------------

    def matrix(self, chunk: str, ahead: str, lead: int) -> np.ndarray:
        """Best score from each entry to each exit state, scaled so that the greatest is 0."""
        size, n = self.longest, len(chunk)
        text = chunk + ahead
        found: list[list[int | None]] = [[None] * size for _ in range(size)]
        first, final = _first_cut(chunk), _last_cut(chunk)
        if first < 0:
            for e in range(min(size, n + 1)):
                found[e] = self._exits(text, e, n, lead)
            for e in range(n + 1, size):  # a piece that spans the whole chunk
                found[e][e - n] = 0
        else:
            exits = self._exits(text, final, n, -final)
            for e in range(min(size, first + 1)):
                value = self.forward(text, e, first, first, lead)[0][first]
                if value is not None:
                    found[e] = [x if x is None else x + value for x in exits]
        # long chunks go beyond 64 bits until they are scaled
        top = max((x for row in found for x in row if x is not None), default=0)
        return np.array([[_NEVER if x is None else x - top for x in row] for row in found], np.int64)

    def _exits(self, text: str, start: int, n: int, lead: int) -> list[int | None]:
        stop = min(len(text), n + self.longest - 1)
        value = self.forward(text, start, stop, n, lead)[0]
        return [value[n + x] if n + x <= stop else None for x in range(self.longest)]

    def chunk_ids(self, chunk: str, ahead: str, lead: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces that begin in the chunk, given both border states."""
        n, text = len(chunk), chunk + ahead
        first, final = _first_cut(chunk), _last_cut(chunk)
        pack = lambda ids: np.array(ids, "<i4").tobytes()
        if first < 0:
            return pack(self.trace(text, entry, n + leave, n, lead)) if entry <= n else b""
        head = pack(self.trace(text, entry, first, first, lead))
        middle = self.words(chunk[first + 1 : final].split(MARK)) if final > first else b""
        return head + middle + pack(self.trace(text, final, n + leave, n, -final))

    def decode(self, ids: pa.Array | None) -> str:
        raw = b"".join(self.shown[ids.to_numpy()].tolist()) if ids is not None and len(ids) else b""
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


@lru_cache(2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product, scaled so that its greatest entry is 0."""
    reached = (a[:, :, None] > _NEVER) & (b[None, :, :] > _NEVER)
    best = np.where(reached, a[:, :, None] + b[None, :, :], _NEVER).max(axis=1)
    top = best.max()
    return np.where(best > _NEVER, best - top, _NEVER) if top > _NEVER else best


def border_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The state before each matrix and after the last one, on the best way through."""
    size = matrices[0].shape[0]
    value = np.full(size, _NEVER)
    value[entry] = 0
    ways = []
    for m in matrices:
        total = np.where((value[:, None] > _NEVER) & (m > _NEVER), value[:, None] + m, _NEVER)
        ways.append(total.argmax(axis=0))
        value = total.max(axis=0)
        value = np.where(value > _NEVER, value - value.max(), _NEVER)
    states = [leave]
    for way in reversed(ways):
        states.append(int(way[states[-1]]))
    return states[::-1]


def _chunks(chunk: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = MARK + text.replace(" ", MARK)
                starts = range(0, len(text), chunk)
                word, leads = 0, []
                for s in starts:
                    low = max(0, s - chunk)
                    cut = _last_cut(text[low : s + 1])
                    word = word if cut < 0 else low + cut
                    leads.append(s - word)
                for at in range(0, len(starts), 64):
                    some = starts[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(some), pa.int64()),
                            pa.array(range(at, at + len(some)), pa.int32()),
                            pa.array([len(starts)] * len(some), pa.int32()),
                            pa.array(leads[at : at + 64], pa.int32()),
                            pa.array([text[s : s + chunk] for s in some]),
                            pa.array([text[s + chunk : s + chunk + longest - 1] for s in some]),
                        ],
                        names=["row", "chunk", "chunks", "lead", "text", "ahead"],
                    )

    return run


def _states(chunks: DataFrame, path: str) -> DataFrame:
    """``row, chunk, entry, leave`` of every chunk, by products of groups of chunks."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            found = [
                pieces.matrix(*x).tobytes()
                for x in zip(*(batch.column(c).to_pylist() for c in ("text", "ahead", "lead")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(found, pa.binary())],
                names=["row", "chunk", "m"],
            )

    def load(column: pd.Series) -> list[np.ndarray]:
        size = int((len(column.iloc[0]) // 8) ** 0.5)
        return [np.frombuffer(b, np.int64).reshape(size, size) for b in column]

    def product(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        whole, *rest = load(group["m"])
        for m in rest:
            whole = multiply(whole, m)
        return pd.DataFrame({"row": [group["row"].iloc[0]], "part": [group["part"].iloc[0]], "m": [whole.tobytes()]})

    def of_document(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        states = border_states(load(group["m"]), 0, 0)
        return group[["row", "part"]].assign(entry=states[:-1], leave=states[1:])

    def of_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        states = border_states(load(group["m"]), int(group["entry"].iloc[0]), int(group["leave"].iloc[0]))
        return group[["row", "chunk"]].assign(entry=states[:-1], leave=states[1:])

    each = staged(
        chunks.select("row", "chunk", "lead", "text", "ahead")
        .mapInArrow(matrices, "row long, chunk int, m binary")
        .withColumn("part", F.expr(f"chunk div {FAN}").cast("int")),
        "matrices",
    )
    products = each.groupBy("row", "part").applyInPandas(product, "row long, part int, m binary")
    outer = products.groupBy("row").applyInPandas(of_document, "row long, part int, entry int, leave int")
    return (
        each.join(outer, ["row", "part"])
        .groupBy("row", "part")
        .applyInPandas(of_group, "row long, chunk int, entry int, leave int")
    )


def encode(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    decoded: bool = False,
) -> DataFrame:
    """``doc_id, ids`` of every row; ``model`` is the vocabulary file's path.

    ``decoded`` adds ``text``, read back from the ids as by ``decode``, but in the same
    Python workers, so that the ids do not travel twice.
    """
    if chunk < 1:
        raise ValueError("a chunk has one character at least")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    giant = F.length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = list(pieces.encode_all(some.column(1).to_pylist()))
                out = _id_batch(["doc_id"], [some.column(0)], ids)
                yield out.append_column("text", _texts(pieces, out.column("ids"))) if decoded else out

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        columns = ("text", "ahead", "lead", "entry", "leave")
        for batch in batches:
            found = [
                pieces.chunk_ids(*x)
                for x in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            ]
            yield _id_batch(["row", "chunk"], [batch.column("row"), batch.column("chunk")], found)

    kind = "doc_id long, ids array<int>" + ", text string" * decoded
    small = rows.where(~giant).mapInArrow(whole, kind)
    # the row number is written with the text, so it holds whatever is computed again later
    large = staged(
        rows.where(giant).withColumn("row", F.monotonically_increasing_id()), "giants"
    )
    longest = pieces_of(model).longest
    chunks = staged(
        large.select("row", "text").mapInArrow(
            _chunks(chunk, longest), "row long, chunk int, chunks int, lead int, text string, ahead string"
        ),
        "chunks",
    )
    ids = (
        chunks.join(_states(chunks, model), ["row", "chunk"])
        .mapInArrow(traced, "row long, chunk int, ids array<int>")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
        .select("row", F.flatten("parts.ids").alias("ids"))
    )
    rest = large.select("doc_id", "row").join(ids, "row").select("doc_id", "ids")
    return small.union(decode(rest, model) if decoded else rest)


def _texts(pieces: Pieces, ids: pa.ListArray) -> pa.Array:
    return pa.array([pieces.decode(x.values) for x in ids], pa.string())


def _id_batch(names: list[str], columns: list[pa.Array], ids: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(b) // 4 for b in ids)]).astype(np.int32)
    flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
    lists = pa.ListArray.from_arrays(pa.array(ends), flat)
    return pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "ids"])


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, text``: the text that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                yield some.append_column("text", _texts(pieces, some.column(1)))

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
