import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet
import pytest
import sentencepiece

from clinsift.llm import piece_scan
from clinsift.llm.piece_scan import MARK, Pieces, border_states, decode, encode, multiply

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


@pytest.fixture(scope="module")
def texts():
    return pa.parquet.read_table(DOCS).column("text").to_pylist()


def ids(pieces, text):
    return np.frombuffer(pieces.encode(text), "<i4").tolist()


def test_best_score_by_trying_all_cuts(pieces):
    def best(unit):
        table = [0] + [None] * len(unit)
        for j in range(1, len(unit) + 1):
            ways = [table[i] + pieces.pieces[unit[i:j]][1] for i in range(j) if unit[i:j] in pieces.pieces]
            if unit[j - 1] not in pieces.pieces:
                ways.append(table[j - 1] + piece_scan._UNKNOWN * piece_scan._SCALE)
            table[j] = max(ways)
        return table[-1] // piece_scan._SCALE

    r = random.Random(1)
    for _ in range(400):
        word = "".join(r.choice("theanrion,.s$é漢") for _ in range(r.randrange(0, 12)))
        unit, found = MARK + word, ids(pieces, word) if word else ids(pieces, " ")[:0]
        if word:
            unknown = sum(c not in pieces.pieces for c in unit)
            assert pieces.scores[found].sum() + unknown * piece_scan._UNKNOWN == best(unit)


def test_score_of_the_library_as_a_unigram_model(pieces, texts):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.score < piece_scan.FLOOR:
            p.score, p.type = piece_scan.FLOOR, 5 if len(p.piece) > 1 else 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in texts[:60]:
        for word in text.split(" ")[:60]:
            assert pieces.scores[ids(pieces, word)].sum() == pieces.scores[library.encode(word)].sum()


def test_the_library_reads_the_ids(pieces, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts[:80] + ["", " ", "  a  b\n", "漢字 \x00", "▁x"]:
        assert library.decode(ids(pieces, text)) == text.replace(MARK, " ")


def test_products_are_associative():
    rng = np.random.default_rng(0)
    a, b, c = rng.integers(-50, 0, (3, 5, 5))
    assert (multiply(multiply(a, b), c) == multiply(a, multiply(b, c))).all()
    states = border_states([a, b, c], 2, 3)
    score = lambda s: a[s[0], s[1]] + b[s[1], s[2]] + c[s[2], s[3]]
    assert score(states) == max(score((2, i, j, 3)) for i in range(5) for j in range(5))


@pytest.mark.parametrize("chunk", [1, 3, 7, 64, 65_536])
def test_chunks_give_the_ids_of_the_whole(spark, pieces, texts, chunk):
    r = random.Random(chunk)
    some = ["", None, " ", "a", "  two  blanks ", "無" * 50, "aaa" * 60, "no blanks here".replace(" ", "")]
    for _ in range(60):
        t = r.choice(texts)
        at = r.randrange(len(t))
        some.append(t[at : at + r.randrange(1, 400)].replace(" ", "" if r.random() < 0.2 else " "))
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(some)] + [(0, "", 0), (None, "x y", 0)],
                               "doc_id long, text string, ids int")
    got = encode(df, MODEL, chunk=chunk)
    rows = got.collect()
    assert len(rows) == len(some) + 2
    for row in rows:
        text = "x y" if row.doc_id is None else some[row.doc_id] or ""
        assert row.ids == ids(pieces, text)
    if chunk == 64:
        for row in [*decode(got, MODEL).collect(), *encode(df, MODEL, chunk=chunk, decoded=True).collect()]:
            assert row.text == ("x y" if row.doc_id is None else some[row.doc_id] or "")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(df, MODEL), MODEL).count() == 0


def by_chunks(pieces, text, chunk):
    rows = pa.RecordBatch.from_pydict({"row": [0], "text": [text]})
    cut = [x for b in piece_scan._chunks(chunk, pieces.longest)(iter([rows])) for x in b.to_pylist()]
    matrices = [pieces.matrix(x["text"], x["ahead"], x["lead"]) for x in cut]
    whole = matrices[0]
    for m in matrices[1:]:
        whole = multiply(whole, m)
    assert whole[0, 0] > piece_scan._NEVER
    states = border_states(matrices, 0, 0)
    found = [
        pieces.chunk_ids(x["text"], x["ahead"], x["lead"], a, b)
        for x, a, b in zip(cut, states, states[1:], strict=False)
    ]
    return np.frombuffer(b"".join(found), "<i4").tolist()


def test_full_chunks_of_rare_characters(pieces):
    rare = max(pieces.pieces, key=lambda p: (len(p) == 1 and p != MARK and ord(p) > 0x3000, -pieces.pieces[p][1]))
    assert len(rare) == 1
    r = random.Random(5)
    text = "".join(r.choice([rare, "\U00020000", "the"]) for _ in range(3 * piece_scan.CHUNK // 2))
    assert by_chunks(pieces, text, piece_scan.CHUNK) == pieces.trace(MARK + text, 0, len(text) + 1, len(text) + 1, 0)


def test_runs_of_blanks_are_scored_as_by_the_library(pieces, texts):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = max(p.score, piece_scan.FLOOR)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    r = random.Random(7)
    some = [" " * n for n in range(1, 40)] + ["a" + " " * n + "b" for n in range(40)]
    for text in texts[:30]:
        some.append("".join(w + " " * r.choice([1, 1, 2, 4, 9, 17, 33]) for w in text.split(" ")[:30] if w.isascii()))
    for text in some:
        found, theirs = ids(pieces, text), library.encode(text)
        assert pieces.scores[found].sum() == pieces.scores[theirs].sum()
    assert ids(pieces, "a" + " " * 16 + "b") != ids(pieces, "a b") and len(ids(pieces, " " * 15)) == 1
    for text in [*some, "  x" * 9 + " " * 50]:
        for chunk in (1, 2, 3, 7, 16, 64):
            assert by_chunks(pieces, text, chunk) == ids(pieces, text)
        assert pieces.decode(pa.array(ids(pieces, text), pa.int32())) == text


def test_words_solved_together_get_the_ids_of_each(pieces, texts, monkeypatch):
    # beginnings shared with the sorted neighbour are solved once; ids are those of the lattice
    monkeypatch.setattr(piece_scan, "_TOGETHER", 500)
    r = random.Random(11)
    some = [t[:700] for t in texts[:80]] + ["", " ", "a  b ", MARK, "the, then; they", "x" * 5000, "漢字 \x00 漢 漢漢"]
    some += ["".join(r.choice("thean,.$é漢 \x00\U0001f600") for _ in range(r.randrange(60))) for _ in range(300)]
    pieces._words.clear()
    found = [np.frombuffer(b, "<i4").tolist() for b in pieces.encode_all(some)]
    for text, got in zip(some, found, strict=True):
        words = piece_scan._with_marks(text.replace(MARK, " ").split(" ")) if text else []
        units = [MARK + w for w in words]
        assert got == [i for u in units for i in pieces.trace(u, 0, len(u), len(u), 0)]
    steps = []
    pieces.tails, tails = _Counted(pieces.tails, steps), pieces.tails
    list(pieces._solve(["sharing"]))
    once = len(steps)
    list(pieces._solve(["sharing", "sharings"]))
    pieces.tails = tails
    assert once == len("sharing") + 1 and len(steps) == 2 * once + 1


class _Counted(dict):
    """Counts how many places are solved: each looks at the first level once."""

    def __init__(self, of, steps):
        super().__init__(of)
        self.steps = steps

    def get(self, key, default=None):
        self.steps.append(key)
        return super().get(key, default)
