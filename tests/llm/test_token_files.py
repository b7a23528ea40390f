import io
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet
import pytest
import zstandard
from tokenizers import Tokenizer

from clinsift.llm.token_files import (
    FrameWriter,
    WordTable,
    documents_of,
    read_frame,
    read_tail,
    read_token_files,
    write_token_files,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "A b", "a\x1cb", "É <|endoftext|>x <|startoftext|>y", "ΑΣ Σ's thing,thing", "e ́x", "\x85a b 'S 's' ll'll",
         "  two  blanks ", "\n\n a\r\nb", "日本 語", "Straße É!! a*** | $$$ été.", "word " * 30_000, "unbroken" * 4000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_words_give_what_whole_texts_give(library):
    docs = pa.parquet.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    texts = [t or "" for t in TEXTS] + docs
    table = WordTable(VOCABULARY, 2)
    for text, ids in zip(texts, table.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def _file(docs, frame_bytes):
    sink = io.BytesIO()
    writer = FrameWriter(sink, frame_bytes)
    for d, ids in docs:
        writer.add(d, np.array(ids, "<u4").tobytes())
    writer.close()
    return sink.getvalue()


class Counting(pa.BufferReader):
    """Remembers what was read."""

    def read_at(self, n, at):
        self.__dict__.setdefault("reads", []).append((at, n))
        return super().read_at(n, at)


def test_random_access_reads_only_the_frames_it_needs():
    docs = [(i, [i] * (50 + i % 7)) for i in range(200)] + [(200, []), (201, list(range(9000)))]
    raw = _file(docs, 1000)
    source = pa.BufferReader(raw)
    tail = read_tail(source)
    assert len(tail.frames) > 20 and tail.doc_ids.tolist() == [d for d, _ in docs]
    assert [(d, np.frombuffer(x, "<u4").tolist()) for d, x in documents_of(pa.BufferReader(raw))] == docs
    read = Counting(raw)
    assert [d for d, _ in documents_of(read, {7, 150, 201})] == [7, 150, 201]
    data = [n for at, n in read.reads if at < tail.frames[-1][0] + tail.frames[-1][1]]
    assert len(data) == 3
    # any zstandard reader can read the whole file
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(np.array(i, "<u4").tobytes() for _, i in docs)


def test_damage_is_found():
    raw = bytearray(_file([(1, list(range(500)))], 1000))
    frame = read_tail(pa.BufferReader(bytes(raw))).frames[0]
    raw[frame[1] // 2] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        read_frame(pa.BufferReader(bytes(raw)), frame)
    with pytest.raises(ValueError, match="seekable"):
        read_tail(pa.BufferReader(b"x" * 40))
    assert list(documents_of(pa.BufferReader(_file([], 10)))) == []


def test_write_and_read_back(spark, tmp_path, library):
    rows = [(100 - i, t, 0) for i, t in enumerate(TEXTS)] + [(5, "same", 0), (5, "same", 0), (5, "rest", 0), (None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    files = write_token_files(df, f"file://{tmp_path}/ids", VOCABULARY, 2, frame_bytes=500)
    got = sorted(read_token_files(files).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for d, t, _ in ordered:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    assert all(not n.startswith(".") for n in os.listdir(f"{tmp_path}/ids"))
    empty = write_token_files(df.limit(0), f"file://{tmp_path}/none", VOCABULARY, 2)
    assert read_token_files(empty).count() == 0
