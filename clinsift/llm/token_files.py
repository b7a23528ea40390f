"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, each holding the ids (little-endian unsigned
32-bit) of whole documents, then a skippable frame with the document index (ids and lengths),
then the seek table of the public seekable format: a skippable frame with compressed size,
decompressed size and checksum (low half of XXH64) of each frame.  A reader opens the tail,
finds the frames of the documents it wants and decompresses only those.

Documents are range-partitioned and sorted by id, so files hold rising ids and the name's number
gives the order of the files.  A task writes under a name of its own and renames when it is
done, so a lost executor leaves no half file.  Files go to a folder that all executors
share and that pyarrow can open (file, hdfs, s3, gs).

The ids come from the tokenizers library.  Its pre-tokenizer never lets a token cross a
blank, so words (cut at blanks and line feeds) are encoded once and looked up after that; the
table of words is bounded and emptied when full.

Defined cases: a null text is empty and has only the end id; a null id sorts first and is
written as the smallest 64-bit number; repeated rows are all written, rows with the same id in
order of their text.  A frame grows with one very long document, never with many.  An
empty table writes no documents.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinsift.llm.staging import new_folder, staged, width

FRAME_BYTES = 1 << 18
_SKIPPABLE_INDEX, _SKIPPABLE_TABLE, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_WORDS = 600_000  # words remembered by one worker, some 200 MB
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([.,;:!?|$%&*#]*)")
# how the byte-level alphabet shows the bytes that have no printable character
_BYTE_NAMES = {
    b: 256 + n
    for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))
}
_NULL_ID = -(1 << 63)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTable:
    """Ids of texts by way of a bounded table of words.

    A new word of plain letters, with marks behind it or without, is two pre-tokens at most
    and goes to the library's model directly; any other new word goes through the library's
    whole encoder, many at a time, and a token belongs to the word its offset lies in.
    """

    def __init__(self, path: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._ids: dict[str, bytes] = {}
        self._letters: dict[str, bytes] = {}
        self._end = struct.pack("<I", end)
        # the direct way is taken only with a vocabulary for which it is the same
        probe = ["Thing,", "été.", "Straße", "ÉOIN!!", "a***", "|"]
        self._direct = all(
            self._plain(_PLAIN.fullmatch(w)) == _packed(self._tokenizer.encode(w, add_special_tokens=False).ids)
            for w in probe
        )

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text and the end id, as little-endian 32-bit numbers."""
        texts = [t.replace("\n", " ").split(" ") for t in texts]
        known = self._ids
        if len(known) > _WORDS:
            known.clear()
            self._letters.clear()
        other = []
        for word in set().union(*texts).difference(known):
            match = _PLAIN.fullmatch(word) if self._direct else None
            if match:
                known[word] = self._plain(match)
            else:
                other.append(word)
        for at in range(0, len(other), 4000):
            self._learn(other[at : at + 4000])
        for words in texts:
            yield b"".join(map(known.__getitem__, words)) + self._end

    def _plain(self, match: re.Match) -> bytes:
        letters, marks = match.groups()
        return (self._pretoken(letters.lower()) if letters else b"") + (self._pretoken(marks) if marks else b"")

    def _pretoken(self, text: str) -> bytes:
        ids = self._letters.get(text)
        if ids is None:
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(_BYTE_NAMES)
            ids = self._letters[text] = _packed([t.id for t in self._model.tokenize(shown)])
        return ids

    def _learn(self, words: list[str]) -> None:
        found = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        begins = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.offsets))
        cuts = np.searchsorted(begins, ends).tolist()
        ids = np.array(found.ids, "<u4").tobytes()
        last = 0
        for word, cut in zip(words, cuts, strict=True):
            self._ids[word] = ids[4 * last : 4 * cut]
            last = cut


@lru_cache(2)
def _table(path: str, end: int) -> WordTable:
    return WordTable(path, end)


class FrameWriter:
    """Writes one file; ``add`` documents in order, then ``close``."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES) -> None:
        self._sink, self._limit = sink, frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=3)
        self._held: list[bytes] = []
        self._size = 0
        self._frames: list[tuple[int, int, int]] = []
        self._docs: list[int] = []
        self._lengths: list[int] = []

    def add(self, doc_id: int, ids: bytes) -> None:
        self._held.append(ids)
        self._size += len(ids)
        self._docs.append(doc_id)
        self._lengths.append(len(ids) // 4)
        if self._size >= self._limit:
            self._flush()

    def _flush(self) -> None:
        if self._held:
            raw = b"".join(self._held)
            packed = self._zstd.compress(raw)
            self._sink.write(packed)
            self._frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self._held, self._size = [], 0

    def close(self) -> None:
        self._flush()
        index = np.array([self._docs, self._lengths], "<i8").tobytes()
        packed = self._zstd.compress(index)
        self._sink.write(struct.pack("<II", _SKIPPABLE_INDEX, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *f) for f in self._frames)
        footer = struct.pack("<IBI", len(self._frames), 0x80, _SEEKABLE)
        self._sink.write(struct.pack("<II", _SKIPPABLE_TABLE, len(table) + len(footer)) + table + footer)

    @property
    def totals(self) -> tuple[int, int]:
        return len(self._docs), sum(self._lengths)


@dataclass(frozen=True)
class Tail:
    """Frames (offset, packed size, raw size, checksum) and documents (id, length) of a file."""

    frames: list[tuple[int, int, int, int]]
    doc_ids: np.ndarray
    lengths: np.ndarray


def read_tail(source) -> Tail:
    """Document index and seek table; no data frame is read."""
    size = source.size()
    count, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != _SEEKABLE or not flags & 0x80:
        raise ValueError("not a seekable file with checksums")
    table_at = size - 9 - 12 * count
    entries = np.frombuffer(source.read_at(12 * count, table_at), "<u4").reshape(-1, 3)
    offsets = np.concatenate(([0], np.cumsum(entries[:, 0], dtype=np.int64)))
    kind, length = struct.unpack("<II", source.read_at(8, int(offsets[-1])))
    if kind != _SKIPPABLE_INDEX:
        raise ValueError("no document index where the frames end")
    index = zstandard.ZstdDecompressor().decompress(source.read_at(length, int(offsets[-1]) + 8))
    ids, lengths = np.frombuffer(index, "<i8").reshape(2, -1)
    frames = [(int(o), *map(int, e)) for o, e in zip(offsets, entries, strict=False)]
    return Tail(frames, ids, lengths)


def read_frame(source, frame: tuple[int, int, int, int]) -> bytes:
    at, packed, raw_size, checksum = frame
    raw = zstandard.ZstdDecompressor().decompress(source.read_at(packed, at), max_output_size=raw_size)
    if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
        raise ValueError(f"the frame at {at} is damaged")
    return raw


def documents_of(source, wanted: set[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """Ids of all documents, or of those wanted, decompressing only frames that hold them."""
    tail = read_tail(source)
    bounds = np.concatenate(([0], np.cumsum(tail.lengths * 4)))
    first = 0
    start = 0
    for frame in tail.frames:
        last = int(np.searchsorted(bounds, start + frame[2], side="left"))
        chosen = [
            d for d in range(first, last) if wanted is None or int(tail.doc_ids[d]) in wanted
        ]
        if chosen:
            raw = read_frame(source, frame)
            for d in chosen:
                yield int(tail.doc_ids[d]), raw[bounds[d] - start : bounds[d + 1] - start]
        first, start = last, start + frame[2]


def _file_name(part: int) -> str:
    return f"ids-{part:06d}.zst"


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Encode and write all documents; one row per file: ``part, path, n_docs, n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(vocabulary, end)
        context = TaskContext.get()
        part = context.partitionId()
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root)
        path = f"{root}/{_file_name(part)}"
        own = f"{root}/.{_file_name(part)}.{context.taskAttemptId()}"
        with filesystem.open_output_stream(own) as sink:
            writer = FrameWriter(sink, frame_bytes)
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    texts = (t or "" for t in some.column(1).to_pylist())
                    ids = (_NULL_ID if i is None else i for i in some.column(0).to_pylist())
                    for doc_id, encoded in zip(ids, table.encode(texts), strict=True):
                        writer.add(doc_id, encoded)
            writer.close()
        filesystem.move(own, path)
        values = (part, f"{folder}/{_file_name(part)}", *writer.totals)
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "path", "n_docs", "n_tokens"), values, strict=True))],
            schema=pa.schema({"part": pa.int32(), "path": pa.string(), "n_docs": pa.int64(), "n_tokens": pa.int64()}),
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    files = (
        rows.repartitionByRange(width(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, "part int, path string, n_docs long, n_tokens long")
    )
    return staged(files, "files")


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before; its base per file is a running sum over
    one row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                filesystem, name = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(name) as source:
                    at, rows = base, []
                    for doc_id, ids in documents_of(source):
                        n = len(ids) // 4
                        rows.append((None if doc_id == _NULL_ID else doc_id, at, n, zlib.crc32(ids)))
                        at += n
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    return (
        based.select("path", "base")
        .repartitionByRange(width(files.sparkSession), "path")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def token_folder(spark: SparkSession) -> str:
    """A new folder for files that a query writes and reads back."""
    return new_folder(spark, "token_files")
