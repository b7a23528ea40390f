"""Repeated passages by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed if it lies in a string of ``length`` bytes that also starts in a document
with a smaller id.  Sorting every suffix would move ``length`` bytes per byte of text, so
only suffixes that can matter are sorted, and only those that can be equal are exchanged:

1. *Anchors.*  Of each ``length``-byte window the ``GRAM``-byte string with the smallest hash is
   the anchor.  Equal windows have equal anchors in equal places, and neighbouring windows mostly
   share one, so a text has an anchor every dozen bytes.  Blocks of documents exchange their
   sorted anchor hashes; anchors that two documents have are candidates.  What documents of
   one block share stays with the block.
2. *Suffixes.*  The suffix at a candidate anchor, as far as its windows reach, followed by what
   its windows hold in front of the anchor, is its key.  A block sorts its keys, keeps each
   once with the smallest id that has it, and sends the run front-coded: the common prefix with
   the key before, then the rest.  A loser tree that carries common prefix lengths merges the
   runs, so that known prefixes are never compared again.  Keys that share an anchor come out
   together; the windows in them are compared in full and get the smallest id that has them.
3. *Removal.*  Answers become byte ranges and go back to the run that sent the keys, packed: one
   row per run and bucket, as on the way there, however many documents share something.  A
   run's ranges are put together per document.

A block answers by itself for every document but the smallest one that has a key, so of a
passage in a third of all documents each block sends one copy.  An anchor is the least of some
hashes, so small hashes are common; the buckets of step 1 follow that, and those of step 2 are as
many as the keys need: a task holds about as much of a small input as of a large one.  Anchors in more than ``HOT``
documents are sent window by window and dealt by the window's hash instead of the anchor's, so
no task meets all texts around a frequent passage.  Nothing is dropped in either case.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; rows with the
same id do not remove each other's bytes, and a null id is larger than any other.  Very long
documents are cut into overlapping pieces for step 1.  An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest as digest

from clinsift.llm.staging import staged, width

LENGTH = 50
GRAM = 24
HOT = 20_000  # documents with an anchor, some MB of keys; above, it is dealt by windows
_BLOCK = 1 << 21  # bytes of text in a block; its hashes and places take some 50 MB
_SLICE = 1 << 17  # windows hashed at a time
_KEYS = 1 << 24  # bytes of keys in a run
_BUCKET_KEYS = 1 << 18  # keys that meet in a bucket on average, at most; each takes some 150 bytes there
_POS = np.uint64(25)  # bits of a position in a block
_DROP = np.uint64(16)  # bits of a hash not exchanged: 48 tell anchors apart well enough, as
# anchors that only share a hash are compared in full later
_LAST = (1 << 63) - 1
_OCC = np.dtype([("u", "<u4"), ("p", "<u4"), ("n", "u1"), ("o", "u1")])
_CAND = np.dtype([("p", "<u4"), ("n", "u1"), ("o", "u1"), ("hot", "u1")])
_DOC = np.dtype([("id", "<i8"), ("key", "<i8")])
_RANGE = np.dtype([("p", "<u4"), ("n", "<u4")])
_SENT = np.dtype([("id", "<i8"), ("key", "<i8"), ("p", "<u4"), ("n", "u1"), ("s", "<u4")])
_GONE = np.dtype([("id", "<i8"), ("key", "<i8"), ("p", "<u4"), ("n", "<u4")])
_compress = zstandard.ZstdCompressor(level=1).compress
_decompress = zstandard.ZstdDecompressor().decompress


def _pack(array: np.ndarray) -> bytes:
    """Bytes of like weight next to each other, compressed."""
    planes = array.view(np.uint8).reshape(len(array), array.dtype.itemsize).T
    return _compress(planes.tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(_decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)


# anchors ------------------------------------------------------------------------------------


def _gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on."""
    with np.errstate(over="ignore"):
        factor = np.uint64(0x100000001B3)
        part = text.astype(np.uint64) + np.uint64(1)  # hashes of 1, 2, 4, ... bytes
        hashed, done, size = None, 0, 1
        while True:
            if gram & size:  # the bytes from ``done`` on come in front of those before
                if hashed is None:
                    hashed = part
                else:
                    n = len(text) - done - size + 1
                    hashed = part[:n] * whole + hashed[size : size + n]
                whole = factor if not done else whole * factor
                done += size
            if done == gram:
                break
            part = part[:-size] * factor + part[size:]
            factor *= factor
            size *= 2
        hashed ^= hashed >> np.uint64(31)
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return hashed


def anchors(units: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Hash, unit, first window, number of windows and place in the first window of all anchors."""
    sizes = np.array([max(0, len(u) - length + 1) for u in units])
    if not sizes.sum():
        return tuple(np.empty(0, t) for t in (np.uint64, int, int, int, int))
    text = np.frombuffer(b"".join(units), np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(u) for u in units])[:-1]))
    hashes = np.empty(len(text) - gram + 1, np.uint64)
    at = np.empty(len(text) - length + 1, np.int32)
    for s in range(0, len(at), _SLICE):
        e = min(s + _SLICE, len(at))
        hashed = _gram_hashes(text[s : e + length - 1], gram)
        hashes[s : s + len(hashed)] = hashed
        low = (hashed >> _POS << _POS) | np.arange(s, s + len(hashed), dtype=np.uint64)
        window, have = length - gram + 1, 1
        while have < window:  # the least of the grams in each window
            step = min(have, window - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        at[s:e] = low & np.uint64((1 << int(_POS)) - 1)
    unit = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
    first = np.concatenate([np.arange(b, b + s, dtype=np.int32) for b, s in zip(begins, sizes, strict=True)])
    at = at[first]
    cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (unit[1:] != unit[:-1]))))
    number = np.diff(np.append(cut, len(at)))
    at, first, unit = (x[cut].astype(np.int64) for x in (at, first, unit))
    return hashes[at], unit, first - begins[unit], number, at - first


def _edges(buckets: int, window: int) -> np.ndarray:
    """Hashes that part the anchors of windows of ``window`` grams into buckets of like size.

    A gram is an anchor if its hash is the least of some window, so anchors crowd at small
    hashes: by equal ranges of hashes the first of many buckets would get ``(window + 1) / 2``
    times its share.
    """

    def below(u: np.ndarray) -> np.ndarray:  # share of the anchors of random hashes
        q = 1 - u
        return ((window + 1) * (1 - q**window) - (window - 1) * (1 - q ** (window + 1))) / 2

    wanted = np.arange(1, buckets) / buckets
    low, high = np.zeros(buckets - 1), np.ones(buckets - 1)
    for _ in range(60):
        mid = (low + high) / 2
        less = below(mid) < wanted
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    return np.maximum.accumulate(high * 2.0 ** (64 - int(_DROP))).astype(np.uint64)


def _anchor_runs(length: int, gram: int, buckets: int, block: int):
    edges = _edges(buckets, length - gram + 1)

    def flush(run: int, held: list[tuple[int, int, int, bytes]]) -> Iterator[dict]:
        h, unit, p, n, o = anchors([x[3] for x in held], length, gram)
        if not len(h):
            return
        # pieces of a document are next to each other: number the documents of the block
        docs = np.array([x[:2] for x in held], np.int64)
        new_doc = np.concatenate(([True], (docs[1:] != docs[:-1]).any(axis=1)))
        number = np.cumsum(new_doc) - 1
        table = np.zeros(int(new_doc.sum()), _DOC)
        table["id"], table["key"] = docs[new_doc].T
        yield {"part": run % buckets, "run": run, "kind": 2, "occ": _pack(table)}
        order = np.argsort(h, kind="stable")
        h, unit = h[order] >> _DROP, unit[order]
        occ = np.zeros(len(h), _OCC)
        occ["u"] = number[unit]
        occ["p"] = p[order] + np.array([x[2] for x in held])[unit]
        occ["n"], occ["o"] = n[order], o[order]
        first = _starts(h)
        count = np.diff(np.append(first, len(h)))
        ids = table["id"][occ["u"]]
        several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
        # documents with a hash; their occurrences follow each other, as the sort is stable
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (occ["u"][1:] != occ["u"][:-1])))
        owners = np.where(several, np.add.reduceat(fresh.astype(np.int64), first), 1)
        heads = h[first]
        here = np.repeat(several, count)
        # what two documents of the block share is settled but for "many": it stays with the block
        if here.any():
            yield {
                "part": run % buckets, "run": run, "kind": 1,
                "hashes": _pack(h[here]), "occ": _pack(occ[here]),
            }
        bounds = np.concatenate(([0], np.searchsorted(heads, edges), [len(heads)]))
        for b in np.flatnonzero(np.diff(bounds)):
            some = slice(bounds[b], bounds[b + 1])
            lo, hi = first[some][0], first[some][-1] + count[some][-1]
            yield {
                "part": int(b),
                "run": run,
                "kind": 0,
                "hashes": _pack(np.diff(heads[some], prepend=np.uint64(0))),
                "docs": _pack(owners[some].astype("<u4")),
                "counts": _pack(np.where(several, 0, count)[some].astype("<u4")),
                "occ": _pack(occ[lo:hi][~here[lo:hi]]),
            }

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 32
        held: list[tuple[int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for doc, key, text in zip(*batch.columns, strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for at in range(0, max(1, len(raw) - length + 1), block):
                    piece = raw[at : at + block + length - 1]
                    held.append((doc.as_py(), key.as_py(), at, piece))
                    size += len(piece)
                    if size >= block:
                        yield from _batches(flush(run, held), _RUN)
                        run, held, size = run + 1, [], 0
        if held:
            yield from _batches(flush(run, held), _RUN)

    return run_all


_RUN = pa.schema(
    [
        ("part", pa.int32()), ("run", pa.int64()), ("kind", pa.int32()),
        *((c, pa.binary()) for c in ("hashes", "docs", "counts", "occ")),
    ]
)
_KEY_RUN = pa.schema(
    [
        ("bucket", pa.int32()), ("run", pa.int64()),
        *((c, pa.binary()) for c in ("keys", "ids", "sent", "gone")),
    ]
)


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _shared(hot: int, group: pd.DataFrame) -> pd.DataFrame:
    """Of each run, the anchors of a bucket that other runs have, and hashes in many documents.

    What a run keeps to itself (kinds 1 and 2) is passed on.
    """
    passed = group[group["kind"] > 0]
    out = [passed[["run", "kind", "hashes", "occ"]]]
    group = group[group["kind"] == 0]
    if len(group):
        hashes = [np.cumsum(_unpack(x, "<u8"), dtype=np.uint64) for x in group["hashes"]]
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        whole = np.concatenate(hashes)
        hashes = np.split(whole, ends)  # views: the parts are not held twice
        order = np.argsort(whole, kind="stable")
        first = _starts(whole[order])
        docs = np.concatenate([_unpack(x, "<u4") for x in group["docs"]])
        total = np.add.reduceat(docs[order], first, dtype=np.int64)
        kinds = (total > 1).astype(np.uint8) + (total > hot)
        state = np.zeros(len(whole), np.uint8)
        state[order] = np.repeat(kinds, np.diff(np.append(first, len(whole))))
        del docs, total, order, first
        rows = []
        states = np.split(state, ends)
        for run, h, counts, occ, st in zip(
            group["run"], hashes, group["counts"], group["occ"], states, strict=True
        ):
            counts, occ = _unpack(counts, "<u4"), _unpack(occ, _OCC)
            for kind, wanted in ((3, st == 1), (4, st == 2)):
                some = np.repeat(wanted, counts)
                if some.any():
                    rows.append((run, kind, None, _pack(occ[some])))
            if (many := h[st == 2]).size:
                rows.append((run, 5, _pack(many), None))
        out.append(pd.DataFrame(rows, columns=["run", "kind", "hashes", "occ"]))
    return pd.concat(out)


def _candidates(group: pd.DataFrame) -> pd.DataFrame:
    """The candidate anchors of each document of a run."""
    of_kind = lambda k: group[group["kind"] == k]
    many = [_unpack(x, "<u8") for x in of_kind(5)["hashes"]]
    many = np.concatenate(many) if many else np.empty(0, np.uint64)
    found = [(_unpack(x, _OCC), np.uint8(0)) for x in of_kind(3)["occ"]]
    found += [(_unpack(x, _OCC), np.uint8(1)) for x in of_kind(4)["occ"]]
    for hashes, occ in zip(of_kind(1)["hashes"], of_kind(1)["occ"], strict=True):
        found.append((_unpack(occ, _OCC), np.isin(_unpack(hashes, "<u8"), many)))
    out: dict[str, list] = {"id": [], "key": [], "cand": [], "keys": []}
    if found:
        table = np.concatenate([_unpack(x, _DOC) for x in of_kind(2)["occ"]])
        occ = np.concatenate([o for o, _ in found])
        cand = np.zeros(len(occ), _CAND)
        for c in ("p", "n", "o"):
            cand[c] = occ[c]
        cand["hot"] = np.concatenate([np.broadcast_to(x, len(o)) for o, x in found])
        order = np.argsort(occ["u"], kind="stable")
        first = _starts(occ["u"][order])
        for s, e in zip(first, np.append(first[1:], len(order)), strict=True):
            doc = table[occ["u"][order[s]]]
            out["id"].append(int(doc["id"]))
            out["key"].append(int(doc["key"]))
            out["cand"].append(cand[order[s:e]].tobytes())
        keys = np.where(cand["hot"], cand["n"], 1)[order]  # as many as will be sent
        out["keys"] = np.add.reduceat(keys, first, dtype=np.int64).tolist()
    return pd.DataFrame(out)


# suffix runs --------------------------------------------------------------------------------


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two keys that agree up to ``known``."""
    n, i = min(len(a), len(b)), known
    while i + 8 <= n and a[i : i + 8] == b[i : i + 8]:
        i += 8
    while i < n and a[i] == b[i]:
        i += 1
    return i


def front_code(keys: list[bytes]) -> bytes:
    """Sorted keys, each as its common prefix with the one before and the rest."""
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    wide = max(1, int(sizes.max(initial=0)))
    table = np.array(keys, f"S{wide}").view(np.uint8).reshape(len(keys), wide)
    differ = table[1:] != table[:-1]
    prefixes = np.zeros(len(keys), np.int64)
    prefixes[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
    prefixes[1:] = np.minimum(prefixes[1:], np.minimum(sizes[1:], sizes[:-1]))  # zeros only pad
    rests = [key[shared:] for key, shared in zip(keys, prefixes.tolist(), strict=True)]
    head = np.array([len(keys)], "<u4").tobytes()
    lengths = np.array([prefixes, sizes - prefixes], "<u2").tobytes()
    return _compress(head + lengths + b"".join(rests))


def front_decode(data: bytes) -> tuple[list[bytes], list[int]]:
    """The keys and their common prefixes."""
    raw = _decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    prefixes, lengths = np.frombuffer(raw, "<u2", 2 * n, 4).reshape(2, -1).tolist()
    keys, before, at = [], b"", 4 + 4 * n
    for shared, more in zip(prefixes, lengths, strict=True):
        before = before[:shared] + raw[at : at + more]
        keys.append(before)
        at += more
    return keys, prefixes


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[bytes, int, int, int]]:
    """Key, common prefix with the key before, run and place, in order, by a loser tree.

    Each head carries its common prefix with the last key put out.  Of two heads, the one with
    the longer such prefix is smaller; only with equal ones are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    place = [0] * size
    prefix = [0] * size
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))

    def beats(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one with the winner."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = prefix[a], prefix[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        shared = common(x, y, p)
        if x[shared:] <= y[shared:]:
            prefix[b] = shared
            return a, b
        prefix[a] = shared
        return b, a

    losers = [0] * size
    level = list(range(size))
    at = size
    while len(level) > 1:
        up = []
        at //= 2
        for i in range(0, len(level), 2):
            winner, loser = beats(level[i], level[i + 1])
            losers[at + i // 2] = loser
            up.append(winner)
        level = up
    winner = level[0]
    while head[winner] is not None:
        keys, shared = runs[winner]
        yield head[winner], prefix[winner], winner, place[winner]
        place[winner] += 1
        if place[winner] < len(keys):
            head[winner], prefix[winner] = keys[place[winner]], shared[place[winner]]
        else:
            head[winner] = None
        node = (winner + size) // 2
        while node:
            winner, losers[node] = beats(winner, losers[node])
            node //= 2


def _key_runs(length: int, gram: int, buckets: int, run_bytes: int):
    """Runs of keys with the smallest id that has each, and ranges settled in the block."""

    def flush(run: int, keys: list[bytes], where: tuple[array, ...]) -> Iterator[dict]:
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        keys = [keys[i] for i in order]
        own = np.zeros(len(keys), _GONE)
        for name, values in zip(_GONE.names, where, strict=True):
            own[name] = np.array(values)[order]
        first = np.flatnonzero([True, *(a != b for a, b in pairwise(keys))])
        low = np.minimum.reduceat(own["id"], first)
        ends = np.append(first[1:], len(keys))
        number = np.repeat(np.arange(len(first)), ends - first)
        settled = own["id"] > low[number]
        bucket = np.array([int.from_bytes(keys[i][:4], "big") for i in first])
        cuts = _starts(bucket)
        for s, e in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
            some = np.flatnonzero(~settled[first[s] : ends[e - 1]]) + first[s]
            sent = np.zeros(len(some), _SENT)
            for name in _GONE.names:
                sent[name] = own[name][some]
            sent["s"] = number[some] - s
            yield {
                "bucket": int(bucket[s]), "run": run, "keys": front_code([keys[i][4:] for i in first[s:e]]),
                "ids": _pack(low[s:e]), "sent": _pack(sent),
            }
        if settled.any():
            yield {"bucket": run % buckets, "run": run, "gone": _pack(own[settled])}

    def unheld() -> tuple[list[bytes], tuple[array, ...]]:
        return [], (array("q"), array("q"), array("I"), array("B"))

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 32
        keys, where = unheld()  # with the bucket in front; id, text, first window and windows of each
        size = 0
        for batch in batches:
            for doc, text_key, text, lists in zip(*(c for c in batch.columns), strict=True):
                doc, text_key = doc.as_py(), text_key.as_py()
                raw = text.as_py().encode("utf-8", "surrogatepass")
                cand = np.unique(np.frombuffer(b"".join(lists.as_py()), _CAND))
                for p, n, o, hot in cand.tolist():
                    part = digest(raw[p + o : p + o + gram]) % buckets
                    for q, m, back in ((p + i, 1, o - i) for i in range(n)) if hot else ((p, n, o),):
                        if hot:
                            part = digest(raw[q : q + length]) % buckets
                        a = q + back
                        key = raw[a : q + m - 1 + length] + raw[q:a] + bytes((back, m))
                        keys.append(part.to_bytes(4, "big") + key)
                        where[2].append(q)
                        where[3].append(m)
                        size += len(key)
                for values, value in zip(where, (doc, text_key), strict=False):
                    values.extend([value] * (len(keys) - len(values)))
                if size >= run_bytes:
                    yield from _batches(flush(run, keys, where), _KEY_RUN)
                    run, (keys, where), size = run + 1, unheld(), 0
        if keys:
            yield from _batches(flush(run, keys, where), _KEY_RUN)

    return run_all


def _windows(key: bytes, length: int) -> list[bytes]:
    back, n = key[-2], key[-1]
    body = key[:-2]
    text = body[len(body) - back :] + body[: len(body) - back]
    return [text[i : i + length] for i in range(n)]


def _answers(length: int, gram: int):
    """Of a bucket's runs, the windows that a smaller id has, as ranges of the senders."""

    def settle(group: list[tuple[bytes, int, int]], ids: list[array], masks: list[np.ndarray]) -> None:
        """``group``: key, run, place of all keys with one anchor; equal keys are neighbours."""
        if all(key == group[0][0] for key, _, _ in group):
            low = min(ids[r][i] for _, r, i in group)
            full = (1 << group[0][0][-1]) - 1
            for _, r, i in group:
                masks[r][i] = full if low < ids[r][i] else 0
            return
        owner: dict[bytes, int] = {}
        split: dict[bytes, list[bytes]] = {}
        for key, r, i in group:
            windows = split.get(key) or split.setdefault(key, _windows(key, length))
            for w in windows:
                if ids[r][i] < owner.get(w, _LAST + 1):
                    owner[w] = ids[r][i]
        for key, r, i in group:
            mask = 0
            for k, w in enumerate(split[key]):
                if owner[w] < ids[r][i]:
                    mask |= 1 << k
            masks[r][i] = mask

    def run(group: pd.DataFrame) -> pd.DataFrame:
        settled = group[group["keys"].isna()][["run", "gone"]]
        group = group[group["keys"].notna()]
        if not len(group):
            return settled
        runs = [front_decode(k) for k in group["keys"]]
        ids = [array("q", _unpack(x, "<i8").tobytes()) for x in group["ids"]]
        masks = [np.zeros(len(x), "<u8") for x in ids]
        held: list[tuple[bytes, int, int]] = []
        for key, shared, r, i in merge(runs):
            if held and shared < gram:
                settle(held, ids, masks)
                held = []
            held.append((key, r, i))
        if held:
            settle(held, ids, masks)
        told = []
        for number, sent, mask in zip(group["run"], group["sent"], masks, strict=True):
            gone = _ranges(sent, mask)
            if len(gone):
                told.append((number, _pack(gone)))
        return pd.concat([settled, pd.DataFrame(told, columns=["run", "gone"])])

    return run


def _ranges(sent: bytes, mask: np.ndarray) -> np.ndarray:
    """The masks of a run's keys as byte ranges of the documents that have them."""
    places = _unpack(sent, _SENT)
    mask = mask[places["s"]]
    places, mask = places[mask > 0], mask[mask > 0]
    count = places["n"].astype(np.uint64)
    full = mask == (np.uint64(1) << count) - np.uint64(1)
    parts = [(places[full], places["p"][full], places["n"][full])]
    some, bits = places[~full], mask[~full]
    for i in range(int(some["n"].max(initial=0))):  # windows one by one
        hit = bits >> np.uint64(i) & np.uint64(1) > 0
        parts.append((some[hit], some["p"][hit] + np.uint32(i), np.uint32(1)))
    out = []
    for of, p, n in parts:
        gone = np.zeros(len(of), _GONE)
        gone["id"], gone["key"], gone["p"], gone["n"] = of["id"], of["key"], p, n
        out.append(gone)
    return np.concatenate(out)


def _by_document(group: pd.DataFrame) -> pd.DataFrame:
    """All ranges of a run's documents, one row per document."""
    gone = np.concatenate([_unpack(x, _GONE) for x in group["gone"]])
    gone = gone[np.lexsort((gone["key"], gone["id"]))]
    first = np.flatnonzero(
        np.concatenate(([True], (gone["id"][1:] != gone["id"][:-1]) | (gone["key"][1:] != gone["key"][:-1])))
    )
    ranges = np.zeros(len(gone), _RANGE)
    ranges["p"], ranges["n"] = gone["p"], gone["n"]
    ends = np.append(first[1:], len(gone))
    return pd.DataFrame(
        {
            "id": gone["id"][first], "key": gone["key"][first],
            "ranges": [ranges[s:e].tobytes() for s, e in zip(first, ends, strict=True)],
        }
    )


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, lists in zip(*batch.columns, strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                ranges = np.frombuffer(b"".join(lists.as_py() or ()), _RANGE)
                gone = np.zeros(len(raw) + 1, np.int32)
                start = ranges["p"].astype(np.int64)
                np.add.at(gone, start, 1)
                np.add.at(gone, start + ranges["n"] + (length - 1), -1)
                covered = np.cumsum(gone[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
                edges = np.diff(covered.astype(np.int8), prepend=0)
                out.append((doc.as_py(), len(raw), len(raw) - len(kept), int((edges == 1).sum()), kept))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot: int = HOT,
    block: int = _BLOCK,
    run_bytes: int = _KEYS,
    bucket_keys: int = _BUCKET_KEYS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row."""
    if not 0 < gram <= length or length - gram > 60 or length > 200:
        raise ValueError("a window is up to 200 bytes and at most 60 bytes longer than a gram")
    buckets = width(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    runs = rows.select("id", "key", "text").mapInArrow(
        _anchor_runs(length, gram, buckets, block),
        "part int, run long, kind int, hashes binary, docs binary, counts binary, occ binary",
    )
    shared = runs.groupBy("part").applyInPandas(
        lambda group: _shared(hot, group), "run long, kind int, hashes binary, occ binary"
    )
    candidates = shared.groupBy("run").applyInPandas(
        _candidates, "id long, key long, cand binary, keys long"
    )
    # rows that repeat a document may lie in several runs
    by_doc = staged(
        candidates.groupBy("id", "key").agg(F.collect_list("cand").alias("cand"), F.sum("keys").alias("keys")),
        "candidates",
        clean=True,
    )
    buckets = max(buckets, (by_doc.agg(F.sum("keys")).first()[0] or 0) // bucket_keys)
    found = (
        rows.join(by_doc, ["id", "key"])
        .select("id", "key", "text", "cand")
        .mapInArrow(
            _key_runs(length, gram, buckets, run_bytes),
            "bucket int, run long, keys binary, ids binary, sent binary, gone binary",
        )
        .groupBy("bucket")
        .applyInPandas(_answers(length, gram), "run long, gone binary")
        .groupBy("run")
        .applyInPandas(_by_document, "id long, key long, ranges binary")
    )
    ranges = staged(
        found.groupBy("id", "key").agg(F.collect_list("ranges").alias("ranges")),
        "ranges",
        clean=True,
    )
    return (
        rows.join(ranges, ["id", "key"], "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
