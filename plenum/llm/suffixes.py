"""Removal of repeated byte strings, by a difference-cover sample of the suffixes.

Of every ``v`` consecutive positions only those in a difference cover are sampled. Two equal
strings of ``length`` bytes hold a shift below ``v`` at which both are sampled, so every repeat
is met at a sampled suffix that both share. The work is done blockwise:

1. Equal whole texts are one text. Texts are stored in chunks, and all positions are places in a chunk.
2. A sample whose next ``length - v + 1`` bytes have a hash that no other sample has cannot lie
   in a repeat and is left out. The hash decides nothing else.
3. The other sampled suffixes are dealt to buckets with the bytes around them, and one bucket at
   a time is sorted: to the right of the sample (suffix ranks) and to its left (ranks of the
   reversed prefixes), both with the common lengths of neighbours. A start ``d`` bytes before a
   sample is a tie of ``length`` bytes; it is resolved by the two ranks, cut at ``d`` to the left
   and ``length - d`` to the right. Bytes are compared, never hashes. Windows that are equal
   within a task are sent once.
4. A class of more than ``hot`` distinct windows does not fit into one task. Its starts are dealt
   one by one under a 128-bit digest of their ``length`` bytes, equal ones once per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import bucketed, shuffle_partitions, staged, text_of

LENGTH = 400
ORDER = 13
#: Bytes of text in a chunk, positions of a running sum at a time, samples and bytes of windows dealt at a time.
CHUNK = 1 << 20
BLOCK = 1 << 20
SAMPLES = 1 << 20
HELD = 1 << 26
#: Buckets in a partition, and distinct windows of one class that a task may hold.
FINE = 4
HOT = 100_000
#: Columns of packed rows: type and width.
LEADS = (("<u4", 1), ("<u2", 1), ("u1", 1), ("<i8", 1), ("<u4", 1))
PLACES = (("<i8", 1), ("<u4", 1))
RANGES = (("<i8", 1), ("<u4", 1), ("<u4", 1))
STARTS = (("V16", 1), ("u1", 1), ("<i8", 1), ("<u4", 1))


def difference_cover(q: int) -> np.ndarray:
    """A difference set of q + 1 residues modulo q*q + q + 1, q prime: every residue is a difference.

    The zeros of a linear recurrence of degree three over the field of q elements form one if
    the recurrence is primitive; recurrences are tried until the zeros pass the check.
    """
    v = q * q + q + 1
    for code in range(1, q**3):
        a, b, c = code % q, code // q % q, code // q**2
        x, y, z = 0, 0, 1
        zeros = []
        for k in range(v):
            if x == 0:
                zeros.append(k)
            x, y, z = y, z, (a * x + b * y + c * z) % q
        if len(zeros) == q + 1 and len({(i - j) % v for i in zeros for j in zeros}) == v:
            return np.array(zeros)
    raise ValueError("q must be prime")


# --- packing --------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _codec():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(columns: list[np.ndarray]) -> bytes:
    return _codec()[0].compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _unpack(blob: bytes, kinds) -> list[np.ndarray]:
    raw = _codec()[1].decompress(blob)
    sizes = [np.dtype(k).itemsize * w for k, w in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for (kind, width), size in zip(kinds, sizes):
        column = np.frombuffer(raw, kind, n * width, at)
        out.append(column.reshape(n, width) if width > 1 else column)
        at += n * size
    return out


def _joined(rows: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*rows)]


def _dealt(bucket: np.ndarray, columns: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    """One packed row per bucket; the order within a bucket is kept."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    packs = [_pack([c[order[i:j]] for c in columns]) for i, j in zip(cuts[:-1], cuts[1:])]
    return bucket[cuts[:-1]].tolist(), packs


def _by_chunk(chunk: np.ndarray, columns: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    """One row per chunk: its bytes of the columns, packed."""
    order = np.argsort(chunk, kind="stable")
    chunk = chunk[order]
    cuts = np.append(np.flatnonzero(np.diff(chunk, prepend=chunk[:1] - 1)), len(chunk))
    return chunk[cuts[:-1]].tolist(), [_pack([c[order[i:j]] for c in columns]) for i, j in zip(cuts[:-1], cuts[1:])]


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns.values()], list(columns))


def _lists(batch: pa.RecordBatch, column: str, k: int, kinds) -> list[np.ndarray]:
    """The packed lists of one chunk, joined."""
    x = batch.column(batch.schema.names.index(column))[k].as_py()
    return _joined([_unpack(b, kinds) for b in x]) if x else [np.empty(0, kind) for kind, _ in kinds]


# --- chunks ---------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts joined to chunks of about ``CHUNK`` bytes; a longer text is a chunk of its own."""
    task, seq = TaskContext.get().partitionId(), 0
    keys, texts, twice, size = [], [], [], 0

    def close():
        ends = np.cumsum([len(t) for t in texts]).astype("<i8").tobytes()
        return _batch({
            "chunk": ([(task << 32) | seq], pa.int64()), "data": ([b"".join(texts)], pa.binary()), "ends": ([ends], pa.binary()),
            "keys": ([b"".join(keys)], pa.binary()), "twice": ([np.array(twice, bool).tobytes()], pa.binary()),
        })

    for batch in batches:
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py()
            if texts and size + len(text) > CHUNK:
                yield close()
                keys, texts, twice, size, seq = [], [], [], 0, seq + 1
            keys.append(batch.column(0)[k].as_py())
            texts.append(text)
            twice.append(batch.column(2)[k].as_py() > 1)
            size += len(text)
    if texts:
        yield close()


def _chunk(batch: pa.RecordBatch, k: int) -> tuple[int, bytes, np.ndarray]:
    return batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), np.frombuffer(batch.column(2)[k].as_py(), "<i8")


def sampled(ends: np.ndarray, room: int, cover: np.ndarray, v: int) -> np.ndarray:
    """Positions of the cover at which ``room`` bytes are left in their text, ascending."""
    n = int(ends[-1]) if len(ends) else 0
    every = (np.arange(0, n, v)[:, None] + cover[None, :]).ravel()
    every = every[every <= n - room]
    return every[every + room <= ends[np.searchsorted(ends, every, side="right")]] if len(every) else every


# --- step 2: the filter ---------------------------------------------------------------------


def _constants() -> tuple[np.ndarray, np.uint64, np.uint64]:
    words = [int.from_bytes(hashlib.blake2b(b"name%d" % k, digest_size=8).digest(), "little") for k in range(257)]
    base = words[256] | 1
    return np.array(words[:256], np.uint64), np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


TABLE, UP, DOWN = _constants()


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate([one, np.full(size - 1, x, np.uint64)]), dtype=np.uint64) for x in (UP, DOWN))


def names(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of ``data[s : s + length]`` for ascending starts; a rolling sum, block by block."""
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, max(1, len(data) - length + 1), BLOCK):
        i, j = np.searchsorted(starts, (lo, lo + BLOCK))
        if i == j:
            continue
        part = np.frombuffer(data, np.uint8, min(BLOCK + length, len(data) - lo), lo)
        up, down = _powers(1 << max(12, len(part).bit_length()))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE[part] * down[: len(part)], dtype=np.uint64)])
        x = starts[i:j] - lo
        h = (sums[x + length] - sums[x]) * up[x]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out[i:j] = h ^ (h >> np.uint64(32))
    return out


def _sample_rows(cover: np.ndarray, v: int, room: int, buckets: int):
    """Samples under their hash, dealt to buckets; a hash that a task has twice is sent once."""

    def flush(rows) -> pa.RecordBatch:
        name, chunk, pos = _joined(rows)
        _, first, count = np.unique(name, return_index=True, return_counts=True)
        lead = np.zeros(len(name), bool)
        lead[first] = True
        own = name[first]
        columns = [(own >> np.uint64(32)).astype("<u4"), (own & np.uint64(0xFFFF)).astype("<u2"), (count > 1).astype("u1"), chunk[first], pos[first]]
        order = np.lexsort((pos[first], chunk[first]))  # places in order pack well
        bucket, packs = _dealt((own[order] % np.uint64(buckets)).astype(np.int64), [c[order] for c in columns])
        rest = _pack([chunk[~lead], pos[~lead]])
        at = int(own[0] % np.uint64(buckets))
        return _batch({"bucket": ([*bucket, at], pa.int32()), "lead": ([*packs, None], pa.binary()), "rest": ([None] * len(packs) + [rest], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                chunk, data, ends = _chunk(batch, k)
                at = sampled(ends, room, cover, v)
                if len(at):
                    rows.append([names(data, at, room), np.full(len(at), chunk, "<i8"), at.astype("<u4")])
                    held += len(at)
                if held >= SAMPLES:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(bucket, value of the second column, value of the third) of rows sorted by bucket."""
    for batch in batches:
        for bucket, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            yield bucket, a, b


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk, near``: places of samples whose hash repeats; one bucket is held at a time."""
    bucket, held, found, n = None, [], [], 0

    def settle():
        high, low, twice, chunk, pos = _joined(held)
        name = (high.astype(np.uint64) << np.uint64(16)) | low
        _, back, count = np.unique(name, return_inverse=True, return_counts=True)
        near = (count > 1)[back] | (twice > 0)
        found.append([chunk[near], pos[near]])

    def lists():
        chunk, pos = _joined(found)
        keys, packs = _by_chunk(chunk, [chunk, pos])
        return _batch({"chunk": (keys, pa.int64()), "near": (packs, pa.binary())})

    for b, lead, rest in _blocks(batches):
        if b != bucket and held:
            settle()
            held = []
        bucket = b
        if lead is not None:
            held.append(_unpack(lead, LEADS))
        if rest is not None:
            found.append(_unpack(rest, PLACES))
        n = sum(len(x[0]) for x in found)
        if n >= SAMPLES:
            yield lists()
            found = []
    if held:
        settle()
    if found and sum(len(x[0]) for x in found):
        yield lists()


# --- step 3: sorted buckets -----------------------------------------------------------------


def _windows(data: bytes, ends: np.ndarray, at: np.ndarray, v: int, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around samples (zero beyond their text), and how many of ``v - 1`` there are to the left and right."""
    side = np.zeros(v - 1, np.uint8)
    padded = np.concatenate([side, np.frombuffer(data, np.uint8), side])
    width = 2 * (v - 1) + room
    out = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    text = np.searchsorted(ends, at, side="right")
    left = np.minimum(at - np.concatenate([[0], ends])[text], v - 1)
    right = np.minimum(ends[text] - at - room, v - 1)
    for cut, side in ((left, out[:, : v - 1][:, ::-1]), (right, out[:, v - 1 + room :])):
        short = np.flatnonzero(cut < v - 1)
        block = side[short]
        block[np.arange(v - 1)[None, :] >= cut[short, None]] = 0
        side[short] = block
    return out, left, right


def _ranked(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of equally long strings, and the common length of each with the one before it in order."""
    strings = np.ascontiguousarray(strings)
    m, width = strings.shape
    order = np.argsort(strings.view(f"V{width}").ravel(), kind="stable")
    common = np.zeros(m, np.int32)
    for lo in range(1, m, 8192):  # a block of differences at a time
        hi = min(m, lo + 8192)
        differ = strings[order[lo:hi]] != strings[order[lo - 1 : hi - 1]]
        common[lo:hi] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    return rank, common


def shared_starts(windows: np.ndarray, left: np.ndarray, right: np.ndarray, twice: np.ndarray, v: int, room: int) -> np.ndarray:
    """Matrix: whether the string of ``room + v - 1`` bytes that starts d bytes before the sample is another's too.

    Suffix ranks cut at a depth are classes of equal strings, as are the ranks of reversed
    prefixes; two starts are equal if both classes are.
    """
    m, side = len(windows), v - 1
    out = np.zeros((m, v), bool)
    if m:
        rank, common = _ranked(windows[:, side:])
        back, before = _ranked(windows[:, :side][:, ::-1]) if side else (np.zeros(m, np.int64), np.zeros(m, np.int32))
        tied = common >= room
        active = np.flatnonzero((tied | np.append(tied[1:], False))[rank])  # alone in its class: no tie to resolve
        for d in range(v):
            use = active[(left[active] >= d) & (right[active] >= side - d)]
            if len(use) < 2:
                continue
            key = np.cumsum(common < room + side - d)[rank[use]] * (m + 1) + np.cumsum(before < d)[back[use]]
            order = np.argsort(key, kind="stable")
            same = np.diff(key[order]) == 0
            equal = np.zeros(len(use), bool)
            equal[order[1:][same]] = True
            equal[order[:-1][same]] = True
            out[use[equal], d] = True
        d = np.arange(v)[None, :]
        out |= (twice[:, None] > 0) & (d <= left[:, None]) & (side - d <= right[:, None])
    return out


def _ranges(found: np.ndarray, chunk: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """Runs of true cells as (chunk, first start, last start)."""
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    last = np.nonzero(edges == -1)[1] - 1
    return [chunk[row], (pos[row] - last).astype("<u4"), (pos[row] - first).astype("<u4")]


def _window_kinds(v: int, room: int):
    return (("<u8", 1), ("<i8", 1), ("<u4", 1), ("<u2", 1), ("<u2", 1), ("u1", 1), ("u1", 2 * (v - 1) + room))


@lru_cache(maxsize=4)
def _mixers(n: int) -> np.ndarray:
    return np.frombuffer(hashlib.shake_256(b"window").digest(8 * n), "<u8") | np.uint64(1)


def _window_rows(v: int, room: int, buckets: int):
    """Windows of the samples that are left, dealt by the hash of the sample; equal windows of a task are sent once."""
    width = 2 * (v - 1) + room

    def flush(rows) -> pa.RecordBatch:
        name, chunk, pos, left, right, windows = _joined(rows)
        words = np.zeros((len(windows), -(-width // 8) * 8), np.uint8)
        words[:, :width] = windows
        mark = name ^ (left * 65536 + right).astype(np.uint64)
        for lo in range(0, len(windows), 8192):
            mark[lo : lo + 8192] += (words[lo : lo + 8192].view("<u8") * _mixers(words.shape[1] // 8)).sum(axis=1, dtype=np.uint64)
        del words
        order = np.argsort(mark, kind="stable")
        head = np.flatnonzero(np.diff(mark[order], prepend=mark[order[:1]] ^ np.uint64(1)) != 0)
        lead = np.empty(len(order), np.int64)
        lead[order] = np.repeat(order[head], np.diff(np.append(head, len(order))))
        equal = np.flatnonzero(lead != np.arange(len(lead)))
        if len(equal):  # the bytes decide
            to = lead[equal]
            sure = (left[equal] == left[to]) & (right[equal] == right[to])
            for lo in range(0, len(equal), 8192):
                sure[lo : lo + 8192] &= (windows[equal[lo : lo + 8192]] == windows[to[lo : lo + 8192]]).all(axis=1)
            equal = equal[sure]
        twice = np.zeros(len(lead), np.uint8)
        twice[lead[equal]] = 1
        sent = np.ones(len(lead), bool)
        sent[equal] = False
        rest = _pack([chunk[equal], (pos[equal] - left[equal]).astype("<u4"), (pos[equal] - (v - 1) + right[equal]).astype("<u4")])
        kept = np.flatnonzero(sent)
        kept = kept[np.argsort(name[kept], kind="stable")]
        columns = [name, chunk, pos, left.astype("<u2"), right.astype("<u2"), twice, windows]
        bucket, packs = _dealt((name[kept] % np.uint64(buckets)).astype(np.int64), [c[kept] for c in columns])
        at = int(name[0] % np.uint64(buckets))
        return _batch({"bucket": ([*bucket, at], pa.int32()), "lead": ([*packs, None], pa.binary()), "rest": ([None] * len(packs) + [rest], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                chunk, data, ends = _chunk(batch, k)
                every = np.sort(_lists(batch, "near", k, PLACES)[1]).astype(np.int64)
                for lo in range(0, len(every), 65536):
                    at = every[lo : lo + 65536]
                    windows, left, right = _windows(data, ends, at, v, room)
                    fits = left + right >= v - 1
                    at, windows, left, right = at[fits], windows[fits], left[fits], right[fits]
                    if len(at):
                        rows.append([names(data, at, room), np.full(len(at), chunk, "<i8"), at.astype("<u4"), left, right, windows])
                        held += windows.size
                    if held >= HELD:
                        yield flush(rows)
                        rows, held = [], 0
        if rows:
            yield flush(rows)

    return run


def _sorted_buckets(v: int, room: int, hot: int):
    """``chunk, ranges, large``: starts that repeat, and samples of classes with more than ``hot`` windows."""
    kinds = _window_kinds(v, room)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, since, ranges, large, classes = None, [], 0, [], [], np.empty(0, np.uint64)

        def part_large():
            """Put the windows of classes that are too large aside."""
            nonlocal held, classes
            columns = _joined(held)
            name, count = np.unique(columns[0], return_counts=True)
            classes = np.union1d(classes, name[count > hot])
            out = np.isin(columns[0], classes)
            if out.any():
                large.append([columns[1][out], columns[2][out]])
                columns = [c[~out] for c in columns]
            held = [columns]

        def settle():
            nonlocal held, since, classes
            part_large()
            _, chunk, pos, left, right, twice, windows = held[0]
            found = shared_starts(windows, left.astype(np.int64), right.astype(np.int64), twice, v, room)
            ranges.append(_ranges(found, chunk, pos.astype(np.int64)))
            held, since, classes = [], 0, np.empty(0, np.uint64)

        def lists():
            rows = {"chunk": ([], pa.int64()), "ranges": ([], pa.binary()), "large": ([], pa.binary())}
            for name, other, found in (("ranges", "large", ranges), ("large", "ranges", large)):
                if found:
                    columns = _joined(found)
                    keys, packs = _by_chunk(columns[0], columns)
                    rows["chunk"][0].extend(keys)
                    rows[name][0].extend(packs)
                    rows[other][0].extend([None] * len(packs))
            return _batch(rows)

        for b, lead, rest in _blocks(batches):
            if b != bucket and held:
                settle()
            bucket = b
            if lead is not None:
                held.append(_unpack(lead, kinds))
                since += len(held[-1][0])
                if since > 2 * hot:
                    part_large()
                    since = 0
            if rest is not None:
                ranges.append(_unpack(rest, RANGES))
            if sum(len(x[0]) for x in (*ranges, *large)) >= SAMPLES:
                yield lists()
                ranges, large = [], []
        if held:
            settle()
        yield lists()

    return run


# --- step 4: starts of large classes --------------------------------------------------------


def _reach(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mask of 0..n-1 inside ``[first, last]`` of some range."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, first, 1)
    np.add.at(delta, np.minimum(last.astype(np.int64) + 1, n), -1)
    return np.cumsum(delta[:n]) > 0


def _start_rows(v: int, room: int, buckets: int):
    length = room + v - 1

    def flush(rows) -> pa.RecordBatch:
        digest, chunk, pos = _joined(rows)
        _, first, back, count = np.unique(digest, return_index=True, return_inverse=True, return_counts=True)
        lead = np.zeros(len(digest), bool)
        lead[first] = True
        bucket = (np.frombuffer(digest[first].tobytes(), "<u8")[::2] % np.uint64(buckets)).astype(np.int64)
        at, packs = _dealt(bucket, [digest[first], (count > 1).astype("u1"), chunk[first], pos[first]])
        rest = _pack([chunk[~lead], pos[~lead]])
        return _batch({"bucket": ([*at, at[0]], pa.int32()), "lead": ([*packs, None], pa.binary()), "rest": ([None] * len(packs) + [rest], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                chunk, data, ends = _chunk(batch, k)
                at = np.sort(_lists(batch, "large", k, PLACES)[1]).astype(np.int64)
                every = np.flatnonzero(_reach(len(data), np.maximum(at - (v - 1), 0), at))
                every = every[every + length <= ends[np.searchsorted(ends, every, side="right")]]
                for lo in range(0, len(every), SAMPLES):
                    part, view = every[lo : lo + SAMPLES], memoryview(data)
                    digest = np.frombuffer(b"".join(hashlib.blake2b(view[s : s + length], digest_size=16).digest() for s in part.tolist()), "V16")
                    rows.append([digest, np.full(len(part), chunk, "<i8"), part.astype("<u4")])
                    held += len(part)
                    if held >= SAMPLES:
                        yield flush(rows)
                        rows, held = [], 0
        if rows:
            yield flush(rows)

    return run


def _settled_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, held, found = None, [], []

    def settle():
        digest, twice, chunk, pos = _joined(held)
        _, back, count = np.unique(digest, return_inverse=True, return_counts=True)
        more = (count > 1)[back] | (twice > 0)
        found.append([chunk[more], pos[more]])

    def lists():
        chunk, pos = _joined(found)
        keys, packs = _by_chunk(chunk, [chunk, pos, pos])
        return _batch({"chunk": (keys, pa.int64()), "ranges": (packs, pa.binary())})

    for b, lead, rest in _blocks(batches):
        if b != bucket and held:
            settle()
            held = []
        bucket = b
        if lead is not None:
            held.append(_unpack(lead, STARTS))
        if rest is not None:
            found.append(_unpack(rest, PLACES))
        if sum(len(x[0]) for x in found) >= SAMPLES:
            yield lists()
            found = []
    if held:
        settle()
    if found and sum(len(x[0]) for x in found):
        yield lists()


# --- the operator ---------------------------------------------------------------------------


def _finish(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, data, ends = _chunk(batch, k)
                keys, twice = batch.column(3)[k].as_py(), np.frombuffer(batch.column(4)[k].as_py(), bool)
                _, first, last = _lists(batch, "ranges", k, RANGES)
                gone = _reach(len(data), first, last.astype(np.int64) + length - 1)
                raw, out, start = np.frombuffer(data, np.uint8), [], 0
                for i, end in enumerate(ends.tolist()):
                    part = gone[start:end] if not (twice[i] and end - start >= length) else np.ones(end - start, bool)
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8)))
                    kept = raw[start:end][~part].tobytes() if len(edges) else data[start:end]
                    out.append((keys[32 * i : 32 * i + 32], end - start, int(part.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges.tolist()))
                    start = end
                columns = zip(*out)
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def _settled(rows: DataFrame, dealer: Callable, settler: Callable, parts: int, out: str) -> DataFrame:
    """Rows dealt to buckets by ``dealer``; ``settler`` reads them sorted by bucket."""
    dealt = rows.mapInArrow(dealer, "bucket int, lead binary, rest binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(settler, out)


def _with(chunks: DataFrame, lists: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """Chunks with the packed lists of ``column``; only the lists move, the chunks lie dealt by their id."""
    of = lists.where(F.col(column).isNotNull()).groupBy("chunk").agg(F.collect_list(column).alias(column))  # bounded by a chunk's starts
    return chunks.join(of.hint("shuffle_hash"), "chunk", how).select(*chunks.columns, column)


def removal(docs: DataFrame, length: int = LENGTH, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Remove every byte inside a string of ``length`` bytes that also starts elsewhere.

    Returns one row per row of ``docs``: ``id_col, n_bytes, n_removed, n_spans, kept_sha256`` and
    ``spans`` (removed runs as an array of start, end in turn). Null texts are empty; repeated
    rows repeat each other and so lose all that has ``length`` bytes; matches do not cross
    rows; a text of any length is one run of positions (a cell of Arrow holds 2 GB); an empty
    table gives no rows; other columns are not read. ``length`` must exceed the cover's modulus.
    """
    cover, v = difference_cover(order), order * order + order + 1
    if length <= v:
        raise ValueError("length must exceed the modulus of the cover")
    room = length - v + 1
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).cast("binary").alias("t"))
    rows = rows.withColumn("key", F.unhex(F.sha2("t", 256)))
    texts = rows.groupBy("key").agg(F.any_value("t").alias("t"), F.count(F.lit(1)).alias("n"))  # equal keys: equal texts
    chunks = texts.mapInArrow(_chunks, "chunk long, data binary, ends binary, keys binary, twice binary")
    chunks = bucketed(chunks, "chunk", "suffix_chunks")

    near = staged(_settled(chunks.select("chunk", "data", "ends"), _sample_rows(cover, v, room, parts * FINE), _near, parts, "chunk long, near binary"), "suffix-near")
    windows = _with(chunks.select("chunk", "data", "ends"), near, "near")
    found = _settled(windows, _window_rows(v, room, parts * FINE), _sorted_buckets(v, room, hot), parts, "chunk long, ranges binary, large binary")
    found = staged(found, "suffix-starts")
    large = found.where("large IS NOT NULL")
    ranges = found.where("ranges IS NOT NULL").select("chunk", "ranges")
    if not large.isEmpty():
        starts = _with(chunks.select("chunk", "data", "ends"), large, "large")
        ranges = ranges.unionByName(staged(_settled(starts, _start_rows(v, room, parts * FINE), _settled_starts, parts, "chunk long, ranges binary"), "suffix-large"))

    whole = _with(chunks, ranges, "ranges", "left")
    judged = whole.mapInArrow(_finish(length), "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
    result = rows.select("key", "doc_id").join(judged, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    return result.withColumnRenamed("doc_id", id_col)


ORACLE_SQL = """WITH t AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS x FROM documents),
s AS (SELECT rid, x, unnest(range(octet_length(x) - 399)) AS p FROM t WHERE octet_length(x) >= 400),
n AS (SELECT rid, p, count(*) OVER (PARTITION BY h) AS n FROM (SELECT rid, p, sha256(x[p + 1 : p + 400]) AS h FROM s)),
b AS (SELECT rid, p, coalesce(p > lag(p) OVER (PARTITION BY rid ORDER BY p) + 400, true)::INT AS new FROM n WHERE n > 1),
m AS (SELECT rid, min(p) AS first, max(p) + 400 AS last FROM (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS run FROM b) GROUP BY rid, run),
k AS (SELECT rid, sum(last - first) AS n_removed, count(*) AS n_spans, list(first ORDER BY first) AS f, list(last ORDER BY first) AS l FROM m GROUP BY rid),
h AS (SELECT doc_id, octet_length(x) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, hex(x) AS y,
  list_prepend(0, coalesce(l, [])) AS a, list_append(coalesce(f, []), octet_length(x)) AS z FROM t LEFT JOIN k USING (rid))
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
sha256(unhex(array_to_string(list_transform(range(len(a)), lambda i: substr(y, 2 * a[i + 1] + 1, 2 * (z[i + 1] - a[i + 1]))), ''))) AS kept_sha256 FROM h"""
