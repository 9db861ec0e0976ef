"""SimHash near-duplicates with a pigeonring filter.

A fingerprint has 64 bits in five segments laid on a ring. If two fingerprints differ in at
most ``limit`` bits, then some segment starts a chain whose running differences all stay
within their proportional share of the limit: d(1) <= limit/5, d(1)+d(2) <= 2*limit/5, and so
on round the ring. With a limit of 4 the first segment must be equal and the next may differ in
one bit. That two-segment condition is the join key (the second segment with one bit masked);
the rest of the chain is checked before the full Hamming distance.

Rows with one fingerprint are one node. No pair list of a group is ever made: a task joins
what it finds into trees by union-find and emits one edge per node it touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import free_name, shuffle_partitions, staged, text_of
from plenum.llm.components import connected, trees

LIMIT = 4
SHINGLE = 4
WIDTHS = (13, 13, 13, 13, 12)
SHIFTS = (0, 13, 26, 39, 52)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Groups up to this size are compared by shifted copies of the sorted rows, larger ones by further parts.
SMALL = 48
#: Members of a large group that are compared with all the others first, which settles most of a dense one.
STEPS = 64
#: Hash values whose bits are counted at a time.
BLOCK = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the ``shingle``-word runs of a UTF-8 text, repeats counted."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    whole = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(whole, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    n = len(stops)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(whole[a:b], 42) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(counts * 2 > n)
    return sum(1 << int(b) for b in on)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])


def _segment(fps: np.ndarray, i: int) -> np.ndarray:
    i %= len(WIDTHS)
    return (fps >> np.uint64(SHIFTS[i])) & np.uint64((1 << WIDTHS[i]) - 1)


def chain_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of each fingerprint: segment i whole, segment i+1 with each one bit masked."""
    keys, rows = [], []
    for i in range(len(WIDTHS)):
        first, second, wide = _segment(fps, i), _segment(fps, i + 1), WIDTHS[(i + 1) % len(WIDTHS)]
        for bit in range(wide):
            masked = second & ~np.uint64(1 << bit)
            keys.append((((np.uint64(i * 16 + bit) << np.uint64(13)) | first) << np.uint64(13)) | masked)
            rows.append(fps)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, rows = chain_keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(rows.view(np.int64))], ["key", "fp"])


def within(a: np.ndarray, b: np.ndarray, start: np.ndarray, limit: int) -> np.ndarray:
    """Which pairs pass every budget of the chain that starts at segment ``start``."""
    differ = a ^ b
    ok = np.ones(len(differ), bool)
    total = np.zeros(len(differ), np.int64)
    n = len(WIDTHS)
    shifts, masks = np.array(SHIFTS, np.uint64), np.array([(1 << w) - 1 for w in WIDTHS], np.uint64)
    for k in range(n):
        at = (start + k) % n
        total += np.bitwise_count((differ >> shifts[at]) & masks[at])
        ok &= total * n <= limit * (k + 1)
    return ok


def _grow(rest: np.ndarray, limit: int, steps: int | None = None) -> tuple[list, np.ndarray]:
    """Trees over ``rest``; what has joined is compared with what has not, and no more with each other.

    After ``steps`` comparisons it stops; then all that may still have links is returned as well.
    """
    out, queue = [], []
    while len(rest) and steps != 0:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        near = np.bitwise_count(rest ^ x) <= limit
        if near.any():
            found = rest[near]
            out.append((np.full(len(found), x), found))
            queue.extend(found)
            rest = rest[~near]
        steps = None if steps is None else steps - 1
    return out, np.concatenate([rest, np.array(queue, np.uint64)]) if len(rest) else rest


def large_links(fps: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among the many distinct fingerprints of one key, without comparing all of them.

    The bits in which they differ at all are dealt to ``limit + 2`` parts. Two that differ in at
    most ``limit`` bits agree in two parts, so only those that agree in some two are compared.
    """
    out, fps = _grow(fps, limit, STEPS)
    if not len(fps):
        return out
    vary = np.bitwise_or.reduce(fps ^ fps[0])
    bits = np.array([1 << b for b in range(64) if int(vary) >> b & 1], np.uint64)
    parts = [np.bitwise_or.reduce(x) if len(x) else np.uint64(0) for x in np.array_split(bits, limit + 2)]
    for one, two in combinations(parts, 2):
        key = fps & (one | two)
        order = np.argsort(key)
        key, sorted_fps = key[order], fps[order]
        new = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)) != 0)
        sizes = np.diff(np.append(new, len(key)))
        few = np.repeat(sizes <= SMALL, sizes)
        k, f = key[few], sorted_fps[few]
        for gap in range(1, min(SMALL, int(sizes.max(initial=0)))):
            same = np.flatnonzero(k[gap:] == k[:-gap])
            if not len(same):
                break
            same = same[np.bitwise_count(f[same] ^ f[same + gap]) <= limit]
            out.append((f[same], f[same + gap]))
        for at, size in zip(new[sizes > SMALL], sizes[sizes > SMALL]):
            out += _grow(sorted_fps[at : at + size], limit)[0]
    return out


def links_in(keys: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key (sorted by key): enough of them to connect all that link."""
    out_a, out_b = [], []
    new = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0)
    sizes = np.diff(np.append(new, len(keys)))
    small = np.repeat(sizes <= SMALL, sizes)
    k, f = keys[small], fps[small]
    for gap in range(1, min(SMALL, int(sizes.max(initial=0)))):
        same = np.flatnonzero(k[gap:] == k[:-gap])
        if not len(same):
            break
        ok = within(f[same], f[same + gap], (k[same] >> np.uint64(30)).astype(np.int64), limit)
        out_a.append(f[same[ok]])
        out_b.append(f[same[ok] + gap])
    for at, size in zip(new[sizes > SMALL], sizes[sizes > SMALL]):
        for a, b in large_links(np.unique(fps[at : at + size]), limit):
            out_a.append(a)
            out_b.append(b)
    if not out_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _linker(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.empty(0, np.uint64), np.empty(0, np.uint64)
        us, vs, waiting = [], [], 0

        def flush():
            nonlocal us, vs, waiting
            u, v = trees(np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.uint64),) * 2
            us, vs, waiting = [u], [v], 0
            return u, v

        def take(k, f):
            nonlocal waiting
            a, b = links_in(k, f, limit)
            if len(a):
                us.append(a)
                vs.append(b)
                waiting += len(a)
                if waiting > 2_000_000:
                    flush()

        for batch in batches:
            k = np.concatenate([held_k, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            f = np.concatenate([held_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(k):
                continue
            cut = int(np.searchsorted(k.view(np.int64), k.view(np.int64)[-1]))  # the last key may go on
            held_k, held_f = k[cut:], f[cut:]
            if cut:
                take(k[:cut], f[:cut])
        if len(held_k):
            take(held_k, held_f)
        if us:
            u, v = flush()
            for at in range(0, len(u), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(u[at : at + 100_000].view(np.int64)), pa.array(v[at : at + 100_000].view(np.int64))], ["u", "v"])

    return run


def near_duplicates(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, fingerprint, component_id``.

    Two fingerprints link at ``limit`` (at most 4) or fewer differing bits; the component is the
    least id reachable. Null and empty texts, and texts without a word, have fingerprint zero
    and link like any other. Repeated rows and exact copies share a fingerprint and so a
    component. A null id is ignored by the minimum unless all are null. An empty table gives an
    empty result; other columns are not read.
    """
    if not 0 <= limit <= 4:
        raise ValueError("the two-segment chain holds for limits 0 to 4")
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).cast("binary").alias("t"))
    rows = staged(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "simhash-rows")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    keyed = nodes.select("fp").mapInArrow(_keyed, "key long, fp long")
    keyed = keyed.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    edges = keyed.mapInArrow(_linker(limit), "u long, v long").distinct()
    member = connected(edges)  # node, root for every node that has a link
    named = nodes.join(member, nodes.fp == member.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "simhash-nodes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the least id, nulls last; all columns pass through.

    Rows are told apart by their place, so repeated rows and repeated ids are one row each.
    """
    row = free_name(docs, "_row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), F.col(text_col).alias("text")), limit).select(F.col("doc_id").alias("row"), "component_id")
    ranked = rows.select(F.col(row).alias("row"), F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("i"), F.col(row).alias("r")).alias("rank"))
    kept = ranked.join(found, "row").groupBy("component_id").agg(F.min_by("row", "rank").alias(row))
    return rows.join(kept.select(row), row, "left_semi").select(*docs.columns)
