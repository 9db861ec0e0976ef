"""Best-fit packing with matching of large pieces.

The plan is made on the histogram of piece lengths, which has ``capacity`` rows whatever the
input. Pieces above a third of the capacity come first: the longest not yet placed takes the
longest other large piece that fits beside it, so a bin holds two of them at most. Shorter
pieces, longest first, go into the smallest gap that holds them; new bins are opened when no
gap does. Equal lengths and equal gaps are moved as runs, so the plan is a table of runs. A
piece's number within its length then names its run, and so its sequence and its place there.
"""

from __future__ import annotations

import bisect
import json
import os
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import numbered, staged, text_of

CAPACITY = 4096
END_ID = 1
#: Bytes of text whose blocks are looked up together, and bytes up to which a block is compared with others.
RUN = 5 << 20
WIDE = 32
#: Marks that, after a letter or digit of an ASCII block, the vocabulary never joins to it.
MARKS = ".,;:!?*&#$%"
#: How a vocabulary must normalise, split and end words for blocks to be encoded alone.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
END = "</w>"
LETTER, DIGIT, MARK, HIGH = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
for _kind, _bytes in ((LETTER, range(97, 123)), (DIGIT, range(48, 58)), (MARK, MARKS.encode()), (HIGH, range(128, 256))):
    KIND[list(_bytes)] = _kind
REST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Plan:
    """Runs ``(length, first number, sequence of the first, pieces a bin, offset of the first)``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.capacity, self.bins = capacity, 0
        self.done: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: [(first bin, bins)]
        self.sizes: list[int] = []  # the gaps that occur, ascending
        large = {x: n for x, n in counts.items() if 3 * x > capacity and n}
        self._pair(large)
        for x in sorted((x for x, n in counts.items() if 3 * x <= capacity and n), reverse=True):
            self._fill(x, counts[x])

    def _place(self, length: int, n: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.runs.append((length, self.done[length], first_bin, per_bin, offset))
        self.done[length] += n

    def _open(self, n: int) -> int:
        self.bins += n
        return self.bins - n

    def _gap(self, size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if not self.gaps[size]:
                bisect.insort(self.sizes, size)
            self.gaps[size].append((first, n))

    def _pair(self, left: dict[int, int]) -> None:
        keys = sorted(left)
        while keys:
            x = keys[-1]
            n = left[x]
            at = bisect.bisect_right(keys, self.capacity - x) - 1
            if at < 0:
                m, y = n, 0
            elif keys[at] == x:
                y, m = x, n // 2
            else:
                y = keys[at]
                m = min(n, left[y])
            if m:
                first = self._open(m)
                self._place(x, m, first, 1, 0)
                if y:
                    self._place(y, m, first, 1, x)
                self._gap(self.capacity - x - y, first, m)
                left[x] -= m
                if y:
                    left[y] -= m
            elif y == x:  # one is over; it takes the next shorter that is left, or stays alone
                z = keys[at - 1] if at > 0 else 0
                first = self._open(1)
                self._place(x, 1, first, 1, 0)
                if z:
                    self._place(z, 1, first, 1, x)
                    left[z] -= 1
                self._gap(self.capacity - x - z, first, 1)
                left[x] -= 1
            keys = [k for k in keys if left[k]]

    def _fill(self, length: int, n: int) -> None:
        while n:
            at = bisect.bisect_left(self.sizes, length)
            if at == len(self.sizes):
                each = self.capacity // length
                first = self._open(-(-n // each))
                self._gap(self.capacity, first, self.bins - first)
                continue
            gap = self.sizes[at]
            first, bins = self.gaps[gap].pop()
            if not self.gaps[gap]:
                self.sizes.pop(at)
            each = gap // length
            whole = min(bins, n // each)
            offset = self.capacity - gap
            if whole:
                self._place(length, whole * each, first, each, offset)
                self._gap(gap - each * length, first, whole)
                n -= whole * each
            rest = bins - whole
            if rest and n:  # fewer than a bin takes
                self._place(length, n, first + whole, n, offset)
                self._gap(gap - n * length, first + whole, 1)
                whole, rest, n = whole + 1, rest - 1, 0
            self._gap(gap, first + whole, rest)


class Vocabulary:
    """A tokenizer, and a barer one for words that are one piece and need no normalising."""

    def __init__(self, path: str):
        # a task has one core; the library's own threads cost more than the short blocks they encode
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        #: Pieces then end at white space, marks other than apostrophes stand alone, and ASCII case is dropped.
        self.blocks = (form["normalizer"], form["pre_tokenizer"], form["model"].get("end_of_word_suffix")) == (NORMALIZER, SPLITTER, END)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        names = self.whole.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for w, i in names.items() if w.endswith(END)]] = True

    def each(self, blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of blocks encoded alone, joined, and how many each has."""
        out = []
        for at in range(0, len(blocks), 4096):
            out += [e.ids for e in self.whole.encode_batch_fast(blocks[at : at + 4096], add_special_tokens=False)]
        return np.array(list(chain.from_iterable(out)), "<u4"), np.fromiter(map(len, out), np.int64, len(out))

    def words(self, joined: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words; every item of ``joined`` holds words of small letters, parted by spaces. A word's end parts the ids."""
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for text, e in zip(joined, self.bare.encode_batch_fast(joined, add_special_tokens=False)):
            own = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(self.ends[own]) + 1
            size = np.diff(cuts, prepend=0)
            if len(cuts) != text.count(" ") + 1 or cuts[-1] != len(own):
                own, size = self.each(text.split(" "))
            ids.append(own)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Vocabulary:
    return Vocabulary(path)


def _blocks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the blocks between spaces; marks at the end of an ASCII block are a block of their own."""
    space = np.flatnonzero(raw == 32)
    start, end = np.concatenate([[0], space[:-1] + 1]), space
    start, end = start[end > start], end[end > start]
    kind = KIND[raw]
    last = np.maximum.accumulate(np.where(kind == MARK, 0, np.arange(len(raw), dtype=np.int32)))
    high = np.concatenate([[0], np.cumsum(kind == HIGH, dtype=np.int32)])
    core = np.maximum(last[end - 1] + 1, start) if len(end) else end
    parted = np.flatnonzero((core > start) & (core < end) & (high[end] == high[start]))
    parted = parted[np.isin(kind[core[parted] - 1], (LETTER, DIGIT))]
    times = np.ones(len(start), np.int64)
    times[parted] = 2
    start, end = np.repeat(start, times), np.repeat(end, times)
    first = np.cumsum(times)[parted] - 2
    end[first], start[first + 1] = core[parted], core[parted]
    return start, end


def _distinct(blob: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One block of each kind, and of which kind every block is. Blocks of over ``WIDE`` bytes are kinds of their own."""
    view = np.ndarray((len(blob) - 7,), "<u8", blob, strides=(1,))
    size = end - start
    words, mark = [], size.astype(np.uint64) * MIX[-1]
    for j in range(0, WIDE, 8):
        inside = size > j
        word = np.zeros(len(size), np.uint64)
        word[inside] = view[start[inside] + j] & REST[np.minimum(size[inside] - j, 8)]
        words.append(word)
        mark += word * MIX[j // 8]
    mark ^= mark >> np.uint64(31)
    order = np.argsort(mark, kind="stable")
    head = np.flatnonzero(np.diff(mark[order], prepend=mark[order[:1]] ^ np.uint64(1)) != 0)
    of = np.empty(len(order), np.int64)
    of[order] = np.repeat(order[head], np.diff(np.append(head, len(order))))
    own = size > WIDE
    for word in (*words, size):  # the bytes decide
        own |= word != word[of]
    of[own] = np.flatnonzero(own)
    one, kind = np.unique(of, return_inverse=True)
    return one, kind


def _spread(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``values[first : first + size]`` of every pair, joined."""
    stops = np.cumsum(size)
    return values[np.repeat(first - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)]


def _small(text: str) -> str | None:
    """Words as the vocabulary's normalising leaves them, None where that is not certain."""
    if "\u03a3" in text or not unicodedata.is_normalized("NFC", text):  # the small form of a sigma depends on its place
        return None
    text = text.lower()
    return text if text.replace(" ", "").isalpha() else None


def _encoded(raw: np.ndarray, start: np.ndarray, end: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of distinct blocks, joined in any order; the first and the number of each block's."""
    kind = KIND[raw]
    odd, high = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in ((kind != LETTER) & (kind != HIGH), kind == HIGH))
    letters, wide = odd[end] == odd[start], high[end] != high[start]
    joined, held, rest = [], [], [np.flatnonzero(~letters)]
    for chosen in (np.flatnonzero(letters & ~wide), np.flatnonzero(letters & wide)):
        for at in range(0, len(chosen), 1024):
            part = chosen[at : at + 1024]
            size = end[part] - start[part] + 1
            blob = _spread(raw, start[part], size)  # with the byte after each
            blob[np.cumsum(size) - 1] = 32
            text = blob[:-1].tobytes().decode()
            if wide[part[0]]:
                small = _small(text)
                if small is None:
                    single = [_small(w) for w in text.split(" ")]
                    fine = np.array([w is not None for w in single])
                    rest.append(part[~fine])
                    part, small = part[fine], " ".join(w for w in single if w is not None)
                text = small
            if len(part):
                joined.append(text)
                held.append(part)
    others = np.concatenate(rest)
    ids, sizes = zip(vocabulary.words(joined), vocabulary.each([raw[start[k] : end[k]].tobytes().decode() for k in others.tolist()]))
    sizes, place = np.concatenate(sizes), np.concatenate([*held, others])
    first, size = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    first[place], size[place] = np.cumsum(sizes) - sizes, sizes
    return np.concatenate(ids), first, size


def token_ids(texts: list[str], path: str) -> Iterator[np.ndarray]:
    """Ids of each text. Where the vocabulary's pieces end at white space, every distinct block of a run of texts is encoded once."""
    vocabulary = _tokenizer(path)
    if not vocabulary.blocks:
        for text in texts:
            yield np.array(vocabulary.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return
    at = 0
    while at < len(texts):
        parts, size = [], 0
        while at < len(texts) and size < RUN:
            parts.append(texts[at].encode().lower())  # ASCII only; other characters are the vocabulary's business
            size += len(parts[-1])
            at += 1
        blob = b" ".join([*parts, b" " * WIDE]).replace(b"\n", b" ")
        raw = np.frombuffer(blob, np.uint8)
        start, end = _blocks(raw)
        one, kind = _distinct(blob, start, end)
        ids, first, size = _encoded(raw, start[one], end[one], vocabulary)
        ids = _spread(ids, first[kind], size[kind])
        stops = np.concatenate([[0], np.cumsum(size[kind])])
        texts_end = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        lo = 0
        for hi in stops[np.searchsorted(start, texts_end)].tolist():
            yield ids[lo:hi]
            lo = hi


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, found in zip(batch.column(0).to_pylist(), token_ids(batch.column(1).to_pylist(), path)):
                ids = np.append(found, np.uint32(END_ID)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((doc, k, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _assign(runs: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            row = table[np.searchsorted(keys, (length << 48) | number, side="right") - 1]
            k = number - row[:, 1]
            seq, offset = row[:, 2] + k // row[:, 3], row[:, 4] + (k % row[:, 3]) * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens; one row per piece.

    Returns ``id_col, piece, start, length, ids_crc32, sequence_id, offset``. A document is its
    ids and one end id; only longer ones are cut. Null and empty texts are the end id alone;
    repeated rows are packed each; an empty table gives no rows; other columns are not read.
    Pieces of equal length are told apart by their place in the input, not by their id.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("t"))
    pieces = rows.mapInArrow(_pieces(path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = staged(pieces.withColumn("part", F.spark_partition_id()), "pack-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = Plan(counts, capacity)
    ranked = numbered(pieces, ["length"], "part", ["doc_id", "piece"], "number").select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    out = ranked.mapInArrow(_assign(plan.runs), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)
