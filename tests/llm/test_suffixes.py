import hashlib
import random
from collections import Counter

import numpy as np

from plenum.llm import suffixes as S


def slow(texts, length):
    """{id: (bytes, removed, runs, sha)} by counting every string."""
    data = [(i, (t or "").encode()) for i, t in texts]
    count = Counter(d[s : s + length] for _, d in data for s in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if count[d[s : s + length]] > 1:
                gone[s : s + length] = b"\x01" * length
        runs = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.drop("spans").collect()), key=str)


def test_cover_and_names():
    for q in (2, 3, 13):
        v, cover = q * q + q + 1, S.difference_cover(q)
        assert {int((a - b) % v) for a in cover for b in cover} == set(range(v))
    data = bytes(range(256)) * 20
    got = S.names(data, np.arange(len(data) - 49), 50)
    assert len(set(got.tolist())) == 256 and got[0] == got[256]


def test_starts_by_ranks_equal_counting():
    rng, v, room = random.Random(3), 7, 10
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(10, 40))).encode() for _ in range(60)]
    data, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    at = np.array([s for s in range(len(data)) if s + room <= ends[np.searchsorted(ends, s, side="right")]])
    windows, left, right = S._windows(data, ends, at, v, room)
    for k, s in enumerate(at.tolist()):
        a, b = max([0, *(e for e in ends if e <= s)]), min(e for e in ends if e > s)
        want = data[max(a, s - v + 1) : min(b, s + room + v - 1)]
        assert windows[k].tobytes()[v - 1 - left[k] : v - 1 + room + right[k]] == want
    got = S.shared_starts(windows, left, right, np.zeros(len(at), np.uint8), v, room)
    for d in range(v):
        strings = [data[s - d : s - d + room + v - 1] if left[k] >= d and right[k] >= v - 1 - d else None for k, s in enumerate(at.tolist())]
        count = Counter(strings)
        assert got[:, d].tolist() == [x is not None and count[x] > 1 for x in strings]


def thue_morse(a, b, n=64):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def test_strings_that_collide_under_rolling_hashes(frame):
    pairs = [("(", "8"), ("c", "("), (" ", "#")]
    texts = []
    for k in range(8):
        word = "".join(thue_morse(*(p[::-1] if k >> i & 1 else p)) for i, p in enumerate(pairs))
        texts.append((k, "x" * 104 + word + "y" * 104))
    want = slow(texts, 400)
    assert {r[2] for r in want} == {0} and rows_of(S.removal(frame(texts))) == want
    assert rows_of(S.removal(frame(texts), hot=1)) == want


def test_very_long_text(frame):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(4000)]
    long = " ".join(rng.choice(words) for _ in range(250_000))  # longer than a chunk
    texts = [(1, long), (2, long[700_000:700_900]), (3, "q" * 500), (4, long[:100] + "!" + long[1_500_000:1_500_399])]
    got = {r[0]: r for r in rows_of(S.removal(frame(texts)))}
    assert len(long) > S.CHUNK and got[2][2] == 900 and got[4][2] == 0 and got[3][2] == 500
    kept = long[:700_000] + long[700_900:]
    assert got[1][1:] == (len(long), 900, 1, hashlib.sha256(kept.encode()).hexdigest())


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows_of(S.removal(docs)) == slow([(r.doc_id, r.text) for r in docs.collect()], 400)


def test_small_strings_nulls_and_ties(frame):
    rng = random.Random(5)
    base = "".join(rng.choice("ab") for _ in range(400)) + "é" * 30
    texts = [(1, None), (2, ""), (3, "a" * 300), (None, "q" * 9), (4, base), (4, base)]
    for i in range(30):
        a, b = sorted(rng.sample(range(len(base)), 2))
        texts.append((10 + i, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 40))) + base[a:b] + "".join(rng.choice("xyz") for _ in range(20))))
    df = frame(texts, ["key", "t", "near", "chunk"])
    assert rows_of(S.removal(df, length=40, order=3)) == slow(texts, 40)
    assert rows_of(S.removal(df, length=40, order=3, hot=2)) == slow(texts, 40)
    assert rows_of(S.removal(df, length=14, order=3)) == slow(texts, 14)
    assert S.removal(frame([])).count() == 0
    assert not frame([]).sparkSession.catalog.listTables()
