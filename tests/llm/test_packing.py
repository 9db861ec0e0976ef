import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from plenum.llm import packing


def spread(counts, capacity):
    """Bins of a plan as {bin: [(offset, length)]}."""
    plan = packing.Plan(dict(counts), capacity)
    bins = {}
    by = {}
    for length, first, seq, each, offset in sorted(plan.runs):
        by.setdefault(length, []).append((first, seq, each, offset))
    for length, runs in by.items():
        for (first, seq, each, offset), stop in zip(runs, [r[0] for r in runs[1:]] + [counts[length]]):
            for k in range(stop - first):
                bins.setdefault(seq + k // each, []).append((offset + k % each * length, length))
    return plan, bins


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_gapless_and_tight(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 300])
    counts = {x: rng.randint(1, 30) for x in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
    plan, bins = spread(counts, capacity)
    assert sorted(bins) == list(range(plan.bins))
    total = 0
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * x > capacity for _, x in held) <= 2
        total += len(held)
    assert total == sum(counts.values())
    volume = -(-sum(x * n for x, n in counts.items()) // capacity)
    big = sum(n for x, n in counts.items() if 2 * x > capacity)
    assert plan.bins <= max(volume, big) * 1.34 + 1


def check(docs, got, capacity=4096):
    model = Tokenizer.from_file(packing.default_tokenizer())
    want = {}
    for i, text in docs:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4")
            want.setdefault(i, []).append((k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    have = {}
    for r in got.itertuples():
        have.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= capacity


def test_whole_table_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.pack_documents(docs).toPandas()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 1


def test_nulls_empties_long_and_odd_texts(frame):
    rows = [(1, None), (2, ""), (3, " \t\r\n x  Y"), (4, "ab'S 12 É́ <|endoftext|> z" * 9), (5, "word " * 9000), (6, "x" * 3000), (None, "a b　c")]
    check(rows[:-1], packing.pack_documents(frame(rows[:-1], ["length", "number", "part"])).toPandas())
    twice = packing.pack_documents(frame([rows[2], rows[2], rows[-1]])).toPandas()
    assert len(twice) == 3 and twice.sequence_id.nunique() == 1
    assert packing.pack_documents(frame([])).count() == 0
