import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from plenum.llm import toxicity


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    if not os.path.isdir(d):
        pytest.skip("needs the larger tables")
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == docs.count()
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    both = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    area = auc(both.score.to_numpy(), both.toxic.to_numpy())
    said = both[both.predicted == 1]
    print("auc", area, "precision", said.toxic.mean(), "recall", both[both.toxic == 1].predicted.mean())
    assert area > 0.85 and said.toxic.mean() > 0.8 and both[both.toxic == 1].predicted.mean() > 0.7


def test_held_out_labels_change_nothing(spark, frame):
    rows = [(i, "you idiot fool" if i % 2 else "a calm day at sea") for i in range(60)]
    docs = frame(rows)
    y = [(i, 1, i % 2) for i in range(60)]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in y]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.toxicity(docs, spark.createDataFrame(x, schema)).toPandas() for x in (y, flipped))
    assert a.equals(b)
    assert set(a[a.doc_id % 2 == 1].predicted) == {1} and set(a[a.doc_id % 2 == 0].predicted) == {0}


def test_nulls_empties_long_and_no_labels(spark, frame):
    docs = frame([(1, None), (2, ""), (3, "a b" * 200_000), (4, "x"), (4, "x"), (None, "y")], ["score", "held_out", "y", "f", "i"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, none).toPandas()
    assert len(got) == 6 and got.score.between(0, 1).all() and set(got.predicted) == {0}
    some = spark.createDataFrame([(1, 0, None), (2, 0, 1), (4, 1, 0), (4, 1, 0), (None, 1, 1)], none.schema)
    assert len(toxicity.toxicity(docs, some).toPandas()) == 6
    assert toxicity.toxicity(frame([]), none).count() == 0


def slow_grams(text):
    out, mask = set(), (1 << 64) - 1
    codes = [ord(c) for c in " " + text.lower() + " "]
    for at in range(len(codes)):
        h = 0
        for n, c in enumerate(codes[at : at + max(toxicity.ORDERS)], 1):
            h = (h + c) * 0x9E3779B97F4A7C15 & mask
            h ^= h >> 29
            if n in toxicity.ORDERS:
                out.add((h >> 7) & ((1 << toxicity.BITS) - 1))
    return sorted(out)


def test_ratios_and_scores_by_plain_counting(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    y = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in texts and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    grams = {i: slow_grams(texts[i]) for i in y}
    pos, neg = (Counter(g for i in y if y[i] == k for g in grams[i]) for k in (1, 0))
    n_pos, n_neg = sum(y.values()), len(y) - sum(y.values())
    r = {}
    for g in pos | neg:
        ratio = math.log((pos[g] + 0.5) / (n_pos + 1)) - math.log((neg[g] + 0.5) / (n_neg + 1))
        if pos[g] + neg[g] >= 5 and abs(ratio) >= 2.5:
            r[g] = max(-4.0, min(4.0, ratio))
    model = toxicity.train(docs, labels)
    assert r and set(np.flatnonzero(model.weights)) <= set(r)
    dense = np.zeros(1 << toxicity.BITS)
    dense[list(r)] = list(r.values())
    ids = sorted(y)
    again = toxicity.fit([np.array([g for g in grams[i] if g in r], np.int64) for i in ids], np.array([y[i] for i in ids]), dense)
    assert np.allclose(again.weights, model.weights, atol=1e-5) and abs(again.bias - model.bias) < 1e-6
    for row in toxicity.toxicity(docs, labels).limit(60).collect():
        z = sum(float(model.weights[g]) for g in slow_grams(texts[row.doc_id])) + model.bias
        assert abs(row.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-5
