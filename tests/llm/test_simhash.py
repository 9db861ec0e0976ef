import random
import time

import numpy as np
import pandas as pd
import xxhash

from plenum.llm import components, simhash


def slow_fingerprint(text):
    words = [w for w in text.translate(simhash.LOWER).split() if w]
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) > len(grams):
            out |= 1 << bit
    return out


def slow_components(ids, fps, limit=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= limit:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id")
    rows = docs.select("doc_id", "text").toPandas().sort_values("doc_id")
    fps = [slow_fingerprint(t.encode()) for t in rows.text]
    assert list(got.fingerprint) == [f"{x:016x}" for x in fps]
    assert list(got.component_id) == slow_components(list(rows.doc_id), fps)


def test_nulls_empties_repeats_and_clashing_names(frame):
    df = frame([(5, None), (3, ""), (9, " \n"), (7, "a b c d e f"), (8, "A b  c d e f"), (8, "A b  c d e f"), (None, "q r")], ["fp", "least", "root", "component_id"])
    got = simhash.near_duplicates(df).toPandas()
    zero = got[got.fingerprint == "0" * 16]
    assert sorted(zero.doc_id) == [3, 5, 9] and set(zero.component_id) == {3}
    assert list(got[got.doc_id == 8].component_id) == [7, 7]
    assert len(got) == 7
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_chain_finds_every_link(spark):
    """Hot ball of near fingerprints and random ones: the same components as all pairs give."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        x = rng.choice(list(fps)) if rng.random() < 0.5 else centre
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    for _ in range(150):
        x = rng.getrandbits(64)
        fps |= {x, x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)), x ^ sum(1 << b for b in rng.sample(range(64), 4)), x ^ sum(1 << b for b in rng.sample(range(64), 5))}
    fps = sorted(fps)
    keys, rows = simhash.chain_keys(np.array(fps, np.uint64))
    order = np.argsort(keys, kind="stable")
    a, b = simhash.links_in(keys[order], rows[order], 4)
    node, root = components.trees(a, b)
    root_of = {x: x for x in fps} | dict(zip(node.tolist(), root.tolist()))
    assert [root_of[x] for x in fps] == slow_components(fps, fps)


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 200), (-5, 300)]
    edges = spark.createDataFrame(pd.DataFrame(pairs, columns=["u", "v"]))
    got = {r.node: r.root for r in components.connected(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert got[300] == -5 and 200 not in got


def test_large_group_of_fingerprints_without_links():
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 1 << 38, 80_000, dtype=np.uint64))  # one key: the other bits are equal
    near = fps[:200] ^ np.uint64(0b1011)
    began = time.process_time()
    found = simhash.large_links(np.unique(np.concatenate([fps, near])), 4)
    took = time.process_time() - began
    pairs = {frozenset(map(int, p)) for a, b in found for p in zip(a, b)}
    node, root = components.trees(*(np.concatenate(x) for x in zip(*found)))
    of = dict(zip(node.tolist(), root.tolist()))
    assert all(of.get(a, a) == of.get(b, b) for a, b in zip(fps[:200].tolist(), near.tolist()))
    assert all(bin(a ^ b).count("1") <= 4 for a, b in map(tuple, pairs)) and took < 20


def test_very_long_text(frame):
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(40_000))
    got = simhash.near_duplicates(frame([(1, text), (2, text + " \n")])).toPandas()
    assert set(got.component_id) == {1} and set(got.fingerprint) == {f"{slow_fingerprint(text.encode()):016x}"}
