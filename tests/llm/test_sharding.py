import itertools
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from plenum.llm import sharding


def slow_capacity(sizes, shards):
    best = sum(sizes)
    n = len(sizes)
    for at in itertools.combinations_with_replacement(range(n + 1), shards - 1):
        edges = [0, *at, n]
        best = min(best, max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])))
    return best


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(1, 4))
def test_capacity_and_cuts_are_minimax(sizes, shards):
    capacity = sharding.smallest_capacity(np.array(sizes), shards)
    assert capacity == slow_capacity(sizes, shards)
    edges = [0, *sharding.cuts(np.array(sizes), shards).tolist(), len(sizes)]
    assert edges == sorted(edges)
    assert max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) <= capacity


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.shard_documents(docs).toPandas()
    text = docs.select("doc_id", "text").toPandas().set_index("doc_id").text
    assert len(got) == len(text)
    for r in got.itertuples():
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    got["text"] = got.doc_id.map(text)
    assert got.groupby("text").shard.nunique().max() == 1
    assert set(got.shard) <= set(range(40)) and got.grown_shard.isna().all() and set(got.law) == {"bytes"}
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert got.groupby("shard")["size"].sum().max() <= got["size"].sum() / 40 + got.groupby("text")["size"].sum().max()


def test_nulls_empties_repeats_and_hot_group(frame):
    rows = [(1, None), (2, ""), (None, "x"), *[(4, "same")] * 50, *[(i, f"t{i}") for i in range(5, 60)]]
    got = sharding.shard_documents(frame(rows, ["size", "cell", "part", "shard"]), shards=4).toPandas()
    assert len(got) == len(rows)
    assert got[got.doc_id == 4].shard.nunique() == 1
    assert list(got[got.doc_id.isin([1, 2])]["size"]) == [16, 16]
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert sharding.shard_documents(frame([])).count() == 0


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 30)), min_size=1, max_size=30), st.integers(1, 5))
def test_group_cuts_equal_cuts_over_all_groups(pairs, shards):
    groups = np.array([(c, k, k, s, 1) for k, (c, s) in enumerate(sorted(pairs))])
    units = np.array([(c, *groups[groups[:, 0] == c][0, 1:3], groups[groups[:, 0] == c][:, 3].sum(), (groups[:, 0] == c).sum()) for c in np.unique(groups[:, 0])])
    got = sharding.group_cuts(units, int(groups[:, 3].max()), shards, lambda chosen: groups[np.isin(groups[:, 0], chosen)])
    want = sharding.cuts(groups[:, 3], shards)
    assert [k if c < 4 else len(groups) for c, k, _ in got] == want.tolist()


def test_cuts_fall_between_groups_of_a_cell(frame, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_BITS", 2)
    rows = [(i, f"t{i % 300}" * (1 + i % 7)) for i in range(600)]
    got = sharding.shard_documents(frame(rows), shards=10).toPandas()
    got["text"] = got.doc_id.map(dict(rows))
    assert len(got) == 600 and got.groupby("text").shard.nunique().max() == 1
    assert got.groupby("shard")["size"].sum().max() <= got["size"].sum() / 10 + got.groupby("text")["size"].sum().max()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_whole_table_has_the_least_capacity_over_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.shard_documents(docs).toPandas()
    h = ["xxhash64(text) AS h", "xxhash64(1, text) AS h2", "shiftrightunsigned(xxhash64(text), 47) AS cell"]
    rows = docs.selectExpr("octet_length(text) + 16 AS size", *h).groupBy("cell", "h", "h2").sum("size").toPandas().sort_values(["cell", "h", "h2"])
    sizes = rows["sum(size)"].tolist()

    def fits(capacity):
        used, shards = 0, 1
        for x in sizes:
            if x > capacity:
                return False
            if used + x > capacity:
                used, shards = 0, shards + 1
            used += x
        return shards <= 40

    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    assert got.groupby("shard")["size"].sum().max() == low


def test_very_long_text(frame):
    rows = [(0, "é" * 1_500_000), *[(i, f"text {i}") for i in range(1, 40)]]
    got = sharding.shard_documents(frame(rows), shards=5).toPandas()
    long = got[got.doc_id == 0].iloc[0]
    assert long["size"] == 3_000_016 and long.text_crc32 == zlib.crc32(rows[0][1].encode()) and (got.shard == long.shard).sum() < 40
