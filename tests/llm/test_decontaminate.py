import hashlib
import re

import duckdb

from plenum.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(10, len(v))
            wins = {tuple(v[s : s + size]) for s in range(max(1, len(v) - 9))} if v else set()
            for s in range(len(w) - size + 1):
                if v and tuple(w[s : s + size]) in wins:
                    hit |= set(range(s, s + size))
                    if item is not None:
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_sql_on_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = D.decontaminate(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark")))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = got.toPandas()
    want = con.sql(D.ORACLE_SQL).df()[list(got.columns)]
    assert got.contaminated.any()
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, want.values.tolist()))


def test_against_brute_force(spark, frame, monkeypatch):
    long = " ".join(f"w{k % 37}" for k in range(3000))
    twelve = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, twelve), (2, "Short item, here!"), (2, "Short item, here!"), (3, None), (4, ""), (5, " ".join(f"w{k}" for k in range(12))), (None, "null item words"), (10, twelve + " é"), (6, "solo")]
    docs = [(1, None), (2, ""), (3, "ONE two,three four five six seven eight nine ten"), (4, "one two three four five six seven eight nine"), (5, "x " + twelve + " " + twelve), (6, "a short ITEM here b short item here"), (7, long), (8, "null item words solo"), (8, "null item words solo"), (9, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(docs, ["rid", "w", "fp", "length", "k1"])
    assert rows(D.decontaminate(df, bench)) == slow(docs, items)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert rows(D.decontaminate(df, bench)) == slow(docs, items)
    assert rows(D.decontaminate(df, bench.limit(0))) == slow(docs, [])
    assert D.decontaminate(frame([]), bench).count() == 0
