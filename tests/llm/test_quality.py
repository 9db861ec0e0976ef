import re
from collections import Counter
from math import comb

import pytest

from plenum.llm import quality as Q


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    dup, seen = 0, set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    wins = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(wins)
    inside = {k + d for k, w in enumerate(wins) if often[w] > 1 for d in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), len(lines), sum(c.isupper() for c in text)


def test_binomial_tail_and_certificate():
    for k, n, p in ((0, 100, 0.02), (3, 50, 0.1), (10, 10, 0.5)):
        assert abs(Q.binomial_tail(k, n, p) - sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) < 1e-12
    assert Q.certified({500: 0, 400: 0, 300: 9}, 1000, (500, 400, 300), 0.02, 0.001) == 400
    assert Q.certified({500: 0}, 10, (500,), 0.02, 0.001) is None


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality(docs, labels).toPandas().set_index("doc_id")
    # all again, plainly: counts of whole texts, cutoffs of every language, verdicts
    rows = {r.doc_id: (r.lang, dict(zip([*Q.COUNTS, *Q.MORE], slow(r.text)))) for r in docs.collect()}
    failed = {i: c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for i, (_, c) in rows.items()}
    good = [i for i in {r.doc_id for r in labels.where("quality = 1").collect()} if i in rows and not failed[i]]
    langs = {rows[i][0] for i in good}
    above = lambda c, rule, cutoff: 1000 * c[Q.RULES[rule][0]] > cutoff * c[Q.RULES[rule][1]]
    chosen = {}
    for lang in langs:
        own = [rows[i][1] for i in good if rows[i][0] == lang]
        for rule, (_, _, grid) in Q.RULES.items():
            for cutoff in grid:
                k, n, p = sum(above(c, rule, cutoff) for c in own), len(own), Q.ALPHA / len(Q.RULES)
                if sum(comb(n, x) * p**x * (1 - p) ** (n - x) for x in range(k + 1)) > Q.DELTA / len(Q.RULES) / len(langs):
                    break
                chosen[lang, rule] = cutoff
    for i, (lang, c) in rows.items():
        r = got.loc[i]
        assert all(r[name] == c[name] for name in Q.COUNTS) and r.base_failed == failed[i]
        assert r.kept == (not failed[i] and not any(above(c, rule, chosen[lang, rule]) for rule in Q.RULES if (lang, rule) in chosen))
    both = got.join(labels.toPandas().set_index("doc_id"), how="inner")
    passed = both[~both.base_failed]
    print("good kept", passed[passed.quality == 1].kept.mean(), "bad kept", passed[passed.quality == 0].kept.mean())
    assert passed[passed.quality == 1].kept.mean() > 0.95


def test_nulls_empties_and_clashing_names(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 0), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    df = frame([(1, None), (2, ""), (3, "a b c " * 40_000), (4, "x\n \nx\n"), (4, "x\n \nx\n"), (None, "q")], ["n_words", "kept", "quality", "_id"])
    got = Q.quality(df, labels).toPandas()
    assert len(got) == 6 and got.base_failed.all() and not got.kept.any()
    assert list(got[got.doc_id == 4].n_dup_lines) == [1, 1]
    assert Q.quality(frame([]), labels).count() == 0


@pytest.mark.parametrize("most", [Q.MOST, 0])
def test_every_stratum_has_cutoffs(spark, monkeypatch, most):
    monkeypatch.setattr(Q, "MOST", most)
    n, each = 1100, 40
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(i, text.upper() if i % each == 0 else text, None if i < each else f"s{i // each:04d}") for i in range(n * each)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % each > 0)) for i in range(n * each)], "doc_id long, quality int")
    got = Q.quality(docs, labels, alpha=0.9, delta=1.0).toPandas()
    assert len(got) == n * each and (got.kept == (got.doc_id % each > 0)).all()
