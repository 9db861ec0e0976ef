import corpus_pipeline
from plenum.llm import pii, simhash, toxicity
from test_decontaminate import slow as slow_hits
from test_packing import check
from test_pii import slow as slow_pii
from test_simhash import slow_components, slow_fingerprint


def test_stages_and_run_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    rows = {i: t for i, t in rows.items() if i not in toxic}
    ids = sorted(rows)
    least = slow_components(ids, [slow_fingerprint(rows[i].encode()) for i in ids])
    rows = {i: rows[i] for i, c in zip(ids, least) if c == i}
    hit = {r[0] for r in slow_hits(rows.items(), [(r.item_id, r.text) for r in bench.collect()]) if r[-1]}
    assert hit
    model = pii.train()
    rows = {i: pii.mask(t, pii.find(t, model)[1]) for i, t in rows.items() if i not in hit}
    assert not any(slow_pii(t) for t in rows.values())
    check(rows.items(), corpus_pipeline.run(spark, sf).toPandas())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in spark.read.parquet(f"{sf}/documents.parquet").schema]


def test_nulls_repeats_and_empty_tables(spark, sf, frame):
    df = frame([(1, None), (2, ""), (5, "a b c d e"), (5, "a b c d e"), (None, "f g h i j k")])
    left = df
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, sf)
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in left.collect()) == [-1, 1, 5]
    left = frame([])
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, sf)
    assert left.count() == 0


def test_columns_of_any_name_and_very_long_texts_pass(spark, sf, frame):
    long = "".join(f"word{k} of {k * k} things, " for k in range(60_000))
    df = frame([(1, long), (2, "x"), (3, None)], ["_row", "row", "toxic_score", "_toxic_score", "component_id", "contaminated"])
    left = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf)
        assert left.columns == df.columns
        assert {tuple(r)[5:] for r in left.collect()} == {("x",) * 6}
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3] and len(left.where("doc_id = 1").first().text) > 1_000_000
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sf)
    assert packed.where("doc_id = 1").count() > 50
