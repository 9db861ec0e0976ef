import json

import numpy as np

from plenum import queries
from plenum.operators import matrix
from plenum.sources import ingest


def test_components_equal_svd(spark, sf):
    part = queries._slice(spark, sf)
    events = matrix.events_of(part)
    x = np.array([r.x for r in matrix.imputed(part, events).orderBy("member").collect()])
    c = x - x.mean(axis=0)
    _, s, v = np.linalg.svd(c, full_matrices=False)
    got = queries.pca_scores(spark, sf).orderBy("member").toPandas().drop(columns="member").to_numpy()
    k = got.shape[1]
    ratio = np.cumsum(s**2 / (s**2).sum())
    assert ratio[k - 1] > 0.6 and (k == 1 or ratio[k - 2] <= 0.6)
    assert np.allclose(np.abs(got), np.abs(c @ v[:k].T), atol=1e-6) and np.allclose(got.mean(axis=0), 0, atol=1e-9)
    coeff = queries.pca_loadings(spark, sf).toPandas().drop(columns="event").to_numpy()
    assert np.allclose((coeff**2).sum(axis=0), 1)


def test_importances(spark, sf):
    got = queries.event_importance(spark, sf).toPandas()
    assert len(got) == 20 and got.importance.is_monotonic_decreasing and list(got["rank"]) == list(range(20))


def test_wide_matrix_by_members_equals_svd(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-1, 2, (14, 60)).astype(float)
    long = spark.createDataFrame([(i, f"e{j:02d}", int(x[i, j])) for i in range(14) for j in range(60) if x[i, j] or rng.random() < 0.5], "member long, event string, value int")
    scores, loadings, variances = matrix.member_components(long, 0.6)
    c = x - x.mean(axis=0)
    u, s, v = np.linalg.svd(c, full_matrices=False)
    y = scores.orderBy("member").toPandas().drop(columns="member").to_numpy()
    w = loadings.orderBy("event").toPandas().drop(columns="event").to_numpy()
    k = y.shape[1]
    assert np.cumsum(s**2)[k - 1] > 0.6 * (s**2).sum() >= np.cumsum(s**2)[k - 2]
    assert np.allclose(variances, (s**2 / 13)[:k])
    assert np.allclose(np.abs(y), np.abs(c @ v[:k].T), atol=1e-8) and np.allclose(np.abs(w), np.abs(v[:k].T), atol=1e-8)
    assert np.allclose(y @ w.T, c @ v[:k].T @ v[:k], atol=1e-8) and (w[np.abs(w).argmax(axis=0), range(k)] > 0).all()
    empty = spark.createDataFrame([], "member long, event string, value int")
    assert matrix.member_components(empty, 0.6)[0].count() == 0


def test_more_events_than_the_covariance_takes(spark):
    rows = spark.range(300 * 3000).selectExpr("id div 3000 AS member", "'e' || (id % 3000) AS event", "cast(pmod(hash(id), 3) - 1 AS int) AS value")
    scores, loadings, variances = matrix.member_components(rows, 400)
    total = rows.groupBy("event").agg({"value": "var_samp"}).agg({"var_samp(value)": "sum"}).first()[0]
    assert scores.count() == 300 and loadings.count() == 3000 and abs(variances.sum() / total - 1) < 1e-9


def test_trees_find_what_the_target_is_made_of(spark):
    x = np.random.default_rng(0).integers(-1, 2, (300, 6)).astype(float)
    dense = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "member long, x array<double>")
    target = spark.createDataFrame([(k, float(3 * r[4] + r[1])) for k, r in enumerate(x)], "member long, PCA0 double")
    got = {r.event: (r.importance, r.spread) for r in matrix.tree_importances(dense, target, list("abcdef"), trees=12).collect()}
    assert sorted(got, key=lambda e: -got[e][0])[:2] == ["e", "b"] and abs(sum(v[0] for v in got.values()) - 1) < 1e-9
    assert got["e"][0] > 0.6 and all(0 <= v[1] < 0.5 for v in got.values())


def test_no_rows(spark):
    dense = spark.createDataFrame([], "member long, x array<double>")
    mean, cov = matrix.covariance(dense, 3)
    assert not cov.any() and matrix.components(cov, 0.6)[0].shape[1] == 3


def test_nested_members(spark, tmp_path):
    rows = [
        {"UserID": 1, "Name": {"family": "A", "sur": "a"}, "Groups": [{"groupid": "X", "end": "2010-01-01", "country": "c"}, {"groupid": ["NA", "NI"], "end": "9999-12-31", "country": "d"}], "Constituencies": [None, {"party": "p"}], "Birth": {"date": "1969-12-31T00:00:00"}},
        {"UserID": 2, "Groups": [], "Constituencies": [{"party": "q", "end": "2000-01-01"}, {"party": "r", "end": "2000-01-01"}]},
        {"UserID": 3},
    ]
    (tmp_path / "m.json").write_text(json.dumps(rows))
    got = {r.mep_id: r for r in ingest.member_summary(ingest.read_members(spark, str(tmp_path / "m.json"))).collect()}
    assert got["1"].current_group == "NA" and got["1"].country == "d" and got["1"].birthdate == -86400000.0
    assert got["1"].current_constituency is None and got["2"].current_constituency == "q"
    assert got["2"].current_group is None and got["3"].current_group is None and got["3"].name is None


def test_members_are_unique_by_last_record_over_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"UserID": 1, "Gender": "x"}, {"UserID": 1, "Gender": "y"}, {"UserID": 2, "Gender": "p"}]))
    (tmp_path / "b.json").write_text(json.dumps([{"UserID": 2, "Gender": "q"}]))
    (tmp_path / "c.json").write_text("[]")
    got = ingest.member_summary(ingest.read_members(spark, str(tmp_path)))
    assert {r.mep_id: r.gender for r in got.collect()} == {"1": "y", "2": "q"} and got.count() == 2


def test_nested_votes(spark, tmp_path):
    arm = lambda *ids: {"groups": [{"votes": [{"ep_id": i} for i in ids]}]}
    votes = [
        {"voteid": "v", "title": "old", "ts": "2015-01-01T00:00:00", "For": arm(1, 2)},
        {"voteid": "v", "title": "new", "ts": "2015-01-02T00:00:00", "Abstain": arm(1), "Against": arm(3)},
        {"voteid": "w", "ts": "bad", "For": arm(1), "Against": arm(1)},
        {"voteid": "z"},
    ]
    (tmp_path / "v.json").write_text(json.dumps(votes))
    raw = ingest.read_votes(spark, str(tmp_path / "v.json"))
    assert {(r.mep_id, r.voteid): r.value for r in ingest.responses(raw).collect()} == {("1", "v"): 0, ("2", "v"): 1, ("3", "v"): -1, ("1", "w"): -1}
    assert {r.voteid: (r.title, r.ts) for r in ingest.vote_summary(raw).collect()} == {"v": ("new", 1420156800000.0), "w": (None, None), "z": (None, None)}


def test_matrix_holds_every_event_and_response(spark, sf):
    long = queries.response_long(spark, sf).toPandas()
    got = queries.QUERIES["response_matrix_full"](spark, sf).toPandas().set_index("member").drop(columns="group")
    assert sorted(got.columns) == sorted(long.event.unique()) and long.event.str[:4].nunique() > 1
    cells = got.stack().dropna().astype(int)
    assert cells.to_dict() == {(r.member, r.event): r.value for r in long.itertuples()}


def test_all_events_beyond_the_covariance_bound(spark):
    long = spark.range(matrix.MAX_EVENTS + 1).selectExpr("id % 3 AS member", "'e' || id AS event", "1 AS value")
    assert len(matrix.all_events(long)) == matrix.MAX_EVENTS + 1


def test_trees_grow_beyond_depth_8(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    models, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: models.append(fit(self, rows)) or models[-1])
    x = np.random.default_rng(0).integers(-1, 2, (2000, 12)).astype(float)
    dense = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "member long, x array<double>")
    target = spark.createDataFrame([(k, float(row @ np.arange(12))) for k, row in enumerate(x)], "member long, PCA0 double")
    matrix.importances(dense, target, [f"e{k}" for k in range(12)], trees=3)
    assert max(t.depth for t in models[0].trees) > 8
