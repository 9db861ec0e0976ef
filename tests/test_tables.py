import json

import pytest
from pyspark.sql import functions as F

from plenum.operators import charts, slices
from plenum.plans import views
from plenum.sources import tables


def test_load_all_keeps_na_as_a_name(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"1": {"current_group": ["NA", "NI"], "country": "c"}, "2": {"current_group": "PPE"}, "3": {"current_group": "NA"}}))
    (tmp_path / "v.json").write_text(json.dumps({"v1": {"title": "a", "ts": 1.0}}))
    (tmp_path / "x.csv").write_text("mep_id,group,v1,v2\n1,\"[u'NA', u'NI']\",1,\n2,NA,,-1\n")
    schema = "mep_id string, group string, v1 int, v2 int"
    members, votes, wide, groups = tables.load_all(spark, *(str(tmp_path / n) for n in ("m.json", "v.json", "x.csv")), "current_group string, country string", "title string, ts double", schema)
    assert [r.group for r in groups.orderBy("first_pos").collect()] == ["NA", "PPE"]
    assert sorted(map(tuple, wide.collect())) == [("1", "NA", 1, None), ("2", "NA", None, -1)]
    assert members.count() == 3 and votes.first().title == "a"
    assert sorted(map(tuple, tables.melted(wide, ["mep_id", "group"]).collect())) == [("1", "NA", "v1", 1), ("2", "NA", "v2", -1)]


def test_exact_forms_of_written_json(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b", 2)], "k string, n int").coalesce(1)
    tables.write_keyed(rows, "k", str(tmp_path / "keyed"))
    tables.write_records(rows, str(tmp_path / "records"))
    text = lambda name: [x.value for x in spark.read.text(str(tmp_path / name)).collect()]
    assert text("keyed") == ['{"a":{"k":"a","n":null},"b":{"k":"b","n":2}}']
    assert text("records") == ['[{"k":"a","n":null},{"k":"b","n":2}]']
    assert json.loads(tables.pretty(rows).first().record) == {"k": "a"} and "\n" in tables.pretty(rows).first().record


def test_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([], "k string, n int")
    tables.write_records(rows, str(tmp_path / "r"))
    assert tables.read_records(spark, str(tmp_path / "r"), "k string, n int").count() == 0
    long = spark.createDataFrame([], "member long, event string, value int")
    members = spark.createDataFrame([(1, "g")], "member long, group string")
    got = slices.temporal_slice(long, views._events(long), members, F.lit("2000-01-01").cast("timestamp"), F.lit("2001-01-01").cast("timestamp"))
    assert [tuple(r) for r in got.collect()] == [(1, "g", 0, False)]


def test_slice_edges(spark):
    """Events on an edge are outside; exactly the threshold is not enough; members without responses have 0."""
    events = spark.createDataFrame([(f"e{k}", f"2000-01-{k + 1:02d}") for k in range(12)], "event string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    long = spark.createDataFrame([(1, "e1", 1), (2, "e1", 0), (2, "e2", -1), (3, "e0", 1), (3, "e11", 1), (4, "e3", None)], "member long, event string, value int")
    members = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5)], "member long")
    at = lambda x: F.lit(x).cast("timestamp")
    got = {r.member: (r.votes_count, r.kept) for r in slices.temporal_slice(long, events, members, at("2000-01-01"), at("2000-01-12")).collect()}
    assert got == {1: (1, False), 2: (2, True), 3: (0, False), 4: (0, False), 5: (0, False)}
    assert {r.member for r in slices.temporal_slice(long, events, members, at("2000-01-01"), at("2000-01-12"), 0.05).where("kept").collect()} == {1, 2}


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k long, v string")
    known = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(KeyError):
        slices.strict_join(rows, known, "k")
    assert slices.strict_join(rows.where("k = 1"), known, "k").count() == 1
    assert [tuple(r) for r in slices.nth_of_group(rows, "k", "v", 1).collect()] == [(2, "c")]
    got = rows.select(slices.constant_lookup(F.col("v"), {"a": "x"}), slices.constant_lookup(F.col("v"), {"a": "x"}, "y")).collect()
    assert [tuple(r) for r in got] == [("x", "x"), (None, "y"), (None, "y")]


def test_ordinals_over_cells(spark):
    rows = spark.range(0, 400_000, 7).withColumnRenamed("id", "k")
    got = slices.ordinals(rows, "k", "n")
    assert got.where("n <> k div 7").count() == 0 and got.count() == rows.count()


def test_dates_and_scales(spark):
    texts = spark.createDataFrame([("01 July 2014",), ("2014-07-01",), ("July 1, 2014",), ("1/7/2014",), ("no date",), (None,)], "t string")
    got = [r[0] for r in texts.select(F.unix_millis(tables.parse_date(F.col("t")))).collect()]
    assert got == [1404172800000] * 4 + [None, None]
    assert texts.limit(1).select(F.unix_millis(tables.parse_date(F.col("t"), "Europe/Brussels"))).first()[0] == 1404172800000 - 7_200_000
    one = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert {r.p for r in charts.linear_scale(one, "x", "p", 100.0).collect()} == {0.0}
    assert {r.p for r in charts.linear_scale(one, "x", "p", 100.0, inverted=True).collect()} == {100.0}


def test_legend_cycles_through_ten_colours(spark):
    got = charts.first_seen(spark.range(12).selectExpr("'g' || (11 - id) AS g", "id"), "g", "id").orderBy("place").collect()
    assert [r.g for r in got] == [f"g{11 - k}" for k in range(12)] and got[10].color == got[0].color == charts.TEN[0]
    assert [r.legend_y for r in got] == [20 * k for k in range(12)]


def test_tables_without_sql(spark, sf):
    scores = views.score_table(spark, sf).toPandas()
    assert {"member", "group", "country", "votes_count", "PCA0"} <= set(scores.columns) and scores.country.notna().all()
    flat, deep = (views.scatter_frames(spark, sf, is3d).collect() for is3d in (False, True))
    assert sum(len(r.member) for r in flat) == sum(len(r.PCA2) for r in deep) == len(scores) and "PCA2" not in flat[0]
    assert sorted(x for r in deep for x in r.PCA1) == sorted(scores.PCA1)
    ranked = views.ranked_events(spark, sf, trees=8).toPandas()
    assert list(ranked["rank"]) == list(range(20)) and ranked.importance.is_monotonic_decreasing and (ranked.spread >= 0).all() and ranked.title.str.startswith("Votes of").all()
