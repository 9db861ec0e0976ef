"""The registered queries of the response-matrix operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators import matrix
from plenum.scratch import staged

#: Links to notebooks, and what replaces them.
LINK = r"\[([^\]]*)\]\(([^)]*)\.ipynb\)"
LINK_TO = "[$1]($2.html)"
#: The slice of the registered queries: months strictly between, and the share of events that is not enough.
START, END, THRESHOLD = "1996-06", "1998-07", 0.1

def response_long(spark: SparkSession, d: str) -> DataFrame:
    """One response per member and event; the last record wins, -1 over 0 over 1 inside a record."""
    line, orders = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("lineitem", "orders"))
    flag = F.col("l_returnflag")
    rows = line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("member"),
        F.date_format("l_shipdate", "yyyy-MM").alias("event"),
        F.col("l_orderkey").alias("idx"),
        F.when(flag == "A", 1).when(flag == "R", 2).otherwise(0).alias("prec"),
        F.when(flag == "A", 1).when(flag == "R", -1).otherwise(0).alias("value"),
    )
    rows = rows.withColumn("prec", F.when(F.col("value") == 0, 0).otherwise(F.col("prec")))
    return rows.groupBy("member", "event").agg(F.max_by("value", F.struct("idx", "prec")).alias("value"))


def temporal_slice(spark: SparkSession, d: str, start: str = START, end: str = END, threshold: float = THRESHOLD) -> DataFrame:
    """Members with more than ``threshold`` of the events inside an open time range, by month."""
    return _active(spark, d, response_long(spark, d), start, end, threshold)


def _between(long: DataFrame, start: str, end: str) -> DataFrame:
    return long.where((F.col("event") > start) & (F.col("event") < end))


def _active(spark: SparkSession, d: str, long: DataFrame, start: str, end: str, threshold: float) -> DataFrame:
    part = _between(long, start, end)
    events = part.agg(F.countDistinct("event").alias("n"))
    counts = part.groupBy("member").agg(F.count("value").alias("votes_count"))
    kept = counts.crossJoin(F.broadcast(events)).where(F.col("votes_count") > F.col("n") * F.lit(threshold))  # one row of totals
    customer = spark.read.parquet(f"{d}/customer.parquet")
    return kept.join(customer, kept.member == customer.c_custkey).select("member", F.col("c_mktsegment").alias("group"), "votes_count")


def first_seen_groups(spark: SparkSession, d: str) -> DataFrame:
    customer = spark.read.parquet(f"{d}/customer.parquet")
    return customer.groupBy(F.col("c_mktsegment").alias("group")).agg(F.min("c_custkey").alias("first_pos"))


LONG = """SELECT o_custkey AS member, strftime(l_shipdate, '%Y-%m') AS event,
CAST(arg_max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 ELSE 0 END,
  {'i': l_orderkey, 'p': CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 0 END}) AS INTEGER) AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""

QUERIES = {"response_long": response_long, "temporal_slice": temporal_slice, "first_seen_groups": first_seen_groups}
ORACLE_SQL = {
    "response_long": LONG,
    "temporal_slice": f"""WITH p AS (SELECT * FROM ({LONG}) WHERE event > '1996-06' AND event < '1998-07'),
c AS (SELECT member, count(value) AS votes_count FROM p GROUP BY member)
SELECT member, c_mktsegment AS "group", votes_count FROM c JOIN customer ON member = c_custkey
WHERE votes_count > (SELECT count(DISTINCT event) FROM p) * 0.1""",
    "first_seen_groups": 'SELECT c_mktsegment AS "group", min(c_custkey) AS first_pos FROM customer GROUP BY 1',
}


def latest_affiliation(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet")
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    return orders.groupBy(F.col("o_custkey").alias("member")).agg(latest.alias("current_group"))


def country_highlight(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("customer", "nation"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("member"), F.col("n_name").alias("country"), F.when(F.col("n_nationkey") == 0, "selected").otherwise("other").alias("style")
    )


def sample_window(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name").orderBy("c_custkey").offset(55).limit(5)


def props_extract(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


QUERIES |= {"latest_affiliation": latest_affiliation, "country_highlight": country_highlight, "sample_window": sample_window, "props_extract": props_extract}
ORACLE_SQL |= {
    "latest_affiliation": "SELECT o_custkey AS member, arg_max(o_orderpriority, {'d': o_orderdate, 'k': o_orderkey}) AS current_group FROM orders GROUP BY 1",
    "country_highlight": "SELECT c_custkey AS member, n_name AS country, CASE WHEN n_nationkey = 0 THEN 'selected' ELSE 'other' END AS style FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "sample_window": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5 OFFSET 55",
    "props_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
}


def epoch_seconds(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))


def response_counts(spark: SparkSession, d: str) -> DataFrame:
    """Responses per event, each value counted: the profile of the matrix by column."""
    value = F.col("value")
    return response_long(spark, d).groupBy("event").agg(F.count_if(value == 1).alias("n_for"), F.count_if(value == -1).alias("n_against"), F.count_if(value == 0).alias("n_abstain"))


QUERIES |= {"epoch_seconds": epoch_seconds, "response_counts": response_counts}
ORACLE_SQL |= {
    "epoch_seconds": "SELECT event_id, epoch_us(ts) // 1000000 AS seconds FROM events",
    "response_counts": f"SELECT event, count(*) FILTER (value = 1) AS n_for, count(*) FILTER (value = -1) AS n_against, count(*) FILTER (value = 0) AS n_abstain FROM ({LONG}) GROUP BY 1",
}


def _slice(spark: SparkSession, d: str, start: str = START, end: str = END, threshold: float = THRESHOLD) -> DataFrame:
    """Responses of the members and events that the slice keeps."""
    long = staged(_between(response_long(spark, d), start, end), "responses")
    return long.join(_active(spark, d, long, start, end, threshold).select("member"), "member", "left_semi")


def response_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Every member, one column per month of 1996, null where there is no response."""
    months = [f"1996-{m:02d}" for m in range(1, 13)]
    wide = matrix.pivot(response_long(spark, d).where("event >= '1996-01' and event <= '1996-12'"), months)
    customer = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("group"))
    return customer.join(wide, "member", "left").select("member", "group", *(F.col(f"`{m}`").alias("m" + m[5:]) for m in months))


def response_matrix_full(spark: SparkSession, d: str) -> DataFrame:
    """Every member, one column per event of the table, null where there is no response."""
    long = staged(response_long(spark, d), "responses")
    wide = matrix.pivot(long, matrix.all_events(long))
    customer = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("group"))
    return customer.join(wide, "member", "left")


def participation_profile(spark: SparkSession, d: str) -> DataFrame:
    """Marker size 1 to 9 and per cent of the highest participation, per member of the slice."""
    counts = temporal_slice(spark, d).select("member", "votes_count")
    ends = counts.agg(F.min("votes_count").alias("lo"), F.max("votes_count").alias("hi"))  # one row
    c, lo, hi = F.col("votes_count"), F.col("lo"), F.col("hi")
    size = F.round(1 + F.coalesce(F.try_divide(8.0 * (c - lo), hi - lo), F.lit(0.0)), 6)
    return counts.crossJoin(F.broadcast(ends)).select("member", "votes_count", size.alias("size"), F.round(100.0 * c / hi, 6).alias("percent"))


def group_traces(spark: SparkSession, d: str) -> DataFrame:
    rows = temporal_slice(spark, d)
    return rows.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.min("votes_count").alias("least"), F.max("votes_count").alias("most"))


def event_covariance(spark: SparkSession, d: str) -> DataFrame:
    """Sample covariance of every two events over the slice, missing responses as 0."""
    part = staged(_slice(spark, d), "slice")
    events = matrix.events_of(part)
    _, cov = matrix.covariance(matrix.imputed(part, events), len(events))
    rows = [(a, b, round(float(cov[i, j]), 6)) for i, a in enumerate(events) for j, b in enumerate(events)]
    return spark.createDataFrame(rows, "event_a string, event_b string, cov double")


def _components(spark: SparkSession, d: str):
    part = staged(_slice(spark, d), "slice")
    events = matrix.events_of(part)
    dense = staged(matrix.imputed(part, events), "dense")
    mean, cov = matrix.covariance(dense, len(events))
    loadings, ratio = matrix.components(cov, 0.6)
    return events, dense, mean, loadings, ratio


def pca_scores(spark: SparkSession, d: str) -> DataFrame:
    _, dense, mean, loadings, _ = _components(spark, d)
    return matrix.scores(dense, mean, loadings)


def pca_loadings(spark: SparkSession, d: str) -> DataFrame:
    events, _, _, loadings, _ = _components(spark, d)
    names = ", ".join(f"pca{k}_coeff double" for k in range(len(loadings)))
    return spark.createDataFrame([(e, *map(float, loadings[:, i])) for i, e in enumerate(events)], f"event string, {names}")


def event_importance(spark: SparkSession, d: str) -> DataFrame:
    """The 20 events that a forest of extremely random trees uses most for the first component."""
    events, dense, mean, loadings, _ = _components(spark, d)
    found = matrix.tree_importances(dense, matrix.scores(dense, mean, loadings[:1]), events)
    top = [(k, r.event, r.importance) for k, r in enumerate(found.orderBy(F.desc("importance"), "event").limit(20).collect())]
    return spark.createDataFrame(top, "rank int, event string, importance double")


def link_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Notebook links to page links, in texts built from the nations' names."""
    cells = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", F.concat(F.lit("see ["), "n_name", F.lit("](a.ipynb) or [b](b.html)")).alias("source"))
    return cells.select("n_nationkey", F.regexp_replace("source", LINK, LINK_TO).alias("source"))


SLICE = f"""p AS (SELECT * FROM ({LONG}) WHERE event > '1996-06' AND event < '1998-07'),
kept AS ({ORACLE_SQL["temporal_slice"].replace("WITH p AS", "WITH q AS").replace("FROM p", "FROM q")})"""
QUERIES |= {f.__name__: f for f in (response_matrix, response_matrix_full, participation_profile, group_traces, event_covariance, pca_scores, pca_loadings, event_importance, link_rewrite)}
ORACLE_SQL |= {
    "response_matrix": f"""SELECT c_custkey AS member, any_value(c_mktsegment) AS "group",
{", ".join(f"max(value) FILTER (event = '1996-{m:02d}') AS m{m:02d}" for m in range(1, 13))}
FROM customer LEFT JOIN ({LONG}) ON member = c_custkey GROUP BY c_custkey""",
    "response_matrix_full": f"""SELECT c_custkey AS member, c_mktsegment AS "group", w.* EXCLUDE (member)
FROM customer LEFT JOIN (PIVOT ({LONG}) ON event USING max(value) GROUP BY member) w ON member = c_custkey""",
    "participation_profile": f"""WITH {SLICE} SELECT member, votes_count,
round(1 + coalesce(8.0::DOUBLE * (votes_count - lo) / nullif(hi - lo, 0), 0), 6) AS size, round(100.0::DOUBLE * votes_count / hi, 6) AS percent
FROM kept, (SELECT min(votes_count) AS lo, max(votes_count) AS hi FROM kept)""",
    "group_traces": f'WITH {SLICE} SELECT "group", count(*) AS members, min(votes_count) AS least, max(votes_count) AS most FROM kept GROUP BY 1',
    "event_covariance": f"""WITH {SLICE}, r AS (SELECT p.* FROM p SEMI JOIN kept USING (member)), n AS (SELECT count(DISTINCT member)::DOUBLE AS n FROM r),
s AS (SELECT event, sum(value)::DOUBLE AS s FROM r GROUP BY 1),
x AS (SELECT a.event AS ea, b.event AS eb, sum(a.value * b.value)::DOUBLE AS xy FROM r a JOIN r b USING (member) GROUP BY 1, 2)
SELECT a.event AS event_a, b.event AS event_b, round((coalesce(xy, 0) - a.s * b.s / n) / (n - 1), 6) AS cov
FROM s a CROSS JOIN s b CROSS JOIN n LEFT JOIN x ON ea = a.event AND eb = b.event""",
    "link_rewrite": r"""SELECT n_nationkey, regexp_replace('see [' || n_name || '](a.ipynb) or [b](b.html)', '\[([^\]]*)\]\(([^)]*)\.ipynb\)', '[\1](\2.html)', 'g') AS source FROM nation""",
}
