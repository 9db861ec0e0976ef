"""Registered queries of slices, lookups, chart tables, readers and writers, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum import queries as base
from plenum.operators import charts, matrix, slices
from plenum.queries import LONG, ORACLE_SQL as CORE_SQL, SLICE, response_long
from plenum.scratch import scratch_dir, staged
from plenum.sources import tables

START, END, THRESHOLD = "1996-06-01", "1998-07-01", 0.1
#: Colours of three segments; the others have none.
COLORS = dict(zip(("BUILDING", "MACHINERY", "HOUSEHOLD"), charts.GROUP_COLORS.values()))
AMOUNTS = [("A", 28), ("B", 55), ("C", 43), ("D", 91), ("E", 81), ("F", 53), ("G", 19), ("H", 87)]
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _members(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("group"))


def _events(long: DataFrame) -> DataFrame:
    return long.select("event").distinct().withColumn("ts", F.to_timestamp(F.concat("event", F.lit("-01"))))


def _path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/plenum/{name}-{uuid.uuid4().hex}"


def _slice(spark: SparkSession, d: str, start: str, end: str, threshold: float) -> DataFrame:
    long = staged(response_long(spark, d), "responses")
    return slices.temporal_slice(long, _events(long), _members(spark, d), F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), threshold)


SLICED = f"""WITH l AS ({LONG}),
e AS (SELECT DISTINCT event FROM l WHERE CAST(event || '-01' AS TIMESTAMP) > TIMESTAMP '{START}' AND CAST(event || '-01' AS TIMESTAMP) < TIMESTAMP '{END}'),
c AS (SELECT member, count(value) AS n FROM l SEMI JOIN e USING (event) GROUP BY 1),
s AS (SELECT c_custkey AS member, c_mktsegment AS "group", coalesce(n, 0) AS votes_count, coalesce(n, 0) > (SELECT count(*) FROM e) * {THRESHOLD} AS kept
  FROM customer LEFT JOIN c ON member = c_custkey)"""


@query(f"{SLICED} SELECT * FROM s")
def slice_members(spark: SparkSession, d: str, start: str = START, end: str = END, threshold: float = THRESHOLD) -> DataFrame:
    """Every member's number of responses in an open time range, and whether it has enough."""
    return _slice(spark, d, start, end, threshold)


@query("SELECT o_orderkey, epoch_ms(date_trunc('day', o_orderdate)) AS ms FROM orders")
def parsed_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in four ways, read back as epoch milliseconds."""
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "d MMMM yyyy")).when(k == 2, F.date_format(day, "MMMM d, yyyy")).otherwise(F.date_format(day, "d/M/yyyy"))
    return _read(spark, d, "orders").select("o_orderkey", F.unix_millis(tables.parse_date(text)).alias("ms"))


@query(f"SELECT event, 'Votes of ' || event AS title, count(*) AS responses FROM ({LONG}) GROUP BY 1")
def event_details(spark: SparkSession, d: str) -> DataFrame:
    """Events with their titles and numbers of responses."""
    long = staged(response_long(spark, d), "responses")
    titles = _events(long).select("event", F.concat(F.lit("Votes of "), "event").alias("title"))
    return long.groupBy("event").agg(F.count(F.lit(1)).alias("responses")).join(titles, "event").select("event", "title", "responses")


@query("SELECT event_id, c_name AS name FROM events JOIN customer ON CAST(user_id AS VARCHAR) = CAST(c_custkey AS VARCHAR)")
def member_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Names of users by the text of their id."""
    names = _read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return _read(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("id")).join(names, "id").select("event_id", "name")


@query("SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def last_records(spark: SparkSession, d: str) -> DataFrame:
    """The last order of each customer, whole."""
    rows = _read(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    return slices.last_records(rows, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT o_custkey AS member, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 13) GROUP BY 1")
def orphan_responses(spark: SparkSession, d: str) -> DataFrame:
    """Members of responses that a part of the member table lacks."""
    known = _read(spark, d, "customer").where("c_nationkey < 13").select(F.col("c_custkey").alias("member"))
    return slices.orphans(_read(spark, d, "orders").select(F.col("o_custkey").alias("member")), known, "member")


@query(f"""SELECT c_custkey AS member, event, coalesce(value, 0) AS value FROM customer CROSS JOIN (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS event FROM lineitem) e
LEFT JOIN ({LONG}) l ON l.member = c_custkey AND l.event = e.event""".replace("AS member, event,", "AS member, e.event,"))
def dense_grid(spark: SparkSession, d: str) -> DataFrame:
    """A cell for every member and event, 0 where there is no response."""
    long = staged(response_long(spark, d), "responses")
    return slices.dense_grid(long, _members(spark, d), matrix.all_events(long))


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS ordinal FROM customer")
def row_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return slices.ordinals(_read(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", "ordinal")


@query("""SELECT c_mktsegment AS "group", c_custkey AS member, 'https://example.org/' || c_custkey AS url FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) = 4""")
def clicked_member(spark: SparkSession, d: str, place: int = 3) -> DataFrame:
    """The page of the point that was clicked: the member of that place in its group."""
    row = slices.nth_of_group(_members(spark, d), "group", "member", place)
    return row.select("group", "member", F.concat(F.lit("https://example.org/"), F.col("member").cast("string")).alias("url"))


@query("SELECT c_custkey AS member, CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLORS.items()) + " END AS color FROM customer")
def group_colors(spark: SparkSession, d: str) -> DataFrame:
    return _members(spark, d).select("member", slices.constant_lookup(F.col("group"), COLORS).alias("color"))


@query(f"""SELECT "group", k AS place, {list(charts.TEN)}[k % 10 + 1] AS color, k * 20 AS legend_y
FROM (SELECT c_mktsegment AS "group", CAST(row_number() OVER (ORDER BY min(c_custkey)) - 1 AS INTEGER) AS k FROM customer GROUP BY 1)""")
def legend(spark: SparkSession, d: str) -> DataFrame:
    """Groups by first appearance with an ordinal colour and a place in the legend."""
    return charts.first_seen(_members(spark, d), "group", "member")


@query("""SELECT a.g AS selected, b.g AS "group", CASE WHEN a.g = b.g THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END AS opacity
FROM (SELECT DISTINCT c_mktsegment AS g FROM customer) a CROSS JOIN (SELECT DISTINCT c_mktsegment AS g FROM customer) b""")
def opacity_matrix(spark: SparkSession, d: str) -> DataFrame:
    return charts.opacity(_members(spark, d), "group")


@query("""SELECT s.n_name AS selected, c_custkey AS member, CASE WHEN s.n_nationkey = c_nationkey THEN CASE c_mktsegment """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLORS.items()) + """ END ELSE 'rgba(0,0,0,0.1)' END AS color,
CASE WHEN s.n_nationkey = c_nationkey THEN 'black' ELSE 'transparent' END AS line FROM customer CROSS JOIN nation s""")
def country_styles(spark: SparkSession, d: str) -> DataFrame:
    nation = _read(spark, d, "nation")
    rows = _read(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # the countries
    rows = rows.select(F.col("c_custkey").alias("member"), F.col("n_name").alias("country"), F.col("c_mktsegment").alias("group"))
    return charts.country_styles(rows, [r.n_name for r in nation.select("n_name").collect()], slices.constant_lookup(F.col("group"), COLORS))


@query("""SELECT 'c_acctbal' AS name, min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer
UNION ALL SELECT 'c_custkey', CAST(min(c_custkey) AS DOUBLE), CAST(max(c_custkey) AS DOUBLE) FROM customer""")
def axis_ranges(spark: SparkSession, d: str) -> DataFrame:
    return charts.extent(_read(spark, d, "customer"), ["c_acctbal", "c_custkey"])


@query("""SELECT c_custkey AS member, round((c_acctbal - a) / (b - a) * 540, 6) AS x, round((1 - (c_custkey - p)::DOUBLE / (q - p)::DOUBLE) * 350, 6) AS y
FROM customer, (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b, min(c_custkey) AS p, max(c_custkey) AS q FROM customer)""")
def pixel_positions(spark: SparkSession, d: str) -> DataFrame:
    """Points of a scatter in pixels, the vertical axis upwards."""
    rows = _read(spark, d, "customer").select(F.col("c_custkey").alias("member"), "c_acctbal")
    return charts.linear_scale(charts.linear_scale(rows, "c_acctbal", "x", 540.0), "member", "y", 350.0, inverted=True).select("member", "x", "y")


@query(f"""{SLICED} SELECT "group", member // 4096 AS part, string_agg(member, ',' ORDER BY member) AS members, string_agg(votes_count, ',' ORDER BY member) AS counts
FROM s WHERE kept GROUP BY 1, 2""")
def group_frames(spark: SparkSession, d: str) -> DataFrame:
    """The traces of a scatter: each group's members and counts as lists."""
    points = charts.traces(slice_members(spark, d).where("kept"), "group", "member", ["votes_count"])
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return points.select("group", "part", text("member").alias("members"), text("votes_count").alias("counts"))


@query(f"""{SLICED} SELECT member, printf('<b>%s %s</b><br>%.2f %%<br>%s', c_name, "group", 100.0::DOUBLE * votes_count / (SELECT max(votes_count) FROM s), 'member ' || member) AS text
FROM s JOIN customer ON member = c_custkey""")
def hover_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = staged(slice_members(spark, d), "slice")
    top = rows.agg(F.max("votes_count").alias("top"))  # one row
    names = _read(spark, d, "customer").select(F.col("c_custkey").alias("member"), "c_name")
    line = F.concat(F.lit("member "), F.col("member").cast("string"))
    return rows.join(names, "member").crossJoin(F.broadcast(top)).select("member", charts.hover_text(F.col("c_name"), F.col("group"), 100.0 * F.col("votes_count") / F.col("top"), line).alias("text"))


_CELL = "CASE n_nationkey % 2 WHEN 0 THEN 'markdown' ELSE 'code' END"


@query(rf"""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN regexp_replace(s, '\[([^\]]*)\]\(([^)]*)\.ipynb\)', '[\1](\2.html)', 'g') ELSE s END AS source
FROM (SELECT n_nationkey, 'see [' || n_name || '](a.ipynb)' AS s FROM nation)""")
def cell_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Links rewritten in cells of text; cells of code stay."""
    text = F.concat(F.lit("see ["), "n_name", F.lit("](a.ipynb)"))
    return _read(spark, d, "nation").select("n_nationkey", charts.rewritten_cell(F.expr(_CELL), text, base.LINK, base.LINK_TO).alias("source"))


@query("SELECT n_nationkey, NOT (n_nationkey % 2 = 0 OR n_nationkey % 3 = 0) AS input, NOT (n_nationkey % 5 = 0) AS output FROM nation")
def shown_cells(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("n_nationkey")
    shown, output = charts.visible(key % 2 == 0, key % 5 == 0, key % 3 == 0)
    return _read(spark, d, "nation").select("n_nationkey", shown.alias("input"), output.alias("output"))


@query("""SELECT c_custkey AS member, c_mktsegment AS "group" FROM customer WHERE c_mktsegment = 'BUILDING'""")
def group_members(spark: SparkSession, d: str, group: str = "BUILDING") -> DataFrame:
    return _members(spark, d).where(F.col("group") == group)


@query(f"""SELECT * EXCLUDE (k)
FROM (SELECT member AS k, {", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in ("member", '"group"', *(f"m{m:02d}" for m in range(1, 9))))}
FROM ({CORE_SQL["response_matrix"]})) ORDER BY k LIMIT 5 OFFSET 55""")
def matrix_window(spark: SparkSession, d: str) -> DataFrame:
    """Ten columns of five rows of the matrix as a display shows them, missing cells blank."""
    wide = base.response_matrix(spark, d)
    return tables.as_text(wide.select(*wide.columns[:10]).orderBy("member").offset(55).limit(5))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_nationkey, n_name, n_regionkey FROM nation")
def keyed_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table written as keyed JSON and read back."""
    rows, path = _read(spark, d, "nation"), _path(spark, "keyed")
    tables.write_keyed(rows, "n_nationkey", path)
    return tables.read_keyed(spark, path, "n_nationkey int, n_name string, n_regionkey int", "id")


@query("SELECT r_regionkey, r_name FROM region")
def records_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table written as JSON arrays of records and read back."""
    rows, path = _read(spark, d, "region"), _path(spark, "records")
    tables.write_records(rows, path)
    return tables.read_records(spark, path, "r_regionkey int, r_name string")


def _marked(wide: DataFrame) -> DataFrame:
    group = F.col("group")
    return wide.withColumn("group", F.when(group == "BUILDING", tables.UNATTACHED[0]).when(group == "MACHINERY", "NA").otherwise(group))


@query(f"""SELECT * REPLACE (CASE WHEN "group" IN ('BUILDING', 'MACHINERY') THEN 'NA' ELSE "group" END AS "group") FROM ({CORE_SQL["response_matrix_full"]})""")
def matrix_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The matrix written as CSV and read back; groups given as a list's text are one name, and a group NA is a name."""
    wide, path = staged(_marked(base.response_matrix_full(spark, d)), "matrix"), _path(spark, "matrix-csv")
    tables.write_matrix(wide, path)
    return tables.read_matrix(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema))


@query(f"""SELECT l.member, c_mktsegment AS "group", event, value FROM ({LONG}) l JOIN customer ON c_custkey = l.member""")
def matrix_melted(spark: SparkSession, d: str) -> DataFrame:
    """The long form again, from the wide matrix."""
    return tables.melted(base.response_matrix_full(spark, d), ["member", "group"])


@query("SELECT CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name}) AS VARCHAR) AS record FROM nation ORDER BY n_nationkey LIMIT 1")
def first_record(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "nation").orderBy("n_nationkey").limit(1)
    return rows.select(F.to_json(F.struct("n_nationkey", "n_name")).alias("record"))


@query('SELECT c_custkey AS member, c_mktsegment AS "group" FROM customer ORDER BY c_custkey LIMIT 10')
def head_rows(spark: SparkSession, d: str, limit: int = 10) -> DataFrame:
    return _members(spark, d).orderBy("member").limit(limit)


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', {n})" for c, n in AMOUNTS) + ") t(category, amount)")
def inline_table(spark: SparkSession, d: str) -> DataFrame:
    return tables.literal(spark, AMOUNTS, "category string, amount int")


_TRACE = CORE_SQL["event_covariance"].replace("round((coalesce(xy, 0) - a.s * b.s / n) / (n - 1), 6) AS cov", "(coalesce(xy, 0) - a.s * b.s / n) / (n - 1) AS cov")
_TOTAL = f"SELECT round(sum(cov), 4) AS variance FROM ({_TRACE}) WHERE event_a = event_b"


@query(_TOTAL)
def pca_variance(spark: SparkSession, d: str) -> DataFrame:
    """The variances of all components, added up: the events' total variance."""
    part = staged(base._slice(spark, d), "slice")
    events = matrix.events_of(part)
    _, cov = matrix.covariance(matrix.imputed(part, events), len(events))
    loadings, ratio = matrix.components(cov, len(events))
    return spark.createDataFrame([(round(float(((loadings @ cov) * loadings).sum()), 4),)], "variance double")


@query(f"""WITH {SLICE}, r AS (SELECT p.* FROM p SEMI JOIN kept USING (member)), n AS (SELECT count(DISTINCT event) AS n FROM r)
SELECT round(sum((q - s * s / n) / (n - 1)), 3) AS variance FROM (SELECT member, sum(value)::DOUBLE AS s, sum(value * value)::DOUBLE AS q FROM r GROUP BY 1), n""")
def wide_variance(spark: SparkSession, d: str) -> DataFrame:
    """The variances of all components of the matrix laid on its side, which is far wider than long, by products of its rows."""
    part = base._slice(spark, d).select(F.col("event").alias("member"), F.col("member").cast("string").alias("event"), "value")
    _, loadings, variances = matrix.member_components(staged(part, "slice"), 10**6)
    return loadings.agg(F.round(sum(F.sum(F.col(f"`{c}`") ** 2) * float(v) for c, v in zip(loadings.columns[1:], variances)), 3).alias("variance"))


@query()
def score_table(spark: SparkSession, d: str) -> DataFrame:
    """Member, group, country, number of responses and scores."""
    nation = _read(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    country = _read(spark, d, "customer").select(F.col("c_custkey").alias("member"), "c_nationkey").join(F.broadcast(nation), "c_nationkey").drop("c_nationkey")
    kept = base.temporal_slice(spark, d).join(country, "member")
    return kept.select("member", "group", "country", "votes_count").join(base.pca_scores(spark, d), "member")


@query()
def scatter_frames(spark: SparkSession, d: str, is3d: bool = True) -> DataFrame:
    """Each group's points in the first two or three components, as arrays."""
    scores = staged(score_table(spark, d), "scores")
    axes = [c for c in ("PCA0", "PCA1", "PCA2")[: 3 if is3d else 2] if c in scores.columns]
    return charts.traces(scores, "group", "member", axes)


@query()
def ranked_events(spark: SparkSession, d: str, trees: int = 100) -> DataFrame:
    """The 20 events that extremely random trees use most for the first component, with titles and the spread over trees."""
    events, dense, mean, loadings, _ = base._components(spark, d)
    found = matrix.tree_importances(dense, matrix.scores(dense, mean, loadings[:1]), events, trees)
    top = found.orderBy(F.desc("importance"), "event").limit(20).agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("_m"), "event", "importance", "spread"))).alias("_all"))
    top = top.select(F.posexplode("_all").alias("rank", "_r")).select("rank", "_r.event", "_r.importance", "_r.spread")  # 20 rows
    return top.withColumn("title", F.concat(F.lit("Votes of "), "event"))
