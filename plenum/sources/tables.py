"""Keyed JSON, record arrays, matrix CSV and literal tables: readers, writers, and the loader of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators.slices import last_records

#: Texts that stand for the group of the unattached.
UNATTACHED = ("[u'NA', u'NI']", "['NA', 'NI']", '["NA", "NI"]', '["NA","NI"]')
#: Date texts that are read, ISO first.
FORMATS = ("d MMMM yyyy", "MMMM d, yyyy", "d/M/yyyy", "d MMM yyyy", "yyyyMMdd")


def parse_date(text: Column, zone: str = "UTC") -> Column:
    """Timestamp of a date text: ISO or one of ``FORMATS``, null if none fits; local times are of ``zone``."""
    local = F.coalesce(F.try_to_timestamp(text), *(F.try_to_timestamp(text, F.lit(f)) for f in FORMATS))
    return local if zone == "UTC" else F.to_utc_timestamp(local, zone)


def one_name(group: Column) -> Column:
    """The group's name; lists of the unattached are ``NA``, which is a name and not a missing value."""
    return F.when(group.isin(*UNATTACHED), "NA").otherwise(group)


def read_keyed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Rows of a JSON object ``{key: record}``; one file is one cell, as such a file is one value."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", f"map<string, struct<{schema}>>")).alias("_key", "_record"))
    return pairs.select(F.col("_key").alias(key), "_record.*")


def write_keyed(rows: DataFrame, key: str, path: str) -> None:
    """One JSON object per task, ``{key: record}``; a table of one partition gives the one file the reader of maps expects."""
    records = F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.struct(*rows.columns))))
    part = F.floor(F.monotonically_increasing_id() / (1 << 33))
    rows.withColumn("_part", part).groupBy("_part").agg(F.to_json(records, {"ignoreNullFields": "false"}).alias("value")).select("value").write.mode("overwrite").text(path)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON arrays of records, or of JSON lines."""
    return spark.read.schema(schema).json(path, multiLine=True)


def write_records(rows: DataFrame, path: str) -> None:
    """JSON arrays of records, one array per task."""
    part = F.floor(F.monotonically_increasing_id() / (1 << 33))
    packed = rows.select(F.struct(*rows.columns).alias("r"), part.alias("_part")).groupBy("_part").agg(F.to_json(F.collect_list("r"), {"ignoreNullFields": "false"}).alias("value"))
    packed.select("value").write.mode("overwrite").text(path)


def write_matrix(wide: DataFrame, path: str) -> None:
    """CSV with a header, null as an empty field."""
    wide.write.mode("overwrite").option("header", True).csv(path)


def read_matrix(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The matrix of a CSV; the group's name normalised, ``NA`` kept as a name."""
    wide = spark.read.schema(schema).option("header", True).csv(path)
    return wide.withColumn("group", one_name(F.col("group"))) if "group" in wide.columns else wide


def melted(wide: DataFrame, ids: list[str], key: str = "event", value: str = "value") -> DataFrame:
    """The long form of a matrix: a row for every cell that is not null."""
    events = [c for c in wide.columns if c not in ids]
    cells = F.explode(F.array(*(F.struct(F.lit(e).alias(key), F.col(f"`{e}`").cast("int").alias(value)) for e in events)))
    return wide.select(*ids, cells.alias("_c")).select(*ids, "_c.*").where(F.col(value).isNotNull())


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """An inline table."""
    return spark.createDataFrame(rows, schema)


def as_text(rows: DataFrame) -> DataFrame:
    """Every column as text, missing values blank: what a display shows."""
    return rows.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in rows.columns))


def pretty(rows: DataFrame) -> DataFrame:
    """Each row as indented JSON."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"pretty": "true"}).alias("record"))


def load_all(spark: SparkSession, members: str, events: str, matrix: str, member_schema: str, event_schema: str, matrix_schema: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members, events, the matrix, and the groups in the order of their first member.

    Of an id that occurs twice the last record counts. Group names are normalised once, here.
    """
    place = F.monotonically_increasing_id()
    people = read_keyed(spark, members, member_schema, "_id").withColumn("current_group", one_name(F.col("current_group"))).withColumn("_at", place)
    people = last_records(people, "_id", ["_at"])
    groups = people.groupBy(F.col("current_group").alias("group")).agg(F.min("_at").alias("first_pos"))
    return people.drop("_id", "_at"), read_keyed(spark, events, event_schema, "_id").drop("_id"), read_matrix(spark, matrix, matrix_schema), groups
