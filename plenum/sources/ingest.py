"""Nested member and vote records to flat summaries and long responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators.slices import last_records

MEMBER = """UserID bigint, Name struct<family:string,sur:string>, active boolean,
Groups array<struct<groupid:string,end:string,country:string>>, Constituencies array<struct<party:string,end:string>>,
Gender string, Birth struct<date:string>, Photo string, Mail string, meta struct<url:string>"""
_ARM = "struct<groups:array<struct<votes:array<struct<ep_id:bigint>>>>>"
VOTE = f"voteid string, title string, issue_type string, url string, report string, ts string, `For` {_ARM}, Against {_ARM}, Abstain {_ARM}"
#: Response arm, value, precedence inside one record (the last applied wins).
ARMS = [("Abstain", 0, 0), ("For", 1, 1), ("Against", -1, 2)]


def _ordered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records with ``idx``, their place: by name of file, then inside it (a file of one array is one split)."""
    rows = spark.read.schema(schema).json(path, multiLine=True)
    return rows.withColumn("idx", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place")))


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array or JSON lines of members; fields that are missing are null."""
    return _ordered(spark, path, MEMBER)


def read_votes(spark: SparkSession, path: str) -> DataFrame:
    return _ordered(spark, path, VOTE)


def epoch_ms(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text)).cast("double")


def one_group(group: Column) -> Column:
    """A group given as a JSON list is its first element; an empty list is null."""
    return F.when(group.startswith("["), F.get(F.from_json(group, "array<string>"), F.lit(0))).otherwise(group)


def latest(items: Column) -> Column:
    """The element with the latest ``end``; null elements and ends count as 1970; ties keep the first."""
    end = lambda x: F.coalesce(F.try_to_timestamp(x["end"]), F.to_timestamp(F.lit("1970-01-01")))
    keyed = F.transform(items, lambda x, i: F.struct(end(x).alias("e"), (-i).alias("i"), x.alias("x")))
    return F.get(F.sort_array(keyed, asc=False), F.lit(0))["x"]


def member_summary(raw: DataFrame) -> DataFrame:
    """One flat row per member; the last record of an id wins. Records without an id are one member."""
    raw = last_records(raw, "UserID", ["idx"])
    group, seat = latest(F.col("Groups")), latest(F.col("Constituencies"))
    return raw.select(
        F.col("UserID").cast("string").alias("mep_id"),
        F.col("Name.family").alias("name"),
        F.col("Name.sur").alias("surname"),
        "active",
        one_group(group["groupid"]).alias("current_group"),
        seat["party"].alias("current_constituency"),
        group["country"].alias("country"),
        F.col("Gender").alias("gender"),
        epoch_ms(F.col("Birth.date")).alias("birthdate"),
        F.col("Photo").alias("picture"),
        F.col("Mail").alias("email"),
        F.col("meta.url").alias("eu_homepage"),
    )


def vote_summary(raw: DataFrame) -> DataFrame:
    """One row per vote id, of its last record."""
    last = raw.groupBy("voteid").agg(F.max_by(F.struct("title", "issue_type", "url", "report", "ts"), "idx").alias("r"))
    return last.select("voteid", "r.title", "r.issue_type", "r.url", "r.report", epoch_ms(F.col("r.ts")).alias("ts"))


def responses(raw: DataFrame) -> DataFrame:
    """``mep_id, voteid, value`` from the three arms in one scan; the last record and arm wins."""
    def arm(name: str, value: int, prec: int) -> Column:
        ids = F.flatten(F.transform(F.col(f"{name}.groups"), lambda g: F.coalesce(g["votes"], F.array())))
        tagged = F.transform(ids, lambda v: F.struct(v["ep_id"].cast("string").alias("mep_id"), F.lit(prec).alias("prec"), F.lit(value).alias("value")))
        return F.coalesce(tagged, F.array())

    rows = raw.select("voteid", "idx", F.explode(F.concat(*(arm(*a) for a in ARMS))).alias("r")).select("voteid", "idx", "r.*")
    return rows.groupBy("mep_id", "voteid").agg(F.max_by("value", F.struct("idx", "prec")).alias("value"))
