"""Helpers that the corpus operators share: shared scratch tables, numbering, column access."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenum.scratch import BATCH_BYTES, WRITING, discard, scratch_dir, settings, staged  # noqa: F401


def bound_batches(spark: SparkSession) -> None:
    """Hold Arrow batches of this session to some megabytes: texts vary in length, and a task's memory with its batches."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _bytes(value: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", value.strip().lower()).groups()
    size = int(number) * 1024 ** "_kmgtp".find(unit[0]) if unit and unit[0] != "b" else int(number)
    return size if size > 0 else 1 << 62


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` once in the shared folder, dealt by ``key``; joins on ``key`` then move only the other side.

    The catalog entry goes at once; the files stay, and the frame reads them.
    """
    spark = df.sparkSession
    n, table = shuffle_partitions(spark), f"plenum_{name}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/plenum/{table}"
    with settings(spark, WRITING):
        df.repartition(n, key).write.option("compression", "zstd").bucketBy(n, key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolves the table before its name goes
    spark.sql(f"DROP TABLE {table}")
    return out


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null as the empty string."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def numbered(df: DataFrame, group: list[str], part: str, order: list[str], out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, though no task holds a whole group.

    ``part`` names a stored column that cuts the rows into pieces of bounded size (a partition
    id frozen in a staged table). Rows are ranked inside (part, group); the pieces' counts,
    one row per piece and group, give each piece its offset.
    """
    keys = [*group, part]
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, keys).withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_local", "_before")
