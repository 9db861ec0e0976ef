"""Time slices of the responses, and lookups between members, events and constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys in a cell of numbered rows.
CELL = 1 << 16


def events_between(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """``event`` of the rows of ``events(event, ts)`` strictly inside the range."""
    return events.where((F.col("ts") > start) & (F.col("ts") < end)).select("event").distinct()


def temporal_slice(long: DataFrame, events: DataFrame, members: DataFrame, start: Column, end: Column, threshold: float = 0.1) -> DataFrame:
    """Every member with ``votes_count`` inside the range (0 where none) and ``kept``.

    ``long`` has ``member, event, value``. A member is kept with more responses than
    ``threshold`` times the number of events in the range; a null value is no response.
    """
    chosen = events_between(events, start, end)
    counts = long.join(chosen, "event", "left_semi").groupBy("member").agg(F.count("value").alias("n"))
    total = chosen.agg(F.count(F.lit(1)).alias("total"))  # one row
    count = F.coalesce("n", F.lit(0)).cast("long")
    every = members.join(counts, "member", "left").crossJoin(F.broadcast(total))
    return every.select(*members.columns, count.alias("votes_count"), (count > F.col("total") * F.lit(threshold)).alias("kept"))


def last_records(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the last in the given order, whole."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def orphans(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys of ``rows`` that ``known`` lacks, with their number of rows."""
    return rows.join(known.select(key), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def strict_join(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Inner join that refuses rows whose key is unknown."""
    first = orphans(rows, known, key).first()
    if first:
        raise KeyError(first[0])
    return rows.join(known, key)


def dense_grid(long: DataFrame, members: DataFrame, events: list[str]) -> DataFrame:
    """``member, event, value`` for every member and listed event, 0 where there is no response."""
    grid = members.select("member", F.explode(F.array(*(F.lit(e) for e in events))).alias("event"))
    return grid.join(long, ["member", "event"], "left").select("member", "event", F.coalesce("value", F.lit(0)).alias("value"))


def ordinals(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Rows numbered from 0 by a unique integer key; no task holds more than a cell of keys."""
    cell = F.floor(F.col(key) / CELL)
    cells = rows.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("_cell", before.alias("_before"))  # a row for each 65536 keys
    local = F.row_number().over(Window.partitionBy("_cell").orderBy(key)) - 1
    numbered = rows.withColumn("_cell", cell).withColumn("_local", local).join(cells, "_cell")
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_local")).cast("long").alias(out))


def nth_of_group(rows: DataFrame, group: str, order: str, n: int, salts: int = 32) -> DataFrame:
    """The row of place ``n`` (from 0) of each group that has one; cut by salt first, so no task holds a group."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    first = salted.withColumn("_k", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(order))).where(F.col("_k") <= n + 1)
    place = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1  # at most salts * (n + 1) rows a group
    return first.withColumn("_k", place).where(F.col("_k") == n).select(*rows.columns)


def constant_lookup(key: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Value of a constant table, ``default`` where the key is not in it."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default).cast("string"))
