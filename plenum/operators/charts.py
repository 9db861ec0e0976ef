"""Tables that charts are drawn from: scales, colours, traces, menus and hover text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Colours of the groups, in the order given.
GROUP_COLORS = {
    "PPE": "#3399FF",
    "S&D": "#FF0000",
    "ECR": "#0054A5",
    "ALDE": "#FFD700",
    "GUE/NGL": "#990000",
    "Verts/ALE": "#009900",
    "EFDD": "#24B9B9",
    "ENF": "#2B3856",
    "NA": "#999999",
}
#: The ten colours of the ordinal scale.
TEN = ("#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd", "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf")
LEGEND_STEP = 20
#: Keys of one row of a trace.
POINTS = 4096


def extent(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``name, low, high`` of each column."""
    ends = rows.agg(*(f(c).cast("double").alias(f"{k}_{c}") for c in columns for k, f in (("low", F.min), ("high", F.max))))  # one row
    return ends.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high")) for c in columns))).alias("r")).select("r.*")


def linear_scale(rows: DataFrame, column: str, out: str, width: float, inverted: bool = False) -> DataFrame:
    """``column`` mapped from its extent to 0..width pixels (from width to 0 if inverted); one value is at the start."""
    ends = rows.agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    share = F.coalesce(F.try_divide((F.col(column) - F.col("_low")).cast("double"), (F.col("_high") - F.col("_low")).cast("double")), F.lit(0.0))
    pixel = (1 - share) * width if inverted else share * width
    return rows.crossJoin(F.broadcast(ends)).withColumn(out, F.round(pixel, 6)).drop("_low", "_high")  # one row of ends


def first_seen(rows: DataFrame, column: str, order: str) -> DataFrame:
    """``column, place``: distinct values by first appearance, with an ordinal colour and a legend offset."""
    seen = rows.groupBy(column).agg(F.min(order).alias("_first"))
    listed = seen.agg(F.array_sort(F.collect_list(F.struct("_first", column))).alias("_all"))  # the classes of a legend
    placed = listed.select(F.posexplode("_all").alias("place", "_r")).select(F.col(f"_r.{column}").alias(column), "place")
    return placed.withColumn("color", F.get(F.array(*(F.lit(c) for c in TEN)), F.col("place") % len(TEN))).withColumn("legend_y", F.col("place") * LEGEND_STEP)


def opacity(groups: DataFrame, column: str) -> DataFrame:
    """``selected, column, opacity`` for every selected group: 1 for itself, 0.1 for others."""
    names = groups.select(column).distinct()
    every = names.agg(F.collect_list(column).alias("_all"))  # the groups of a menu
    pairs = every.select(F.explode("_all").alias("selected"), "_all").select("selected", F.explode("_all").alias(column))
    return pairs.withColumn("opacity", F.when(F.col("selected") == F.col(column), 1.0).otherwise(0.1))


def country_styles(members: DataFrame, countries: list[str], color: Column) -> DataFrame:
    """For every selected country the fill and line colour of each member."""
    rows = members.select("member", "country", color.alias("_color"), F.explode(F.array(*(F.lit(c) for c in countries))).alias("selected"))
    own = F.col("country") == F.col("selected")
    return rows.select("selected", "member", F.when(own, F.col("_color")).otherwise("rgba(0,0,0,0.1)").alias("color"), F.when(own, "black").otherwise("transparent").alias("line"))


def traces(rows: DataFrame, group: str, key: str, columns: list[str]) -> DataFrame:
    """Points of each group as arrays in the order of an integer key, a row for each ``POINTS`` keys."""
    part = F.floor(F.col(key) / POINTS).cast("long").alias("part")
    points = rows.groupBy(group, part).agg(F.array_sort(F.collect_list(F.struct(key, *columns))).alias("p"))
    return points.select(group, "part", *(F.col("p").getField(c).alias(c) for c in (key, *columns)))


def hover_text(name: Column, surname: Column, percent: Column, *lines: Column) -> Column:
    """Bold names, a share to two places, then lines."""
    return F.format_string("<b>%s %s</b><br>%.2f %%" + "<br>%s" * len(lines), name, surname, percent, *lines)


def rewritten_cell(kind: Column, source: Column, pattern: str, replacement: str) -> Column:
    """Text of a cell with links rewritten, in cells of text only."""
    return F.when((kind == "markdown") & source.isNotNull(), F.regexp_replace(source, pattern, replacement)).otherwise(source)


def visible(cell_input: Column, cell_output: Column, notebook_input: Column) -> tuple[Column, Column]:
    """Whether a cell's input and output are shown: input is hidden by its own or the notebook's flag, output by its own."""
    off = F.lit(False)
    return ~(F.coalesce(cell_input, off) | F.coalesce(notebook_input, off)), ~F.coalesce(cell_output, off)
