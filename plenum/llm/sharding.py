"""Sharding by a minimax contiguous partition of ordered atomic groups.

Rows with equal texts (of equal 128 bits of hash) form a group that is never split, the atomic
unit. Groups are ordered by the hash of their text; the leading hash bits name one of 2**17
cells. The cells' total sizes are a table whose length is bounded however many rows there are,
so the smallest feasible capacity is found on the driver: a binary search, each capacity being
checked by greedy filling. The cuts are then laid as near to equal sizes as that capacity
allows. A cell of several groups in which the search or a cut looks is replaced by its groups
and the search is run again, until it looks into none: the result is that over all groups.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import numbered, staged, text_of

CELL_BITS = 17
OVERHEAD = 16
#: Units on either side of one that is looked into which are replaced by groups with it, to save rounds.
AROUND = 4
FIRST = -(1 << 63)


def feasible(ends: np.ndarray, capacity: int, shards: int, asked: list | None = None) -> bool:
    """Whether greedy filling fits all units in ``shards`` shards. ``ends``: running totals.

    Totals at which units are looked up are added to ``asked``, here and below.
    """
    base = 0
    for _ in range(shards):
        if ends[-1] - base <= capacity:
            return True
        if asked is not None:
            asked.append(base + capacity)
        at = int(np.searchsorted(ends, base + capacity, side="right"))
        if at == 0 or ends[at - 1] <= base:
            return False
        base = int(ends[at - 1])
    return False


def smallest_capacity(sizes: np.ndarray, shards: int, largest: int | None = None, asked: list | None = None) -> int:
    """Binary search for the least largest shard over contiguous runs of ``sizes``.

    ``largest`` is the largest group where units of ``sizes`` may hold several.
    """
    if not len(sizes):
        return 0
    ends = np.cumsum(sizes)
    share = -(-int(ends[-1]) // shards)
    low = max(int(sizes.max()) if largest is None else largest, share)
    # what fits with units left whole fits with their groups too
    high = int(ends[-1]) if largest is None else smallest_capacity(sizes, shards)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(ends, mid, shards, asked) else (mid + 1, high)
    return low


def cuts(sizes: np.ndarray, shards: int, largest: int | None = None, asked: list | None = None) -> np.ndarray:
    """First unit of each shard after the first: ``shards - 1`` positions in 0..len(sizes).

    No shard exceeds the minimax capacity. Within that bound each cut goes where the shard
    comes closest to an equal share of what is left.
    """
    n = len(sizes)
    if not n:
        return np.zeros(shards - 1, dtype=np.int64)
    capacity = smallest_capacity(sizes, shards, largest, asked)
    asked = [] if asked is None else asked
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    # earliest[j]: the first position from which j shards hold the rest
    earliest = [n]
    for _ in range(shards):
        asked.append(int(ends[earliest[-1]]) - capacity)
        earliest.append(int(np.searchsorted(ends, ends[earliest[-1]] - capacity, side="left")))
    out, at = [], 0
    for k in range(shards - 1):
        left = shards - k - 1
        low = max(at, earliest[left])
        high = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        goal = ends[at] + (ends[-1] - ends[at]) / (left + 1)
        asked += [int(ends[at]) + capacity, goal]
        near = int(np.searchsorted(ends, goal))
        best = min((x for x in (near - 1, near) if 0 <= x <= n), key=lambda x: abs(ends[x] - goal))
        at = min(max(best, low), high)
        out.append(at)
    return np.array(out, dtype=np.int64)


def group_cuts(units: np.ndarray, largest: int, shards: int, groups_of: Callable[[list[int]], np.ndarray]) -> list[tuple[int, int, int]]:
    """First ``cell, h, h2`` of each shard after the first, as over all groups.

    ``units`` are rows ``cell, h, h2, bytes, groups`` in order, one per cell; ``groups_of`` gives
    the rows of the groups of some cells. ``largest`` is the size of the largest group.
    """
    while True:
        asked: list = []
        starts = cuts(units[:, 3], shards, largest, asked)
        ends = np.cumsum(units[:, 3])
        # exact integers up to 2**53, far above any total; goals are fractions
        at = np.searchsorted(ends, np.unique(np.array(asked, dtype=np.float64)), side="left")
        at = at[at < len(units)]
        at = at[units[at, 4] > 1]
        if not len(at):
            break
        near = np.unique(np.clip(at[:, None] + np.arange(-AROUND, AROUND + 1), 0, len(units) - 1))
        near = near[units[near, 4] > 1]
        found = groups_of(units[near, 0].tolist())
        units = np.concatenate([np.delete(units, near, axis=0), found])
        units = units[np.lexsort((units[:, 2], units[:, 1], units[:, 0]))]
    return [tuple(map(int, units[x, :3])) if x < len(units) else (1 << CELL_BITS, FIRST, FIRST) for x in starts]


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into ``shards`` shards of nearly equal bytes; equal texts stay together.

    Returns ``id_col, size, text_crc32, law, shard, slot, grown_shard``. A null text counts as
    empty (size 16). Repeated rows are rows of their own; an empty table gives an empty result;
    columns beyond the two named are not read. A group larger than an equal share makes its
    shard larger, as a group is atomic. ``grown_shard`` is null: the law held is ``bytes``.
    """
    text = text_of(docs, text_col)
    rows = staged(
        docs.select(
            docs[id_col].alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 64 - CELL_BITS).cast("int").alias("cell"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(F.lit(1), text).alias("h2"),
            F.spark_partition_id().alias("part"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("cell", "h", "h2").agg(F.sum("size").alias("bytes"))
    # at most 2**CELL_BITS rows, whatever the input
    cells = groups.groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups"), F.max("bytes").alias("largest"), F.min("h").alias("h"), F.min("h2").alias("h2"))
    cells = cells.toPandas().sort_values("cell")
    units = cells[["cell", "h", "h2", "bytes", "groups"]].to_numpy(dtype=np.int64)

    def groups_of(chosen: list[int]) -> np.ndarray:
        found = rows.where(F.col("cell").isin(chosen)).groupBy("cell", "h", "h2").agg(F.sum("size").alias("bytes"))  # a few cells a shard
        return found.withColumn("groups", F.lit(1)).toPandas().to_numpy(dtype=np.int64)

    firsts = group_cuts(units, int(cells["largest"].max()) if len(cells) else 0, shards, groups_of)
    shard = F.lit(0)
    for cell, h, h2 in firsts:
        inside = (F.col("h") > h) | ((F.col("h") == h) & (F.col("h2") >= h2))
        shard = shard + ((F.col("cell") > cell) | ((F.col("cell") == cell) & inside)).cast("int")
    placed = rows.withColumn("shard", shard.cast("int"))
    placed = numbered(placed, ["shard"], "part", ["cell", "doc_id"], "slot")
    return placed.select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
