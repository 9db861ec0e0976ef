"""The response matrix: pivot, covariance, principal components, importances.

The long table ``member, event, value`` is the canonical form. Dense rows are made only for a
listed set of events, which bounds what reaches the driver: ``n_events`` squared sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Events above which a covariance over events is refused: its sums go to the driver.
MAX_EVENTS = 2000
#: Members up to which products of members are made, events of which a task holds a block, cells of a forest's matrix.
MAX_MEMBERS = 5000
WIDE = 256
MAX_CELLS = 1 << 28
#: Spark's limit on the depth of a tree; the reference has none.
MAX_DEPTH = 30
#: Trees that the driver holds at a time.
TREES_AT_ONCE = 20


def events_of(long: DataFrame) -> list[str]:
    """The events, ordered; at most ``MAX_EVENTS``."""
    found = [r.event for r in long.select("event").distinct().orderBy("event").limit(MAX_EVENTS + 1).collect()]
    if len(found) > MAX_EVENTS:
        raise ValueError(f"more than {MAX_EVENTS} events")
    return found


def all_events(long: DataFrame) -> list[str]:
    """Every event, ordered, however many; only their names reach the driver."""
    return [r.event for r in long.select("event").distinct().orderBy("event").collect()]


def pivot(long: DataFrame, events: list[str]) -> DataFrame:
    """One row per member, one column per event, null where there is no response."""
    return long.groupBy("member").pivot("event", events).agg(F.first("value"))


def imputed(long: DataFrame, events: list[str]) -> DataFrame:
    """``member, x``: responses as a dense array over ``events``, missing ones 0."""
    places = long.sparkSession.createDataFrame(list(enumerate(events)), "i int, event string")  # a row per listed event
    packed = long.join(F.broadcast(places), "event").where(F.col("value").isNotNull())
    packed = packed.groupBy("member").agg(F.collect_list("i").alias("i"), F.collect_list(F.col("value").cast("double")).alias("v"))
    n = len(events)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, n))
            rows = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            x[rows, batch.column(1).flatten().to_numpy()] = batch.column(2).flatten().to_numpy()
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["member", "x"])

    return packed.mapInArrow(run, f"member {long.schema['member'].dataType.simpleString()}, x array<double>")


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _rows_of(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "r"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed matrix rows added up by their number; a task holds the rows dealt to it."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            row = np.frombuffer(r)
            total[i] = total[i] + row if i in total else row
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([r.tobytes() for r in total.values()], pa.binary())], ["i", "r"])


def _collected(parts: DataFrame, n: int) -> np.ndarray:
    """The sum of the tasks' n x n matrices, sent as packed rows."""
    out = np.zeros((n, n))
    for r in parts.repartition("i").mapInArrow(_summed, "i long, r binary").toLocalIterator():
        out[r.i] = np.frombuffer(r.r)
    return out


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0), batch.num_rows)
            x = np.hstack([np.ones((len(x), 1)), x])
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield _rows_of(total)


def covariance(dense: DataFrame, n_events: int) -> tuple[np.ndarray, np.ndarray]:
    """Column means and the sample covariance; ``n_events`` squared sums reach the driver."""
    s = _collected(dense.select("x").mapInArrow(_products, "i long, r binary"), n_events + 1)
    n = s[0, 0]
    if n < 2:
        return np.zeros(n_events), np.zeros((n_events, n_events))
    mean = s[0, 1:] / n
    return mean, (s[1:, 1:] - n * np.outer(mean, mean)) / (n - 1)


def components(cov: np.ndarray, share: float | int) -> tuple[np.ndarray, np.ndarray]:
    """Loadings (one row per component) and variance ratios.

    A ``share`` below 1 keeps the fewest components whose ratios add up to more than it. Of each
    component the loading of largest magnitude is positive.
    """
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.clip(values[::-1], 0, None), vectors[:, ::-1].T
    ratio = values / values.sum() if values.sum() else values
    k = int(share) if share >= 1 else int(np.searchsorted(np.cumsum(ratio), share, side="right")) + 1
    k = min(k, len(values))
    vectors = vectors[:k]
    if not vectors.size:
        return vectors, ratio[:k]
    sign = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])
    return vectors * sign[:, None], ratio[:k]


def scores(dense: DataFrame, mean: np.ndarray, loadings: np.ndarray) -> DataFrame:
    """``member, PCA0, ...``: centred scores; the loadings go to the tasks as one matrix."""
    shift, names = loadings @ mean, [f"PCA{k}" for k in range(len(loadings))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), batch.num_rows) @ loadings.T - shift if batch.num_rows else np.empty((0, len(names)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in y.T)], ["member", *names])

    return dense.select("member", "x").mapInArrow(run, ", ".join([f"member {dense.schema['member'].dataType.simpleString()}", *(f"{c} double" for c in names)]))


def member_components(long: DataFrame, share: float | int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Scores, loadings and variances of a matrix wider than long, from the products of its members.

    The centred members' products have the eigenvalues of the events' covariance, so the size
    of what reaches the driver is that of the members (at most ``MAX_MEMBERS``), squared.
    Responses are dealt by event; a task holds the responses of ``WIDE`` events at a time.
    """
    spark = long.sparkSession
    members = [r.member for r in long.select("member").distinct().orderBy("member").limit(MAX_MEMBERS + 1).collect()]
    if len(members) > MAX_MEMBERS:
        raise ValueError(f"more than {MAX_MEMBERS} members")
    m, kind = len(members), long.schema["member"].dataType.simpleString()
    places = spark.createDataFrame(list(enumerate(members)), f"i int, member {kind}")
    rows = long.where(F.col("value").isNotNull()).join(F.broadcast(places), "member").select("event", "i", F.col("value").cast("double").alias("v"))
    by_event = rows.groupBy("event").agg(F.collect_list("i").alias("i"), F.collect_list("v").alias("v"))  # at most one cell a member

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, m))
        for batch in batches:
            for at in range(0, batch.num_rows, WIDE):
                part = batch.slice(at, WIDE)
                x = np.zeros((m, part.num_rows))
                event = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
                x[part.column(1).flatten().to_numpy(), event] = part.column(2).flatten().to_numpy()
                total += x @ x.T
        if total.any():
            yield _rows_of(total)

    k = _collected(by_event.select("event", "i", "v").mapInArrow(run, "i long, r binary"), m)
    k = k - k.mean(axis=0) - k.mean(axis=1)[:, None] + k.mean() if m else k
    vectors, ratio = components(k / max(m - 1, 1), share)
    variances = ratio * np.trace(k) / max(m - 1, 1) if m else np.zeros(0)
    some = variances[: len(vectors)] > 1e-12 * max(1.0, variances.max(initial=0))
    vectors = vectors[some]
    length = np.sqrt(variances[: len(some)][some] * (m - 1))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            event = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            out = np.zeros((batch.num_rows, len(vectors)))
            np.add.at(out, event, vectors.T[batch.column(1).flatten().to_numpy()] * batch.column(2).flatten().to_numpy()[:, None])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in (out / length).T.copy())], ["event", *names])

    names = [f"pca{c}_coeff" for c in range(len(vectors))]
    loadings = by_event.select("event", "i", "v").mapInArrow(load, ", ".join(["event string", *(f"{c} double" for c in names)]))
    top = loadings.agg(*(F.max_by(c, F.struct(F.abs(F.col(c)), "event")).alias(c) for c in names)).first() if names else ()
    sign = np.array([-1.0 if x is not None and x < 0 else 1.0 for x in top])
    loadings = loadings.select("event", *((F.col(c) * float(x)).alias(c) for c, x in zip(names, sign)))
    y = (vectors * (length * sign)[:, None]).T if names else np.zeros((m, 0))
    table = spark.createDataFrame([(a, *map(float, r)) for a, r in zip(members, y)], ", ".join([f"member {kind}", *(f"PCA{c} double" for c in range(len(names)))]))
    return table, loadings, variances


def grown(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Importances of one extremely random tree: at each node one random cut per event, the best of them taken."""
    total, todo = np.zeros(x.shape[1]), [np.arange(len(y))]
    while todo:
        rows = todo.pop()
        part, goal = x[rows], y[rows]
        if len(rows) < 2 or np.ptp(goal) <= 1e-12:
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        live = np.flatnonzero(high > low)
        if not len(live):
            continue
        cut = rng.uniform(low[live], high[live])
        left = part[:, live] <= cut
        n, s = left.sum(axis=0), goal @ left
        gain = s**2 / n + (goal.sum() - s) ** 2 / (len(rows) - n) - goal.sum() ** 2 / len(rows)
        best = int(gain.argmax())
        total[live[best]] += gain[best]
        todo += [rows[left[:, best]], rows[~left[:, best]]]
    return total / total.sum() if total.sum() else total


def tree_importances(dense: DataFrame, target: DataFrame, events: list[str], trees: int = 100, seed: int = 0) -> DataFrame:
    """``event, importance, spread`` over extremely random trees grown without a depth limit.

    Trees are dealt to tasks; each task has the whole matrix (a byte a cell, refused above
    ``MAX_CELLS``) and the target, so a lost task grows its trees again with the same seeds.
    """
    n = dense.count()
    if n * len(events) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells; importances() takes any number")
    table = dense.join(target, "member").orderBy("member").select("x", "PCA0").toPandas()
    x = np.array(table["x"].tolist(), dtype=np.int8).reshape(len(table), len(events))
    shared = dense.sparkSession.sparkContext.broadcast((x, table["PCA0"].to_numpy(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(events), k)), pa.array(events, pa.string()), pa.array(grown(x, y, np.random.default_rng([seed, k])))], ["tree", "event", "importance"])

    each = dense.sparkSession.range(trees).repartition(min(trees, 64)).mapInArrow(run, "tree long, event string, importance double")
    return each.groupBy("event").agg(F.avg("importance").alias("importance"), F.stddev_pop("importance").alias("spread"))


def importances(dense: DataFrame, target: DataFrame, events: list[str], trees: int = 100, seed: int = 0) -> DataFrame:
    """``rank, event, importance`` of the 20 events a forest of regression trees uses most for ``target``."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import RandomForestRegressor

    rows = dense.join(target, "member").select(array_to_vector("x").alias("features"), F.col("PCA0").alias("label"))
    rows, total = rows.persist(), np.zeros(len(events))
    # a forest's importances are the mean of its trees', so forests can be grown one by one
    for first in range(0, trees, TREES_AT_ONCE):
        n = min(TREES_AT_ONCE, trees - first)
        forest = RandomForestRegressor(numTrees=n, seed=seed + first, maxDepth=MAX_DEPTH, featureSubsetStrategy="onethird").fit(rows)
        total += n * forest.featureImportances.toArray()
        del forest
    rows.unpersist()
    total /= trees
    ranked = sorted(zip(total.tolist(), events), key=lambda p: (-p[0], p[1]))[:20]
    return dense.sparkSession.createDataFrame([(k, e, v) for k, (v, e) in enumerate(ranked)], "rank int, event string, importance double")
