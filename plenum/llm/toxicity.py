"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams (case folded). Each feature's value is its
log-count ratio between toxic and other training texts; a logistic regression over the scaled
features gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import bound_batches, staged, text_of

BITS = 20
ORDERS = (4, 5, 6)
#: Training rows at most: those labelled rows whose ids have the least hashes. A documented bound.
SAMPLE = 6000
THRESHOLD = 0.7
#: Characters whose n-grams are hashed at a time.
BLOCK = 1 << 18


@dataclass
class Model:
    weights: np.ndarray  # over 2**BITS features, zero for those left out
    bias: float


def grams(text: str, keep: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams of a whole text, of those marked in ``keep``."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    found = []
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK + max(ORDERS) - 1]
        h = np.zeros(len(part), np.uint64)
        for k in range(max(ORDERS)):
            n = len(part) - k
            if n <= 0:
                break
            h = (h[:n] + part[k:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if k + 1 in ORDERS:
                ids = (h >> np.uint64(7)) & np.uint64((1 << BITS) - 1)
                if keep is not None:
                    ids = ids[keep[ids]]
                found.append(np.unique(ids))
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64)


def log_ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, alpha: float = 0.5, least: int = 5, ratio: float = 2.5) -> np.ndarray:
    """Log-count ratio of each feature from the texts of each class that hold it; 0 where it carries none."""
    r = np.log((pos + alpha) / (n_pos + 2 * alpha)) - np.log((neg + alpha) / (n_neg + 2 * alpha))
    r[(pos + neg < least) | (np.abs(r) < ratio)] = 0
    return np.clip(r, -4, 4)


def constant(y: np.ndarray) -> Model:
    """The model of labels that hold nothing to tell apart."""
    return Model(np.zeros(1 << BITS, np.float32), -4.0 if not len(y) or not y.max() else 4.0)


def fit(texts: list[np.ndarray], y: np.ndarray, r: np.ndarray, l2: float = 2.0, steps: int = 200) -> Model:
    """Logistic regression on features scaled by their ratios ``r``; ``texts`` hold only features that have one."""
    rows = np.repeat(np.arange(len(y)), [len(t) for t in texts])
    ids = np.concatenate(texts)
    names, at = np.unique(ids, return_inverse=True)
    value = r[names]
    x = value[at]
    w, bias = np.zeros(len(names)), float(np.log(y.mean() / (1 - y.mean())))
    # Adam on the penalised likelihood; all rows at each step, so the result has no random part
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=x * w[at], minlength=len(y)) + bias
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = (np.bincount(at, weights=x * err[rows], minlength=len(w)) + l2 * w) / len(y)
        gb = err.mean()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.02 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= 0.02 * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    out = np.zeros(1 << BITS, np.float32)
    out[names] = (w * value).astype(np.float32)
    return Model(out, bias)


def score(text: str, model: Model, keep: np.ndarray) -> float:
    z = float(model.weights[grams(text, keep)].sum()) + model.bias
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(id_column):
    return F.crc32(id_column.cast("string").cast("binary")) % 3 == 1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [grams(x.as_py()).astype("<i4").tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["y", "f"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a feature, one row per feature and task."""
    of = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for y, f in zip(batch.column(0).to_pylist(), batch.column(1)):
            of[y, np.frombuffer(f.as_py(), "<i4")] += 1  # a text's features are distinct
    ids = np.flatnonzero(of.any(axis=0))
    for at in range(0, len(ids), 100_000):
        i = ids[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(of[1, i]), pa.array(of[0, i])], ["id", "pos", "neg"])


def _only(names: np.ndarray):
    """Each text's features cut to those in ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        keep[names] = True
        for batch in batches:
            values = [ids[keep[ids]].tobytes() for ids in (np.frombuffer(f.as_py(), "<i4") for f in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["y", "f"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", least: int = 5) -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out.

    Features are counted by the executors; the driver sees the counts of features that occur
    ``least`` times (2**BITS rows at most) and the training rows' features that carry a ratio.
    """
    marked = labels.where(labels.toxic.isNotNull() & labels[id_col].isNotNull() & ~held_out(labels[id_col]))
    marked = marked.groupBy(F.col(id_col).alias("i")).agg((F.max("toxic") > 0).cast("int").alias("y"))
    chosen = marked.orderBy(F.xxhash64("i"), "i").limit(sample)
    rows = docs.select(docs[id_col].alias("i"), text_of(docs, text_col).alias("t")).where(F.col("i").isNotNull())
    texts = rows.join(F.broadcast(chosen), "i").groupBy("i").agg(F.max("y").alias("y"), F.min("t").alias("t"))  # ``sample`` rows
    found = staged(texts.select("y", "t").mapInArrow(_features, "y int, f binary"), "toxicity-features")
    size = {row.y: row["count"] for row in found.groupBy("y").count().collect()}  # two rows
    if len(size) < 2:
        return constant(np.array(list(size)))
    counts = found.mapInArrow(_counted, "id int, pos long, neg long").groupBy("id").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    seen = counts.where(F.col("pos") + F.col("neg") >= least).toPandas()
    r = np.zeros(1 << BITS)
    r[seen.id] = log_ratios(seen.pos.to_numpy(), seen.neg.to_numpy(), size[1], size[0], least=least)
    table = found.mapInArrow(_only(np.flatnonzero(r)), "y int, f binary").toPandas()
    order = np.argsort([bytes(f[:64]) + str(len(f)).encode() for f in table.f], kind="stable")
    return fit([np.frombuffer(table.f[k], "<i4").astype(np.int64) for k in order], table.y.to_numpy(np.int64)[order], r)


def score_documents(docs: DataFrame, model: Model, out: str = "toxic_score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``out`` of scores from 0 to 1 added; all other columns pass through."""
    bound_batches(docs.sparkSession)
    weights, bias = model.weights, model.bias
    names = np.flatnonzero(weights)
    small, values = names.astype("<i4"), weights[names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(1 << BITS, np.float32)
        full[small] = values
        own, keep = Model(full, bias), full != 0
        for batch in batches:
            scores = [score(x.as_py() or "", own, keep) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, out])

    at = docs.columns.index(text_col)
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{out}` double"])
    return docs.mapInArrow(run, fields)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, score, predicted``.

    Null texts are scored as empty ones. A null id is not held out. Without labels of both
    classes the score is a constant near the one class seen (0 where there is no label). Repeated
    rows get equal scores; an empty table gives no rows; other columns are not read.
    """
    model = train(docs, labels, sample, id_col, text_col)
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("text"))
    scored = score_documents(rows, model, "score")
    return scored.select(id_col, F.coalesce(held_out(scored[id_col]), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
