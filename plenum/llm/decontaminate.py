"""Benchmark decontamination by winnowing, in DataFrame functions throughout.

Every run of ``gram`` words is hashed, and of each run of ``window - gram + 1`` consecutive
hashes the minimum is kept. Two texts that share ``window`` words in a row therefore share a
fingerprint, so the join of training and test fingerprints misses no shared window. Each hit is
then extended to the windows that hold it, which are compared by 128 hash bits. An item of fewer
words is one window of its own length, its fingerprint its own hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import staged, text_of

WINDOW, GRAM = 10, 5
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of benchmark windows (about 40 bytes each) up to which they are broadcast, by count.
BROADCAST_ROWS = 400_000
SALTS = 16


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATOR), "")


def _starts(n: Column, length: int) -> Column:
    """0 .. n - length, empty where the text is shorter."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _run_hash(words: Column, start: Column, length: int, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.slice(words, start + 1, length))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _runs(df: DataFrame, column: str, length: int, joined, out: str) -> DataFrame:
    """``out``: ``joined`` over every run of ``length`` values of ``column``, put together from runs half as long.

    Each step is a column of its own, as an expression that is used twice is computed twice.
    """

    def both(a: str, b: str, by: int) -> Column:
        return F.slice(F.zip_with(a, _shifted(F.col(b), by), joined), 1, F.greatest(F.size(b) - by, F.lit(0)))

    made, done = {1: column}, 1
    while 2 * done <= length:
        df = df.withColumn(f"{out}_{2 * done}", both(made[done], made[done], done))
        made[2 * done], done = f"{out}_{2 * done}", 2 * done
    at = made[done]
    for half in sorted((k for k in made if k < done and length & k), reverse=True):
        df = df.withColumn(f"{out}_{done + half}", both(at, made[half], done))
        at, done = f"{out}_{done + half}", done + half
    return df.withColumn(out, F.col(at))


def _keys(words: Column, n: Column, length: int) -> Column:
    """Every window of ``length`` words as (start, length, two hashes)."""
    return F.transform(
        _starts(n, length),
        lambda i: F.struct(i.alias("start"), F.lit(length).alias("length"), _run_hash(words, i, length, length).alias("k1"), _run_hash(words, i, length, 1000 + length).alias("k2")),
    )


def _hashed(rows: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """``g``: hashes of runs of ``gram`` words; ``m``: their minima over a window; ``s<n>``: hashes of runs of each short length."""
    # each word's text is hashed once; then hashes of two runs make that of the run they form
    out = rows.select("rid", "n_words", F.transform("w", lambda w: F.xxhash64(w)).alias("l"))
    joined = lambda a, b: F.xxhash64(a, b)
    out = _runs(_runs(out, "l", gram, joined, "g"), "g", window - gram + 1, lambda a, b: F.least(a, b), "m")
    for n in short:
        out = _runs(out, "l", n, joined, f"s{n}")
    return out


def _fingerprints(rows: DataFrame, short: list[int], window: int, gram: int, own: bool) -> DataFrame:
    """``rid, fp``: winnowed fingerprints, and of each short length the hash of every run.

    ``own``: the rows are items; one that is shorter than a window has the hash of itself alone.
    """
    parts = [F.when((F.col("n_words") >= window) | F.lit(not own), F.col("m"))]
    parts += [F.when((F.col("n_words") == n) | F.lit(not own), F.col(f"s{n}")) for n in short]
    found = F.array_distinct(F.flatten(F.array_compact(F.array(*parts))))
    return _hashed(rows, short, window, gram).select("rid", F.explode(found).alias("fp"))


def _extended(near: DataFrame, prints: DataFrame, n_prints: int, short: list[int], window: int, gram: int) -> DataFrame:
    """``rid, spots``: places (length, start) of windows that hold a shared fingerprint.

    A fingerprint of a shared window lies at most ``window - gram`` words after its start, so
    the windows that a hit can be extended to begin there or up to that many words before.
    """
    hashed = _hashed(near, short, window, gram)
    at = [("g", window, window - gram), *((f"s{n}", n, 0) for n in short)]
    places = [hashed.select("rid", F.lit(n).alias("length"), F.lit(back).alias("back"), F.posexplode(c).alias("pos", "fp")) for c, n, back in at]
    hit = _probe(reduce(DataFrame.unionByName, places), prints, ["fp"], n_prints, "left_semi")
    starts = hit.select("rid", "length", F.explode(F.sequence(F.greatest(F.col("pos") - F.col("back"), F.lit(0)), F.col("pos"))).alias("start"))
    return starts.groupBy("rid").agg(F.collect_set(F.struct("length", "start")).alias("spots"))  # within one text


def _probe(big: DataFrame, small: DataFrame, keys: list[str], small_rows: int, how: str = "inner") -> DataFrame:
    """Join to the benchmark side: broadcast below a checked size, otherwise salted against hot keys."""
    if small_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")).join(salted, [*keys, "salt"], how).drop("salt")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null texts and texts without a word have none; an item without a word has no window. Items
    with a null id mark words as hit but are not counted or listed; repeated item ids count once.
    Repeated rows of ``docs`` are judged each; empty tables give no rows or no hits; columns
    beyond those named are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), words_of(text_of(docs, text_col)).alias("w"))
    rows = staged(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "w", F.size("w").alias("n_words")), "decon-rows")
    items = benchmark.select(benchmark[item_col].cast("string").alias("item_id"), words_of(text_of(benchmark, text_col)).alias("w"))
    items = staged(items.select(F.monotonically_increasing_id().alias("rid"), "item_id", "w", F.size("w").alias("n_words")).where("n_words > 0"), "decon-items")

    short = sorted(r.n_words for r in items.where(F.col("n_words") < window).select("n_words").distinct().collect())  # under ``window`` values
    own = F.when(F.col("n_words") >= window, _keys(F.col("w"), F.col("n_words"), window))
    for m in short:
        own = own.when(F.col("n_words") == m, _keys(F.col("w"), F.col("n_words"), m))
    of_item = staged(items.select("item_id", F.explode(own).alias("k")).select("item_id", "k.length", "k.k1", "k.k2").distinct(), "decon-windows")
    windows = of_item.select("length", "k1", "k2").distinct()
    n_windows = of_item.count()

    prints = staged(_fingerprints(items, short, window, gram, True).select("fp").distinct(), "decon-prints")
    suspects = _probe(_fingerprints(rows, short, window, gram, False), prints, ["fp"], n_windows, "left_semi").select("rid").distinct()
    suspects = staged(suspects, "decon-suspects")
    few = suspects.count() <= BROADCAST_ROWS  # then the words of the others need not be moved

    near = staged(rows.join(F.broadcast(suspects) if few else suspects, "rid", "left_semi").select("rid", "w", "n_words"), "decon-near")
    spots = _extended(near, prints, n_windows, short, window, gram)
    found = F.filter("spots", lambda x: x["start"] + x["length"] <= F.col("n_words"))
    keys = F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            x["length"].alias("length"),
            F.xxhash64(x["length"], F.slice("w", x["start"] + 1, x["length"])).alias("k1"),
            F.xxhash64(x["length"] + 1000, F.slice("w", x["start"] + 1, x["length"])).alias("k2"),
        ),
    )
    spans = near.join(spots, "rid").select("rid", F.explode(keys).alias("k")).select("rid", "k.*")
    hits = staged(_probe(spans, windows, ["length", "k1", "k2"], n_windows), "decon-hits")

    span = F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("stop"))))
    zero = F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        span,
        zero,
        lambda a, x: F.struct(F.greatest(a["stop"], x["stop"]).alias("stop"), (a["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(a["stop"], x["start"]))).cast("long").alias("n")),
        lambda a: a["n"],
    )
    hit_words = hits.groupBy("rid").agg(covered.alias("n_hit"))
    # a window that many items share is one row with their ids, not a row for each
    shared = of_item.groupBy("length", "k1", "k2").agg(F.collect_set("item_id").alias("ids"))
    named = _probe(hits.select("rid", "length", "k1", "k2").distinct(), shared, ["length", "k1", "k2"], n_windows)
    listed = named.groupBy("rid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"))
    none = F.array().cast("array<string>")
    out = rows.select("rid", "doc_id", "n_words").join(hit_words, "rid", "left").join(listed, "rid", "left")
    ids = F.coalesce("ids", none)
    return out.select(
        F.col("doc_id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM bw),
dw AS (SELECT doc_id, l, s, array_to_string(w[s + 1 : s + l], ' ') AS t FROM (SELECT doc_id, w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS s FROM d, ls)),
h AS (SELECT DISTINCT doc_id, l, s, t FROM dw SEMI JOIN bw USING (l, t)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS ids FROM h JOIN bw USING (l, t) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""
