"""Quality rules whose cutoffs carry a guarantee on false rejection.

Four rule statistics of a text are compared with cutoffs chosen per stratum (language). On
labelled rows, every cutoff of a rule's grid is a hypothesis "a good document is rejected with
a probability above the rule's part of ``alpha``"; the parts of the rules add up to ``alpha``,
which so bounds what all rules together reject in a stratum. Its exact binomial p-value comes from the good documents that
it rejects. Grids are tested from the mildest cutoff on (fixed sequence), and rules and strata
share the error level ``delta`` by a Bonferroni correction; the strictest cutoff reached is
used. Where no cutoff can be certified, the rule rejects nothing in that stratum.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import staged, text_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
#: Share of a stratum's good documents that the rules together may reject, and the chance that any bound fails.
ALPHA, DELTA = 0.05, 0.05
#: Strata with cutoffs up to which these are broadcast; of more, each is dealt to ``SALTS`` places.
MOST, SALTS = 50_000, 16
#: Rules: numerator, denominator, and the grid of cutoffs in thousandths, mildest first. Fixed values.
RULES = {
    "symbols": ("n_symbols", "word_chars", (500, 400, 300, 250, 200, 150, 100, 70, 50)),
    "dup_lines": ("n_dup_lines", "n_lines", (800, 700, 600, 500, 400, 300, 200, 100)),
    "repeats": ("n_repeat_words", "n_words", (500, 400, 300, 250, 200, 150, 100)),
    "capitals": ("n_capitals", "word_chars", (900, 800, 700, 600, 500, 400, 300)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_capitals")


def statistics(text: str) -> tuple[int, ...]:
    """``COUNTS`` and ``MORE`` of a whole text."""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, c in Counter(windows).items() if c > 1}
    repeat, reach = 0, 0
    if often:
        for k, w in enumerate(windows):
            if w in often:
                repeat += k + 3 - max(reach, k)
                reach = k + 3
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup, repeat, lines, sum(map(str.isupper, text))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), by its terms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(counts: dict[int, int], good: int, grid: tuple[int, ...], alpha: float, level: float) -> int | None:
    """Strictest cutoff whose false rejection is certified. ``counts[c]``: good rows above cutoff c."""
    best = None
    for cutoff in grid:
        if not good or binomial_tail(counts[cutoff], good, alpha) > level:
            break
        best = cutoff
    return best


def _measure(docs: DataFrame, extra: list[str], id_col: str, text_col: str) -> DataFrame:
    names = [*COUNTS, *MORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(statistics(x.as_py()) for x in batch.column(1)))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *extra, *names])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("t"), *(docs[c].cast("string").alias(c) for c in extra))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"`{c}` string" for c in extra), *(f"{c} long" for c in names)]))


def _above(rule: str, cutoff):
    top, under, _ = RULES[rule]
    return F.coalesce(F.col(top) * 1000 > cutoff * F.col(under), F.lit(False))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, alpha: float, delta: float, id_col: str = "doc_id") -> DataFrame:
    """``_stratum, _<rule>...``: certified cutoffs of each stratum that has one, null where a rule has none."""
    good = labels.where(labels.quality == 1).select(labels[id_col].cast("long").alias("doc_id")).distinct()
    passed = measured.where("NOT base_failed").join(good, "doc_id")
    sums = [F.count_if(_above(r, c)).alias(f"{r}_{c}") for r, (_, _, grid) in RULES.items() for c in grid]
    found = staged(passed.groupBy(F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("good"), *sums), "quality-strata")
    level = delta / max(1, len(RULES) * found.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            best = [pa.array([certified({c: row[f"{rule}_{c}"] for c in grid}, row["good"], grid, alpha / len(RULES), level) for row in rows], pa.int32()) for rule, (_, _, grid) in RULES.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *best], ["_stratum", *(f"_{r}" for r in RULES)])

    out = found.mapInArrow(run, ", ".join(["_stratum string", *(f"_{r} int" for r in RULES)]))
    return staged(out.where(F.coalesce(*(F.col(f"_{r}") for r in RULES)).isNotNull()), "quality-cutoffs")


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the counts, ``base_failed``, ``kept``.

    A null text has no words and fails the base rules. A null stratum is a stratum. Labels that
    are null, or of rows without a document, are not used; of strata without good labels
    nothing is rejected but by the base rules. Repeated rows count each. An empty table gives no rows; columns beyond those named are not read.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # every text is measured once; what follows moves about a hundred bytes a row
    measured = staged(_measure(docs, [stratum], id_col, text_col).withColumn("base_failed", base), "quality-counts")
    chosen = cutoffs(measured, labels, stratum, alpha, delta, id_col)
    same = F.col(stratum).eqNullSafe(F.col("_stratum"))
    if chosen.count() <= MOST:
        chosen = F.broadcast(chosen)
    else:
        measured = measured.withColumn("_salt", F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(SALTS)))
        chosen = chosen.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = same & (F.col("_salt") == F.col("_place"))
    measured = measured.join(chosen, same, "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | _above(rule, F.col(f"_{rule}"))
    out = measured.withColumn("kept", ~F.col("base_failed") & ~rejected)
    return out.select(F.col("doc_id").alias(id_col), *COUNTS, "base_failed", "kept")


_GRIDS = ", ".join(f"('{rule}', {list(grid)})" for rule, (_, _, grid) in RULES.items())
_LONG = " UNION ALL ".join(f"SELECT rid, doc_id, lang, base_failed, '{rule}' AS rule, {top} AS top, {under} AS under FROM c" for rule, (top, under, _) in RULES.items())
_PART = f"({ALPHA}::DOUBLE / {len(RULES)})"
ORACLE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, k, w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3] AS x FROM (SELECT rid, w, unnest(range(len(w) - 2)) AS k FROM w WHERE len(w) > 2)),
o AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, x) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT k + i) AS n FROM o CROSS JOIN (VALUES (0), (1), (2)) v(i) GROUP BY rid),
c AS (SELECT rid, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_capitals,
  len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed FROM w LEFT JOIN r USING (rid)),
x AS ({_LONG}),
p AS (SELECT x.* FROM x SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id) WHERE NOT base_failed),
grid AS (SELECT rule, unnest(range(len(cuts))) AS i, unnest(cuts) AS cutoff FROM (VALUES {_GRIDS}) v(rule, cuts)),
s AS (SELECT lang, rule, i, cutoff, count(*) AS n, count(*) FILTER (1000 * top > cutoff * under) AS k FROM p JOIN grid USING (rule) GROUP BY ALL),
f AS (SELECT *, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda a: exp(lgamma(n + 1) - lgamma(a + 1) - lgamma(n - a + 1) + a * ln({_PART}) + (n - a) * ln(1 - {_PART})))) END
  > {DELTA}::DOUBLE / ({len(RULES)} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM p))) AS failed FROM s),
u AS (SELECT *, coalesce(min(i) FILTER (failed) OVER (PARTITION BY lang, rule), 99) AS stop FROM f),
q AS (SELECT lang, rule, arg_max(cutoff, i) AS cutoff FROM u WHERE i < stop GROUP BY ALL),
z AS (SELECT DISTINCT rid FROM x JOIN q ON x.rule = q.rule AND x.lang IS NOT DISTINCT FROM q.lang WHERE 1000 * top > cutoff * under)
SELECT doc_id, {", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in COUNTS)}, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM z) AS kept FROM c"""
