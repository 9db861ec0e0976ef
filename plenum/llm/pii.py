"""Personal data by rules and a semi-Markov conditional random field.

Four base kinds are found by rules and always stay. The model adds spans. It works on windows:
runs of blocks that hold a digit or an ``@``, with two words before them. A window is split into
tokens; a candidate segment is a run of at most ``MAX_TOKENS`` tokens, scored as a whole (its
shape, digit count, checksums, separators, whether it is a base match, the word before). A
dynamic programme over (end, length, type) chooses boundaries and types together. Outside a
window no segment of these types is possible, as each holds a digit or an ``@``.

The weights are trained on generated windows (a fixed seed), by stochastic gradient steps on
the conditional likelihood.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import bound_batches, text_of

#: Base kinds, in order; then the kinds that only the model finds; type 0 is outside.
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn")
KINDS = (*BASE, *MORE)
TYPES = len(KINDS) + 1
MAX_TOKENS = 12
DIM = 1 << 13

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S", re.ASCII)
BLOCK = re.compile(r"\S+")
TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    return out


# --- the model ------------------------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def _feature(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % DIM


def shape(text: str) -> str:
    """Letters as a or A, digits as 9, repeats with their number; other characters stay."""
    out = []
    for c in text:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else "_" if c.isspace() else c
        if out and out[-1][0] == k:
            out[-1][1] += 1
        else:
            out.append([k, 1])
    return "".join(f"{k}{n}" if k == "9" else k for k, n in out)


def segment_features(text: str, a: int, b: int, before: str, after: str, base: frozenset) -> list[int]:
    part = text[a:b]
    digits = NOT_DIGIT.sub("", part)
    n = len(digits)
    names = [
        f"shape={shape(part)[:40]}",
        f"first={'d' if part[0].isdigit() else 'a' if part[0].isalpha() else part[0]}",
        f"last={'d' if part[-1].isdigit() else 'a' if part[-1].isalpha() else part[-1]}",
        f"digits={min(n, 20)}",
        f"before={before.lower()[:12]}",
        f"glue={text[a - 1 : a].isalnum() or text[a - 1 : a] in ('.', '-', '+', '@') if a else False}/{text[b : b + 1].isalnum() or after in ('-', '@')}",
        f"space={' ' in part}",
    ]
    names += [f"base={KINDS[k]}" for k in range(len(BASE)) if (a, k, b) in base]
    if 9 <= n <= 9 and re.fullmatch(r"[0-9]{3}([ -])[0-9]{2}\1[0-9]{4}", part):
        names.append("ssn")
    if 12 <= n <= 19 and CARD.fullmatch(part):
        names.append(f"luhn={luhn(digits)}")
    tight = part.replace(" ", "")
    if 15 <= len(tight) <= 34 and tight.isascii() and re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]+", tight) and mod97(tight):
        names.append("mod97")
    return [_feature(x) for x in names]


#: What a segment of each type may look like. Fixed values.
SHAPES = (
    re.compile(r"[^\s@]+@[^\s@]+\.[^\s@]+"),
    re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ -]?[0-9]){11,18}"),
    re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}"),
    re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"),
    re.compile(r"[0-9]{3}([ -])[0-9]{2}\1[0-9]{4}"),
)


def allowed(text: str, a: int, b: int) -> list[int]:
    """Types that ``text[a:b]`` may have. None does that begins or ends inside a run of letters and digits."""
    if (a and text[a - 1].isalnum() and text[a].isalnum()) or (b < len(text) and text[b].isalnum() and text[b - 1].isalnum()):
        return []
    return [k + 1 for k, shape_of in enumerate(SHAPES) if shape_of.fullmatch(text, a, b)]


class Model:
    """``weights[feature, type]`` and ``moves[type before, type]``."""

    def __init__(self):
        self.weights = np.zeros((DIM, TYPES))
        self.moves = np.zeros((TYPES, TYPES))


def candidates(text: str, tokens: list[tuple[int, int]], base: frozenset) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Candidate segments (first token, end token, features, types), by first token. One token may be outside, type 0."""
    for i, (a, _) in enumerate(tokens):
        before = text[tokens[i - 1][0] : tokens[i - 1][1]] if i else ""
        for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
            b = tokens[j - 1][1]
            if j > i + 1 and "\n" in text[tokens[j - 2][1] : tokens[j - 1][0]]:
                break
            types = allowed(text, a, b)
            if j == i + 1:
                types.append(0)
            elif not types:
                continue
            after = text[tokens[j][0] : tokens[j][1]] if j < len(tokens) else ""
            yield i, j, segment_features(text, a, b, before, after, base), types


def lattice(text: str, tokens: list[tuple[int, int]], base: frozenset) -> list[tuple[int, int, list[int], list[int]]]:
    return list(candidates(text, tokens, base))


def _score(model: Model, f: list[int], types: list[int]) -> np.ndarray:
    s = np.full(TYPES, -np.inf)
    s[types] = model.weights[f].sum(axis=0)[types]
    return s


def _scores(model: Model, segments) -> list[np.ndarray]:
    return [_score(model, f, types) for _, _, f, types in segments]


def decode(model: Model, n: int, segments) -> list[tuple[int, int, int]]:
    """Best segmentation as (first token, end token, type), outside left out.

    ``segments`` come by first token and are read once, so a window of any length is decoded
    whole: only the last columns of scores are held, and two bytes a token and type to go back.
    """
    ring = MAX_TOKENS + 1
    best = np.full((ring, TYPES), -np.inf)  # column j is row j % ring
    best[0, 0] = 0
    length = np.zeros((n + 1, TYPES), np.uint8)
    prior = np.zeros((n + 1, TYPES), np.uint8)
    at = -1
    for i, j, f, types in segments:
        while at < i:
            if at >= 0:
                best[at % ring] = -np.inf  # becomes column at + ring
            at += 1
            reach = best[at % ring][:, None] + model.moves
            top, arg = reach.max(axis=0), reach.argmax(axis=0)
        value = top + _score(model, f, types)
        better = value > best[j % ring]
        best[j % ring, better] = value[better]
        length[j, better] = j - i
        prior[j, better] = arg[better]
    out, j, y = [], n, int(best[n % ring].argmax())
    while j:
        i, before = j - int(length[j, y]), int(prior[j, y])
        if y:
            out.append((i, j, y))
        j, y = i, before
    return out[::-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.maximum(x.max(axis=axis), -1e30)
    return np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis)) + top


def _step(model: Model, n: int, segments, gold: set, rate: float) -> None:
    """One gradient step on the conditional likelihood of ``gold`` segments."""
    scores = _scores(model, segments)
    alpha = np.full((n + 1, TYPES), -np.inf)
    alpha[0, 0] = 0
    beta = np.full((n + 1, TYPES), -np.inf)
    beta[n] = 0
    with np.errstate(divide="ignore", invalid="ignore"):
        into = {}
        for (i, j, *_), s in zip(segments, scores):
            if i not in into:
                into[i] = _lse(alpha[i][:, None] + model.moves, 0)
            alpha[j] = np.logaddexp(alpha[j], into[i] + s)
        for (i, j, *_), s in sorted(zip(segments, scores), key=lambda x: -x[0][0]):
            beta[i] = np.logaddexp(beta[i], _lse(model.moves + (s + beta[j])[None, :], 1))
    z = beta[0, 0]
    moves = np.zeros_like(model.moves)
    for (i, j, f, _), s in zip(segments, scores):
        joint = np.exp(alpha[i][:, None] + model.moves + (s + beta[j])[None, :] - z)
        moves -= joint
        grad = -joint.sum(axis=0)
        for y in range(TYPES):
            if (i, j, y) in gold:
                grad[y] += 1
        np.add.at(model.weights, f, rate * grad)
    last = 0
    for _, _, y in sorted(gold):
        moves[last, y] += 1
        last = y
    model.moves += rate * moves


def _luhn_number(rng: random.Random, n: int) -> str:
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + c for c in "0123456789" if luhn(head + c))


def _iban(rng: random.Random) -> str:
    country, rest = rng.choice(["DE", "FR", "ES", "GB", "NL", "IT"]), "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97
    flat = f"{country}{check:02d}{rest}"
    return flat if rng.random() < 0.5 else " ".join(flat[k : k + 4] for k in range(0, len(flat), 4))


def generated(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A made-up window and its (start, end, type) spans."""

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def hexes(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def word():
        return "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8)))

    def not_luhn(n):
        head = number(n)
        return head if not luhn(head) else head[:-1] + str((int(head[-1]) + rng.randint(1, 9)) % 10)

    text, spans = word() + " ", []
    for _ in range(rng.randint(1, 2)):
        kind = rng.randint(-6, len(KINDS))
        if kind == 1:
            value = f"{word()}{rng.choice(['.', '', '_'])}{number(2)}@{word()}{number(1)}.{word()}.{rng.choice(['com', 'org', 'net'])}"
        elif kind == 2:
            value = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        elif kind == 3:
            value = _luhn_number(rng, rng.choice([14, 15, 16, 16, 16]))
            if rng.random() < 0.5:
                value = rng.choice(" -").join(value[k : k + 4] for k in range(0, len(value), 4))
            if rng.random() < 0.15:  # twice in a row: the base rule takes both as one and drops it
                text += value + " "
                spans.append((len(text) - len(value) - 1, len(text) - 1, kind))
        elif kind == 4:
            area, mid, end = number(3), number(3), number(4)
            value = rng.choice([f"+1 ({area}) {mid}-{end}", f"+{number(2)} {area} {mid} {end}", f"({area}) {mid}-{end}", f"+1-{area}-{mid}-{end}", f"{area}-{mid}-{end}"])
        elif kind == 5:
            value = _iban(rng)
        elif kind == 6:
            value = f"{rng.randint(1, 899):03d}-{rng.randint(1, 99):02d}-{number(4)}"
        else:
            value = rng.choice([number(rng.randint(1, 13)), f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{number(2)}:{number(2)}", f"{number(1)}.{number(2)}", f"{number(3)}%", f"{word()}{number(2)}", f"v{number(1)}.{number(1)}.{number(2)}", f"@{word()}", number(20), f"{number(4)} {number(4)}", f"{number(40)}", not_luhn(rng.randint(13, 19)), " ".join([not_luhn(16)] * 2), hexes(40), hexes(rng.randint(6, 32)), f"AKIA{hexes(16).upper()}", f"id={hexes(8)}-{hexes(4)}", f"{number(2)}/{number(2)}/{number(4)}", f"{number(2)}.{number(2)}.{rng.randint(1900, 2030)}", f"#{number(rng.randint(3, 12))}", f"{number(3)},{number(3)},{number(3)}", f"{number(3)}-{number(4)}", f"{number(5)}-{number(4)}"])
        cue = rng.choice(["", "", word() + " ", {1: "mail ", 2: "host ", 3: "card ", 4: "call ", 5: "iban ", 6: "ssn "}.get(kind, "no ")])
        text += cue
        if kind > 0:
            spans.append((len(text), len(text) + len(value), kind))
        text += value + rng.choice([" ", ", ", ". "]) + word() + " "
    return text.rstrip(), spans


@lru_cache(maxsize=2)
def train(seed: int = 7, size: int = 400, epochs: int = 4) -> Model:
    rng, model = random.Random(seed), Model()
    data = []
    for _ in range(size):
        text, spans = generated(rng)
        tokens = [m.span() for m in TOKEN.finditer(text)]
        starts, ends = {a: k for k, (a, _) in enumerate(tokens)}, {b: k + 1 for k, (_, b) in enumerate(tokens)}
        gold = {(starts[a], ends[b], y) for a, b, y in spans if a in starts and b in ends and ends[b] - starts[a] <= MAX_TOKENS}
        inside = {k for i, j, _ in gold for k in range(i, j)}
        gold |= {(k, k + 1, 0) for k in range(len(tokens)) if k not in inside}
        data.append((len(tokens), lattice(text, tokens, frozenset(base_spans(text))), gold))
    for epoch in range(epochs):
        for n, segments, gold in data:
            _step(model, n, segments, gold, 0.3 / (1 + epoch))
        rng.shuffle(data)
    return model


# --- scanning -------------------------------------------------------------------------------


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Runs of blocks with a trigger, with up to two blocks before and one after, joined where they meet."""
    start = stop = -1
    for m in TRIGGER.finditer(text):
        if m.start() < stop:
            continue
        a = m.start()
        for _ in range(3):
            while a > 0 and not text[a - 1].isspace():
                a -= 1
            if _ < 2:
                while a > 0 and text[a - 1].isspace():
                    a -= 1
        b = m.end()
        while b < len(text) and not text[b].isspace():
            b += 1
        if start >= 0 and a <= stop + 1:
            stop = b
        else:
            if start >= 0:
                yield start, stop
            start, stop = a, b
    if start >= 0:
        yield start, stop


def added_spans(text: str, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """The model's spans (start, kind, end) that touch no base span."""
    out, at = [], 0
    for a, b in windows(text):
        part = text[a:b]
        while at < len(base) and base[at][2] <= a:
            at += 1
        near, k = [], at
        while k < len(base) and base[k][0] < b:
            near.append(base[k])
            k += 1
        local = frozenset((x - a, kind, y - a) for x, kind, y in near)
        tokens = [m.span() for m in TOKEN.finditer(part)]
        for i, j, y in decode(model, len(tokens), candidates(part, tokens, local)):
            x, z = tokens[i][0] + a, tokens[j - 1][1] + a
            if z - x >= 7 and not any(x < e and s < z for s, _, e in near):
                out.append((x, y - 1, z))
    return out


def find(text: str, model: Model) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(set(base) | set(added_spans(text, base, model)))


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, counts of base kinds, ``base_sha256``, ``spans``.

    Spans are ``kind:start:end`` in code points. A null text is empty; repeated rows give
    repeated results; an empty table gives no rows; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    model = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes, spans = [[] for _ in BASE], [], []
            for x in batch.column(1):
                base, every = find(x.as_py(), model)
                for k in range(len(BASE)):
                    counts[k].append(sum(s[1] == k for s in base))
                hashes.append(hashlib.sha256(_join(base).encode()).hexdigest())
                spans.append(_join(every))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("t"))
    out = rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return out.withColumnRenamed("doc_id", id_col)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked; null texts stay null, other columns pass through."""
    bound_batches(docs.sparkSession)
    model, at, names = train(), docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else mask(t, find(t, model)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
