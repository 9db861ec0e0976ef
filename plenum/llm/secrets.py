"""Secret scan by one combined deterministic automaton.

Every rule is a small regular expression. The rules are parsed to position automata, joined
under an unanchored start, turned deterministic by subset construction and minimised by
partition refinement. The result is one array of transitions over bytes; a text is scanned for
all rules in a single pass. Where the pass reports that some rule's match has ended, that
rule's own two automata (the reverse one leftwards, the forward one rightwards, built the same
way) give the leftmost start and the longest end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from plenum.llm.common import bound_batches, text_of

LETTERS, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789"


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, ``[classes]``, ``(a|b)``, ``? * + {n} {n,} {n,m}``, ``\\xHH``.

    ``least``: characters of a match (after ``value``'s opening part, if set) below which the
    match is dropped. ``fold``: letters of the part before the value match in either case.
    """

    kind: str
    pattern: str
    least: int = 0
    value: str = ""
    fold: bool = False


#: The base rules. Fixed values; order is the order of kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", 8, "[A-Za-z0-9+/_.=-]+", fold=True),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{32,}", 32),
)
#: Further rules for formats that providers document publicly. Fixed values.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


# --- regular expression to position automaton -------------------------------------------------


@dataclass
class Nfa:
    """Epsilon automaton: ``edges[state]`` lists (byte mask or None, next state)."""

    edges: list[list[tuple[int | None, int]]] = field(default_factory=list)

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def add(self, a: int, mask: int | None, b: int) -> None:
        self.edges[a].append((mask, b))


def mask_of(chars: str, fold: bool = False) -> int:
    out = 0
    for c in chars:
        for x in {c.lower(), c.upper()} if fold and c in LETTERS else {c}:
            out |= 1 << ord(x)
    return out


class Parser:
    """Recursive descent; the tree is built of ('set', mask), ('cat', [..]), ('alt', [..]), ('rep', x, lo, hi)."""

    def __init__(self, text: str, fold: bool):
        self.text, self.at, self.fold = text, 0, fold

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def alternatives(self):
        branches = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            branches.append(self.sequence())
        return branches[0] if len(branches) == 1 else ("alt", branches)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        item = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at : end].partition(",")
                self.at = end + 1
                bounds = (int(low), int(high) if high else (None if comma else int(low)))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            item = ("rep", item, *bounds)
        return item

    def char(self) -> str:
        c = self.text[self.at]
        self.at += 1
        if c != "\\":
            return c
        c = self.text[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return chr(int(self.text[self.at - 2 : self.at], 16))
        return c

    def atom(self):
        if self.peek() == "(":
            self.at += 1
            inner = self.alternatives()
            self.at += 1
            return inner
        if self.peek() != "[":
            return ("set", mask_of(self.char(), self.fold))
        self.at += 1
        chars = ""
        while self.peek() != "]":
            c = self.char()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                c = "".join(map(chr, range(ord(c), ord(self.char()) + 1)))
            chars += c
        self.at += 1
        return ("set", mask_of(chars, self.fold))


def parse(rule: Rule):
    tree = Parser(rule.pattern, rule.fold).alternatives()
    return ("cat", [tree, Parser(rule.value, False).alternatives()]) if rule.value else tree


def reverse(tree):
    if tree[0] == "cat":
        return ("cat", [reverse(x) for x in reversed(tree[1])])
    if tree[0] == "alt":
        return ("alt", [reverse(x) for x in tree[1]])
    return ("rep", reverse(tree[1]), *tree[2:]) if tree[0] == "rep" else tree


def build(nfa: Nfa, tree, start: int) -> int:
    """Add ``tree`` to the automaton from ``start``; the state it ends in."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.add(start, tree[1], end)
        return end
    if kind == "cat":
        for part in tree[1]:
            start = build(nfa, part, start)
        return start
    if kind == "alt":
        end = nfa.state()
        for part in tree[1]:
            nfa.add(build(nfa, part, start), None, end)
        return end
    _, inner, low, high = tree
    for _ in range(low):
        start = build(nfa, inner, start)
    if high is None:
        loop = nfa.state()
        nfa.add(start, None, loop)
        nfa.add(build(nfa, inner, loop), None, loop)
        return loop
    end = nfa.state()
    nfa.add(start, None, end)
    for _ in range(high - low):
        start = build(nfa, inner, start)
        nfa.add(start, None, end)
    return end


@dataclass
class Dfa:
    """``next[state][byte]`` is a state; state 0 is the start. ``accepts[state]``: rules that end here."""

    next: list[list[int]]
    accepts: list[frozenset[int]]
    dead: int | None


def determinise(nfa: Nfa, start: int, finals: dict[int, int], anchored: bool) -> Dfa:
    """Subset construction; unanchored automata re-enter the start before every byte."""
    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, queue = {state}, [state]
            while queue:
                for mask, to in nfa.edges[queue.pop()]:
                    if mask is None and to not in seen:
                        seen.add(to)
                        queue.append(to)
            closures[state] = frozenset(seen)
        return closures[state]

    first = closure(start)
    names, order, rows = {first: 0}, [first], []
    at = 0
    while at < len(order):
        here = order[at]
        at += 1
        moves = [(mask, closure(to)) for s in here for mask, to in nfa.edges[s] if mask is not None]
        row, memo = [0] * 256, {}
        for byte in range(256):
            hit = tuple(k for k, (mask, _) in enumerate(moves) if mask >> byte & 1)
            if hit not in memo:
                to = frozenset().union(*(moves[k][1] for k in hit), *(() if anchored else (first,)))
                if to not in names:
                    names[to] = len(order)
                    order.append(to)
                memo[hit] = names[to]
            row[byte] = memo[hit]
        rows.append(row)
    accepts = [frozenset(finals[s] for s in x if s in finals) for x in order]
    return minimise(rows, accepts)


def minimise(rows: list[list[int]], accepts: list[frozenset[int]]) -> Dfa:
    """Merge states that no input tells apart (partition refinement, start kept as state 0)."""
    # bytes that every state treats alike are looked at once
    columns = list(dict.fromkeys(zip(*rows)))
    compact = list(zip(*columns))
    block = [0] * len(rows)
    kinds: dict = {}
    for s, a in enumerate(accepts):
        block[s] = kinds.setdefault(a, len(kinds))
    count = len(kinds)
    while True:
        seen: dict = {}
        new = [seen.setdefault((block[s], *(block[t] for t in compact[s])), len(seen)) for s in range(len(rows))]
        block = new
        if len(seen) == count:
            break
        count = len(seen)
    pick = {}
    for s, b in enumerate(block):  # blocks are numbered in order of their first state
        pick.setdefault(b, s)
    table = [[block[t] for t in rows[pick[b]]] for b in range(count)]
    ends = [accepts[pick[b]] for b in range(count)]
    dead = next((b for b in range(count) if not ends[b] and all(t == b for t in table[b])), None)
    return Dfa(table, ends, dead)


def compile_rules(rules: tuple[Rule, ...]) -> tuple[Dfa, list[Dfa], list[Dfa]]:
    """The combined scanner, and each rule's anchored forward and reverse automata."""
    nfa, finals = Nfa(), {}
    start = nfa.state()
    forward, backward = [], []
    for k, rule in enumerate(rules):
        tree = parse(rule)
        begin = nfa.state()
        nfa.add(start, None, begin)
        finals[build(nfa, tree, begin)] = k
        for way, into in ((tree, forward), (reverse(tree), backward)):
            one = Nfa()
            s = one.state()
            end = build(one, way, s)
            into.append(determinise(one, s, {end: 0}, anchored=True))
    return determinise(nfa, start, finals, anchored=False), forward, backward


# --- scanning ---------------------------------------------------------------------------------


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        self.scan, self.forward, self.backward = compile_rules(rules)
        self.heads = [None] * len(rules)  # automata of what comes before the value
        for k, rule in enumerate(rules):
            if rule.value:
                one = Nfa()
                s = one.state()
                end = build(one, Parser(rule.pattern, rule.fold).alternatives(), s)
                self.heads[k] = determinise(one, s, {end: 0}, anchored=True)
        self._link()

    def _link(self) -> None:
        # A state is the list of its successors, so a step is one index; slot 256 has its rules.
        # A rule is reported where its match first ends, not again while that match grows.
        states = [[None] * 257 for _ in self.scan.next]
        for row, state, ends in zip(self.scan.next, states, self.scan.accepts):
            state[:256] = [states[t] for t in row]
            state[256] = sorted(ends) or None
        self.start = states[0]

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "start"}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._link()

    @staticmethod
    def _longest(dfa: Dfa, data: bytes, at: int, step: int, stop: int) -> int:
        """Furthest position from ``at`` (moving by ``step``) where ``dfa`` accepts; -1 if none."""
        state, best = 0, -1
        table, ends, dead = dfa.next, dfa.accepts, dfa.dead
        while at != stop:
            state = table[state][data[at if step > 0 else at - 1]]
            if state == dead:
                break
            at += step
            if ends[state]:
                best = at
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, leftmost and non-overlapping per rule, failing matches dropped."""
        out = []
        last = [0] * len(self.rules)  # where each rule's search goes on
        state, at = self.start, 0
        for byte in data:
            state = state[byte]
            at += 1
            if state[256]:
                for k in state[256]:
                    if at <= last[k]:
                        continue
                    begin = self._longest(self.backward[k], data, at, -1, last[k])
                    if begin < 0:
                        continue
                    end = self._longest(self.forward[k], data, begin, 1, len(data))
                    last[k] = end
                    size = end - begin
                    if self.heads[k] is not None:
                        size = end - self._value(k, data, begin, end)
                    if size >= self.rules[k].least:
                        out.append((begin, end, k))
        out.sort()
        return out

    def _value(self, k: int, data: bytes, begin: int, end: int) -> int:
        return self._longest(self.heads[k], data, begin, 1, end)


def to_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code point spans."""
    edges = sorted({x for a, b, _ in spans for x in (a, b)})
    points, before, count = {}, 0, 0
    for x in edges:
        count += len(data[before:x].decode("utf-8", "replace"))
        before = x
        points[x] = count
    return [(points[a], points[b], k) for a, b, k in spans]


@lru_cache(maxsize=1)
def default_scanner() -> Scanner:
    """Compiled once, on the driver; tasks get its transition tables."""
    return Scanner()


def _digest(scanner: Scanner, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = len(BASE)
    for batch in batches:
        counts, hashes, spans = [[] for _ in range(base)], [], []
        for x in batch.column(1):
            data = x.as_py()
            found = to_points(data, scanner.spans(data))
            named = [f"{scanner.rules[k].kind}:{a}:{b}" for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]
            own = [n for n, (_, _, k) in zip(named, sorted(found, key=lambda s: (s[0], s[2]))) if k < base]
            for k in range(base):
                counts[k].append(sum(s[2] == k for s in found))
            hashes.append(hashlib.sha256(",".join(own).encode()).hexdigest())
            spans.append(",".join(named))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text: one row per row of ``docs``.

    Returns ``id_col``, the counts of the base kinds, ``base_sha256`` and ``spans``
    (``kind:start:end`` in code points, by start, then by the order of the rules). A null text
    is empty; repeated rows give repeated results; an empty table gives none; other columns are
    not read. The scan holds one text at a time and takes time in proportion to its length.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).cast("binary").alias("t"))
    bound_batches(docs.sparkSession)
    out = rows.mapInArrow(partial(_digest, default_scanner()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return out.withColumnRenamed("doc_id", id_col)
