import hashlib
import random
import re

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from plenum.llm import pii

PIECES = ["a.b", "@", "x", "mail", ".com", ".", "-", "+", "1", "23", "255", "256", "192.168.0.1", "4465758382889437", "4111 1111 1111 1111", "+1 (743) 555-3824", " ", "(", ")", "é", "\n", "000", "9" * 20, "_", "%"]


def slow(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == slow(text)


def brute(model, n, segments):
    scores = {(i, j): s for (i, j, *_), s in zip(segments, pii._scores(model, segments))}

    def go(i, y):
        if i == n:
            return 0.0
        return max((model.moves[y, t] + s[t] + go(j, t) for (a, j), s in scores.items() if a == i for t in range(pii.TYPES)), default=float("-inf"))

    return go(0, 0), scores


def test_decoding_is_optimal():
    model = pii.train()
    text = "call 555-12 @x"
    tokens = [m.span() for m in pii.TOKEN.finditer(text)]
    segments = pii.lattice(text, tokens, frozenset())
    best, scores = brute(model, len(tokens), segments)
    inside = {i: (j, y) for i, j, y in pii.decode(model, len(tokens), segments)}
    total, at, before = 0.0, 0, 0
    while at < len(tokens):
        j, y = inside.get(at, (at + 1, 0))
        total += model.moves[before, y] + scores[at, j][y]
        at, before = j, y
    assert abs(total - best) < 1e-6


def test_model_on_held_out_windows():
    model, rng = pii.train(), random.Random(99)
    want = got = both = 0
    for _ in range(150):
        text, spans = pii.generated(rng)
        gold = {(a, y - 1, b) for a, b, y in spans}
        found = set(pii.find(text, model)[1])
        want, got, both = want + len(gold), got + len(found), both + len(gold & found)
    print("precision", both / got, "recall", both / want)
    assert both / want > 0.85 and both / got > 0.85


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = pii.scan_pii(docs).toPandas().set_index("doc_id")
    for doc_id, text in docs.select("doc_id", "text").collect():
        want, row = slow(text), got.loc[doc_id]
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert row.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(row.spans.split(",")) | {""}
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]


def test_added_spans_on_real_text():
    """All documents of a table: no added span lies in a run of letters and digits, and all have their kind's form."""
    model, added = pii.train(), []
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist():
        base, every = pii.find(text or "", model)
        for a, k, b in set(every) - set(base):
            part, digits = text[a:b], re.sub("[^0-9]", "", text[a:b])
            assert not text[a - 1 : a].isalnum() and not text[b : b + 1].isalnum()
            assert k != 0 or "@" in part
            assert k == 0 or k == 4 or not re.search("[A-Za-z]", part)
            assert k != 2 or pii.luhn(digits)
            added.append((pii.KINDS[k], part))
    print(added)
    assert 0 < len(added) < 20


def test_hexadecimal_secrets_are_left_alone():
    model, rng = pii.train(), random.Random(12)
    for _ in range(200):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 64])))
        assert pii.find(f"token = {secret} and so on", model) == ([], [])


def test_nulls_empties_long_and_redaction(frame):
    rows = [(1, None), (2, ""), (3, "x a@b.co y"), (3, "x a@b.co y"), (4, "9" * 50_000 + "a" * 50_000), (None, "q")]
    df = frame(rows, ["spans", "n_ip", "t"])
    got = pii.scan_pii(df).toPandas()
    assert len(got) == 6 and list(got[got.doc_id == 3].spans) == ["email:2:8"] * 2
    clean = pii.redact(df)
    assert clean.schema == df.schema
    assert [r.text for r in clean.where("doc_id = 3").collect()] == ["x [EMAIL] y"] * 2
    assert clean.where("doc_id = 1").first().text is None
    assert pii.scan_pii(frame([])).count() == 0


def test_long_lists_lose_no_entry():
    model, rng = pii.train(), random.Random(3)
    for make in (lambda: f"{rng.randint(1, 899):03d}-{rng.randint(1, 99):02d}-{rng.randint(0, 9999):04d}", lambda: pii._iban(rng)):
        for join in (", ", "\n"):
            text, gold = "list ", set()
            for value in (make() for _ in range(150)):
                gold.add((len(text), len(text) + len(value)))
                text += value + join
            found = pii.find(text, model)[1]
            assert {(a, b) for a, _, b in found} == gold
            assert not re.search("[0-9]", pii.mask(text, found))
