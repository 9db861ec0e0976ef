import base64
import gzip
import hashlib
import zlib

import pytest

from plenum.llm import warc


def slow(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = max(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = i is not None and len(data) >= least and i < first[h or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert rows_of(warc.round_trip(pages)) == slow([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_nulls_ties_and_odd_texts(spark, monkeypatch):
    rows = [(1, "u\r\nX: y", "a"), (2, None, "a"), (3, "é%", None), (4, "", ""), (5, "u", "WARC/1.1\r\n\r\n" * 30_000), (None, "u", "a"), (2, "v", "a"), (6, "u", "long enough")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as sha", "2 as salt", "3 as page", "4 as n")
    assert rows_of(warc.round_trip(pages)) == slow(rows)
    assert rows_of(warc.round_trip(pages, least=2)) == slow(rows, 2)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_normaliser_makes_members_that_read_alone(tmp_path):
    records = [warc.record({"WARC-Type": "response", "N": str(k)}, bytes([k]) * (k * 70_000)) for k in range(5)]
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:])))
    assert warc.normalise_file(str(tmp_path / "a.gz"), str(tmp_path / "b.gz"), str(tmp_path / "b.idx")) == 5
    data = (tmp_path / "b.gz").read_bytes()
    spans = [tuple(map(int, x.split())) for x in (tmp_path / "b.idx").read_text().splitlines()]
    assert [gzip.decompress(data[a : a + n]) for a, n in spans] == records


def test_streams_that_are_cut_or_padded():
    one = gzip.compress(warc.record({"WARC-Type": "response"}, b"x" * 300_000))
    for cut in (1, 4, 8, 12, len(one) // 2):
        with pytest.raises(ValueError):
            list(warc.normalise([one + one[:-cut]]))
    assert len(list(warc.normalise([one + b"\0" * 700, b"\0" * 9 + one, b"\0"]))) == 2
    assert [len(x) for x in warc.normalise(one[k : k + 7] for k in range(0, len(one), 7))] == [2]
    with pytest.raises(zlib.error):
        list(warc.normalise([one[:-6] + b"\1" + one[-5:]]))  # another checksum
