"""WARC archives: writing, a normaliser for monolithic gzip, and reading by a sidecar index.

Writers that compress a whole archive as one gzip stream make single records unreachable. The
normaliser inflates such a stream once, piece by piece, cuts it at the record boundaries,
writes every record as a gzip member of its own, and lists ``(offset, length)`` of each member
in a sidecar index. Records can then be read alone.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import WRITING, scratch_dir, settings, staged, text_of

#: Payload bytes after which a new archive is begun; one record is never cut.
ARCHIVE_BYTES = 8 << 20
SALTS = 16
STEP = 1 << 16
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def one_line(value: str) -> str:
    """Header text: breaks and ``%`` are percent-coded, so any string survives a header line."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n%" or ord(c) < 32 else c for c in value)


def inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Inflated pieces of bounded size, over any number of members."""
    engine, begun = zlib.decompressobj(31), False
    for chunk in chunks:
        while chunk:
            if not begun:  # padding between and after members
                chunk = chunk.lstrip(b"\0")
                if not chunk:
                    break
                begun = True
            out = engine.decompress(chunk, STEP)
            if out:
                yield out
            if engine.eof:
                chunk, begun = engine.unused_data, False
                engine = zlib.decompressobj(31)
            else:
                chunk = engine.unconsumed_tail
    while begun and not engine.eof:  # what is held back; a member's last bytes are its checksum
        out = engine.decompress(b"", STEP)
        if not out:
            raise ValueError("the stream ends inside a member")
        yield out


def split_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records from inflated pieces; holds one record at a time."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).lower().split(b"\r\n")
                length = next((x for x in head if x.startswith(b"content-length:")), None)
                if not head[0].startswith(b"warc/") or length is None:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(length[15:]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


def gzip_member(data: bytes) -> bytes:
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def normalise(chunks: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset, member) for every record of a gzip stream, whatever its members were."""
    at = 0
    for one in split_records(inflate(chunks)):
        member = gzip_member(one)
        yield at, member
        at += len(member)


def normalise_file(source: str, target: str, index: str) -> int:
    """Rewrite an archive file by record and write its index, a line ``offset length`` a record."""
    count = 0
    with open(source, "rb") as f, open(target, "wb") as out, open(index, "w") as side:
        for at, member in normalise(iter(lambda: f.read(STEP), b"")):
            out.write(member)
            side.write(f"{at} {len(member)}\n")
            count += 1
    return count


def parse(one: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = one.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of about ``ARCHIVE_BYTES``, each one gzip stream."""
    engine, parts, size = None, [], 0

    def close():
        return pa.RecordBatch.from_arrays([pa.array([b"".join([*parts, engine.flush()])], pa.binary())], ["archive"])

    for batch in batches:
        for page, url, html, sha, kind, refers in zip(*(batch.column(k) for k in range(6))):
            page, payload, kind = page.as_py(), html.as_py(), kind.as_py()
            name = "none" if page is None else str(page)
            headers = {
                "WARC-Type": kind,
                "WARC-Record-ID": f"<urn:page:{name}>",
                "WARC-Target-URI": one_line(url.as_py() or ""),
                "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha.as_py())).decode(),
                "X-Payload-Length": str(len(payload)),
            }
            if kind == "revisit":
                headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{refers.as_py()}>"}
            engine = engine or zlib.compressobj(6, zlib.DEFLATED, 31)
            parts.append(engine.compress(record(headers, b"" if kind == "revisit" else payload)))
            size += len(payload) + 512
            if size >= ARCHIVE_BYTES:
                yield close()
                engine, parts, size = None, [], 0
    if engine:
        yield close()


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every archive by record, and its index, as rows of two kinds."""
    task, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        for x in batch.column(0):
            found, name = list(normalise([x.as_py()])), (task << 32) | seq
            seq += 1
            columns = ["archive", "index"], [name] * 2, [b"".join(m for _, m in found), None], [None, [a for a, _ in found]], [None, [len(m) for _, m in found]]
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["kind", "id", "archive", "offsets", "lengths"])


def _number(name: str) -> int | None:
    inner = name[len("<urn:page:") : -1]
    return None if inner == "none" else int(inner)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, offsets, lengths in zip(batch.column(0), batch.column(1), batch.column(2)):
            data, rows = archive.as_py(), []
            for at, n in zip(offsets.as_py(), lengths.as_py()):
                headers, payload = parse(zlib.decompress(data[at : at + n], 31))
                stated, kind = headers["WARC-Payload-Digest"][5:], headers["WARC-Type"]
                if kind == "response" and digest(payload) != stated:
                    raise ValueError("payload and digest differ")
                refers = _number(headers["WARC-Refers-To"]) if kind == "revisit" else None
                size = int(headers["X-Payload-Length"]) if kind == "revisit" else len(payload)  # a revisit has no payload
                rows.append((_number(headers["WARC-Record-ID"]), size, stated, kind, refers))
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def archives(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Monolithic archives of ``pages``, one per row (``archive`` binary).

    Of equal payloads of at least ``least`` bytes the row with the largest id is the response.
    Rows with a null id, and repeated rows of the largest id, are responses too.
    """
    payload = text_of(pages, html_col).cast("binary")
    rows = pages.select(pages[id_col].cast("long").alias("page"), pages[url_col].cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("salt", F.pmod(F.xxhash64("page", "url"), F.lit(SALTS)).cast("int"))
    groups = rows.where(F.octet_length("html") >= least).groupBy("sha").agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = groups.select("sha", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    joined = rows.join(groups, ["sha", "salt"], "left")
    later = F.coalesce(F.col("page") < F.col("first"), F.lit(False))
    return joined.select("page", "url", "html", "sha", F.when(later, "revisit").otherwise("response").alias("kind"), F.when(later, F.col("first")).alias("refers")).mapInArrow(_write, "archive binary")


def normalised(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Archives by record (``id, archive``) and, in files beside them, their index (``id, offsets, lengths``)."""
    spark = stored.sparkSession
    path, columns = f"{scratch_dir(spark)}/plenum/warc-records-{uuid.uuid4().hex}", "id long, archive binary, offsets array<long>, lengths array<long>"
    with settings(spark, WRITING):
        stored.mapInArrow(_normalise, f"kind string, {columns}").write.partitionBy("kind").parquet(path)
    both = spark.read.schema(f"{columns}, kind string").parquet(path)
    return both.where("kind = 'archive'").select("id", "archive"), both.where("kind = 'index'").select("id", "offsets", "lengths")


def round_trip(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write archives, normalise them, and read every record back through the index.

    Returns ``id_col, payload_bytes, payload_digest, record_type, refers_to``, one row per page.
    A null html is an empty payload; a payload of any length is one record, an archive a cell of
    at most 2 GB; an empty table gives no rows; repeated rows are records of
    their own; columns beyond those named are not read.
    """
    stored = staged(archives(pages, least, id_col, url_col, html_col), "warc")
    by_record, index = normalised(stored)
    listed = by_record.join(index, "id").select("archive", "offsets", "lengths")
    return listed.mapInArrow(_read, SCHEMA).withColumnRenamed("page_id", id_col)


#: Five hexadecimal digits of the SHA-1 are four digits of base 32.
ORACLE_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, coalesce(page_id < first, false) AS again, first FROM p JOIN g USING (h))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST((CAST('0x' || substr(x, (i // 4) * 5 + 1, 5) AS INTEGER) // CAST(power(32, 3 - i % 4) AS INTEGER)) % 32 + 1 AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM d"""
