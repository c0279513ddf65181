"""WARC archives: a writer with revisit records, and a salvage reader.

Of pages with equal payloads (by SHA-1), the one with the largest id is written as a response, the others as revisits
that refer to it; which, is found by ids and digests alone. Records are put together by DataFrame functions, and each
becomes a gzip member of its own, as the format wants, so that damage to one leaves the others readable. Files hold
`file_bytes` of members, or one larger record; Spark's own text sink writes each as one line, so they land in any store
that Spark can write. The line's end is a byte 0, which is what a member's last byte is (its length's highest byte, of
records under 16 MB; after a larger one an empty member follows), so it stands for that byte and nothing is added.

The reader checks version line, headers, lengths, the end of each record and its digests. After a failed check it
searches for the next valid gzip member or version line, goes on there, and logs the bytes between as a quarantined gap.

Defined results: a null payload counts as empty; empty payloads are equal to each other; rows with equal id and payload
give records of the same type; a null id is written as `null` and comes back as null, and loses any tie; line breaks in
a URL are dropped; an empty table gives no archive and no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import small_batches

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
URN = "urn:quire:page:"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Columns id, url, payload, sha1, n (bytes) and refers_to: null for a response. Payloads under least_bytes never refer."""
    own = pages.select(pages[key].alias("id"), pages[url].alias("url"), F.coalesce(pages[payload], F.lit("")).alias("payload"))
    own = own.withColumns({"sha1": F.unhex(F.sha1(F.col("payload").cast("binary"))), "n": F.octet_length("payload").cast("long")})
    light = own.select("id", "sha1", "n").groupBy("id", "sha1", "n").agg(F.lit(1).alias("one")).drop("one")
    largest = light.groupBy("sha1").agg(F.max("id").alias("largest"))
    refers = (F.col("n") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("largest"))
    named = light.join(largest, "sha1").where(refers & F.col("largest").isNotNull()).select(F.col("id").alias("__id"), F.col("sha1").alias("__sha1"), F.col("largest").alias("refers_to"))
    joined = own.join(named, own["id"].eqNullSafe(named["__id"]) & (own["sha1"] == named["__sha1"]), "left")
    return joined.select("id", "url", "payload", "sha1", "n", "refers_to")


def base32(sha1: Column) -> Column:
    """Upper-case base32 of 20 bytes: 40 hex digits, five of them are four base32 digits."""
    digits = F.hex(sha1)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def write_archives(records: DataFrame, path: str, file_bytes: int = 8 << 20) -> None:
    """with_revisits()'s rows as gzip WARC files below path."""
    revisit = F.col("refers_to").isNotNull()
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{URN}"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))),
        line("WARC-Target-URI", F.coalesce(F.regexp_replace("url", "[\\r\\n]", ""), F.lit(""))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32(F.unhex(F.sha1(F.col("block").cast("binary")))))),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit(f"<{URN}"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit(END),
    )

    def packed(batches):
        held, size = [], 0

        def file() -> pa.RecordBatch:
            if held[-1][-1]:
                held.append(EMPTY_MEMBER)
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])

        for batch in batches:
            for record in batch.column(0):
                held.append(gzip.compress(record.as_buffer(), 6, mtime=0))
                size += len(held[-1])
                if size >= file_bytes:
                    yield file()
                    held, size = [], 0
        if held:
            yield file()

    small_batches(records.sparkSession)
    files = records.withColumn("block", block).select(text.alias("record")).mapInArrow(packed, "value binary").select(F.col("value").cast("string"))
    files.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Bad(ValueError):
    pass


def record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, bytes, int]:
    """Headers, block and payload of the record that begins at `at`, and where it ends; Bad if a check fails."""
    if not VERSION.match(data, at):
        raise Bad("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Bad("headers are cut short")
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, sep, value = line.partition(b":")
        if not sep:
            raise Bad("a header has no colon")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not {"warc-type", "warc-record-id"} <= headers.keys() or not headers.get("content-length", "").isdigit():
        raise Bad("type, id or length is missing")
    end = stop + 4 + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Bad("the record doesn't end where its length says")
    block = data[stop + 4 : end]
    if (d := headers.get("warc-block-digest", "").removeprefix("sha1:")) and d != digest_of(block):
        raise Bad("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    if headers["warc-type"] != "revisit" and (d := headers.get("warc-payload-digest", "").removeprefix("sha1:")) and d != digest_of(payload):
        raise Bad("payload digest differs")
    return headers, block, payload, end + 4


def plain_records(data: bytes, base: int = 0) -> Iterator[tuple]:
    """("record", start, end, headers, block, payload) and ("gap", start, end, reason), in order; offsets are moved by base."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            headers, block, payload, end = record_at(data, at)
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            found = VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield "gap", base + gap, base + at, why
            gap = None
        yield "record", base + at, base + end, headers, block, payload
        at = end
    if gap is not None:
        yield "gap", base + gap, base + len(data), why


def member_at(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What a gzip member holds, as far as it can be read, where it ends, and what is wrong with it."""
    reader, out = zlib.decompressobj(31), []
    view, step = memoryview(data), 1 << 12
    try:
        while at < len(data):
            out.append(reader.decompress(view[at : at + step]))
            if reader.eof:
                return b"".join(out), min(at + step, len(data)) - len(reader.unused_data), ""
            at += step
            step = min(2 * step, 1 << 20)
        return b"".join(out), len(data), "a gzip member is cut short"
    except zlib.error as e:
        return b"".join(out), -1, f"gzip: {e}"


def begins_record(data: bytes, at: int) -> bool:
    """Whether a gzip member begins there whose first bytes are a version line's."""
    try:
        return zlib.decompressobj(31).decompress(memoryview(data)[at : at + 4096], 5) == b"WARC/"
    except zlib.error:
        return False


def salvage(data: bytes) -> Iterator[tuple]:
    """plain_records() of an archive, plain or of gzip members, each with a last item: null, or where its member begins.

    Offsets are the file's where that is null, else the member's content's. A damaged member gives what can be read of
    it, and a gap of the file from where it begins to the next one.
    """
    if not data.startswith(MAGIC):
        first, version = data.find(MAGIC), VERSION.search(data)
        if version is not None and (first < 0 or version.start() < first) or first < 0:
            for found in plain_records(data):
                yield *found, None
            return
        yield "gap", 0, first, "no member at the start", None
        at = first
    else:
        at = 0
    while at < len(data):
        content, end, wrong = member_at(data, at) if data.startswith(MAGIC, at) else (b"", -1, "no gzip member")
        for found in plain_records(content):
            yield *found, at
        if wrong:
            end = data.find(MAGIC, at + 1)
            while end >= 0 and not begins_record(data, end):
                end = data.find(MAGIC, end + 1)
            end = len(data) if end < 0 else end
            yield "gap", at, end, wrong, None
        at = end


ROWS = "kind string, file string, member long, start long, end long, reason string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary"
LENGTH = re.compile(rb"^content-length:\s*(\d+)\s*$", re.I | re.M)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record and each quarantined gap (`kind`) of the files below path; payloads only if asked for."""
    def number(urn: str | None) -> int | None:
        found = re.fullmatch(rf"<{URN}(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (x.split() for x in ROWS.split(", "))])

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for found in salvage(content.as_py()):
                    row = dict.fromkeys(schema.names) | {"kind": found[0], "file": file, "member": found[-1], "start": found[1], "end": found[2]}
                    if found[0] == "gap":
                        row["reason"] = found[3]
                    else:
                        headers, block, payload = found[3:-1]
                        revisit = headers["warc-type"] == "revisit"
                        stated = LENGTH.search(block.partition(b"\r\n\r\n")[0])
                        row |= {"page_id": number(headers.get("warc-record-id")), "record_type": headers["warc-type"], "refers_to": number(headers.get("warc-refers-to")), "url": headers.get("warc-target-uri"), "payload": payload if payloads else None}
                        row |= {"payload_bytes": int(stated[1]) if revisit and stated else len(payload), "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest_of(payload)}
                    rows.append(row)
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, ROWS)
