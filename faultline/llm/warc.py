"""Operator 2: WARC archives, written with revisit records and read by a salvaging reader.

Writing deals records to tasks; each task writes gzip members, one per record, into archives of
about ``ARCHIVE_BYTES`` (a new archive starts when one is full). An archive is written under a
hidden name and renamed when whole. Rows are sorted inside the task, so a task that replaces a
lost one writes the same bytes under the same names.

Reading checks every record: gzip trailer, version line, headers, length, the closing blank
lines, block and payload digest. After a failed check the reader looks for the next gzip magic
or version line that starts a record passing all checks, goes on there, and reports the bytes in
between as a gap with the reason. The archive folder must be on a file system that both Spark
and pyarrow open by the same address.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import cut

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 1000
INFLATE_STEP = 1 << 16
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
_BLANK_LINE = re.compile(rb"\r\n\r\n")
_HEAD_END = re.compile(rb"\r\n(?:\r\n|WARC/1\.)")
# The profile a revisit of an equal payload names, and the HTTP head of a stored page.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

RECORD_SCHEMA = (
    "archive string, offset bigint, length bigint, kind string, reason string, record_type string, record_id string, "
    "target_uri string, date string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)
FIELDS = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
_ARROW = pa.schema(
    [
        (n, {"bigint": pa.int64(), "binary": pa.binary()}.get(t, pa.string()))
        for n, t in (f.split() for f in RECORD_SCHEMA.split(", "))
    ]
)


def with_revisits(
    rows: DataFrame, id_col: str, uri_col: str, payload_col: str, min_bytes: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """``(id, uri, payload, payload_bytes, payload_digest, refers_to)`` per row of ``rows``.

    Of rows with equal payloads of at least ``min_bytes`` bytes the largest id stays a response;
    the others refer to it. Digests alone travel to the groups, with a partial maximum per task,
    so a payload shared by a third of the rows is one row per task there. Null payloads are
    empty; a row with a null id is always a response; repeated rows of one id are all kept.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    base = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    base = base.select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    big = base.where((F.col("payload_bytes") >= min_bytes) & F.col("id").isNotNull())
    ids = big.select("id", "payload_digest")
    top = ids.groupBy("payload_digest").agg(F.max("id").alias("top"), F.min("id").alias("low")).where("low < top")
    revisits = ids.join(top.drop("low"), "payload_digest").where("id < top").distinct()
    revisits = revisits.select("id", "payload_digest", F.col("top").alias("refers_to"))
    return base.join(revisits, ["id", "payload_digest"], "left").select(
        "id", "uri", "payload", "payload_bytes", "payload_digest", "refers_to"
    )


def record_bytes(id_, uri, payload, n, digest, refers_to, date: str) -> bytes:
    """One WARC record: a response with its HTTP head and payload, or a revisit with the head alone."""
    head = (HTTP_HEAD % n).encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if id_ is None else id_}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Profile", None if refers_to is None else REVISIT_PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Payload-Length", None if refers_to is None else str(n)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write the rows of ``with_revisits`` as archives in ``path``; ``(archive, records, bytes)`` per archive.

    Every row is a record, repeated rows too. A null id or uri leaves its header empty or out, a null
    payload is empty; uris and payloads may be of any length. An empty table writes no archive. An
    archive has its name only once it is whole, so a task that is run again leaves no half ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        context = TaskContext.get()
        number, out, done = 0, None, []

        def close():
            nonlocal out, number
            if out is not None:
                out[0].close()
                name = f"part-{context.partitionId():05d}-{number:05d}.warc.gz"
                fs.move(out[1], f"{folder}/{name}")
                done.append((name, out[2], out[3]))
                out, number = None, number + 1

        for batch in batches:
            for i in range(len(batch)):
                row = [batch[c][i].as_py() for c in ("id", "uri", "payload", "payload_bytes", "payload_digest", "refers_to")]
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(*row, date)) + packer.flush()
                if out is None:
                    hidden = f"{folder}/_{context.taskAttemptId()}-{context.partitionId()}-{number}"
                    out = [fs.open_output_stream(hidden, compression=None), hidden, 0, 0]
                out[0].write(member)
                out[2] += 1
                out[3] += len(member)
                if out[3] >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.record_batch(
            [pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["archive", "records", "bytes"],
        )

    ordered = records.sortWithinPartitions("id", "payload_digest")
    return ordered.mapInArrow(run, "archive string, records bigint, bytes bigint")


def _parse(data: memoryview, at: int) -> tuple[dict | None, int, str]:
    """The record at ``at`` and its end, or None, ``at`` and what failed."""
    if bytes(data[at : at + len(VERSION)]) != VERSION:
        return None, at, "no version line"
    # A blank line or the next version line, whichever is first.
    found = _HEAD_END.search(data, at)
    if found is None or found[0] != b"\r\n\r\n":
        return None, at, "headers do not end"
    stop = found.start()
    fields = {}
    for line in bytes(data[at:stop]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "bad header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]+", fields.get("content-length", "")):
        return None, at, "no content length"
    begin, size = stop + 4, int(fields["content-length"])
    end = begin + size
    if end + 4 > len(data):
        return None, at, "record is cut off"
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        return None, at, "no end of record"
    block = data[begin:end]
    named = fields.get("warc-block-digest", "")
    if named.startswith("sha1:") and named[5:] != hashlib.sha1(block).hexdigest():
        return None, at, "block digest differs"
    kind, payload = fields.get("warc-type", ""), block
    if fields.get("content-type", "").startswith("application/http"):
        http = _BLANK_LINE.search(block)
        if http is None:
            return None, at, "no http head"
        payload = block[http.end() :]
    digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
    named = fields.get("warc-payload-digest", "")
    if kind == "revisit":
        digest = named.removeprefix("sha1:") or None
        length = int(fields["warc-payload-length"]) if fields.get("warc-payload-length", "").isdigit() else None
    elif named.startswith("sha1:") and named[5:] != digest:
        return None, at, "payload digest differs"
    strip = lambda v: None if v is None else v.strip("<>")
    record = {
        "kind": "record", "record_type": kind, "record_id": strip(fields.get("warc-record-id")),
        "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "refers_to": strip(fields.get("warc-refers-to")), "payload_bytes": length, "payload_digest": digest,
        "payload": payload,
    }
    return record, end + 4, ""


def _member(data: memoryview, at: int) -> tuple[bytes | None, int, str]:
    """The inflated gzip member at ``at`` and its end; its trailer is checked by zlib."""
    inflater, parts, pos = zlib.decompressobj(31), [], at
    try:
        while not inflater.eof:
            step = data[pos : pos + INFLATE_STEP]
            if not len(step):
                return None, at, "gzip member is cut off"
            parts.append(inflater.decompress(step))
            pos += len(step)
    except zlib.error:
        return None, at, "gzip member is broken"
    return b"".join(parts), pos - len(inflater.unused_data), ""


def _unit(data: memoryview, at: int) -> tuple[list[dict], int, str]:
    """Records of what starts at ``at`` (a member or a plain record) and its end."""
    if bytes(data[at : at + 3]) != GZIP_MAGIC:
        record, end, why = _parse(data, at)
        return ([] if record is None else [record | {"offset": at, "length": end - at}]), end, why
    inner, end, why = _member(data, at)
    if inner is None:
        return [], at, why
    if not inner:
        return [], end, ""
    found = list(salvage(inner, plain=True))
    if not any(x["kind"] == "record" for x in found):
        return [], at, found[0]["reason"]
    return [x | {"offset": at, "length": end - at} for x in found], end, ""


def salvage(content: bytes | memoryview, plain: bool = False) -> Iterator[dict]:
    """Every record that passes its checks and every gap between them, in order.

    ``offset`` and ``length`` are bytes of the archive (a record in a gzip member has the
    member's). Only magic numbers and version lines are tried, each at most once as a start.
    """
    data, at, start, reason = memoryview(content), 0, None, ""
    marks = re.compile(rb"WARC/1\." if plain else rb"\x1f\x8b\x08|WARC/1\.")

    def gap(end):
        return {"kind": "gap", "offset": start, "length": end - start, "reason": reason}

    while at < len(data):
        found, end, why = _unit(data, at) if marks.match(data, at) else ([], at, "no record starts here")
        if why:
            start, reason = (at, why) if start is None else (start, reason)
            next_mark = marks.search(data, at + 1)
            at = next_mark.start() if next_mark else len(data)
            continue
        if start is not None:
            yield gap(at)
            start = None
        yield from found
        at = end
    if start is not None:
        yield gap(len(data))


class LostRecords(RuntimeError):
    """Archives that were read back with byte gaps or without all their records."""


def read_back(spark: SparkSession, path: str, archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives that ``write_warc`` reported, read from ``path`` and checked.

    What is read is written as files first, so the archives are read once. Byte gaps are logged as
    rows of ``archive, offset, length, reason`` in the folder ``<path>-gaps``. If there are any, or
    records are missing otherwise, ``LostRecords`` names the log and the numbers; the records that
    were salvaged stay readable by ``read_warc``. No archives (an empty table) give no rows.
    """
    written = archives.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    if not written:
        return spark.createDataFrame([], RECORD_SCHEMA)
    found = cut(read_warc(spark, path, with_payload), "archive-records")
    gaps = found.where("kind = 'gap'").select("archive", "offset", "length", "reason")
    gaps.write.parquet(f"{path}-gaps")
    records = found.where("kind = 'record'")
    read, lost = records.count(), spark.read.schema(gaps.schema).parquet(f"{path}-gaps").count()
    if lost or read != written:
        raise LostRecords(f"{read} of {written} records were read back; {lost} gaps are logged in {path}-gaps")
    return records


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives in ``path`` (columns of ``RECORD_SCHEMA``).

    Repeated records are all read; an archive without bytes has no rows; a folder that does not exist
    is an error.

    ``kind`` is ``record`` or ``gap``. For a revisit, digest and length are those its headers
    name for the full payload. One archive is in memory at a time, beside the output batch.
    """

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                rows, size = [], 0
                for x in salvage(memoryview(content.as_buffer())):
                    payload = x.pop("payload", None)
                    x["payload"] = bytes(payload) if with_payload and payload is not None else None
                    rows.append(dict.fromkeys(FIELDS) | x | {"archive": name.as_py()})
                    size += len(x["payload"] or b"")
                    if len(rows) >= 2000 or size >= ARCHIVE_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    return files.load(path).select("path", "content").mapInArrow(run, RECORD_SCHEMA)
