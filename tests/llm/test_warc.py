from __future__ import annotations

import glob
import gzip
import hashlib
import tempfile

import pytest

from faultline.llm import warc
from faultline.llm.common import cut
from faultline.llm.queries import op2_warc

SCHEMA = "page_id bigint, url string, html string, payload string, offset int"
BIG = "<p>é</p>" * 200


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def round_trip(spark, rows):
    path = tempfile.mkdtemp(prefix="faultline-warc-") + "/a"
    records = warc.with_revisits(pages(spark, rows), "page_id", "url", "html")
    cut(warc.write_warc(records, path), "archives")
    return warc.read_warc(spark, path).collect()


def test_round_trip_with_edge_rows(spark):
    rows = [(1, "http://a/\r\nx y", BIG), (2, None, BIG), (3, "u", BIG), (4, "u", "short"), (5, "u", "short"), (6, "u", None)]
    rows += [(7, "u", ""), (None, "u", BIG), (8, "u", "z" * 300_000), (8, "u", "z" * 300_000), (9, "u", "a\r\n\r\nWARC/1.1\r\n")]
    got = round_trip(spark, rows)
    assert len(got) == len(rows) and all(r["kind"] == "record" for r in got)
    by = sorted(got, key=lambda r: r["record_id"])
    want = sorted(rows, key=lambda r: f"urn:page:{'' if r[0] is None else r[0]}")
    for r, (i, _, h) in zip(by, want):
        body = (h or "").encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        if i in (1, 2):
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("revisit", "urn:page:3", b"")
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, body)


def test_long_urls_and_http_heads_are_read(spark):
    url = "http://a/" + "x y" * 33_333
    got = round_trip(spark, [(1, url, "body"), (2, "u", BIG)])
    assert [(r["kind"], r["record_id"]) for r in sorted(got, key=lambda r: r["record_id"] or "")] == [("record", "urn:page:1"), ("record", "urn:page:2")]
    assert url.replace(" ", "%20") in {r["target_uri"] for r in got}
    block = b"HTTP/1.1 200 OK\r\nX-Long: " + b"y" * 100_000 + b"\r\n\r\nbody"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
    plain = head.encode() + block + b"\r\n\r\n"
    cut_off = b"WARC/1.1\r\nWARC-Type: response\r\n"
    read = list(warc.salvage(plain + cut_off + plain))
    assert [x["kind"] for x in read] == ["record", "gap", "record"] and bytes(read[2]["payload"]) == b"body"
    assert read[1]["reason"] == "headers do not end"


def test_empty_table(spark, tmp_path):
    path = tempfile.mkdtemp(prefix="faultline-warc-") + "/none"
    records = warc.with_revisits(pages(spark, []), "page_id", "url", "html")
    archives = cut(warc.write_warc(records, path), "archives")
    assert archives.count() == 0 and warc.read_back(spark, path, archives).count() == 0
    pages(spark, []).write.parquet(str(tmp_path / "pages.parquet"))
    assert op2_warc(spark, str(tmp_path)).count() == 0


def test_damage_between_writing_and_reading_is_logged_and_raised(spark, tmp_path, monkeypatch):
    pages(spark, [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(20)]).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    damaged, write = [], warc.write_warc

    def write_and_damage(records, path, **kw):
        archives = cut(write(records, path, **kw), "archives")
        first = sorted(glob.glob(path.removeprefix("file:") + "/*.gz"))[0]
        with open(first, "r+b") as f:
            f.seek(3)
            f.write(b"\xff" * 40)
        damaged.append(path)
        return archives

    monkeypatch.setattr(warc, "write_warc", write_and_damage)
    with pytest.raises(warc.LostRecords, match="1 gaps are logged"):
        op2_warc(spark, str(tmp_path))
    log = spark.read.parquet(f"{damaged[0]}-gaps").collect()
    assert len(log) == 1 and log[0]["offset"] == 0 and log[0]["length"] > 40
    # The other records of the archives are still there.
    kinds = [r["kind"] for r in warc.read_warc(spark, damaged[0]).collect()]
    assert kinds.count("record") == 19 and kinds.count("gap") == 1


def test_nulls_and_repeated_rows_come_back(spark):
    rows = [(1, None, None), (None, "u", BIG), (2, "u", BIG), (2, "u", BIG), (3, "v", "")]
    path = tempfile.mkdtemp(prefix="faultline-warc-") + "/a"
    archives = cut(warc.write_warc(warc.with_revisits(pages(spark, rows), "page_id", "url", "html"), path), "archives")
    got = warc.read_back(spark, path, archives).collect()
    assert sorted(r["payload_bytes"] for r in got) == sorted(len((h or "").encode()) for _, _, h in rows)
    assert all(r["record_type"] == "response" for r in got)


def member(i, body):
    digest = hashlib.sha1(body).hexdigest()
    return gzip.compress(warc.record_bytes(i, "u", body, len(body), digest, None, "d"), mtime=0)


def kinds(data):
    return [(x["kind"], x.get("record_id"), x["offset"], x["length"]) for x in warc.salvage(data)]


def test_broken_members_are_gaps_and_later_records_are_read():
    parts = [member(i, bytes([65 + i]) * 500) for i in range(5)]
    whole = b"".join(parts)
    at = [sum(map(len, parts[:i])) for i in range(6)]
    assert [k[1] for k in kinds(whole)] == [f"urn:page:{i}" for i in range(5)]
    for hit in range(len(parts[1])):  # any byte of the second member
        bad = bytearray(whole)
        bad[at[1] + hit] ^= 0x55
        got = kinds(bytes(bad))
        read = [k[1] for k in got if k[0] == "record"]
        assert read[0] == "urn:page:0" and read[-3:] == ["urn:page:2", "urn:page:3", "urn:page:4"]
        if len(read) == 4:
            assert [k for k in got if k[0] == "gap"] == [("gap", None, at[1], len(parts[1]))]
    assert kinds(whole[: at[4] + 9])[-1] == ("gap", None, at[4], 9)
    assert kinds(whole[3:])[0] == ("gap", None, 0, at[1] - 3)
    assert kinds(b"") == [] and kinds(b"junk") == [("gap", None, 0, 4)]


def test_plain_records_and_wrong_digests():
    plain = [warc.record_bytes(i, "u", b"x" * 50, 50, hashlib.sha1(b"x" * 50).hexdigest(), None, "d") for i in range(3)]
    bad = plain[1].replace(b"xxxxx\r\n", b"xxxxy\r\n")
    got = kinds(plain[0] + bad + b"noise" + plain[2])
    assert [k[0] for k in got] == ["record", "gap", "record"] and got[1][2:] == (len(plain[0]), len(bad) + 5)
    both = gzip.compress(plain[0] + plain[1])
    assert [k[1] for k in kinds(both + member(7, b"y"))] == ["urn:page:0", "urn:page:1", "urn:page:7"]
