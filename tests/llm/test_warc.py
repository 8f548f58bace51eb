import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from scoreloom.llm import warc

PAGES = [
    (5, "http://a.example/5", "same"),
    (3, "http://a.example/3", "same"),
    (4, None, "same"),
    (3, "http://a.example/3", "same"),
    (None, "http://a.example/none", "same"),
    (7, "http://a.example/7\r\nX: y", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"),
    (8, "u", None),
    (9, "u", ""),
    (10, "u", "été 日本 \U0001f600\r\n\r\n"),
    (11, "u", "x" * 3_000_000),
    (None, None, "alone"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "'z' AS payload", "2 AS capture")


def brute(least):
    out = []
    for key, _, html in PAGES:
        data = (html or "").encode()
        ids = [k for k, _, h in PAGES if (h or "").encode() == data and k is not None]
        first = min(ids, default=None)
        revisit = len(data) >= least and key != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_captures(pages, least):
    got = sorted((tuple(r) for r in warc.capture_digests(pages, least).collect()), key=repr)
    assert got == brute(least)


def test_no_pages(pages):
    assert warc.capture_digests(pages.limit(0)).collect() == []


def test_transactions(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    for file in Path(path).glob("part-*"):
        data = gzip.decompress(file.read_bytes())
        assert not data or (data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n"))
    records = warc.read_records(spark, path)
    assert records.count() == 3 * len(PAGES)
    rows = warc.assemble(records).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        assert (r["n_requests"], r["n_metadata"]) == (len(r["requests"]), len(r["metadata"])) == (1, 1)
    payloads = sorted(r["main"]["payload"] for r in rows if r["main"]["type"] == "response")
    firsts = ["same", "same", *(h or "" for k, _, h in PAGES if h != "same" and k != 9)]
    assert payloads == sorted(firsts)
    orphan = records.where("type <> 'request'")
    assert all(r["requests"] == [] and r["n_requests"] == 0 for r in warc.assemble(orphan).collect())


def record(kind, name, block, *headers):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + name, b"Content-Length: %d" % len(block), *headers]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
ONE = [
    record(b"warcinfo", b"<i>", b"software: x\r\n"),
    record(b"response", b"<r>", HTTP + b"body", b"WARC-Target-URI: http://a/"),
    record(b"request", b"<q2>", b"GET", b"WARC-Concurrent-To: <r>"),
    record(b"request", b"<q1>", b"GET", b"WARC-Concurrent-To: <r>", b"WARC-Concurrent-To: <r2>"),
    record(b"metadata", b"<m2>", b"page-id: 6\r\nk: v", b"WARC-Concurrent-To: <r>"),
    record(b"metadata", b"<m1>", b"via: z\r\n", b"WARC-Concurrent-To: <r>"),
    record(b"response", b"<r2>", HTTP + b"\xff\xfe", b"WARC-Target-URI: http://b/"),
]


def read(spark, folder, **files):
    folder.mkdir(exist_ok=True)
    for name, data in files.items():
        (folder / f"{name}.warc").write_bytes(data)
    return warc.read_records(spark, str(folder))


def plain(records):
    return sorted(tuple(r) for r in records.select("type", "record_id", "uri", "payload_bytes").collect())


def test_every_gzip_member_is_read(spark, tmp_path):
    whole = b"".join(ONE)
    forms = {
        "plain": whole,
        "one": gzip.compress(whole),
        "each": b"".join(map(gzip.compress, ONE)),
        "split": gzip.compress(whole[:333]) + gzip.compress(whole[333:]),
        "padded": b"".join(map(gzip.compress, ONE)) + b"\0" * 700,
        "nothing": b"",
    }
    found = {name: plain(read(spark, tmp_path / name, a=data)) for name, data in forms.items()}
    assert len(found["plain"]) == len(ONE) and found.pop("nothing") == []
    assert all(rows == found["plain"] for rows in found.values())


def test_one_row_a_capture_whatever_stands_beside_it(spark, tmp_path):
    rows = {r["record_id"]: r for r in warc.assemble(read(spark, tmp_path / "w", a=b"".join(ONE))).collect()}
    assert sorted(rows) == ["<r2>", "<r>"]
    assert [q["record_id"] for q in rows["<r>"]["requests"]] == ["<q1>", "<q2>"]
    assert [m["record_id"] for m in rows["<r>"]["metadata"]] == ["<m1>", "<m2>"]
    assert rows["<r>"]["metadata"][1]["fields"] == {"page-id": "6", "k": "v"}
    assert rows["<r>"]["original"]["page_id"] == 6
    assert [q["record_id"] for q in rows["<r2>"]["requests"]] == ["<q1>"] and rows["<r2>"]["metadata"] == []
    assert rows["<r2>"]["main"]["payload_bytes"] == 2


def test_many_records_beside_one_capture(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BESIDE", 3)
    many = [record(b"metadata", b"<m%02d>" % i, b"k: v", b"WARC-Concurrent-To: <r>") for i in range(9)]
    records = read(spark, tmp_path / "w", a=b"".join([ONE[1], *many[::-1]]))
    row = warc.assemble(records).first()
    assert [m["record_id"] for m in row["metadata"]] == ["<m00>", "<m01>", "<m02>"] and row["n_metadata"] == 9
    assert warc.side_records(records).count() == 9


def test_header_forms(spark, tmp_path):
    odd = (
        b"WARC/1.0\nwarc-type:response\nWARC-RECORD-ID:<a>\ncontent-length:%d\n"
        b"WARC-Target-URI: http://a/\n  long\n\tname\n\n%b\n\n" % (len(HTTP) + 1, HTTP + b"x")
    )
    found = read(spark, tmp_path / "w", a=odd + ONE[1]).collect()
    assert [(r["record_id"], r["uri"], r["payload"]) for r in found] == [("<a>", "http://a/ long name", "x"), ("<r>", "http://a/", "body")]


def test_damage_is_told_and_the_rest_read(spark, tmp_path):
    wrong = record(b"response", b"<w>", HTTP + b"x", b"WARC-Payload-Digest: sha1:AAAA")
    other = record(b"response", b"<o>", HTTP + b"x", b"WARC-Payload-Digest: sha256:00")
    cases = {
        "rubbish": (b"rubbish\r\nmore\r\n" + ONE[1], ["no record begins"], 1),
        "length": (b"WARC/1.0\r\nWARC-Record-ID: <x>\r\n\r\nblock\r\n\r\n" + ONE[1], ["no Content-Length", "no record begins"], 1),
        "cut": (ONE[1] + ONE[2][:-7], ["cut off after"], 1),
        "digest": (wrong + other + ONE[1], ["the payload's digest"], 2),
        "gzip": (gzip.compress(ONE[1]) + gzip.compress(ONE[2])[:-12], ["gzip"], 1),
    }
    for name, (data, problems, good) in cases.items():
        rows = read(spark, tmp_path / name, a=data).collect()
        told = [r["problem"] for r in rows if r["type"] == warc.DAMAGED]
        assert len(told) == len(problems) and all(t.startswith(p) for t, p in zip(told, problems, strict=True)), (name, told)
        assert len(rows) - len(told) == good, name


def test_archives_of_two_runs_are_read_together(spark, pages, tmp_path):
    for run in ("a", "b"):
        warc.write_archives(pages, str(tmp_path / "both" / run), captures_per_file=2)
    records = warc.read_records(spark, str(tmp_path / "both" / "*"))
    assert records.select("record_id").distinct().count() == records.count() == 6 * len(PAGES)
    assert warc.assemble(records).count() == 2 * len(PAGES)
    sizes = [gzip.decompress(f.read_bytes()).count(b"WARC-Record-ID") for f in (tmp_path / "both").glob("*/part-*")]
    assert max(sizes) <= 6
