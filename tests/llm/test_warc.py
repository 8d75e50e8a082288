import gzip
import hashlib
import random

import pytest

from objsync.llm import warc

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    kept = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= warc.REVISIT_BYTES:
            kept[data] = max(page, kept.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = kept.get(data) if sum((h or "").encode() == data for _, _, h in rows) > 1 else None
        refers = None if refers == page else refers
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(make, llm, folder, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 16)
    draw = random.Random(1)
    text = lambda n: "".join(draw.choice("ab é\r\n0<>😀") for _ in range(n))
    rows = [(i, f"http://h{i}/", text(draw.choice([0, 10, 999, 1000, 3000, 9000]))) for i in range(40)]
    same, hot = text(1500), text(1200)
    rows += [(50 + i, None, same) for i in range(5)] + [(100 + i, "http://x/ y\r\nA: b", hot) for i in range(60)]
    rows += [(200, "http://z", None), (201, "", ""), (None, "http://n", same), (60, "u", "short"), (61, "u", "short"), (62, "u", text(200_000))]
    rows += [(70, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 50), (54, None, same)]
    warc.write_archives(make(rows, SCHEMA, clash=True), folder + "/a", segment_bytes=700)
    back = warc.read_archives(llm, folder + "/a").collect()
    assert all(r["problem"] is None for r in back)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=repr) == expected(rows)
    html = {(p, (h or "").encode()) for p, _, h in rows}
    assert all((r["page_id"], bytes(r["payload"])) in html for r in back if r["record_type"] == "response")


def test_empty_table(make, llm, folder):
    warc.write_archives(make([], SCHEMA), folder + "/a")
    assert warc.read_archives(llm, folder + "/a").count() == 0


@pytest.mark.parametrize(("broken", "problem"), [
    (lambda records: records[:1] + records[2:], "missing segment"), (lambda records: records[:-1], "missing segment"),
    (lambda records: [r.replace(b"Total-Length: ", b"Total-Length: 1") for r in records], "wrong total length"),
    (lambda records: [r.replace(b"chunky", b"chunkX") for r in records], "digest differs"),
])
def test_damage_is_reported(llm, folder, broken, problem):
    import os

    body = b"chunky" * 300
    row = {"page_id": 5, "number": 1, "url": "u", "digest": hashlib.sha1(body).hexdigest(), "refers_to": None, "size": len(body), "payload": body}
    records = broken(warc._records(row, 600))
    os.makedirs(folder + "/a")
    with gzip.open(folder + "/a/one.txt.gz", "wb") as out:
        out.write(b"\n".join(records) + b"\n")
    assert [r["problem"] for r in warc.read_archives(llm, folder + "/a").collect()] == [problem]


def test_broken_framing():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    for body in (b"5\r\nabc", b"zz\r\nabc\r\n", b"3\r\nabc\r\n"):
        assert warc._decoded(head + body, None)["problem"] == "broken framing"
