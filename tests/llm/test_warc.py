import hashlib
import io
import zlib

import pytest

from slotwise.llm.warc import inflated, read_records, record, round_trip

BIG = "<p>" + "é" * 1000


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def member(raw: bytes) -> bytes:
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def test_round_trip(spark, make):
    rows = [
        (1, "http://a", BIG), (2, None, BIG), (3, "http://b\r\nWARC-Type: x", BIG), (4, "", None), (5, "u", "short"), (6, "u", "short"),
        (7, "u", "x" * 999), (8, "u", "x" * 999), (9, "u", "x" * 1000), (9, "u", "x" * 1000), (None, "u", "y" * 1000),
        (None, "u", "y" * 1000), (None, "u", BIG), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (11, "long", "ab\x00c\n" * 400_000),
    ]
    got = round_trip(spark, pages(spark, rows), archive_bytes=300).collect()
    assert len(got) == len(rows) and all(r.problem is None for r in got)
    last = {BIG: 3, "x" * 1000: 9}
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        refers = last.get(html) if last.get(html) != page_id else None
        stored = b"" if refers else payload
        want.append((page_id, "revisit" if refers else "response", refers, hashlib.sha1(payload).hexdigest(), len(payload), stored))
    have = [(r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, bytes(r.payload)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_no_pages(spark, make):
    assert round_trip(spark, pages(spark, []), payloads=False).count() == 0


@pytest.mark.parametrize("read_bytes", [1, 7, 100, 1 << 16])
def test_reader_frames_members_at_any_block_size(read_bytes):
    payloads = [b"", b"a", b"x" * 70_000, b"WARC/1.1\r\n\r\n"]
    raw = b"".join(member(record(i, "u", p, hashlib.sha1(p).hexdigest(), None, False)) for i, p in enumerate(payloads))
    got = [(b.partition(b"\r\n\r\n")[2], e) for _, b, e in read_records(io.BytesIO(raw), read_bytes)]
    assert got == [(p, None) for p in payloads]


def test_reader_reports_damage():
    good = record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    wrong_body = good.replace(b"payload\r\n", b"qayload\r\n")
    wrong_length = good.replace(b"Content-Length: ", b"Content-Length: 1")
    wrong_digest = record(1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), None, False)
    raw = b"".join(map(member, (wrong_body, good, wrong_length, wrong_digest, b"nothing")))
    assert [p for _, _, p in read_records(io.BytesIO(raw))] == [
        "the block digest differs", None, "the content length does not frame the block", "the payload digest differs",
        "not a WARC record",
    ]
    with pytest.raises(ValueError, match="ends within a record"):
        list(inflated(io.BytesIO(member(good)[:-9])))
