import base64
import gzip
import hashlib
import os

import pytest

from corpusmill.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, row string, segment int")


def brute(rows):
    keeper = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None:
            keeper[b] = max(p, keeper.get(b, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        k = keeper.get(b)
        again = k is not None and p != k
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", k if again else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/1", "<p>é中 one</p>"), (2, "http://a/2", None), (3, None, ""), (4, "http://a/4", "x\r\n\r\nWARC/1.1\r\n\r\ny"),
        (5, "http://a/5", "<p>é中 one</p>"), (6, "http://a/6?q=1 2\r\n", "long " * 40_000), (7, "http://a/7", "𝒳" * 30_000), (8, "http://a/8", "long " * 40_000),
        (9, "u", "same row"), (9, "u", "same row"), (None, "n", "no id"), (None, "n", "<p>é中 one</p>"), (10, "u", "0\r\n\r\n")]


def test_round_trip(spark):
    got = warc.archive_round_trip(pages(spark, ROWS)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_payloads_come_back_whole_and_segmented(spark, tmp_dir):
    path = os.path.join(tmp_dir, "w")
    warc.write_archives(pages(spark, ROWS), path)
    payload = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, path, with_payload=True).collect() if r["record_type"] == "response"}
    assert payload[8] == b"long " * 40_000 and payload[7] == ("𝒳" * 30_000).encode() and payload[4] == ROWS[3][2].encode()
    records = warc.read_records(spark, path).collect()
    parts = [r for r in records if r["page_id"] == 8]
    assert {r["type"] for r in parts} == {"response", "continuation"} and max(r["segment"] for r in parts) == len(parts) > 3
    assert [r["total"] for r in sorted(parts, key=lambda r: r["segment"])][-1] == sum(len(r["block"]) for r in parts)


def test_a_lost_segment_is_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "w")
    warc.write_archives(pages(spark, ROWS[5:6]), path)
    parts = warc.read_records(spark, path, segmented=True)
    assert warc.reassemble(parts).count() == 1
    twice = warc.reassemble(parts.unionAll(parts))
    assert len(twice.collect()) == 1                       # equal copies are no harm
    for bad in (parts.where("segment <> 2"), parts.where("total is null")):
        with pytest.raises(Exception, match="segments do not make up"):
            warc.reassemble(bad).collect()


def test_framing():
    for p in (b"", b"x", b"y" * warc.CHUNK, b"z" * (2 * warc.CHUNK + 1)):
        assert warc.unchunked(warc.chunked(p)) == p
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"4\r\nabc\r\n0\r\n\r\n")
    data = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(gzip.compress(data) + gzip.compress(data))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(data[:-1])))
