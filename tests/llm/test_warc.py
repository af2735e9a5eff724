import gzip

import pytest
from pyspark.sql import functions as F

from footfall.llm import warc as W


def _raw(kind, number, url, at, http):
    return bytearray(W._record(kind, number, url, at, http))


def _full(body=b"body", **headers):
    lines = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in headers.items())
    return f"HTTP/1.1 200 OK\r\n{lines}\r\n".encode() + body


def _again(**headers):
    lines = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in headers.items())
    return f"HTTP/1.1 304 Not Modified\r\n{lines}\r\n".encode()


def _resolve(spark, raws):
    records = W.parse_records(spark.createDataFrame([(r,) for r in raws], "raw binary"))
    return {r.record_id: r for r in W.resolve_revisits(records).collect()}, records


def test_canonical_urls():
    same = ["http://www.Example.org:80/a?b=2&a=1&utm_source=x#f", "https://u@example.org/a?a=1&b=2&ref=9", "//example.org/a?a=1&b=2"]
    assert {W.canonical_url(u) for u in same} == {"example.org/a?a=1&b=2"}
    assert W.canonical_url("http://example.org") == "example.org/" and W.canonical_url(None) is None
    assert W.canonical_url("http://m.example.org/A") == "m.example.org/A" and W.canonical_url("urn:x#y") == "urn:x"


def test_latest_strictly_earlier_response_and_validators(spark):
    u = "http://a.org/x"
    raws = [_raw("response", 1, u, 100, _full(b"one", ETag='"1"', Vary="a", Content_Type="t")),
            _raw("response", 2, u, 200, _full(b"two", ETag='"2"', Last_Modified="d")),
            _raw("response", 3, u, 300, b"HTTP/1.1 404 Not Found\r\n\r\nno"),
            _raw("revisit", 10, u, 150, _again(ETag='W/"1"', Vary="b", Content_Length="0", Server="s")),
            _raw("revisit", 11, u, 200, _again(ETag='"1"')),  # the second response isn't earlier
            _raw("revisit", 12, u + "?utm_id=4", 400, _again(ETag='"1"')),
            _raw("revisit", 13, u, 400, _again(Last_Modified="d")), _raw("revisit", 14, u, 400, _again(Date="x")),
            _raw("revisit", 15, u, 100, _again(ETag='"1"')), _raw("revisit", 16, "http://b.org/", 400, _again(ETag='"1"')),
            bytearray(b"junk"), bytearray(b""), None]
    got, records = _resolve(spark, raws)
    assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {
        "10": ("resolved", "1"), "11": ("resolved", "1"), "12": ("mismatch", None), "13": ("resolved", "2"),
        "14": ("unverified", None), "15": ("missing", None), "16": ("missing", None)}
    assert got["10"].headers == {"etag": 'W/"1"', "vary": "b", "content-type": "t"}
    assert got["12"].headers == {"etag": '"1"'} and got["12"].payload_bytes is None
    resolved = W.resolve_revisits(records)
    assert {r.record_id: bytes(r.payload) for r in W.with_payloads(resolved, records).collect()} == {
        "10": b"one", "11": b"one", "13": b"two"}


def test_one_url_over_many_partitions(spark):
    raws, want, last = [], {}, None
    for k in range(600):
        url = "http://hot.org/" if k % 5 else f"http://cold.org/{k % 40}"
        if k % 3 == 0:
            raws.append(_raw("response", k, url, 1000 + 10 * k, _full(str(k).encode(), ETag='"e"')))
        else:
            raws.append(_raw("revisit", k, url, 1000 + 10 * k, _again(ETag='"e"')))
    latest = {}
    for k in range(600):
        url = "hot" if k % 5 else k % 40
        if k % 3 == 0:
            latest[url] = str(k)
        else:
            want[str(k)] = latest.get(url)
    got, _ = _resolve(spark, raws)
    assert {k: r.response_id for k, r in got.items()} == want


def test_edge_rows(spark):
    raws = [_raw("response", 1, "http://a.org/", 100, _full(b"", ETag='"1"'))] * 2
    raws += [_raw("revisit", 2, "http://a.org/", 200, _again(ETag='"1"'))] * 2
    raws += [bytearray(b"WARC/1.0\r\nWARC-Type: revisit\r\n\r\nHTTP/1.1 304 x\r\n\r\n"),
             bytearray(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: zz\r\n\r\nx")]
    records = W.parse_records(spark.createDataFrame([(r,) for r in raws], "raw binary"))
    rows = sorted(((r.record_id or ""), r.outcome, r.payload_bytes) for r in W.resolve_revisits(records).collect())
    assert rows == [("", "missing", None), ("2", "resolved", 0), ("2", "resolved", 0)]
    assert W.resolve_revisits(records.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, None, "x"), (None, "u", "x"), (2, "http://a.org", None)], "page_id long, url string, html string")
    assert W.crawl_of_pages(pages).count() == 2


def test_files_plain_and_gzip(spark, tmp_path):
    records = [bytes(_raw("response", k, f"http://a.org/{k}", 100 + k, _full(bytes(range(256)) * (k + 1), ETag=f'"{k}"'))) for k in range(9)]
    (tmp_path / "a.warc").write_bytes(b"".join(records[:5]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[5:]))
    read = W.read_warc(spark, str(tmp_path))
    got = {r.record_id: bytes(r.payload) for r in read.collect()}
    assert got == {str(k): bytes(range(256)) * (k + 1) for k in range(9)}
    assert read.where(F.col("status") == 200).count() == 9


def test_both_versions_and_marks_in_payloads(spark, tmp_path):
    body = b"a line\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\nWARC/1.1 and WARC/1.\r\n" * 3
    records = [bytes(_raw("response", k, f"http://a.org/{k}", 100 + k, _full(body if k % 2 else b"x", ETag='"e"'))) for k in range(6)]
    mixed = [r.replace(b"WARC/1.0", b"WARC/1.1", 1) if k > 2 else r for k, r in enumerate(records)]
    (tmp_path / "a.warc").write_bytes(b"".join(mixed[:4]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in mixed[4:]))
    got = {r.record_id: bytes(r.payload) for r in W.read_warc(spark, str(tmp_path)).collect()}
    assert got == {str(k): body if k % 2 else b"x" for k in range(6)}
    for name, data in (("cut", records[1][:-40]), ("junk", b"not a record WARC/1.0\r\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "c.warc").write_bytes(records[0] + data if name == "cut" else data)
        with pytest.raises(Exception, match="WARC record"):
            W.read_warc(spark, str(tmp_path / name)).collect()
    long = bytes(_raw("response", 9, "http://long.org/", 100, _full(b"z" * 20_000_000)))
    (tmp_path / "long").mkdir()
    (tmp_path / "long" / "d.warc").write_bytes(long + records[0])
    assert {r.record_id: r.payload_bytes for r in W.read_warc(spark, str(tmp_path / "long"), False).collect()} == {"9": 20_000_000, "0": 1}


def test_profile_stands_for_the_answer(spark):
    bare = (b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: 5\r\nWARC-Target-URI: http://a.org/x\r\n"
            b"WARC-Date: 1970-01-01T00:10:00Z\r\nContent-Length: 0\r\n"
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/%s\r\n\r\n\r\n\r\n")
    raws = [_raw("response", 1, "http://a.org/x", 100, _full(b"one", ETag='"1"')), bytearray(bare % b"server-not-modified"),
            bytearray(bare.replace(b"ID: 5", b"ID: 6") % b"identical-payload-digest")]
    got, _ = _resolve(spark, raws)
    assert {k: r.outcome for k, r in got.items()} == {"5": "unverified"}
