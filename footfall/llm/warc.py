"""WARC records, and resolution of not-modified revisits.

A revisit record of a server's 304 answer has no payload.  It is resolved by an
as-of join on the canonical URL: the latest strictly earlier full response of
that URL gives the payload if the validators agree, and the 304's permitted
headers replace those of the response.

The join is two ordered passes over one range partitioning by (URL, time): rows
of a URL that is captured very often spread over many partitions.  Inside a
partition a window finds the latest response; what a partition has to take over
from those before it is one row, found from one summary row for each partition.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.stages import stage

#: Parameters that don't choose the content.
TRACKING = re.compile(r"^(?:utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid|jsessionid)$", re.I)
#: Headers of a 304 that may replace a stored response's (all others stay).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Profile of a revisit that stands for a 304 answer, also without the answer's own head.
NOT_MODIFIED_PROFILE = "/revisit/server-not-modified"
RECORD_SCHEMA = ("record_id string, warc_type string, url string, canonical_url string, captured_at long, "
                 "status int, headers map<string,string>, payload_bytes long, payload_sha256 string, payload binary")
_URL = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?", re.I | re.S)
_NAMES = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
_KINDS = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(),
          pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary())


def canonical_url(url: str | None) -> str | None:
    """Host and path with the sorted parameters that choose the content: without
    scheme, user, ``www.``, default port, fragment and tracking parameters."""
    if url is None:
        return None
    found = _URL.match(url)
    if not found:
        return url.strip().split("#")[0]
    host, path, query = found.groups()
    host = re.sub(r":(?:80|443)?$", "", host.rsplit("@", 1)[-1].lower()).removeprefix("www.").rstrip(".")
    kept = sorted(p for p in (query or "").split("&") if p and not TRACKING.match(p.split("=", 1)[0]))
    return host + (path or "/") + ("?" + "&".join(kept) if kept else "")


def _headers(block: bytes) -> dict[str, str]:
    """Names in lower case; values of repeated names joined by commas."""
    out: dict[str, str] = {}
    for line in block.split(b"\n"):
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon and name.strip():
            key, value = name.strip().lower(), value.strip()
            out[key] = f"{out[key]}, {value}" if key in out else value
    return out


def _head_and_rest(data: bytes) -> tuple[bytes, bytes]:
    ends = [(at, len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := data.find(mark)) >= 0]
    if not ends:
        return data, b""
    at, length = min(ends)
    return data[:at], data[at + length:]


def _seconds(date: str | None) -> int | None:
    try:
        return int(datetime.fromisoformat(date.replace("Z", "+00:00")).replace(tzinfo=timezone.utc).timestamp())
    except (AttributeError, ValueError):
        return None


def parse_record(raw: bytes | None, with_payload: bool = True):
    """Values of ``RECORD_SCHEMA`` of one record (from its version line, or the
    line after it); None for bytes that are no record."""
    head, block = _head_and_rest((raw or b"").lstrip(b"\r\n"))
    warc = _headers(head)
    if "warc-type" not in warc:
        return None
    length = warc.get("content-length", "")
    if length.isascii() and length.isdigit():
        block = block[:int(length)]
    status, headers, payload = None, {}, block
    if block.startswith(b"HTTP/"):
        http, payload = _head_and_rest(block)
        line, _, rest = http.partition(b"\n")
        code = re.match(rb"HTTP/\S+\s+(\d{3})", line)
        status, headers = int(code.group(1)) if code else None, _headers(rest)
    url = warc.get("warc-target-uri")
    return (warc.get("warc-record-id"), warc["warc-type"].lower(), url, canonical_url(url), _seconds(warc.get("warc-date")),
            304 if status is None and warc.get("warc-profile", "").lower().endswith(NOT_MODIFIED_PROFILE) else status,
            list(headers.items()), len(payload), hashlib.sha256(payload).hexdigest(),
            payload if with_payload else None)


def parse_records(raw: DataFrame, raw_col: str = "raw", with_payload: bool = True) -> DataFrame:
    """Records (``RECORD_SCHEMA``) of a binary column with one record in each row.

    Null, empty and malformed rows give no record."""
    def run(batches):
        for batch in batches:
            rows = [r for v in batch.column(0) if (r := parse_record(v.as_py(), with_payload))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_KINDS)], _NAMES)

    return raw.select(F.col(raw_col).cast("binary")).mapInArrow(run, RECORD_SCHEMA)


VERSION = "WARC/1."
_START = re.compile(rb"[01][^\S\n]*\n")


def _missing_bytes(record: bytes) -> int:
    """Bytes that a record lacks by its Content-Length."""
    head, block = _head_and_rest(record)
    length = _headers(head).get("content-length", "")
    return int(length) - len(block) if length.isascii() and length.isdigit() else 0


def _whole_records(pieces):
    """Records from the pieces of one range of a file between version marks: a piece goes on
    with the next one as long as its Content-Length says so, because a payload may hold the
    mark itself.  What is no record or stays short fails."""
    record, lacking = b"", 0
    for piece in pieces:
        if lacking > 0:
            record += VERSION.encode() + piece
            lacking -= len(VERSION) + len(piece)
            continue
        if record:
            yield record
        if not _START.match(piece):
            raise ValueError(f"no WARC record: {piece[:60]!r}")
        record, lacking = piece, _missing_bytes(piece)
    if lacking > 0:
        raise ValueError(f"a WARC record ends {lacking} bytes before its Content-Length: {record[:200]!r}")
    if record:
        yield record


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of WARC files of versions 1.0 and 1.1, plain (split between tasks) or gzip
    (streamed).

    Records are told apart by their version mark and checked against their
    Content-Length, so no file is held whole.  A mark inside a payload doesn't cut it.  A
    record that ends too early, in a cut file or (plain files only) because a mark in its
    payload lies in the next split, fails the read."""
    text = spark.read.option("lineSep", VERSION).text(path)
    lines = text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_block_start").alias("start"))

    def run(batches):
        def rows():
            for batch in batches:
                for piece, path, start in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    yield piece.as_py(), (path, start)

        for _, own in itertools.groupby(rows(), key=lambda row: row[1]):
            for record in _whole_records(piece for piece, _ in own if piece):
                yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["raw"])

    return parse_records(lines.mapInArrow(run, "raw binary"), "raw", with_payload)


def _validators(mine: Column, stored: Column) -> Column:
    """Outcome of comparing a revisit's validators with a stored response's."""
    def tag(headers: Column) -> Column:
        return F.regexp_replace(headers["etag"], r"^W/", "")

    def both(name: str) -> Column:
        return mine[name].isNotNull() & stored[name].isNotNull()

    def outcome(same: Column) -> Column:
        return F.when(same, "resolved").otherwise("mismatch")

    return (F.when(both("etag"), outcome(tag(mine) == tag(stored)))
            .when(both("last-modified"), outcome(mine["last-modified"] == stored["last-modified"]))
            .otherwise("unverified"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each not-modified revisit (type ``revisit``, status 304):
    ``record_id, url, canonical_url, captured_at, outcome, response_id,
    payload_bytes, payload_sha256, headers``.

    The candidate is the latest response (type ``response``, status 200) of the
    same canonical URL with a smaller time; of several at one time the one with
    the largest record id.  ``outcome``: ``resolved``; ``mismatch``, the entity
    tags differ (weak comparison), or else the modification dates do;
    ``unverified``, no validator on both sides; ``missing``, no candidate.  Only a
    resolved revisit has the response's payload columns and merged headers; others
    have nulls and their own headers.  Records without URL or time are never
    candidates and their revisits are missing; repeated records each appear.
    """
    is_revisit = (F.col("warc_type") == "revisit") & (F.col("status") == 304)
    is_full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    keyed = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    own = ["record_id", "url", "canonical_url", "captured_at", "headers"]
    # At equal times revisits come first, so a candidate is strictly earlier.
    rows = stage(records.where(is_revisit | (is_full & keyed)).select(
        *own, is_full.cast("int").alias("full"),
        F.when(is_full, F.struct("canonical_url", "captured_at", "record_id", "payload_bytes", "payload_sha256",
                                 F.map_entries("headers").alias("stored"))).alias("response")), "records")
    placed = stage(
        rows.where(keyed).repartitionByRange("canonical_url", "captured_at", "full", "record_id")
        .withColumn("part", F.spark_partition_id()), "captures")
    # The last response of all partitions before: one row for each partition.
    last = placed.groupBy("part").agg(F.max("response").alias("last"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = stage(last.select("part", F.max("last").over(over_parts).alias("carried")), "carried")
    inside = Window.partitionBy("part", "canonical_url").orderBy("captured_at", "full", "record_id")
    found = (placed.withColumn("latest", F.last("response", ignorenulls=True).over(
                 inside.rowsBetween(Window.unboundedPreceding, -1)))
             .where("full = 0").join(F.broadcast(carried), "part")
             .withColumn("candidate", F.coalesce(
                 "latest", F.when(F.col("carried.canonical_url") == F.col("canonical_url"), F.col("carried")))))
    stored = F.map_from_entries("candidate.stored")
    outcome = F.when(F.col("candidate").isNull(), "missing").otherwise(_validators(F.col("headers"), stored))
    resolved = F.col("outcome") == "resolved"
    allowed = [F.lit(h) for h in PERMITTED]
    merged = F.map_concat(
        F.map_filter(F.col("stored"), lambda k, _: ~(k.isin(*allowed) & F.map_contains_key("headers", k))),
        F.map_filter(F.col("headers"), lambda k, _: k.isin(*allowed)))
    done = found.withColumn("outcome", outcome).withColumn("stored", stored).select(
        "record_id", "url", "canonical_url", "captured_at", "outcome",
        *[F.when(resolved, F.col(f"candidate.{c}")).alias(a) for c, a in (
            ("record_id", "response_id"), ("payload_bytes", "payload_bytes"), ("payload_sha256", "payload_sha256"))],
        F.when(resolved, merged).otherwise(F.col("headers")).alias("headers"))
    missing = rows.where(~keyed).select(
        "record_id", "url", "canonical_url", "captured_at", F.lit("missing").alias("outcome"),
        F.lit(None).cast("string").alias("response_id"), F.lit(None).cast("long").alias("payload_bytes"),
        F.lit(None).cast("string").alias("payload_sha256"), "headers")
    return done.union(missing)


def with_payloads(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Resolved revisits with the payload of their response; other outcomes have none and
    don't appear, nor do revisits of a response without a record id.  Repeated responses
    of one id each appear."""
    payloads = records.where("warc_type = 'response'").select(F.col("record_id").alias("response_id"), "payload")
    return resolved.where("outcome = 'resolved'").join(payloads, "response_id")


# ---------------------------------------------------------------------------
# A crawl derived from a table of pages
# ---------------------------------------------------------------------------
CRAWL_START = 1_700_000_000
REVISIT_AFTER = 86_400


def _record(kind: str, number: int, url: str, at: int, http: bytes) -> bytes:
    date = datetime.fromtimestamp(at, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {number}\r\nWARC-Target-URI: {url}\r\n"
            f"WARC-Date: {date}\r\nContent-Length: {len(http)}\r\n\r\n").encode() + http + b"\r\n\r\n"


def page_captures(page_id: int, url: str, html: str | None) -> list[bytes]:
    """Two raw records of a page: its response, numbered ``2 * page_id``, and a
    day later a revisit, ``2 * page_id + 1``.  The revisit has the weak entity tag
    of the page; of ten pages one has another tag, one has no validator, one is dated
    (the response, too, with another date for half of these) and one is revisited at an
    address that was never captured."""
    body = (html or "").encode("utf-8", "surrogatepass")
    tag = hashlib.sha256(body).hexdigest()[:16]
    at = CRAWL_START + 60 * page_id
    seen = {3: 'ETag: "changed"\r\n', 5: "Last-Modified: day 5\r\n", 7: ""}.get(page_id % 10, f'ETag: W/"{tag}"\r\n')
    dated = f"Last-Modified: day {5 if page_id % 20 == 5 else 6}\r\n" if page_id % 10 == 5 else f'ETag: "{tag}"\r\n'
    full = (f'HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{dated}Cache-Control: max-age={page_id % 100}\r\n'
            f"Content-Length: {len(body)}\r\n\r\n").encode() + body
    again = (f"HTTP/1.1 304 Not Modified\r\n{seen}Cache-Control: max-age=7200\r\nContent-Length: 0\r\n"
             f"Server: again\r\n\r\n").encode()
    return [_record("response", 2 * page_id, url, at, full),
            _record("revisit", 2 * page_id + 1, f"http://never.captured/{page_id}" if page_id % 10 == 9 else url,
                    at + REVISIT_AFTER, again)]


def crawl_of_pages(pages: DataFrame) -> DataFrame:
    """Raw records (column ``raw``) of all pages with an id and a URL."""
    def run(batches):
        for batch in batches:
            out = [raw for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns))
                   for raw in page_captures(page_id, url, html)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["raw"])

    usable = pages.where("page_id is not null and url is not null")
    return usable.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                         F.col("html").cast("string")).mapInArrow(run, "raw binary")
