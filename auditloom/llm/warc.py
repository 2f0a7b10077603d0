"""WARC archives with a two-level capture index.

Archives are ``.warc.gz`` files: one gzip member per record. The index holds a line per
capture, keyed by the URL with its host reversed, in key order; runs of lines are
compressed to blocks, and a sparse directory keeps each block's first key and place. A lookup
searches the directory, reads the block by its byte range, searches the block, and reads the
record by its byte range. Sorted keys are looked up in one sweep, which opens each block once and
reads records that lie side by side in one range.

Both kinds of files are written by Spark's text sink, so they land in any file system Spark
writes to and survive lost executors: a member ends with a zero byte, which is left to the sink
as line separator.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from auditloom.llm.common import durable, scratch, stored
from auditloom.llm.words import slices

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK_LINES = 256
LEVEL = 5
#: Records of a block closer than this many bytes are read in one range, of at most ``SPAN`` bytes where they are more than one.
GAP = 1 << 16
SPAN = 1 << 22
#: Parts that the rows of one payload, or of one key, are dealt to in a join.
SALTS = 256
_FEED = 1 << 16


def digest32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: 40 bits are eight digits."""
    group = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*group), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def surt(url: str) -> str:
    """``com,example,www)/path?query`` of a URL; what has no host stands as it is."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return url
    if not host:
        return url
    port = parts.netloc.rpartition("@")[2].partition(":")[2]
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def header_url(url: str | None) -> str:
    """A URL as it stands in a header: white space and control characters as per cent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url or "")


def capture_key(url: str, page_id: int | None, digest: str = "") -> str:
    """Index key: reversed-host URL, the id in an order-keeping form, and the payload's digest, so that
    captures of one key have one payload."""
    return f"{surt(url)} {'-' if page_id is None else format(page_id + (1 << 63), '020d')} {digest}"


def member(data: bytes) -> bytes:
    """A gzip member without its last byte, which is zero: the last byte of the size of up to
    16 MiB; a larger record gets an empty member behind it."""
    made = gzip.compress(data, LEVEL, mtime=0)
    if made[-1]:
        made += gzip.compress(b"", LEVEL, mtime=0)
    return made[:-1]


def members(source) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of a file or of bytes, read piece by piece; an empty
    one belongs to the one before."""
    source = source if hasattr(source, "read") else io.BytesIO(source)
    at, last, held = 0, None, source.read(_FEED)
    while held:
        start, parts, gz = at, [], zlib.decompressobj(31)
        while not gz.eof:
            held = held or source.read(_FEED)
            if not held:
                raise ValueError("the archive ends inside a record")
            parts.append(gz.decompress(held))
            at += len(held) - len(gz.unused_data)
            held = gz.unused_data
        content = b"".join(parts)
        if content:
            if last:
                yield last
            last = (start, at - start, content)
        elif last:
            last = (last[0], at - last[0], last[2])
        held = held or source.read(_FEED)
    if last:
        yield last


def record(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit record without payload."""
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id),
            "WARC-Target-URI": header_url(url), "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{digest}"}
    payload = (html or "").encode() if refers_to is None else b""
    if refers_to is not None:
        head |= {"WARC-Refers-To": name(refers_to), "WARC-Refers-To-Target-URI": header_url(refers_url),
                 "WARC-Refers-To-Date": DATE, "WARC-Profile": PROFILE}
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        f"Content-Length: {len(payload)}\r\n".encode() if refers_to is None else b"") + b"\r\n" + payload
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body))}
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return lines.encode() + body + b"\r\n\r\n"


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _id(name: str) -> int | None:
    text = name[len("<urn:page:"):-1]
    return None if text == "null" else int(text)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def opened(uri: str) -> pa.NativeFile:
    """A file in any file system that Arrow knows."""
    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return system.open_input_file(path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    with opened(uri) as f:
        return f.read_at(length, offset)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            cols = [part[c].to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to", "refers_url")]
            made = pa.array([member(record(*row)) for row in zip(*cols)], pa.binary())
            yield pa.RecordBatch.from_arrays([made], names=["data"])


def _write(members_frame: DataFrame, folder: str) -> None:
    members_frame.select(F.col("data").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Writes a record per row of ``pages`` (``page_id``, ``url``, ``html``) into ``folder``, one archive per task.

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with the smallest
    page_id are responses and the others revisits that refer to it. A null html is empty; rows
    with a null id are responses, and nothing refers to them.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
                        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"),
                        F.pmod(F.xxhash64(F.col("page_id").cast("bigint")), F.lit(SALTS)).cast("int").alias("salt"))
    may = F.col("page_id").isNotNull() & (F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes)
    # Only payloads that occur again come back to the rows, once a salt, so no task takes all copies of a text.
    again = (rows.where(may).groupBy("sha1")
             .agg(F.min(F.struct("page_id", "url")).alias("first"), F.max("page_id").alias("last"), F.collect_set("salt").alias("salts"))
             .where("first.page_id < last")
             .select("sha1", F.explode("salts").alias("salt"), F.col("first.page_id").alias("origin"), F.col("first.url").alias("origin_url")))
    refers = F.col("page_id") > F.col("origin")
    linked = rows.where(may).join(durable(again), ["sha1", "salt"], "left").select(
        "page_id", "url", F.when(refers, None).otherwise(F.col("html")).alias("html"), digest32(F.col("sha1")).alias("digest"),
        F.when(refers, F.col("origin")).alias("refers_to"), F.when(refers, F.col("origin_url")).alias("refers_url"))
    alone = rows.where(~may).select("page_id", "url", "html", digest32(F.col("sha1")).alias("digest"),
                                    F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"))
    _write(linked.unionByName(alone).mapInArrow(_records, "data binary"), folder)


_CAPTURE = "key string, page_id bigint, record_type string, path string, offset bigint, length bigint, refers_to bigint, payload_key string"
_CAPTURE_TYPES = {"key": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "path": pa.string(), "offset": pa.int64(),
                  "length": pa.int64(), "refers_to": pa.int64(), "payload_key": pa.string()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def _capture_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            rows = []
            with opened(path) as archive:
                for offset, length, content in members(archive):
                    head, _ = parse(content)
                    page_id, digest = _id(head["WARC-Record-ID"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                    key, origin, payload_key = capture_key(head["WARC-Target-URI"], page_id, digest), None, None
                    if head["WARC-Type"] == "revisit":
                        origin = _id(head["WARC-Refers-To"])
                        payload_key = capture_key(head["WARC-Refers-To-Target-URI"], origin, digest)
                    rows.append((key, page_id, head["WARC-Type"], path, offset, length, origin, payload_key or key))
                    if len(rows) == 4096:
                        yield _batch(rows, _CAPTURE_TYPES)
                        rows = []
            yield _batch(rows, _CAPTURE_TYPES)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of ``folder``; their content is left to the tasks, which read it piece by piece."""
    return spark.read.format("binaryFile").load(folder).where("length > 0").select("path")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives in ``folder``: key, id, type and place, and the key of the capture
    that holds its payload: its own for a response, that of the response it refers to for a revisit."""
    return _files(spark, folder).mapInArrow(_capture_rows, _CAPTURE)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines: list[str] = []

    def made(part: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([member("\n".join(part).encode())], pa.binary())], names=["data"])

    for batch in batches:
        for row in batch.to_pylist():
            lines.append(json.dumps([row["key"], row["path"], row["offset"], row["length"]]))
            if len(lines) == BLOCK_LINES:
                yield made(lines)
                lines = []
    if lines:
        yield made(lines)


def _block_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"first_key": pa.string(), "path": pa.string(), "offset": pa.int64(), "length": pa.int64()}
    for batch in batches:
        for path in batch["path"].to_pylist():
            with opened(path) as blocks:
                yield _batch([(json.loads(content.partition(b"\n")[0])[0], path, offset, length) for offset, length, content in members(blocks)], types)


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the key-ordered blocks of ``captures`` into ``folder`` and returns the sparse directory:
    ``first_key``, ``path``, ``offset`` and ``length`` of each block."""
    places = ["key", "path", "offset"]
    ordered = captures.select(*places, "length").repartitionByRange(*places).sortWithinPartitions(*places)
    _write(ordered.mapInArrow(_blocks, "data binary"), folder)
    spark = captures.sparkSession
    return stored(_files(spark, folder).mapInArrow(_block_places, "first_key string, path string, offset bigint, length bigint"), "directory")


def _payloads(places: dict[str, tuple[str, int, int]]) -> dict[str, tuple[int, str]]:
    """Size and digest of the payload of each key of a block, by the places (path, offset, length) of their records."""
    out: dict[str, tuple[int, str]] = {}
    run: list[tuple[str, str, int, int]] = []

    def read() -> None:
        _, path, start, _ = run[0]
        data = read_range(path, start, run[-1][2] + run[-1][3] - start)
        for key, _, offset, length in run:
            payload = parse(next(members(data[offset - start: offset - start + length]))[2])[1]
            out[key] = (len(payload), payload_digest(payload))

    for key, (path, offset, length) in sorted(places.items(), key=lambda item: item[1]):
        if run and (path != run[-1][1] or offset - run[-1][2] - run[-1][3] > GAP or offset + length - run[0][2] > SPAN):
            read()
            run = []
        run.append((key, path, offset, length))
    if run:
        read()
    return out


_FOUND = "payload_key string, salt int, payload_bytes bigint, payload_digest string"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Looks up keys that come in order behind the directory entries of their index file: rows with an
    ``offset`` are blocks, the others keys. A block's keys are held, at most ``BLOCK_LINES`` of them with a result."""
    types = {"payload_key": pa.string(), "salt": pa.int32(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
    block, wanted = None, []

    def answered() -> pa.RecordBatch:
        found = {}
        if block and wanted:
            lines = [json.loads(x) for _, _, content in members(read_range(*block)) for x in content.decode().split("\n")]
            keys, places = [x[0] for x in lines], {}
            for key, _ in wanted:
                at = bisect_right(keys, key) - 1
                if at >= 0 and keys[at] == key:
                    places[key] = tuple(lines[at][1:])
            found = _payloads(places)
        return _batch([(key, salt, *found[key]) for key, salt in wanted if key in found], types)

    for batch in batches:
        for key, salt, path, offset, length in zip(*(batch[c].to_pylist() for c in ("key", "salt", "path", "offset", "length"))):
            if offset is None:
                wanted.append((key, salt))
                if len(wanted) < 4 * BLOCK_LINES or key == wanted[-2][0]:
                    continue
                yield answered()
                wanted = []
            else:
                if wanted:
                    yield answered()
                block, wanted = (path, offset, length), []
    if wanted:
        yield answered()


def resolve(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """``payload_bytes`` and ``payload_digest`` of the record of each capture key in ``payload_key``; ``salt`` is handed on.
    A key that no capture has is left out.

    The driver holds the first key of each index file, as many as the index has tasks. Keys go to
    the file that covers them and are swept in order with that file's part of the directory, in constant memory.
    """
    spark = keys.sparkSession
    files = sorted((r["first"], r["path"]) for r in directory.groupBy("path").agg(F.min("first_key").alias("first")).collect())
    if not files:
        return spark.createDataFrame([], _FOUND)
    firsts, paths = [f for f, _ in files], np.array([p for _, p in files], dtype=object)

    def covering(column: pd.Series) -> pd.Series:
        return pd.Series(paths[[max(0, bisect_right(firsts, k) - 1) for k in column]], dtype=object)

    asked = keys.select(F.pandas_udf(covering, "string")("payload_key").alias("file"), F.col("payload_key").alias("key"), "salt",
                        F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("bigint").alias("length"))
    blocks = directory.select(F.col("path").alias("file"), F.col("first_key").alias("key"), F.lit(None).cast("int").alias("salt"), "path", "offset", "length")
    # Nulls come last: a block stands before the keys that equal its first one.
    order = ["file", "key", F.col("offset").asc_nulls_last()]
    return blocks.unionByName(asked).repartition(len(files), "file").sortWithinPartitions(*order).mapInArrow(_sweep, _FOUND)


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes archives and index of ``pages``, reads them back, and returns a row per page: ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``. Size and digest are those of the record that the
    index finds for the page: its own for a response, the one it refers to for a revisit. Repeated rows stay repeated.
    """
    spark = pages.sparkSession
    archives = scratch(spark, "warc")
    write_archives(pages, archives, least_bytes)
    rows = stored(read_archives(spark, archives), "captures").withColumn("salt", F.pmod(F.xxhash64("path", "offset"), F.lit(SALTS)).cast("int"))
    directory = write_index(rows, scratch(spark, "index"))
    # A payload that many pages share is asked for at most once a salt.
    found = stored(resolve(rows.select("payload_key", "salt").distinct(), directory), "payloads")
    return rows.join(found, ["payload_key", "salt"], "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
