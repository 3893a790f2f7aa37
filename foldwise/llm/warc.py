"""WARC archives with a two-level capture index.

``write`` puts one gzip member per record into one file per task; identical
payloads of ``MIN_REVISIT`` bytes or more are stored once, by the record with
the largest id, and revisited by the others. ``build_index`` range-partitions
the captures by reversed-host URL key and writes each shard as compressed
blocks of sorted lines, with a sparse directory of the blocks' first keys.
``fetch`` finds captures by binary search, first among the shards, then in the
shard's directory, then in the one block read and unpacked, and then reads just
the records' byte ranges.

Defined results: null html is an empty payload; a null url has an empty key;
rows with a null id never become the response that others revisit unless no
other row has their payload, and then all of them are responses; rows that
repeat an id and payload are written as often as they occur, and all of the
largest id are responses; very long pages are records like others; an empty table writes nothing; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks, splits
from foldwise.llm.files import attempt_name, reader, writer
from foldwise.session import scratch_path, write_table

MIN_REVISIT = 1000
BLOCK_LINES = 1000
SHARD_BYTES = 32 << 20     # archive bytes that the captures of an index shard take
GZIP_LEVEL = 5
CAPTURE_DATE = "2000-01-01T00:00:00Z"
RECORD_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's name space for URLs
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _clean(url: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)


def url_key(url: str | None) -> str:
    """Reversed host, port, path and query: ``com,example,www)/path?query``; no fragment."""
    if not url:
        return ""
    text = _clean(url.strip())
    try:
        p = urlsplit(text)
        host, port = p.hostname or "", p.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    where = ",".join(reversed(host.split(".")))
    if port and (p.scheme, port) not in (("http", 80), ("https", 443)):
        where += f":{port}"
    return f"{where}){p.path or '/'}" + (f"?{p.query}" if p.query else "")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {CAPTURE_DATE}"]
    if url:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(member: bytes) -> dict:
    """The fields of one record, the payload's length and digest taken from the payload
    itself (from the headers for a revisit, which has none)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(h["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    named = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = h["WARC-Type"]
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != named:
            raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
    else:
        size, digest = int(http.rpartition(b"Content-Length: ")[2]), named
    return {"page_id": int(h["X-Page"]) if "X-Page" in h else None, "payload_bytes": size,
            "payload_digest": digest, "record_type": kind,
            "refers_to": int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None,
            "url": h.get("WARC-Target-URI"), "payload": payload if kind == "response" else None}


def write(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """Write the archives; returns the captures: ``key, page_id, file, offset, length``."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= MIN_REVISIT
    # One row per digest; hashes alone are shuffled for it. Small payloads never revisit and are
    # written where they are read.
    firsts = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("first"))
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = (rows.filter(large).join(firsts, "digest", "left").withColumn("refers_to", first).drop("first")
            .unionByName(rows.filter(~large).withColumn("refers_to", F.lit(None).cast("long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, name = attempt_name()
        out, at = None, 0
        for b in batches:
            ids, keys, offsets, lengths = [], [], [], []
            for i, u, p, d, r in zip(*(c for c in b.columns)):
                if out is None:
                    out = writer(f"{folder}/{name}.warc.gz")
                i, u = i.as_py(), u.as_py()
                member = record(i, u, p.as_py(), d.as_py(), r.as_py())
                out.write(member)
                ids.append(i)
                keys.append(url_key(u))
                offsets.append(at)
                lengths.append(len(member))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(ids, pa.int64()),
                 pa.array([f"{folder}/{name}.warc.gz"] * len(ids), pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = arrow_tasks(rows.select("page_id", "url", "payload", "digest", "refers_to"), run,
                           "key string, page_id long, file string, offset long, length long")
    return write_table(captures, "warc-captures")


def _place(key: str, page_id: int | None) -> tuple[str, bool, int]:
    """Order of the lines: by key, then id, null first."""
    return key, page_id is not None, page_id or 0


def build_index(captures: DataFrame, folder: str | None = None) -> list[dict]:
    """Write the index; returns one entry per shard (its file and its first and last place)."""
    folder = folder or scratch_path(captures.sparkSession, "warc-index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name = attempt_name()
        out, at, lines, directory = None, 0, [], []
        first = last = None

        def flush() -> None:
            nonlocal at, lines
            if lines:
                packed = zlib.compress("".join(lines).encode(), 6)
                out.write(packed)
                head = lines[0].split("\t", 2)
                directory.append(f"{head[0]}\t{head[1]}\t{at}\t{len(packed)}\n")
                at, lines = at + len(packed), []

        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    out = writer(f"{folder}/{name}.blocks")
                    first = (row["key"], row["page_id"])
                last = (row["key"], row["page_id"])
                i = "" if row["page_id"] is None else row["page_id"]
                lines.append(f"{row['key']}\t{i}\t{row['file']}\t{row['offset']}\t{row['length']}\n")
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        flush()
        out.close()
        with writer(f"{folder}/{name}.directory") as f:
            f.write("".join(directory).encode())
        yield pa.RecordBatch.from_pylist(
            [{"shard": part, "file": f"{folder}/{name}", "first_key": first[0], "first_id": first[1],
              "last_key": last[0], "last_id": last[1]}],
            pa.schema([("shard", pa.int32()), ("file", pa.string()), ("first_key", pa.string()),
                       ("first_id", pa.int64()), ("last_key", pa.string()), ("last_id", pa.int64())]))

    by = [F.col("key"), F.col("page_id").asc_nulls_first()]
    # as many shards as the archives need tasks to read them back; the index alone is much smaller
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n = splits(captures.sparkSession, size, SHARD_BYTES)
    shards = arrow_tasks(captures.repartitionByRange(n, *by).sortWithinPartitions(*by), run,
                         "shard int, file string, first_key string, first_id long, "
                         "last_key string, last_id long")
    # one row per shard, that is per partition
    rows = write_table(shards, "warc-shards").collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r["shard"])]


class _Shard:
    """One shard's directory, and the block read last."""

    def __init__(self, file: str):
        with reader(file + ".directory") as f:
            rows = [x.split("\t") for x in f.read().decode().split("\n")[:-1]]
        self.firsts = [_place(k, int(i) if i else None) for k, i, _, _ in rows]
        self.ranges = [(int(a), int(n)) for _, _, a, n in rows]
        self.blocks = reader(file + ".blocks")
        self.at, self.places, self.lines = -1, [], []

    def _open(self, block: int) -> None:
        if block != self.at:
            at, n = self.ranges[block]
            self.blocks.seek(at)
            text = zlib.decompress(self.blocks.read(n)).decode()
            self.lines = [x.split("\t") for x in text.split("\n")[:-1]]
            self.places = [_place(k, int(i) if i else None) for k, i, *_ in self.lines]
            self.at = block

    def find(self, place: tuple[str, bool, int]) -> Iterator[tuple[str, int, int]]:
        """The file ranges of the captures at a place: directory, block, line by binary search."""
        block = max(bisect.bisect_left(self.firsts, place) - 1, 0)
        while block < len(self.firsts) and self.firsts[block] <= place:
            self._open(block)
            i = bisect.bisect_left(self.places, place)
            while i < len(self.places) and self.places[i] == place:
                _, _, file, offset, length = self.lines[i]
                yield file, int(offset), int(length)
                i += 1
            block += 1


def fetch(wanted: DataFrame, shards: list[dict], page_id: str = "page_id", url: str = "url"
          ) -> DataFrame:
    """The records of the captures named by url and id (each pair once): ``page_id,
    payload_bytes, payload_digest, record_type, refers_to``."""
    firsts = [_place(s["first_key"], s["first_id"]) for s in shards]
    lasts = [_place(s["last_key"], s["last_id"]) for s in shards]
    files = [s["file"] for s in shards]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, str, int | None]] = []
            for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                key = url_key(u)
                place = _place(key, i)
                out += [(s, key, i) for s in range(bisect.bisect_left(lasts, place),
                                                   bisect.bisect_right(firsts, place))]
            s, k, i = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(s, pa.int32()), pa.array(k, pa.string()), pa.array(i, pa.int64())],
                names=["shard", "key", "page_id"])

    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives: dict[str, pa.NativeFile] = {}
        shard, number = None, -1
        for b in batches:
            ranges = []
            for s, key, i in zip(*(c.to_pylist() for c in b.columns)):
                if s != number:
                    shard, number = _Shard(files[s]), s
                ranges += shard.find(_place(key, i))
            rows = []
            for file, offset, length in sorted(ranges):
                if file not in archives:
                    if len(archives) >= 64:
                        archives.pop(next(iter(archives))).close()
                    archives[file] = reader(file)
                archives[file].seek(offset)
                r = parse(archives[file].read(length))
                rows.append({c: r[c] for c in kinds.names})
            yield pa.RecordBatch.from_pylist(rows, kinds)

    routed = arrow_tasks(wanted.select(F.col(page_id).cast("long").alias("page_id"),
                                       F.col(url).alias("url")), route,
                         "shard int, key string, page_id long").distinct()
    n = max(1, len(shards))
    return arrow_tasks(routed.repartitionByRange(n, "shard").sortWithinPartitions("shard", "key", "page_id"),
                       read, "page_id long, payload_bytes long, payload_digest string, "
                             "record_type string, refers_to long")
