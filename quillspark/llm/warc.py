"""Legacy web archives: ARC files of versions 1 and 2, converted to WARC.

Pages are written as ARC files; the converter parses the version block, the
version's header lines and the declared lengths, and synthesises for each record
a WARC identifier, date, type and digests.  Of records with equal payloads of at
least ``least`` bytes the one with the largest page_id is a response, the others
are revisits of it; smaller ones are all responses.

Files are gzip members, one a record, of about FILE_BYTES.  Python code reaches
the shared folder by pyarrow's file systems.  A file is written under an
attempt's name and then moved, so a repeated task leaves equal files.

Null html is an empty payload, a null url is urn:page:.  Rows without page_id
are responses that nothing refers to; equal rows with the largest id are all
responses.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import attempt_name, lean, new_folder, put_file, store, written

FILE_BYTES, FILE_RECORDS = 8 << 20, 10_000
#: Header fields after each version's block line.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
CAPTURED = "20000101000000"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def members(stream, size: int = 1 << 16):
    """Decompressed gzip members one after another."""
    left = b""
    while True:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not left:
                left = stream.read(size)
                if not left:
                    if out:
                        raise ValueError("archive ends inside a record")
                    return
            out.append(z.decompress(left))
            left = z.unused_data
        yield b"".join(out)


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 quillspark\n{' '.join(FIELDS[version])}\n\n".encode()
    line = {1: [f"filedesc://{name}", "0.0.0.0", CAPTURED, "text/plain", str(len(body))], 2: [f"filedesc://{name}", "0.0.0.0", CAPTURED, "text/plain", "200", "-", "-", "0", name, str(len(body))]}[version]
    return " ".join(line).encode() + b"\n" + body


def arc_record(version: int, name: str, offset: int, page_id, url: str | None, payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head + payload
    uri = re.sub(r"\s", lambda m: "%%%02X" % ord(m[0]) if ord(m[0]) < 256 else "%20", url) if url else f"urn:page:{'' if page_id is None else page_id}"
    line = [uri, "0.0.0.0", CAPTURED, "text/html"]
    if version == 2:
        line += ["200", digest(payload), "-", str(offset), name]
    return " ".join([*line, str(len(body))]).encode() + b"\n" + body + b"\n"


def parse_arc(stream):
    """Yields (number of the record, header fields, body) of an ARC file's records, by its own version block."""
    fields = None
    for k, raw in enumerate(members(stream)):
        raw = raw.lstrip(b"\n") if k else raw
        line, _, rest = raw.partition(b"\n")
        got = line.decode().split(" ")
        length = int(got[-1])
        body = rest[:length]
        if len(body) != length:
            raise ValueError("an ARC record is shorter than its declared length")
        if k == 0:
            version = int(body.split(b" ", 1)[0])
            fields = body.split(b"\n")[1].decode().split(" ")
            if fields != FIELDS.get(version):
                raise ValueError(f"unknown ARC fields: {fields}")
            continue
        if len(got) != len(fields):
            raise ValueError(f"an ARC header line has {len(got)} fields, not {len(fields)}")
        yield k, dict(zip(fields, got, strict=True)), body


def http_parts(body: bytes) -> tuple[bytes, dict[str, str], bytes]:
    head, mark, payload = body.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return head + mark, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def record_id(page_id, arc: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}' if page_id is not None else f'{arc}#{number}')}>"


def to_warc(arc: str, number: int, fields: dict, body: bytes, refers_to: int | None) -> bytes:
    """The WARC record of an ARC record; refers_to: page of the response, for a revisit."""
    head, http, payload = http_parts(body)
    page = http.get("x-page-id") or None
    d = fields["Archive-date"]
    block = body if refers_to is None else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page, arc, number)}",
        f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        f"WARC-Target-URI: {fields['URL']}",
        f"WARC-IP-Address: {fields['IP-address']}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, '', 0)}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_info(name: str) -> bytes:
    body = b"software: quillspark\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_warc(stream):
    """Yields (header fields in lower case, block) of a WARC file's records."""
    for raw in members(stream):
        f = io.BytesIO(raw)
        if not f.readline().startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := f.readline().strip()):
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        block = f.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a WARC record is shorter than its declared length")
        yield fields, block


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ARC files, every other one of version 2; a written manifest of one row a file."""

    def run(batches):
        part, shard, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal shard, size
            at = f"{folder}/{name()}"
            put_file(at, held, attempt_name())
            n = len(held) - 1
            held.clear()
            shard, size = shard + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([n], pa.int64())], names=["path", "records"])

        def name():
            return f"part-{part:06d}-{shard:06d}.arc.gz"

        for b in batches:
            for page_id, url, html in zip(b["page_id"], b["url"], b["html"], strict=True):
                version = 1 + (part + shard) % 2
                if not held:
                    held.append(member(arc_version_block(name(), version)))
                payload = (html.as_py() or "").encode()
                held.append(member(arc_record(version, name(), size, page_id.as_py(), url.as_py(), payload)))
                size += len(payload)
                if size >= FILE_BYTES or len(held) > FILE_RECORDS:
                    yield flush()
        if held:
            yield flush()

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return written(rows.mapInArrow(lean(run), "path string, records long"), "arc-files")


def _spread(files: DataFrame) -> DataFrame:
    n = files.count()
    return files.repartition(max(1, min(n, 4 * max(files.sparkSession.sparkContext.defaultParallelism, n // 64))), F.xxhash64("path"))


def _open(path: str):
    fs, at = store(path)
    return fs.open_input_stream(at, compression=None)


def index_arc(files: DataFrame) -> DataFrame:
    """path, number, page_id, payload_bytes and payload_digest of each ARC record."""

    def run(batches):
        for b in batches:
            for path in b["path"].to_pylist():
                rows = []
                with _open(path) as f:
                    for number, _, body in parse_arc(f):
                        _, http, payload = http_parts(body)
                        rows.append((path, number, int(http["x-page-id"]) if http.get("x-page-id") else None, len(payload), digest(payload)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["path", "number", "page_id", "payload_bytes", "payload_digest"])

    return _spread(files.select("path")).mapInArrow(lean(run), "path string, number int, page_id long, payload_bytes long, payload_digest string")


def convert(files: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Converts ARC files to WARC files; a written manifest of one row a file."""
    index = written(index_arc(files), "arc-index")
    large = index.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    keep = large.groupBy("payload_digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("times")).where("times > 1")
    revisits = large.join(keep, "payload_digest").where("page_id < kept")
    # a file holds at most FILE_RECORDS records, so these lists are bounded
    of_file = revisits.groupBy("path").agg(F.collect_list(F.struct("number", "kept")).alias("revisits"))
    work = files.select("path").join(of_file, "path", "left")

    def run(batches):
        for b in batches:
            for path, revisits in zip(b["path"].to_pylist(), b["revisits"].to_pylist(), strict=True):
                kept = {x["number"]: x["kept"] for x in revisits or []}
                name = path.rsplit("/", 1)[1].replace(".arc.gz", ".warc.gz")
                arc = path.rsplit("/", 1)[1]
                out = [member(warc_info(name))]
                with _open(path) as f:
                    out += [member(to_warc(arc, number, fields, body, kept.get(number))) for number, fields, body in parse_arc(f)]
                put_file(f"{folder}/{name}", out, attempt_name())
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(out) - 1], pa.int64())], names=["path", "records"])

    return written(_spread(work).mapInArrow(lean(run), "path string, records long"), "warc-files")


def read_warc(files: DataFrame) -> DataFrame:
    """One row a response or revisit, checked against its digests; payload is null for revisits."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        for b in batches:
            for path in b["path"].to_pylist():
                rows = []
                with _open(path) as f:
                    for fields, block in parse_warc(f):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        if digest(block) != fields["warc-block-digest"].removeprefix("sha1:"):
                            raise ValueError(f"{path}: a block digest does not match")
                        _, http, payload = http_parts(block)
                        said = fields["warc-payload-digest"].removeprefix("sha1:")
                        whole = fields["warc-type"] == "response"
                        if whole and digest(payload) != said:
                            raise ValueError(f"{path}: a payload digest does not match")
                        refers = fields.get("refers-to-page-id")
                        rows.append((int(http["x-page-id"]) if http.get("x-page-id") else None, fields["warc-target-uri"], int(http["content-length"]), said, fields["warc-type"], int(refers) if refers else None, payload if whole else None))
                for k in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1000], strict=True), kinds, strict=True)], names=names)

    return _spread(files.select("path")).mapInArrow(lean(run), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages to ARC to WARC, read back."""
    spark = pages.sparkSession
    arcs = write_arc(pages, new_folder(spark, "arc"))
    return read_warc(convert(arcs, new_folder(spark, "warc"), least))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY hex) AS kept,
        array_to_string(list_transform(generate_series(0, 7), lambda g:
          array_to_string(list_transform(generate_series(0, 3), lambda k:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * g, 5) AS BIGINT) >> (15 - 5 * k)) & 31 AS INTEGER), 1)), '')), '') AS payload_digest
      FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM d
"""
