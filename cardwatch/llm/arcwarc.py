"""Legacy ARC archives to WARC.

An ARC file is a version block (``filedesc://`` record, whose second line names the version
and whose third names the header fields), then for each document a header line and as many
bytes as it declares. Version 1 lines have five fields (URL, IP, date, type, length),
version 2 ten (result code, checksum, location, offset and file name before the length). The
converter reads both, and makes of each document a WARC record with an identifier, an ISO
timestamp, a type and block and payload digests. A document whose payload was seen before
becomes a ``revisit`` with the HTTP headers only.

Pages go through it archive by archive: a task writes its pages as ARC records, converts
them, and writes gzipped WARC files of bounded size to the shared folder, under names of its
own; the manifest that Spark commits lists those that count. Which of equal payloads is the
response is found before, from digests alone.

Defined cases: null html is an empty payload; a null url becomes ``-``; white space and
control characters in urls are percent-encoded, as header lines need. Of equal payloads the
smallest page id is the response; where rows repeat that id with that payload, one of them is,
and the others revisit it. All rows of a payload that only null ids have are responses. No two
records share an identifier. An empty table makes no file. Other columns are not read.

Archives that exist are converted by :func:`convert_files`, also gzipped ones.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (batches_of, materialize, new_file, open_fs, record_batch,
                     scratch_path)

#: Fixed values of the two formats.
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = ("URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
             "Filename Archive-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

#: Archive date of pages, which have none of their own.
DATE = "20240101000000"
FILE_BYTES = 64 << 20
GZIP_LEVEL = 1
READ_BYTES = 64 << 10
#: Tasks that read files, at most; more files are shared out among them.
READ_TASKS = 10_000

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
ROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("record_type", pa.string()),
                 ("refers_to", pa.int64()), ("target_uri", pa.string())])


def header_url(url: str | None) -> str:
    """A url that can stand in a header line."""
    if not url:
        return "-"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


# --- ARC ---------------------------------------------------------------------------------
def arc_start(name: str, version: int = 1, date: str = DATE) -> bytes:
    body = f"{version} 0 cardwatch\n{V1_FIELDS if version == 1 else V2_FIELDS}\n".encode()
    line = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        line += ["200", "-", "-", "0", name]
    return " ".join([*line, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(url: str, body: bytes, version: int = 1, mime: str = "text/html",
               date: str = DATE, ip: str = "0.0.0.0", name: str = "-", offset: int = 0) -> bytes:
    line = [url, ip, date, mime]
    if version == 2:
        line += ["200", "-", "-", str(offset), name]
    return " ".join([*line, str(len(body))]).encode() + b"\n" + body + b"\n"


#: URL (old crawlers left spaces in it), IP address, date, and the rest of a header line.
LINE = re.compile(r"(.*?) ((?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*|-) (\d{4,14}) (.*)",
                  re.S)


def header_fields(text: str, names: list[str]) -> dict:
    """The fields of a header line: URL, IP address and date from the left, those after the
    content type from the right, so that the type may hold spaces
    (``text/html; charset=utf-8``), as may the URL."""
    if (m := LINE.fullmatch(text)) and names[:3] == V1_FIELDS.split(" ")[:3]:
        rest = m[4].rsplit(" ", len(names) - 4)
        if len(rest) == len(names) - 3:
            return dict(zip(names, [m[1], m[2], m[3], *rest]))
    return dict(zip(names, text.rsplit(" ", len(names) - 1)))


def plain_arc(stream):
    """The stream itself, or what it unpacks to where it is an ``.arc.gz``, whose records are
    gzip members one after the other."""
    stream = io.BufferedReader(stream) if not hasattr(stream, "peek") else stream
    return gzip.GzipFile(fileobj=stream) if stream.peek(2)[:2] == b"\x1f\x8b" else stream


def read_arc(stream):
    """(fields by name, body) of each document of an ARC stream, of either version, plain or
    gzipped. The version block names the fields; where it doesn't, its number tells them."""
    names, stream = None, plain_arc(stream)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        length = int(text.rsplit(" ", 1)[1])
        body = stream.read(length)
        if len(body) < length:
            raise ValueError("a record is shorter than its declared length")
        if names is None:
            if not text.startswith("filedesc://"):
                raise ValueError("an ARC file starts with a version block")
            own = body.decode("utf-8", "replace").splitlines()
            names = own[1].split() if len(own) > 1 and own[1].startswith("URL ") else \
                {1: V1_FIELDS, 2: V2_FIELDS}[int(body.split(b" ", 1)[0])].split(" ")
            continue
        yield header_fields(text, names), body


# --- WARC --------------------------------------------------------------------------------
def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(*parts) -> str:
    """The same identifier for the same document, also when a task runs again."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(map(str, parts)))}>"


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and payload; no headers if it isn't HTTP."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    at = body.find(b"\r\n\r\n")
    return (body, b"") if at < 0 else (body[:at + 4], body[at + 4:])


def to_warc(fields: dict, body: bytes, identifier: str | None = None,
            refers_to: str | None = None, more: dict | None = None) -> bytes:
    """The WARC record of an ARC document; ``refers_to``: the identifier of the record with
    the same payload, for a revisit."""
    http, payload = split_http(body)
    url = fields["URL"]
    if url.startswith("dns:"):
        kind, mime = "resource", "text/dns"
    elif http:
        kind, mime = "response", "application/http; msgtype=response"
    else:
        kind, mime = "resource", fields["Content-type"]
    block = body
    head = {}
    if refers_to:
        kind, block = "revisit", http
        head = {"WARC-Refers-To": refers_to, "WARC-Profile": REVISIT_PROFILE}
    pay = digest(payload)
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": identifier or record_id(url, fields["Archive-date"], pay),
        "WARC-Date": iso_date(fields["Archive-date"]),
        "WARC-Target-URI": url,
        "WARC-IP-Address": fields["IP-address"],
        "WARC-Payload-Digest": f"sha1:{pay}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        **head, **(more or {}),
        "Content-Type": mime,
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def convert(stream, **kw):
    """WARC records of an ARC stream."""
    for fields, body in read_arc(stream):
        yield to_warc(fields, body, **kw)


def gzipped(record: bytes) -> bytes:
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def read_members(stream):
    """The gzip members of a stream, one by one, in pieces of bounded size."""
    data, z, out = b"", None, []
    while True:
        if not data:
            data = stream.read(READ_BYTES)
            if not data:
                if z is not None:
                    raise ValueError("a member is cut off")
                return
        if z is None:
            z, out = zlib.decompressobj(31), []
        out.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(out)
            z = None


def parse_warc(record: bytes) -> tuple[dict, bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is not the declared one")
    return fields, rest[:n]


# --- pages -------------------------------------------------------------------------------
def _page_as_arc(page_id, url, payload: bytes, version, name, offset) -> bytes:
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n"
            + ("" if page_id is None else f"X-Page-Id: {page_id}\r\n") + "\r\n").encode()
    return arc_record(header_url(url), head + payload, version, name=name, offset=offset)


def _write(folder, version, file_bytes):
    def run(batches):
        shard, out, size, records, name = TaskContext.get().partitionId(), None, 0, 0, None

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records])],
                                              schema=MANIFEST)

        nth = 0
        for batch in batches:
            for pid, url, html, first, again in zip(*(batch.column(k).to_pylist()
                                                      for k in range(5))):
                nth += 1
                arc = f"pages-{shard:06d}.arc"
                payload = (html or "").encode("utf-8", "replace")
                stream = io.BytesIO(arc_start(arc, version) + _page_as_arc(
                    pid, url, payload, version, arc, nth))
                # Only a response that others revisit needs an identifier that they know.
                shared = None if first is None else record_id("page", first, digest(payload))
                own = record_id("row", pid, shard, nth) if again or first is None else shared
                more = {"X-Refers-To-Page": first} if again else None
                for record in convert(stream, identifier=own, more=more,
                                      refers_to=shared if again else None):
                    if out is None:
                        name = new_file(folder, f"pages-{shard:06d}", ".warc.gz")
                        fs, at = open_fs(name)
                        out, size, records = fs.open_output_stream(at, compression=None), 0, 0
                    data = gzipped(record)
                    out.write(data)
                    size += len(data)
                    records += 1
                if size >= file_bytes:
                    yield close()
                    out = None
                    size = 0
        if out is not None:
            yield close()
    return run


def _read(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, at = open_fs(path)
            rows = []
            with fs.open_input_stream(at, compression=None) as f:
                for record in read_members(f):
                    fields, block = parse_warc(record)
                    http, payload = split_http(block)
                    own = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:] if x)
                    kind = fields["WARC-Type"]
                    if kind == "response" and digest(payload) != fields[
                            "WARC-Payload-Digest"].removeprefix("sha1:"):
                        raise ValueError("a payload does not match its digest")
                    to = fields.get("X-Refers-To-Page")
                    pid = own.get("X-Page-Id")
                    rows.append((None if pid is None else int(pid), int(own["Content-Length"]),
                                 fields["WARC-Payload-Digest"].removeprefix("sha1:"), kind,
                                 None if to is None else int(to), fields["WARC-Target-URI"]))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f_.type) for c, f_ in zip(
                            zip(*rows), ROW)], schema=ROW)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f_.type) for c, f_ in zip(
                    zip(*rows), ROW)], schema=ROW)


def write(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", min_bytes: int = 0, version: int = 2,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages' WARC files to ``folder``; returns the manifest, written as a table.
    Payloads below ``min_bytes`` are always responses."""
    spark = df.sparkSession
    batches_of(spark)
    fs, at = open_fs(folder)
    fs.create_dir(at, recursive=True)
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = df.select(F.col(id_col).cast("long").alias("p"), F.col(url_col).alias("u"),
                      F.col(html_col).alias("h"), F.when(F.octet_length(html) >= min_bytes,
                                                         F.sha1(html)).alias("d"))
    # Only payloads that repeat need a look at other rows; both join sides are plain scans
    # and tables, so a payload that a third of the pages share can be split.
    firsts = materialize(
        pages.filter("d IS NOT NULL").groupBy("d", "p").agg(F.count("*").alias("n"))
        .groupBy("d").agg(F.min("p").alias("first"), F.min_by("n", "p").alias("copies"),
                          F.sum("n").alias("n")).filter("n > 1").drop("n"), "warc_firsts")
    joined = pages.join(firsts, "d", "left")
    rows = joined.withColumn("again", F.coalesce(F.col("p").isNull() & F.col("first").isNotNull()
                                                 | (F.col("p") != F.col("first")), F.lit(False)))
    if not firsts.filter("copies > 1").isEmpty():
        # The first id itself repeats: of its rows, written once so that numbers stay, one is
        # the response.
        twin = F.coalesce((F.col("copies") > 1) & (F.col("p") == F.col("first")), F.lit(False))
        twins = materialize(rows.filter(twin).withColumn("m", F.monotonically_increasing_id()),
                            "warc_twins")
        one = twins.groupBy("d").agg(F.min("m").alias("least"))
        rows = rows.filter(~twin).unionByName(
            twins.join(one, "d").withColumn("again", F.col("m") != F.col("least"))
            .drop("m", "least"))
    rows = rows.select("p", "u", "h", "first", "again")
    return materialize(rows.mapInArrow(_write(folder, version, file_bytes),
                                       "path string, records long"), "warc_manifest")


def _convert_files(folder, file_bytes):
    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, at = open_fs(path)
                stem = re.sub(r"\.arc(\.gz)?$", "", at.rsplit("/", 1)[-1])
                out, size, records, name = None, 0, 0, None
                with source.open_input_stream(at, compression=None) as raw:
                    for nth, (fields, body) in enumerate(read_arc(raw)):
                        if out is None:
                            name = new_file(folder, stem, ".warc.gz")
                            fs, to = open_fs(name)
                            out, size, records = fs.open_output_stream(to, compression=None), 0, 0
                        # Two documents of one archive never share an identifier.
                        data = gzipped(to_warc(fields, body, record_id(path, nth)))
                        out.write(data)
                        size, records = size + len(data), records + 1
                        if size >= file_bytes:
                            out.close()
                            yield record_batch(MANIFEST, [name], [records])
                            out = None
                if out is not None:
                    out.close()
                    yield record_batch(MANIFEST, [name], [records])
    return run


def convert_files(archives: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Convert existing ARC files (``.arc`` or ``.arc.gz``, column ``path``) to WARC files in
    ``folder``, an archive a task, a document in memory at a time; returns the manifest,
    written as a table. Null paths are left out; a repeated path is converted once."""
    batches_of(archives.sparkSession)
    fs, at = open_fs(folder)
    fs.create_dir(at, recursive=True)
    paths = materialize(archives.select("path").filter("path IS NOT NULL").distinct(),
                        "arc_paths")
    return materialize(one_a_task(paths).mapInArrow(_convert_files(folder, file_bytes),
                                                    "path string, records long"),
                       "warc_manifest")


def one_a_task(files: DataFrame) -> DataFrame:
    """The files (column ``path``) over as many tasks as there are files, up to READ_TASKS. The
    number is stated, so that paths, being short, are not put together into one task."""
    return files.repartitionByRange(min(max(1, files.count()), READ_TASKS), "path")


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's files, with its payload checked."""
    batches_of(manifest.sparkSession)
    return one_a_task(manifest).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, target_uri string")


def round_trip(df: DataFrame, **kw) -> DataFrame:
    return read(write(df, scratch_path(df.sparkSession, "warc"), **kw))
