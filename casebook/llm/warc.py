"""WARC records in ZIP packages: writer, and a reader that never unpacks.

A package (WACZ layout) is a ZIP with stored, i.e. uncompressed, members:
``archive/data.warc.gz`` (every record a gzip member of its own) and
``indexes/index.cdxj`` (a sorted line per record with offset and length).

Writing: each task streams its rows into packages of at most ARCHIVE_BYTES
and ARCHIVE_RECORDS in the given shared folder, under names that no other
attempt uses; the written table of packages is the manifest, so files of lost
attempts are never read.

Reading: per package the end record, the ZIP64 locator and end record and the
central directory are read by range, then the index member; a package without
index is walked record by record. The locations are dealt out by package and
stretch of READ_BYTES, so one large package feeds many tasks, and each task
reads its neighbouring records in one range.

Of records with equal payloads of at least REVISIT_BYTES the one with the
largest page_id is a response, the others are revisits that refer to it (rows
that share the largest page_id are all responses). A null payload is empty; a
null page_id is written and read as an empty id and is always a response; a
null url leaves the target out. Control characters in urls are percent-coded.
"""

from __future__ import annotations

import base64
import json
import struct
import zipfile
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import stage

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
ARCHIVE_RECORDS = 100_000
READ_BYTES = 8 << 20
READ_TASKS = 50_000                 # beyond, a task reads several stretches
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """Arrow file system and path of a folder or file that all executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------- writing

def record_bytes(page_id, url, payload: bytes, sha1_hex: str, refers) -> bytes:
    """One WARC record, as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers is not None else 'response'}",
            f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        head += [f"WARC-Refers-To: <{ID}{refers}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + z.flush()


def sort_key(url) -> str:
    """Index key without blanks: host parts reversed, then the path."""
    try:
        u = urlsplit(url or "")
        key = ",".join(reversed((u.hostname or "").split("."))) + ")" + (u.path or "/") + ("?" + u.query if u.query else "")
    except ValueError:
        key = url
    return quote(key, safe="!#$%&'()*+,/:;=?@[]~")


class _Package:
    """A package being written; the index follows the records."""

    def __init__(self, folder: str, name: str):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{folder.rstrip('/')}/{name}"
        self.out = self.fs.open_output_stream(f"{base.rstrip('/')}/{name}")
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page_id, url, payload, sha1_hex, refers):
        data = record_bytes(page_id, url, payload, sha1_hex, refers)
        self.member.write(data)
        entry = {"offset": self.at, "length": len(data), "digest": f"sha1:{sha1_hex}", "url": url, "mime": "text/html",
                 "status": 200, "filename": "data.warc.gz"}
        self.index.append(f"{sort_key(url)} {''.join(c for c in DATE if c.isdigit())} {json.dumps(entry)}\n")
        self.at += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.index.sort()
        self.zip.writestr("indexes/index.cdxj", "".join(self.index))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, len(self.index)


class _Forward:
    """What the zip writer needs of a stream that cannot seek."""

    def __init__(self, out):
        self.out = out

    def write(self, data):
        self.out.write(data)
        return len(data)

    def tell(self):
        return self.out.tell()

    def flush(self):
        pass


def _write(folder: str):
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        package, done = None, []
        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")]
            for row in zip(*cols):
                if package is None:
                    package = _Package(folder, f"{name}-{len(done):04d}.wacz")
                package.add(*(x.as_py() for x in row))
                if package.at >= ARCHIVE_BYTES or len(package.index) >= ARCHIVE_RECORDS:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], ["path", "bytes", "n_records"])
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the manifest (path, bytes, n_records)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    big = rows.where(F.col("size") >= REVISIT_BYTES).select("page_id", "sha1", "size")
    shared = big.groupBy("sha1", "size").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.where("n > 1").select("sha1", "size", "target"), "warc_shared")
    rows = rows.join(shared, ["sha1", "size"], "left")
    rows = rows.withColumn("refers_to", F.when(F.col("page_id") < F.col("target"), F.col("target")))
    rows = rows.select("page_id", "url", "payload", "sha1", "refers_to")
    return stage(rows.mapInArrow(_write(folder), "path string, bytes long, n_records long"), "warc_manifest")


# ---------------------------------------------------------------- reading

def central_directory(read, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, stored bytes, local header offset) of every member; ``read(offset, n)`` reads a range."""
    tail_at = max(0, size - 65_557)                  # longest comment and the end record
    tail = read(tail_at, size - tail_at)
    k = tail.rfind(b"PK\x05\x06")
    if k < 0:
        raise ValueError("no ZIP end record")
    entries, length, start = struct.unpack("<HII", tail[k + 10:k + 20])
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        at = tail_at + k - 20
        sign, _, end64 = struct.unpack("<4sIQ", read(at, 16))
        if sign != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = read(end64, 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack("<QQQ", end[32:56])
    data, out, i = read(start, length), [], 0
    for _ in range(entries):
        if data[i:i + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", data[i + 10:i + 12])
        packed, plain, n, extra, comment = struct.unpack("<IIHHH", data[i + 20:i + 34])
        offset, = struct.unpack("<I", data[i + 42:i + 46])
        name = data[i + 46:i + 46 + n].decode("utf-8", "replace")
        field, stop = i + 46 + n, i + 46 + n + extra
        while field + 4 <= stop:                     # sizes that did not fit are in the ZIP64 field, in this order
            tag, many = struct.unpack("<HH", data[field:field + 4])
            if tag == 1:
                values = iter(struct.unpack(f"<{many // 8}Q", data[field + 4:field + 4 + many // 8 * 8]))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            field += 4 + many
        out.append((name, method, packed, offset))
        i += 46 + n + extra + comment
    return out


def member_start(read, header: int) -> int:
    """First byte of a member's data, after its local header."""
    head = read(header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    name, extra = struct.unpack("<HH", head[26:30])
    return header + 30 + name + extra


def _walk(read, start: int, size: int):
    """Offsets and lengths of the gzip members in a stretch without index."""
    z, begin, at = zlib.decompressobj(31), start, start
    while at < start + size:
        data = read(at, min(READ_BYTES, start + size - at))
        at += len(data)
        while data:
            z.decompress(data)
            if not z.eof:
                break
            data = z.unused_data
            end = at - len(data)
            yield begin, end - begin
            z, begin = zlib.decompressobj(31), end


def locate(read, size: int) -> list[tuple[int, int]]:
    """(offset in the package, length) of every record."""
    members = central_directory(read, size)
    archives = {n.rsplit("/", 1)[-1]: (m, s, h) for n, m, s, h in members if n.startswith("archive/") and n.endswith(".warc.gz")}
    indexed, out = set(), []
    for name, method, packed, header in members:
        if not (name.startswith("indexes/") and name.endswith(".cdxj")):
            continue
        if method:
            raise ValueError(f"{name} is not stored")
        for line in read(member_start(read, header), packed).decode().splitlines():
            e = json.loads(line.split(" ", 2)[2])
            indexed.add(e["filename"])
            out.append((e["filename"], int(e["offset"]), int(e["length"])))
    starts = {}
    for name, (method, _, header) in archives.items():
        if method:
            raise ValueError(f"{name} is not stored")
        starts[name] = member_start(read, header)
    found = [(starts[n] + o, length) for n, o, length in out]
    for name, (_, packed, _) in archives.items():
        if name not in indexed:
            found += _walk(read, starts[name], packed)
    return found


def _locations(batches):
    for b in batches:
        for path, size in zip(b.column("path").to_pylist(), b.column("bytes").to_pylist()):
            fs, base = filesystem(path)
            with fs.open_input_file(base) as f:
                found = sorted(locate(lambda o, n: f.read_at(n, o), size if size is not None else f.size()))
            for k in range(0, len(found), 10_000):
                part = found[k:k + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(part)), pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int64())],
                    ["path", "offset", "length"])


def parse_record(member: bytes) -> dict:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = dict(x.lower().split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:] if ": " in x)
    return {"fields": fields, "payload": payload, "payload_bytes": int(inner.get("content-length", len(payload)))}


def _read_records(batches):
    import hashlib

    def number(value):
        text = (value or "").removeprefix(f"<{ID}").removesuffix(">")
        return int(text) if text.lstrip("-").isdigit() else None
    handle = (None, None)
    for b in batches:
        rows = list(zip(b.column("path").to_pylist(), b.column("offset").to_pylist(), b.column("length").to_pylist()))
        i = 0
        while i < len(rows):
            path, start, _ = rows[i]
            j = i
            while j < len(rows) and rows[j][0] == path and rows[j][1] + rows[j][2] - start <= max(READ_BYTES, rows[i][2]):
                j += 1
            if handle[0] != path:
                if handle[1] is not None:
                    handle[1].close()
                fs, base = filesystem(path)
                handle = (path, fs.open_input_file(base))
            data = handle[1].read_at(rows[j - 1][1] + rows[j - 1][2] - start, start)
            out = []
            for _, o, n in rows[i:j]:
                r = parse_record(data[o - start:o - start + n])
                f = r["fields"]
                kind = f.get("WARC-Type")
                if kind not in ("response", "revisit"):
                    continue
                given = base64.b32decode(f["WARC-Payload-Digest"].split(":", 1)[1]).hex()
                whole = kind == "response"
                if whole and (hashlib.sha1(r["payload"]).hexdigest() != given or len(r["payload"]) != r["payload_bytes"]):
                    raise ValueError(f"damaged record at {o} of {path}")
                out.append((number(f.get("WARC-Record-ID")), f.get("WARC-Target-URI"), kind, number(f.get("WARC-Refers-To")),
                            r["payload_bytes"], given, r["payload"] if whole else None))
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(types)],
                ["page_id", "target_uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
            i = j
    if handle[1] is not None:
        handle[1].close()


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of the packages in ``archives`` (path, bytes; null bytes: asked from the file system).

    A row per response or revisit: page_id, target_uri, record_type, refers_to,
    payload_bytes and payload_digest of the full payload, payload (null for revisits).
    """
    where = stage(archives.select("path", "bytes").repartition("path").mapInArrow(
        _locations, "path string, offset long, length long"), "warc_locations")
    # an explicit number: the locations are few bytes, their records are not
    tasks = -(-(where.agg(F.sum("length")).first()[0] or 1) // READ_BYTES)
    spread = where.repartition(min(tasks, READ_TASKS), F.col("path"), F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("path", "offset")
    return spread.mapInArrow(_read_records, "page_id long, target_uri string, record_type string, refers_to long, "
                                            "payload_bytes long, payload_digest string, payload binary")
