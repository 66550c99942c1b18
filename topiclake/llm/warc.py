"""WARC archives: write, normalise gzip, read back by offset.

``write_archives`` writes the pages of a partition as one archive that is a single gzip stream,
as many crawlers leave them.  ``normalise`` inflates each such file once, as a stream, and
writes every record as a gzip member of its own, beside an index of offsets.  ``read_records``
reads records by the index.

Files go through Arrow's file systems (file:, hdfs:, s3:, gs:), by names that Spark's own file system has completed, so that a
path without a scheme means the same to both.  A task writes
under a name of its own and reports the name in its rows; the rows are written to a table,
so only files of finished tasks are ever read, and a task that runs again leaves no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.llm.tables import counted_side, let_workers_import, written
from topiclake.plans.workspace import new_dir

#: pages of this many bytes or more may become revisits
LEAST_BYTES = 0
#: bytes of records in an archive, about
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
BLOCK = 1 << 20

_DATE = "2000-01-01T00:00:00Z"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _place(path: str, ending: str) -> tuple[fs.FileSystem, str, str]:
    """The file system, a new name below ``path`` in it, and the same name as a path for others."""
    name = f"{uuid.uuid4().hex}{ending}"
    system, folder = _file_system(path)
    system.create_dir(folder, recursive=True)
    return system, f"{folder}/{name}", f"{path}/{name}"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host that Spark takes for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().toString()
    return re.sub("^file:/(?!/)", "file:///", full)


def record(page: dict) -> bytes:
    """The WARC record of a page: a response with its payload, or a revisit without."""
    payload = (page["html"] or "").encode() if page["is_first"] else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['payload_bytes']}\r\n\r\n".encode()
    block = http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if page['is_first'] else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + str(page['page_id']))}>",
        f"WARC-Date: {_DATE}",
        # a field ends with its line; the URI is quoted so that any text survives
        f"WARC-Target-URI: {json.dumps(page['url'])}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(page['digest'])).decode()}",
        f"X-Page: {json.dumps(page['page_id'])}",
    ]
    if not page["is_first"]:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + str(page['first_id']))}>",
            f"X-Refers-To-Page: {json.dumps(page['first_id'])}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def _write(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = None
        names, counts, size = [], [], 0
        for batch in batches:
            for at in range(0, len(batch), 64):
                for page in batch.slice(at, 64).to_pylist():
                    if out is None:
                        system, name, shown = _place(folder, ".warc.gz")
                        out, packer, size = system.open_output_stream(name, compression=None), zlib.compressobj(LEVEL, wbits=31), 0
                        names.append(shown)
                        counts.append(0)
                    data = record(page)
                    out.write(packer.compress(data))
                    counts[-1] += 1
                    size += len(data)
                    if size >= limit:
                        out.write(packer.flush())
                        out.close()
                        out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64())})

    return run


def _records(system: fs.FileSystem, name: str) -> Iterator[bytes]:
    """The records of an archive, inflated as one stream that may hold one member or many."""
    with system.open_input_stream(name, compression=None) as file:
        inflate, held = zlib.decompressobj(wbits=31), bytearray()
        wanted, data = None, b""
        while True:
            data = data or file.read(BLOCK)
            if not data:
                break
            held += inflate.decompress(data)
            data = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                inflate = zlib.decompressobj(wbits=31)
            begin = 0
            while True:
                if wanted is None:
                    end = held.find(b"\r\n\r\n", begin)
                    if end < 0:
                        break
                    wanted = end + 4 - begin + int(_fields(bytes(held[begin:end]))["Content-Length"]) + 4
                if len(held) - begin < wanted:
                    break
                yield bytes(held[begin : begin + wanted])
                begin, wanted = begin + wanted, None
            del held[:begin]
        if held:
            raise ValueError(f"{name} ends inside a record")


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, source = _file_system(archive)
                target, name, shown = _place(folder, ".warc.gz")
                _, index_name, index_shown = _place(folder, ".idx")
                offset, count = 0, 0
                with target.open_output_stream(name, compression=None) as out, target.open_output_stream(index_name, compression=None) as index:
                    for data in _records(system, source):
                        packer = zlib.compressobj(LEVEL, wbits=31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        index.write(f"{offset} {len(member)}\n".encode())
                        offset += len(member)
                        count += 1
                yield pa.RecordBatch.from_pydict({"archive": [shown], "index": [index_shown], "records": pa.array([count], pa.int64())})

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, name = _file_system(row["archive"])
            index_system, index_name = _file_system(row["index"])
            rows: list[dict] = []
            held = 0
            with system.open_input_file(name) as file, index_system.open_input_stream(index_name, compression=None) as index:
                for line in _lines(index):
                    offset, size = map(int, line.split())
                    file.seek(offset)
                    rows.append(parsed(zlib.decompress(file.read(size), wbits=31), row["archive"], offset, size))
                    held += size
                    if held >= BLOCK:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def _lines(file) -> Iterator[str]:
    rest = b""
    while data := file.read(BLOCK):
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            yield line.decode()


_READ = pa.schema(
    [
        ("archive", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_READ_COLUMNS = "archive string, offset long, size long, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def parsed(data: bytes, archive: str, offset: int, size: int) -> dict:
    """A record's fields; the payload of a response is checked against its length and digest."""
    end = data.index(b"\r\n\r\n")
    fields = _fields(data[:end])
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    http = block.index(b"\r\n\r\n")
    payload, length = block[http + 4 :], int(_fields(block[:http])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{archive} at {offset}: the payload is not what was written")
    return {
        "archive": archive, "offset": offset, "size": size, "page_id": json.loads(fields["X-Page"]),
        "url": json.loads(fields["WARC-Target-URI"]), "record_type": fields["WARC-Type"], "payload_digest": digest,
        "payload_bytes": length, "refers_to": json.loads(fields["X-Refers-To-Page"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def with_first(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Add digest, payload_bytes, first_id (the smallest page_id with this payload) and is_first.

    A NULL html is an empty payload.  Rows with the smallest page_id are all responses, also
    when the same id is there twice; NULL ids come after all others, and if a payload has no
    other, all its rows are responses.  Only digests and ids are grouped, not payloads.
    """
    html = F.coalesce("html", F.lit(""))
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    page = page.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    # written, so that pages move only if payloads are many, and those of a frequent one are then split over tasks
    first = written(page.groupBy("digest").agg(F.min("page_id").alias("first_id")), "first-pages")
    known = page.join(counted_side(first), "digest")
    alone = (F.col("payload_bytes") < least_bytes) | F.col("page_id").eqNullSafe(F.col("first_id"))
    return known.withColumn("is_first", alone).select("page_id", "url", "html", "digest", "payload_bytes", "first_id", "is_first")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page; returns the table of archives (archive, records)."""
    let_workers_import(pages.sparkSession)
    # the payload of a revisit is not needed any more
    folder = qualified(pages.sparkSession, folder)
    page = with_first(pages, least_bytes).withColumn("html", F.when(F.col("is_first"), F.col("html")))
    return written(page.mapInArrow(_write(folder, limit), "archive string, records long"), "archives")


def _one_each(archives: DataFrame) -> DataFrame:
    """A task for each archive: the rows are tiny, what they stand for is not."""
    return archives.repartition(max(1, archives.count()))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """A gzip member for every record and an index beside: (archive, index, records)."""
    let_workers_import(archives.sparkSession)
    spread, folder = _one_each(archives.select("archive")), qualified(archives.sparkSession, folder)
    return written(spread.mapInArrow(_normalise(folder), "archive string, index string, records long"), "normalised")


def read_records(archives: DataFrame) -> DataFrame:
    """The records of normalised archives: archive, offset, size, page_id, url, record_type,
    payload_digest, payload_bytes, refers_to, payload (NULL for revisits)."""
    let_workers_import(archives.sparkSession)
    spread = _one_each(archives.select("archive", "index"))
    return spread.mapInArrow(_read, _READ_COLUMNS)


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html, any others), normalise, and read back.

    Payloads of any length are written whole.  Other columns are not looked at, whatever their names; an empty table gives no records.
    """
    spark = pages.sparkSession
    raw = write_archives(pages, new_dir(spark, "warc-raw"), least_bytes)
    return read_records(normalise(raw, new_dir(spark, "warc")))
