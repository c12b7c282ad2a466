"""WARC records in ZIP packages: writing, and reading by range (operator 8).

A package is a ZIP file with stored members: ``archive/data.warc.gz`` (a gzip member per
record) and ``indexes/index.cdx`` (a line per record with its offset and length). Tasks
write packages of bounded size to the shared folder through a file system API, and name
them in a manifest table that holds what succeeded tasks wrote, so that a repeated task
leaves at most an unread file. Reading goes from the manifest to the central directory
(or its ZIP64 form), the index, and one range read per record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revwatch.llm import zipio
from revwatch.llm.common import importable, written
from revwatch.session import shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of a package's records, compressed, before the next is begun.
PACKAGE_BYTES = 32 << 20
#: Smaller payloads are always written in full.
MIN_PAYLOAD = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"
_NO_ID = "urn:x-no-page"
#: Packages a reading task takes, where there are more than the session's shuffle partitions.
PACKAGES_PER_TASK = 4


def file_at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _uri(page_id: str | None) -> str:
    return f"<{_ID}{quote(page_id, safe='')}>" if page_id is not None else f"<{_NO_ID}>"


def _page_id(uri: str) -> str | None:
    name = uri.strip("<>")
    return None if name == _NO_ID else unquote(name.removeprefix(_ID))


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit holds the response's head alone."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": _uri(page_id),
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{digest}",
        **({"WARC-Profile": PROFILE, "WARC-Refers-To": _uri(refers_to)} if refers_to is not None else {}),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of a WARC record with an HTTP response."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class Package:
    """A package being written; its size is bounded by the caller."""

    def __init__(self, uri: str):
        system, path = file_at(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.size, self.lines = uri, 0, []
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, data: bytes, page_id: str | None, digest: str) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        line = {"offset": self.size, "length": len(packed), "digest": f"sha256:{digest}"}
        self.lines.append(f"{_uri(page_id)} {json.dumps(line)}\n")
        self.data.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines)


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller page_id has too."""
    keys = pages.select("page_id", F.octet_length("html").alias("n"), F.sha2("html", 256).alias("digest"))
    long = keys.where(F.col("n") >= MIN_PAYLOAD)
    first = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("pages"))
    repeated = first.where("pages > 1 and refers_to is not null").drop("pages")
    return (
        long.join(repeated, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write_packages(
    pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the manifest.

    Null html is an empty payload. Of equal payloads of at least 100 bytes that of the least
    page_id is a response and the others revisit it; rows that repeat the least page_id
    are responses too, and rows without page_id only ever revisit. Other columns are ignored.
    """
    wanted = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    again = revisits(wanted).withColumnsRenamed({"page_id": "r_page", "digest": "r_digest"})
    marked = wanted.withColumn("digest", F.sha2("html", 256))
    rows = marked.join(
        again, (F.col("digest") == F.col("r_digest")) & F.col("page_id").eqNullSafe(F.col("r_page")), "left"
    ).select(
        F.col("page_id").cast("string"), "url", "html", "digest", F.col("refers_to").cast("string")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, text, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package is None:
                    package = Package(f"{folder}/{uuid.uuid4().hex}.wacz")
                data = record(page_id, url, text.encode("utf-8"), digest, refers_to, date)
                package.add(data, page_id, digest)
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        uris, counts = zip(*done, strict=True) if done else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(uris, pa.string()), pa.array(counts, pa.int64())], names=["package", "records"]
        )

    return written(rows.mapInArrow(write, "package string, records long"), "packages")


def _reader(handle: pa.NativeFile) -> zipio.Read:
    return lambda offset, size: handle.read_at(size, offset)


def locate(package: str) -> Iterator[tuple[int, int]]:
    """(offset, length) in the package of each record, from the directory and the index."""
    system, path = file_at(package)
    with system.open_input_file(path) as handle:
        read = _reader(handle)
        found = {m.name: m for m in zipio.members(read, handle.size())}
        if not (found[DATA].stored and found[INDEX].stored):
            raise ValueError(f"{package}: records can be read by range from stored members only")
        base = zipio.data_offset(read, found[DATA])
        index = read(zipio.data_offset(read, found[INDEX]), found[INDEX].size)
    for line in io.StringIO(index.decode("utf-8")):
        entry = json.loads(line.partition(" ")[2])
        yield base + entry["offset"], entry["length"]


def read_packages(manifest: DataFrame) -> DataFrame:
    """A row per record of the packages named in ``manifest``; revisits have no payload of their own."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column("package").to_pylist():
                found = list(locate(package))
                offsets, lengths = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([package] * len(found), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["package", "offset", "length"],
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, opened = None, None
        for batch in batches:
            rows = []
            for package, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package != opened:
                    if handle is not None:
                        handle.close()
                    system, path = file_at(package)
                    handle, opened = system.open_input_file(path), package
                data = zlib.decompress(handle.read_at(length, offset), 31)
                headers, payload = parse_record(data)
                refers_to = headers.get("warc-refers-to")
                claimed = headers["warc-payload-digest"].partition(":")[2]
                if refers_to is None and hashlib.sha256(payload).hexdigest() != claimed:
                    raise ValueError(f"{package}: the record at {offset} does not have the digest it claims")
                rows.append(
                    (
                        _page_id(headers["warc-record-id"]), headers["warc-type"], claimed,
                        None if refers_to else len(payload), refers_to and _page_id(refers_to),
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to"],
            )
        if handle is not None:
            handle.close()

    located = manifest.select("package").mapInArrow(places, "package string, offset long, length long")
    return located.mapInArrow(
        fetch, "page_id string, record_type string, payload_digest string, payload_bytes long, refers_to string"
    )


def dealt(manifest: DataFrame) -> DataFrame:
    """The packages, the units of reading, dealt to as many tasks as they can use.

    The number is stated, as a manifest is so small that Spark would gather it in one task.
    """
    packages = manifest.count()
    shuffled = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(packages, shuffled), -(-packages // PACKAGES_PER_TASK), 1)
    return manifest.repartition(tasks, "package")


def archived(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to packages and reads them back; one row per row of ``pages``.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to; a revisit's
    size is that of the response it refers to. An empty table writes nothing.
    """
    spark = importable(pages.sparkSession)
    kind = pages.schema["page_id"].dataType
    folder = shared_folder(spark, "warc")
    if "://" not in folder and folder.startswith("file:"):
        folder = folder.replace("file:", "file://", 1)
    manifest = write_packages(pages, folder)
    rows = written(read_packages(dealt(manifest)), "records")
    sizes = (
        rows.where("record_type = 'response' and page_id is not null")
        .groupBy("page_id", "payload_digest")
        .agg(F.max("payload_bytes").alias("full"))
        .withColumnRenamed("page_id", "refers_to")
    )
    sized = rows.join(sizes, ["refers_to", "payload_digest"], "left")
    return sized.select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.coalesce("payload_bytes", "full").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
