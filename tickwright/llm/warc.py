"""WARC archives: a record per page, each a gzip member of its own, and a sequential reader.

A page whose payload another page of a smaller id has too is a revisit record without the
payload. Archives are read front to back: zlib inflates one member after the other in small
steps, Content-Length frames the block, and block and payload digests are verified.
"""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.llm.common import documents, scratch, written

#: Archives are closed beyond this many bytes; a reader holds one of them at a time.
ARCHIVE_BYTES = 8 << 20
STEP = 1 << 16

# fixed values: the format's own names
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


class BadRecord(ValueError):
    """An archive that is cut off, framed wrongly, or whose bytes do not match their digest."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + page)}>"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *fields]
    lines += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in lines)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def _line(text: str) -> str:
    """A value that stays on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _escaped(text: str) -> str:
    """A value on one line without blanks, from which ``unquote`` gives the text back."""
    return re.sub(r"[\s%\x00-\x1f\x7f]", lambda m: quote(m[0], safe=""), text)


def page_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """The gzip member of a page: a revisit if it refers to another page."""
    sha = digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [("WARC-Record-ID", _record_id(str(page))), ("WARC-Payload-Digest", f"sha1:{sha}")]
    fields += [("Content-Type", "application/http;msgtype=response")]
    fields += [("WARC-Target-URI", _line(url))] if url is not None else []
    fields += [("Page-ID", _escaped(page))] if page is not None else []
    if refers_to is None:
        return _record("response", fields, http + payload)
    fields += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", _record_id(refers_to)),
        ("Refers-To-Page-ID", _escaped(refers_to)),
    ]
    return _record("revisit", fields, http)


def _opening() -> bytes:
    fields = [("WARC-Record-ID", _record_id("info")), ("Content-Type", "application/warc-fields")]
    return _record("warcinfo", fields, b"format: WARC File Format 1.1\r\n")


# reading


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, inflated one after the other."""
    at = 0
    while at < len(data):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(data):
                raise BadRecord("the archive ends inside a record")
            step = data[at : at + STEP]
            try:
                parts.append(unpacker.decompress(step))
            except zlib.error as error:
                raise BadRecord(f"no gzip member at byte {at}: {error}") from error
            at += len(step) - len(unpacker.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n") if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, framed and verified."""
    for member in members(data):
        head, blank, rest = member.partition(b"\r\n\r\n")
        version, _, lines = head.partition(b"\r\n")
        if not blank or version != VERSION:
            raise BadRecord("a member does not begin with a record's header")
        fields = _fields(lines)
        length = int(fields.get("content-length", -1))
        block, end = rest[:length], rest[length:]
        if length < 0 or len(block) != length or end != b"\r\n\r\n":
            raise BadRecord("Content-Length does not frame the block")
        if fields.get("warc-block-digest", "") != f"sha1:{digest(block)}":
            raise BadRecord("the block does not match its digest")
        yield fields, block


def page_of(fields: dict[str, str], block: bytes) -> tuple | None:
    """(page_id, url, payload bytes, digest, type, refers_to, payload) of a page's record."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank:
        raise BadRecord("no end of the HTTP header")
    length = int(_fields(http.partition(b"\r\n")[2])["content-length"])
    sha = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != sha):
        raise BadRecord("the payload does not match its length or digest")
    body = payload.decode() if kind == "response" else None
    page, refers = (None if x is None else unquote(x) for x in map(fields.get, ("page-id", "refers-to-page-id")))
    return page, fields.get("warc-target-uri"), length, sha, kind, refers, body


# tables to archives and back


def _file_system(folder: str):
    """The store of a folder, as executors reach it, and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def _written_to(folder: str, archive_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _file_system(folder)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        open_file, size, count, number, done = None, 0, 0, 0, []

        def close():
            # an archive appears whole under its name; those of another attempt have other names
            open_file.close()
            name = f"{path}/part-{part:05d}-{attempt:012d}-{number:05d}.warc.gz"
            store.move(f"{path}/_{attempt}-{number}", name)
            done.append((name, count, size))

        for batch in batches:
            for page, url, html, refers in batch.itertuples(index=False):
                if open_file is None:
                    open_file = store.open_output_stream(f"{path}/_{attempt}-{number}")
                    open_file.write(opening := _opening())
                    size, count = len(opening), 0
                member = page_record(page, url, (html or "").encode(), refers)
                open_file.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    close()
                    open_file, number = None, number + 1
        if open_file is not None:
            close()
        yield pd.DataFrame(done, columns=["archive", "pages", "bytes"])

    return write


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row (page_id, url, html) into ``folder``; (archive, pages, bytes).

    NULL html is an empty payload. Of equal payloads of at least ``min_bytes`` the row with the
    smallest page_id is a response and the others revisit it; rows that share the smallest id
    are all responses, as are those of a payload that only NULL ids have. A lost attempt of a task
    may leave archives behind; those that count are the ones in the result.
    """
    rows = documents(pages, "page_id", "url", "html")
    html = F.coalesce("html", F.lit(""))
    rows = rows.withColumns({"sha": F.sha2(html, 256), "size": F.octet_length(html)})
    # written, so that the join below is one of two plain shuffles and can split a hot payload
    same = ["sha", "size"]
    first = written(rows.groupBy(*same).agg(F.min("page_id").alias("first")), "first-pages")
    revisits = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    linked = rows.join(first, same).select(
        F.col("page_id").cast("string").alias("page"),
        "url",
        "html",
        F.when(revisits, F.col("first")).cast("string").alias("refers"),
    )
    store, path = _file_system(folder)
    store.create_dir(path)
    spec = "archive string, pages long, bytes long"
    return written(linked.mapInPandas(_written_to(folder, archive_bytes), spec), "archives")


def read_archives(
    spark: SparkSession, folder: str, *, payload: bool = False, written_by: DataFrame | None = None
) -> DataFrame:
    """A row per page record: page_id, target_uri, payload_bytes, payload_digest, record_type,
    refers_to (and payload). A damaged archive is an error.

    ``written_by`` is what ``write_archives`` returned: archives of the attempts named there are read
    and no others. There is one attempt per task, which is what is sent to the readers.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page", "url", "size", "sha", "kind", "refers", "payload"]
        for batch in batches:
            for data in batch["content"]:
                rows, held = [], 0
                for fields, block in records(data):
                    row = page_of(fields, block)
                    if row:
                        rows.append(row if payload else (*row[:-1], None))
                        held += len(block)
                    if held >= ARCHIVE_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    if written_by is not None:
        attempt = lambda path: F.regexp_extract(path, r"(part-[0-9]+-[0-9]+)-[0-9]+\.warc\.gz$", 1)
        counting = written_by.select(attempt("archive").alias("attempt")).distinct()
        files = files.withColumn("attempt", attempt("path")).join(F.broadcast(counting), "attempt", "left_semi")
    spec = "page string, url string, size long, sha string, kind string, refers string, payload string"
    found = files.select("content").mapInPandas(read, spec)
    return found.select(
        F.col("page").alias("page_id"),
        F.col("url").alias("target_uri"),
        F.col("size").alias("payload_bytes"),
        F.col("sha").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
        *["payload"] * payload,
    )


def round_trip(pages: DataFrame, *, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """What the archives of ``pages`` say: one row per row, ids in the type they came in.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri. An
    empty table gives no rows; other columns are left behind.
    """
    spark = pages.sparkSession
    kind = documents(pages, "page_id").schema["page_id"].dataType
    folder = scratch(spark, "warc")
    listed = write_archives(pages, folder, min_bytes=min_bytes, archive_bytes=archive_bytes)
    return read_archives(spark, folder, written_by=listed).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "target_uri",
    )
