"""WARC archives of pages: writing, normalising whole-file gzip, reading by offset.

``write_archives`` writes one gzip stream per file.  ``normalise`` inflates
each such stream once, from front to back, writes every record as a gzip member
of its own, and leaves a sidecar index ``<archive>.idx`` with offset, length,
type and record id per record.  ``read_records`` fetches records by that index,
any number of tasks to a file.

Files are written through ``pyarrow.fs`` below a folder that all executors
share (local mounts, ``hdfs://``, ``s3://``).  Every attempt of a task writes
names of its own, and only names that the finished step lists are read, so a
lost or repeated task leaves no trace in the result.  A task holds one record
at a time, besides the Arrow batch it came in.

Records with equal payloads of at least ``min_bytes`` are written once: the one
with the largest page id is the response, the others are revisits that refer to
it.  Payload groups are found by SHA-256 with map-side partial counts, and a
page joins its group by a salted key, so a payload that a third of all pages
share is spread.

Defined results: a null html is an empty payload.  A null page id loses to any
id; payloads of null ids only are all responses.  Rows that share the largest
id are all responses.  A null url leaves the target header out; line breaks in
a url become ``%0A`` and ``%0D``.  An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import salted_join
from lakemart.sources.paths import scratch_path

MIN_BYTES = 1000
#: Inflated bytes after which a writer starts its next file.
FILE_BYTES = 256 << 20
LEVEL = 6
_CHUNK = 1 << 20
_ID = "urn:x-page:"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_GZIP = 31  # zlib window bits of a gzip stream


def file_system(path: str):
    """File system and path below it for a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


# Records


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_ID}{refers_to}>"),
            ("X-Payload-Length", str(len(payload))),
        ]
    return _record(headers, _HTTP % len(payload) + (b"" if revisit else payload))


def split_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream that arrives in chunks."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        while (end := _record_end(buffer)) is not None:
            yield bytes(buffer[:end])
            del buffer[:end]
    if buffer.strip():
        raise ValueError("the stream ends inside a record")


def _record_end(buffer: bytearray) -> int | None:
    head = buffer.find(b"\r\n\r\n")
    if head < 0:
        return None
    for line in bytes(buffer[:head]).split(b"\r\n"):
        if line[:15].lower() == b"content-length:":
            end = head + 4 + int(line[15:]) + 4
            return end if end <= len(buffer) else None
    raise ValueError("a record has no length")


def inflated(stream) -> Iterator[bytes]:
    """Content of a gzip file of one or more members, read once from front to back."""
    inflate = zlib.decompressobj(_GZIP)
    while data := stream.read(_CHUNK):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof and data:
                inflate = zlib.decompressobj(_GZIP)
    if not inflate.eof:
        raise ValueError("the gzip stream is cut off")


# Steps


def _write(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = file_system(folder)
        part, stream, pack, size, path = TaskContext.get().partitionId(), None, None, 0, ""

        def close() -> pa.RecordBatch:
            stream.write(pack.flush())
            stream.close()
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(n) for n in ("page_id", "url", "html", "refers_to", "revisit")), strict=True):
                if stream is None:
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                    path, size = f"{folder}/{name}", 0
                    stream, pack = files.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                    info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{name}>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    stream.write(pack.compress(info))
                record = page_record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), refers_to.as_py(), revisit.as_py())
                stream.write(pack.compress(record))
                size += len(record)
                if size >= file_bytes:
                    yield close()
                    stream = None
        if stream is not None:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes whole-file gzip archives; a stored table of their paths."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), html.cast("binary").alias("html"),
        F.sha2(html, 256).alias("payload"), F.octet_length(html).alias("size"),
    )
    groups = (
        rows.filter(F.col("size") >= min_bytes)
        .groupBy("payload")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    joined = salted_join(rows, groups, "payload", F.xxhash64("page_id", "url"), "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    chosen = joined.select("page_id", "url", "html", "refers_to", revisit.alias("revisit"))
    _make_folder(folder)
    return _stored(chosen.mapInArrow(_write(folder, file_bytes, level), "path string"), "archives")


def _normalise(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = file_system(folder)
        for batch in batches:
            for source in batch.column("path").to_pylist():
                files, path = file_system(source)
                name = f"{source.rpartition('/')[2].removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                offset = 0
                with (
                    files.open_input_stream(path, compression=None) as stream,
                    target.open_output_stream(f"{root}/{name}", compression=None) as out,
                    target.open_output_stream(f"{root}/{name}.idx", compression=None) as index,
                ):
                    for record in records(inflated(stream)):
                        headers, _ = split_record(record)
                        pack = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        index.write(f"{offset}\t{len(member)}\t{headers.get('warc-type', '')}\t{headers.get('warc-record-id', '')}\n".encode())
                        offset += len(member)
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([f"{folder}/{name}.idx"])], names=["path", "index"])

    return run


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """One member per record, with sidecar indexes; a stored table of ``path, index``.

    A gzip stream can only be inflated from its start, so a file is one task.
    """
    spark = archives.sparkSession
    _make_folder(folder)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return _stored(archives.repartition(tasks, "path").mapInArrow(_normalise(folder, level), "path string, index string"), "normalised")


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist(), strict=True):
            files, name = file_system(index)
            with files.open_input_stream(name, compression=None) as stream:
                rest = b""
                while data := stream.read(_CHUNK):
                    *lines, rest = (rest + data).split(b"\n")
                    columns = list(zip(*(line.decode().split("\t") for line in lines), strict=True))
                    if columns:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(lines)), *[pa.array(list(map(int, c)), pa.int64()) for c in columns[:2]], pa.array(columns[2]), pa.array(columns[3])],
                            names=["path", "offset", "length", "type", "record_id"],
                        )


def read_index(archives: DataFrame) -> DataFrame:
    """``path, offset, length, type, record_id`` per record, from the sidecars."""
    return archives.mapInArrow(_index_rows, "path string, offset long, length long, type string, record_id string")


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened, source = None, None
    try:
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("path", "offset", "length")}
            out: list[tuple] = []
            for path, offset, length in zip(columns["path"], columns["offset"], columns["length"], strict=True):
                if path != opened:
                    if source is not None:
                        source.close()
                    files, name = file_system(path)
                    opened, source = path, files.open_input_file(name)
                source.seek(offset)
                out.append(_page(zlib.decompress(source.read(length), _GZIP)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PAGE_TYPES, strict=True)], names=_PAGE_NAMES)
    finally:
        if source is not None:
            source.close()


_PAGE_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
_PAGE_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def _number(record_id: str | None) -> int | None:
    digits = (record_id or "").strip("<>").removeprefix(_ID)
    return int(digits) if digits else None


def _digest(value: str) -> str:
    """Bare lower-case hex of a SHA-1 header, which may also be base32."""
    text = value.partition(":")[2]
    return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()


def _page(record: bytes) -> tuple:
    headers, block = split_record(record)
    said = _digest(headers["warc-payload-digest"])
    if headers["warc-type"] == "revisit":
        size = int(headers["x-payload-length"])
    else:
        payload = block.partition(b"\r\n\r\n")[2]
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != said:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    return _number(headers["warc-record-id"]), size, said, headers["warc-type"], _number(headers.get("warc-refers-to"))


def read_records(archives: DataFrame, run: int = 2_000) -> DataFrame:
    """One row per page record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    The index deals runs of ``run`` neighbouring records of a file to tasks.
    """
    index = read_index(archives).filter("type IN ('response', 'revisit')")
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = index.select("path", "offset", "length", F.floor(F.col("offset") / (run * 4096)).alias("run"))
    dealt = placed.repartition(tasks, "path", "run").sortWithinPartitions("path", "offset").select("path", "offset", "length")
    return dealt.mapInArrow(_fetch, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _make_folder(folder: str) -> None:
    files, path = file_system(folder)
    files.create_dir(path, recursive=True)


def archive_report(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the archives, normalises them and reads every record back by its index."""
    spark: SparkSession = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    archives = write_archives(pages, f"{folder}/whole")
    return read_records(normalise(archives, f"{folder}/members"))


QUERY_SQL = """
  WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
  g AS (SELECT b, max(page_id) AS best FROM p WHERE octet_length(b) >= 1000 GROUP BY b HAVING count(*) > 1)
  SELECT page_id, octet_length(p.b)::BIGINT AS payload_bytes, sha1(p.b) AS payload_digest,
    CASE WHEN best IS NOT NULL AND page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to
  FROM p LEFT JOIN g ON p.b = g.b
"""
