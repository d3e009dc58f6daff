"""WARC archives and the chunked record table.

Writing: every page becomes one record, ``response`` with the payload or ``revisit`` of the
response with an equal payload. Payloads are cut into (record, chunk number) rows by DataFrame
functions and written once as that table; equal ones are found by digest. The writer streams those rows into gzip members (one per record, as the format
asks) of archive files in the shared scratch folder. A file counts only if the manifest row
that its task returned is in the committed manifest, so files of lost or repeated attempts
are ignored.

Reading: ``read_chunks`` streams each archive member through a bounded buffer and yields the
chunked record table: one row per record and chunk number with the SHA-256 of the payload up
to and including the chunk. No step holds a whole archive or, when reading, a whole record.
The length and digest of the header are checked against the stream.

Defined results: null or empty html is an empty payload; a null url is an absent header,
characters outside ASCII are percent-encoded in it; a
null page_id is read back as null and never is the smallest, so a group of equal payloads
without any page_id has responses only; rows that repeat the smallest page_id of their
payload are all responses; payloads under ``min_revisit`` bytes are all responses; an empty
table gives an empty manifest and no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import bucketed, materialise, partitions_for, pick
from segrec.session import scratch_path

CHUNK = 1 << 18
GROUP = 256  # records whose rows are handed the list of first pages together
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_TABLE = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int64()), ("page_id", pa.int64()),
                    ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                    ("is_last", pa.bool_())])
TABLE_DDL = ("record_id string, chunk_no long, page_id long, target_uri string, record_type string, "
             "refers_to long, payload_bytes long, payload_digest string, payload binary, is_last boolean")


def file_system(uri: str):
    """(file system, path) for a folder or file that driver and executors share."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {url} {digest}')}>"


def record_pieces(pages: DataFrame) -> DataFrame:
    """The chunked record table of pages, written: chunk, nth (which record), chunk_no, page_id, url, n, digest, piece.

    A payload is cut before its rows are made, so no row but the page's own ever holds it whole. The
    table is bucketed by ``chunk``, ``GROUP`` records of one scan task, and read by it without a shuffle."""
    p = pick(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    total = p.agg(F.sum(F.octet_length("payload"))).first()[0]
    p = p.withColumns({"record": F.monotonically_increasing_id(), "n": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    last = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("int") - 1
    pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
        k.alias("chunk_no"), F.substring("payload", k * CHUNK + 1, F.lit(CHUNK)).alias("piece")))
    rows = p.select("record", "page_id", "url", "n", "digest", F.explode(pieces).alias("c"))
    rows = rows.select(F.floor(F.col("record") / GROUP).alias("chunk"), (F.col("record") % GROUP).cast("int").alias("nth"),
                       "c.chunk_no", "page_id", "url", "n", "digest", "c.piece")
    # with fewer buckets than shuffle partitions Spark would shuffle the pieces for more parallelism
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(rows, "records", "chunk", partitions_for(total, least=least))


def plan_records(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """The pieces to write, those of a record one after the other, with the first page (id and url) of an
    equal payload for revisits, which have one row without a piece.

    Equal payloads are found by their digests alone; what was found returns as one list for every group of
    records, so no payload is shuffled."""
    pieces = record_pieces(pages)
    records = pieces.where("chunk_no = 0").select("chunk", "nth", "page_id", "url", "n", "digest")
    first = (records.where((F.col("n") >= min_revisit) & F.col("page_id").isNotNull()).groupBy("digest")
             .agg(F.min(F.struct("page_id", "url")).alias("first")))
    found = F.when(F.col("first.page_id") < F.coalesce("page_id", F.lit(2**63 - 1)), F.col("first")).alias("first")
    lists = (records.join(first, "digest", "left").select("chunk", "nth", found).groupBy("chunk")
             .agg(F.sort_array(F.collect_list(F.struct("nth", "first"))).alias("firsts")))  # GROUP entries at most
    planned = pieces.join(lists, "chunk").withColumn("first", F.get("firsts", F.col("nth"))["first"]).where("first is null or chunk_no = 0")
    return planned.select("chunk", "nth", "chunk_no", "page_id", "url", "n", "digest", F.col("first.page_id").alias("first_id"),
                          F.col("first.url").alias("first_url"), F.when(F.col("first").isNull(), F.col("piece")).alias("piece")
                          ).sortWithinPartitions("chunk", "nth", "chunk_no")


def _head(row: dict) -> bytes:
    """WARC and HTTP header of a record; the payload follows."""
    n, digest = row["n"], row["digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n"
    revisit = row["first_id"] is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(row['page_id'], row['url'], digest)}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=~%')}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['first_id'], row['first_url'], digest)}",
                  f"X-Refers-To-Page-ID: {row['first_id']}"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else n)}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode("ascii")


class _ArchiveWriter:
    """Gzip members of one task, in files of about ``file_bytes``."""

    def __init__(self, folder: str, file_bytes: int):
        self.fs, self.folder = file_system(folder)
        self.file_bytes = file_bytes
        self.fs.create_dir(self.folder, recursive=True)
        self.out, self.member, self.done = None, None, []

    def begin(self, head: bytes) -> None:
        if self.out is None:
            self.name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
            self.out, self.records, self.size = self.fs.open_output_stream(f"{self.folder}/{self.name}",
                                                                           compression=None), 0, 0
        self.member = zlib.compressobj(3, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.size))
            self.out = None

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the planned records; returns the committed manifest (file, records, bytes)."""
    def run(batches):
        writer, left = _ArchiveWriter(folder, file_bytes), 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    writer.begin(_head(row))
                    left = row["n"] if row["first_id"] is None else 0
                if row["piece"]:
                    writer.add(row["piece"])
                    left -= len(row["piece"])
                if not left:
                    writer.end()
        writer.close()
        names, counts, sizes = zip(*writer.done, strict=True) if writer.done else ((), (), ())
        yield pa.RecordBatch.from_pydict({"file": pa.array([f"{folder}/{x}" for x in names], pa.string()),
                                          "records": pa.array(counts, pa.int64()), "bytes": pa.array(sizes, pa.int64())})

    return materialise(records.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Decompressed bytes of an archive of gzip members, read through a bounded buffer."""

    def __init__(self, raw):
        self.raw, self.member, self.pending, self.buffer = raw, None, b"", b""

    def _more(self) -> bool:
        """Add up to ``CHUNK`` decompressed bytes to the buffer; False at the end of the file."""
        while True:
            if not self.pending:
                self.pending = self.raw.read(CHUNK)
                if not self.pending:
                    if self.member is not None:
                        raise ValueError("the archive ends within a record")
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            got = self.member.decompress(self.pending, CHUNK)
            self.pending = self.member.unconsumed_tail
            if self.member.eof:
                self.pending, self.member = self.member.unused_data, None
            if got:
                self.buffer += got
                return True

    def line(self) -> bytes | None:
        while b"\r\n" not in self.buffer:
            if not self._more():
                return None
        line, self.buffer = self.buffer.split(b"\r\n", 1)
        return line

    def take(self, most: int) -> bytes:
        if not self.buffer and not self._more():
            raise ValueError("the archive ends within a record")
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data

    def headers(self) -> tuple[dict[str, str], int]:
        """Header fields up to the empty line, and the bytes that they took after the first line."""
        out, size = {}, 0
        while line := self.line():
            size += len(line) + 2
            name, _, value = line.decode("ascii").partition(":")
            out[name.lower()] = value.strip()
        return out, size + 2


def _records(raw, payloads: bool) -> Iterator[tuple]:
    """Chunk rows of one archive, in the order of the record table's columns."""
    stream = _Stream(raw)
    while (version := stream.line()) is not None:
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head, _ = stream.headers()
        status = stream.line()
        http, size = stream.headers()
        left = int(head["content-length"]) - len(status) - 2 - size
        number = lambda name: int(head[name]) if name in head else None
        fixed = (number("x-page-id"), head.get("warc-target-uri"), head["warc-type"], number("x-refers-to-page-id"))
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        if head["warc-type"] == "revisit":
            yield head["warc-record-id"], 0, *fixed, int(http["content-length"]), stated, None, True
        else:
            digest, chunk_no, total = hashlib.sha256(), 0, left
            while True:
                piece = b""
                while left and len(piece) < CHUNK:
                    piece += (got := stream.take(min(left, CHUNK - len(piece))))
                    left -= len(got)
                digest.update(piece)
                if not left and (digest.hexdigest() != stated or total != int(http["content-length"])):
                    raise ValueError(f"record {head['warc-record-id']} differs from its header")
                yield (head["warc-record-id"], chunk_no, *fixed, total, digest.hexdigest(),
                       piece if payloads else None, not left)
                chunk_no += 1
                if not left:
                    break
        if stream.line() != b"" or stream.line() != b"":
            raise ValueError("a record does not end in two empty lines")


def read_chunks(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``.

    ``payload_digest`` is the digest up to and including the chunk (of the full payload on the
    row with ``is_last``); ``payload`` is null for revisits and where ``payloads`` is False."""
    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = file_system(uri)
                with fs.open_input_stream(path, compression=None) as raw:
                    for row in _records(raw, payloads):
                        rows.append(row)
                        held += len(row[8] or b"") + 300
                        if held >= 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
        yield _batch(rows)

    files = manifest.select("file")
    return files.repartition(max(1, manifest.count())).mapInArrow(run, TABLE_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_TABLE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TABLE, strict=True)], schema=_TABLE)


def archive_pages(pages: DataFrame, folder: str | None = None, min_revisit: int = 100,
                  file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages to archives and return their manifest."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_archives(plan_records(pages, min_revisit), folder, file_bytes)


__all__ = ["archive_pages", "file_system", "plan_records", "read_chunks", "record_id", "record_pieces", "write_archives"]
