"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

Archives are gzip files with one member per record.  The reader checks every record as it
goes (member CRC, version line, length, digests).  Where a check fails it searches for the next
member or version line at which a valid record begins, goes on from there, and logs the
bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.session import shared_dir, stage_table

# Payloads below this many bytes are always stored.
REVISIT_BYTES = 1000
# A new archive begins once one holds this many bytes.
ARCHIVE_BYTES = 64 << 20
# Bytes read at once.
BLOCK = 1 << 18
# Records of one outgoing batch.
BATCH_RECORDS = 256

# --- fixed values: the archive format -------------------------------------------------
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# ---------------------------------------------------------------------------------------


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that every machine reaches by this name."""
    if folder.startswith("file:"):
        folder = re.sub("^file:/*", "/", folder)
    return pafs.FileSystem.from_uri(folder)


# --- writing ------------------------------------------------------------------------------


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``key, url, html, payload_bytes, payload_digest, refers_to``; the last is set on revisits.

    Among rows with equal payloads of ``least_bytes`` or more, those with the largest key are
    stored and the others refer to it.  Only digests that occur under more than one key are
    looked up, from a staged table, so pages move only if that table is too large to send around.
    """
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")}
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("key").alias("kept"), F.min("key").alias("_low"), F.count("*").alias("_n"), F.count("key").alias("_keys"))
        .filter((F.col("_low") < F.col("kept")) | ((F.col("_keys") > 0) & (F.col("_keys") < F.col("_n"))))
        .select("payload_digest", "payload_bytes", "kept")
    )
    joined = rows.join(stage_table(shared, "shared-payloads"), ["payload_digest", "payload_bytes"], "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("kept")), F.col("kept"))
    # A payload that is stored elsewhere need not travel to the writer.
    payload = F.when(refers.isNull(), F.col("payload"))
    return joined.select("key", "url", payload.alias("payload"), "payload_bytes", "payload_digest", refers.alias("refers_to"))


def _name(key: object) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def build_record(key: object, url: str | None, payload: bytes | None, payload_bytes: int, digest: str, refers_to: object) -> bytes:
    """One record: a response with its payload, or a revisit that names the response."""
    revisit = refers_to is not None
    block = _HTTP % payload_bytes + (b"" if revisit else payload or b"")
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(key)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"X-Payload-Length: {payload_bytes}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line end inside a header would end it.
        lines.insert(2, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_REVISIT_PROFILE}"]
    head = VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "surrogatepass")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes planned records and gives ``archive, records, bytes``, staged.

    Every attempt of a task writes files of its own, and only those that a finished
    task reports are in the result, so lost executors leave no half archive in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int, int]] = []
        out, n, size = None, 0, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, n, size = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                member = gzip_member(build_record(*row))
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        names, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["archive", "records", "bytes"])

    columns = ("key", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    return stage_table(records.select(*columns).mapInArrow(run, "archive string, records bigint, bytes bigint"), "archives")


# --- reading ------------------------------------------------------------------------------


class _Bad(Exception):
    """A check that failed."""


class _Stream:
    """Bytes from a place of a file on: plain, or those of one gzip member."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size = file, at, size
        file.seek(at)
        self.unpack = zlib.decompressobj(31) if file.read(3) == MEMBER else None
        file.seek(at)
        self.buffer = bytearray()
        self.ended = False

    def _more(self) -> bool:
        if self.ended:
            return False
        block = self.file.read(BLOCK)
        if self.unpack is None:
            self.at += len(block)
            self.buffer += block
            self.ended = not block
            return bool(block)
        if not block:
            raise _Bad("the member is cut off")
        try:
            self.buffer += self.unpack.decompress(block)
        except zlib.error as e:
            raise _Bad(f"the member does not unpack: {e}") from None
        self.at += len(block)
        if self.unpack.eof:
            self.ended = True
            self.at -= len(self.unpack.unused_data)
        return True

    def line_block(self, most: int) -> bytes:
        """Up to and without the next empty line, of ``most`` bytes at most.

        Lines are checked as they arrive, so that a version line by chance is given up soon.
        """
        seen = line = 0
        while (end := self.buffer.find(b"\r\n\r\n", seen)) < 0:
            while (stop := self.buffer.find(b"\r\n", max(line, seen))) >= 0:
                _check_line(self.buffer[line:stop], first=line == 0)
                line = stop + 2
            seen = max(0, len(self.buffer) - 3)
            if len(self.buffer) > most or not self._more():
                raise _Bad("the header does not end")
        return self.take(end + 4)[:-4]

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise _Bad("the record is cut off")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def over(self) -> bool:
        """Whether no byte is left, the member's check sum having been compared."""
        while not self.buffer and self._more():
            pass
        return not self.buffer

    def place(self) -> int:
        """Of the next byte, in a plain file."""
        return self.at - len(self.buffer)


def _check_line(line: bytes, first: bool) -> None:
    if first and not re.fullmatch(rb"WARC/1\.[01]", line):
        raise _Bad("no version line")
    if not first and b":" not in line:
        raise _Bad("a header line has no colon")


def _record(stream: _Stream, most: int) -> dict:
    head = stream.line_block(most).split(b"\r\n")
    _check_line(head[0], first=True)
    fields = {}
    for line in head[1:]:
        _check_line(line, first=False)
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = fields.get(b"content-length", "")
    if not re.fullmatch("[0-9]{1,15}", length) or int(length) > most:
        raise _Bad("the length is missing or wrong")
    block = stream.take(int(length))
    if stream.take(4) != b"\r\n\r\n":
        raise _Bad("the record does not end where its length says")
    digest = fields.get(b"warc-block-digest", "")
    if digest.startswith("sha1:") and re.fullmatch("[0-9a-f]{40}", digest[5:]) and digest[5:] != hashlib.sha1(block).hexdigest():
        raise _Bad("the block digest differs")
    kind = fields.get(b"warc-type")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get(b"content-type", "") else block
        stated = fields.get(b"warc-payload-digest", "")
        actual = hashlib.sha1(payload).hexdigest()
        if re.fullmatch("sha1:[0-9a-f]{40}", stated) and stated[5:] != actual:
            raise _Bad("the payload digest differs")
    elif kind != "revisit":
        payload = block
    key = lambda name: (re.fullmatch(r"<urn:record:(.*)>", fields.get(name, "")) or [None, None])[1] or None
    return {
        "record_key": key(b"warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get(b"warc-target-uri"),
        "refers_to": key(b"warc-refers-to"),
        "payload": payload,
        "payload_bytes": len(payload) if payload is not None else _number(fields.get(b"x-payload-length")),
        "payload_digest": hashlib.sha1(payload).hexdigest() if payload is not None else fields.get(b"warc-payload-digest", "").removeprefix("sha1:") or None,
    }


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("[0-9]{1,18}", text) else None


def _next_start(file, at: int, size: int) -> int:
    """Place of the next member or version line from ``at`` on, else the end."""
    longest = 10
    while at < size:
        file.seek(at)
        block = file.read(BLOCK)
        if m := _STARTS.search(block):
            return at + m.start()
        at += max(len(block) - longest + 1, 1) if len(block) >= longest else len(block)
    return size


def salvage(file, size: int) -> Iterator[tuple[int, int, dict | str]]:
    """``(start, end, record)`` of every valid record and ``(start, end, reason)`` of every gap, in order.

    The records of a gzip member count once all of the member has passed its checks.
    """
    at, gap, why = 0, None, ""
    while at < size:
        try:
            stream = _Stream(file, at, size)
            found = [_record(stream, (size - at) * 1100)]
            if stream.unpack is None:
                end = stream.place()
            else:
                while not stream.over():
                    found.append(_record(stream, (size - at) * 1100))
                end = stream.at
        except _Bad as e:
            if gap is None:
                gap, why = at, str(e)
            at = _next_start(file, at + 1, size)
            continue
        if gap is not None:
            yield gap, at, why
            gap = None
        for record in found:
            yield at, end, record
        at = end
    if gap is not None:
        yield gap, size, why


_FIELDS = [
    ("archive", pa.string()),
    ("start", pa.int64()),
    ("end", pa.int64()),
    ("quarantined", pa.string()),
    ("record_key", pa.string()),
    ("record_type", pa.string()),
    ("target_uri", pa.string()),
    ("refers_to", pa.string()),
    ("payload", pa.binary()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
]
_SCHEMA = (
    "archive string, start bigint, end bigint, quarantined string, record_key string, record_type string, target_uri string, "
    "refers_to string, payload binary, payload_bytes bigint, payload_digest string"
)


def read_archives(archives: DataFrame, column: str = "archive", payloads: bool = True) -> DataFrame:
    """A row for each valid record, and one with ``quarantined`` set for each gap, of the archives named.

    Names are URIs that pyarrow opens on every executor.  Archives are dealt out one by one and
    streamed; a task holds one member's records at a time.  An empty archive gives no rows; so
    does an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.schema(_FIELDS)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = _store(archive)
                rows: list[dict] = []
                with store.open_input_file(path) as file:
                    for start, end, what in salvage(file, file.size()):
                        place = {"archive": archive, "start": start, "end": end}
                        rows.append(place | ({"quarantined": what} if isinstance(what, str) else what))
                        if not payloads:
                            rows[-1]["payload"] = None
                        if len(rows) == BATCH_RECORDS:
                            yield pa.RecordBatch.from_pylist(rows, names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, names)

    named = archives.filter(F.col(column).isNotNull()).select(F.col(column).alias("archive"))
    return named.repartition(max(1, named.count())).mapInArrow(run, _SCHEMA)


def records_of(read: DataFrame) -> DataFrame:
    return read.filter("quarantined IS NULL").drop("quarantined")


def gaps_of(read: DataFrame) -> DataFrame:
    """The quarantine log: archive, start, end and what failed there."""
    return read.filter("quarantined IS NOT NULL").select("archive", "start", "end", "quarantined")


def archive_pages(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record per row and gives the archives' names.

    Null payloads are stored as empty ones; a null url is left out of the record; a null key
    reads back as null; rows that repeat the largest key of a payload are each stored.  Other columns play no part.
    """
    if folder is None:
        folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return write_archives(plan_records(pages, key, url, html), folder)
