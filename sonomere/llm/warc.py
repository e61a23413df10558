"""Web archives: records written one gzip member each, and read back in sequence."""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.sources.pcm import open_file, split_uri
from sonomere.storage import written

# Compressed bytes of an archive before the next one is begun.
ARCHIVE_BYTES = 64 << 20
# Bytes inflated at once.
PIECE = 1 << 18
# Groups of equal payloads that are known to every task. Any other group has at most one in so many
# of all rows.
HOT_GROUPS = 1000
LONGEST_HEADER = 1 << 20

# The names and forms of WARC 1.1.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
GZIP = 31

RECORD_SCHEMA = (
    "archive string, offset bigint, record_type string, record_id string, target_uri string,"
    " refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)


def sha1_base32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


# Which records are responses


def with_first_of_equals(
    pages: DataFrame, page_id: str = "page_id", payload: str = "payload", least_bytes: int = 0
) -> DataFrame:
    """``pages`` with ``refers_to``: the smallest id of the rows with the same payload, null in the
    row that has it.

    Payloads under ``least_bytes`` refer to nothing. Null payloads are empty ones. Rows that repeat
    the smallest id with its payload all refer to nothing; a null id is greater than any other.

    Equality is that of SHA-256. Groups are found by partial aggregation of digests. The
    ``HOT_GROUPS`` largest are broadcast, at most that many rows of some fifty bytes; their rows go
    anywhere. All others meet their group by an equi-join, in which no key has more than a
    thousandth of all rows.
    """
    key = F.unhex(F.sha2(F.coalesce(payload, F.lit(b"")), 256))
    eligible = F.octet_length(F.coalesce(payload, F.lit(b""))) >= least_bytes
    keyed = pages.withColumn("__key", F.when(eligible, key))
    groups = keyed.filter("__key IS NOT NULL").groupBy("__key").agg(
        F.min(page_id).alias("__first"), F.count("*").alias("__n")
    )
    groups = written(groups.filter("__n > 1 AND __first IS NOT NULL"), "payload-groups")
    hot = groups.orderBy(F.desc("__n"), "__key").limit(HOT_GROUPS)
    hot = hot.select("__key", F.col("__first").alias("__hot"))
    # Rows that need no group, or know theirs already, are dealt by a key that no group has.
    elsewhere = F.encode(F.xxhash64(page_id, payload).cast("string"), "UTF-8")
    open_key = F.when(F.col("__hot").isNull(), F.col("__key"))
    known = keyed.join(F.broadcast(hot), "__key", "left")
    known = known.withColumn("__key", F.coalesce(open_key, elsewhere))
    found = known.join(groups.drop("__n"), "__key", "left")
    first = F.coalesce("__hot", "__first")
    refers = F.when(first.isNotNull() & ~first.eqNullSafe(F.col(page_id)), first)
    return found.withColumn("refers_to", refers).drop("__key", "__hot", "__first")


# Writing


@dataclass
class Page:
    """What a record is made of; ``refers_to`` makes it a revisit, which holds no payload."""

    record_id: str
    target_uri: str | None
    payload: bytes
    refers_to: str | None = None


def _head(fields: list[tuple[str, str | None]], first: bytes) -> bytes:
    lines = [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return b"\r\n".join([first, *lines, b"", b""])


def _uri(text: str | None) -> str | None:
    """A header value in one line of printable ASCII; all other bytes are percent-encoded."""
    return None if text is None else quote(text, safe="!#$%&'()*+,/:;=?@[]~-._")


def record_bytes(page: Page, date: str) -> bytes:
    """One response or revisit record before compression."""
    http = _head(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(page.payload)))],
        b"HTTP/1.1 200 OK",
    )
    revisit = page.refers_to is not None
    block = http if revisit else http + page.payload
    digest = lambda data: "sha1:" + sha1_base32(hashlib.sha1(data, usedforsecurity=False))
    head = _head(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<{page.record_id}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", _uri(page.target_uri)),
            ("WARC-Refers-To", f"<{page.refers_to}>" if revisit else None),
            ("WARC-Profile", IDENTICAL if revisit else None),
            ("WARC-Payload-Digest", digest(page.payload)),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", RESPONSE_TYPE),
            ("Content-Length", str(len(block))),
        ],
        VERSION,
    )
    return b"".join([head, block, b"\r\n\r\n"])


def _info(name: str, date: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = _head(
        [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"),
            ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
            ("Content-Length", str(len(body))),
        ],
        VERSION,
    )
    return b"".join([head, body, b"\r\n\r\n"])


def member(data: bytes) -> Iterator[bytes]:
    """A gzip member, in pieces."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    view = memoryview(data)
    for at in range(0, len(view), PIECE):
        yield squeeze.compress(view[at : at + PIECE])
    yield squeeze.flush()


class _Archives:
    """Writes records to numbered archives of one task."""

    def __init__(self, folder: str, date: str, size: int):
        self.files, self.root = split_uri(folder)
        self.folder, self.date, self.size = folder, date, size
        self.files.create_dir(self.root, recursive=True)
        # A second attempt of a task writes names of its own; only listed archives count.
        self.prefix = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        self.sink, self.n_files, self.bytes, self.records = None, 0, 0, 0

    def _put(self, data: bytes) -> None:
        for piece in member(data):
            self.sink.write(piece)
            self.bytes += len(piece)

    def add(self, page: Page) -> Iterator[tuple[str, int, int]]:
        if self.sink is None:
            self.name = f"{self.prefix}-{self.n_files:05d}.warc.gz"
            self.sink = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.n_files, self.bytes, self.records = self.n_files + 1, 0, 0
            self._put(_info(self.name, self.date))
        self._put(record_bytes(page, self.date))
        self.records += 1
        if self.bytes >= self.size:
            yield from self.close()

    def close(self) -> Iterator[tuple[str, int, int]]:
        if self.sink is not None:
            self.sink.close()
            self.sink = None
            yield f"{self.folder}/{self.name}", self.records, self.bytes


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    target_uri: str = "url",
    payload: str = "payload",
    refers_to: str = "refers_to",
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row to archives in ``folder``; ``(archive, records, bytes)`` of each.

    A row with ``refers_to`` becomes a revisit, any other a response; record ids are
    ``urn:page:<id>``, that of a null id is ``urn:page:``. Null payloads are empty; a null URI is
    left out. Every task writes archives of its own, one record at a time, and begins the next one
    at ``archive_bytes``. The list is written before it is returned: it names the archives of tasks
    that ended, so what a lost executor or a second attempt leaves behind is never read. Repeated
    rows give repeated records; an empty table gives no archive; other columns are ignored.
    """
    rows = pages.select(
        F.col(page_id).cast("string"), F.col(target_uri).cast("string"),
        F.col(payload).cast("binary"), F.col(refers_to).cast("string"),
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, date, archive_bytes)

        def done(rows: Iterable[tuple[str, int, int]]) -> Iterator[pa.RecordBatch]:
            for name, records, size in rows:
                yield pa.RecordBatch.from_pydict(
                    {"archive": [name], "records": [records], "bytes": [size]}
                )

        for batch in batches:
            for i in range(batch.num_rows):
                key, uri, data, first = (c[i].as_py() for c in batch.columns)
                page = Page(
                    f"urn:page:{key or ''}", uri, data or b"",
                    None if first is None else f"urn:page:{first}",
                )
                yield from done(archives.add(page))
        yield from done(archives.close())

    return written(
        rows.mapInArrow(write, "archive string, records bigint, bytes bigint"), "archive-list"
    )


# Reading


class BadArchive(ValueError):
    """An archive that is not what its framing says."""


class _Members:
    """The gzip members of a file, inflated piece by piece. ``buffer`` has what is inflated of the
    present one and not taken yet, never more than a piece beyond what was asked for.
    """

    def __init__(self, source, name: str):
        self.source, self.name = source, name
        self.packed, self.read = b"", 0
        self.at = 0

    def begin(self) -> bool:
        """Move on to the next member, if there is one."""
        if not self.packed:
            self.packed = self._more()
        if not self.packed:
            return False
        self.at = self.read - len(self.packed)
        self.inflate, self.buffer = zlib.decompressobj(GZIP), bytearray()
        return True

    def _more(self) -> bytes:
        data = self.source.read(PIECE)
        self.read += len(data)
        return data

    def fail(self, why: str) -> BadArchive:
        return BadArchive(f"{why}: {self.name}, record at byte {self.at}")

    def _piece(self) -> bool:
        """Inflate a piece more; false at the end of the member."""
        while not self.inflate.eof:
            if not self.packed:
                self.packed = self._more()
                if not self.packed:
                    raise self.fail("Truncated gzip member")
            try:
                data = self.inflate.decompress(self.packed, PIECE)
            except zlib.error as error:
                raise self.fail(f"Broken gzip member ({error})") from None
            self.packed = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if data:
                self.buffer += data
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """All up to and with ``mark``."""
        looked = 0
        while (found := self.buffer.find(mark, max(0, looked - len(mark)))) < 0:
            looked = len(self.buffer)
            if looked > LONGEST_HEADER or not self._piece():
                raise self.fail("Header without an end")
        data = bytes(self.buffer[: found + len(mark)])
        del self.buffer[: found + len(mark)]
        return data

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.buffer and not self._piece():
                raise self.fail("Content shorter than its length")
            data = bytes(self.buffer[:size])
            del self.buffer[: len(data)]
            size -= len(data)
            yield data

    def end(self) -> None:
        """Check that the record's last four bytes are all that is left."""
        while len(self.buffer) <= 4 and self._piece():
            pass
        if bytes(self.buffer) != b"\r\n\r\n":
            raise self.fail("Content longer than its length")


def _fields(head: bytes) -> tuple[bytes, dict[str, str]]:
    first, *lines = head[:-4].split(b"\r\n")
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


@dataclass
class Record:
    """A response or revisit as it was read. A revisit has the length and digest of the payload it
    stands for.
    """

    offset: int
    record_type: str
    record_id: str
    target_uri: str | None
    refers_to: str | None
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: list[bytes] = field(default_factory=list)


def _length(members: _Members, fields: dict[str, str]) -> int:
    size = fields.get("content-length", "")
    if not size.isdecimal():
        raise members.fail("Record without a content length")
    return int(size)


def read_records(source, name: str, keep_payload: bool = False) -> Iterator[Record]:
    """The responses and revisits of an archive, in sequence; other records are checked and passed
    over.

    A member is inflated piece by piece and hashed as it goes by, so memory does not grow with a
    record unless its payload is kept. Raises ``BadArchive`` where a member, a version, a content
    length or a digest is wrong.
    """
    members = _Members(source, name)
    while members.begin():
        version, fields = _fields(members.until(b"\r\n\r\n"))
        if not version.startswith(b"WARC/1."):
            raise members.fail("Record without a version")
        left = _length(members, fields)
        block = hashlib.sha1(usedforsecurity=False)
        record = None
        if fields.get("warc-type") in ("response", "revisit"):
            record, used = _http_record(members, fields, left, block, keep_payload)
            left -= used
        for data in members.take(left):
            block.update(data)
        members.end()
        _verify(members, fields, "warc-block-digest", block)
        if record is not None:
            yield record


def _verify(members: _Members, fields: dict[str, str], what: str, found) -> None:
    stated = fields.get(what)
    if stated is not None and stated.removeprefix("sha1:") != sha1_base32(found):
        raise members.fail(f"Wrong {what}")


def _http_record(
    members: _Members, fields: dict[str, str], size: int, block, keep_payload: bool
) -> tuple[Record, int]:
    """A record whose block is an HTTP response, and the bytes of the block that were read."""
    strip = lambda value: None if value is None else value.strip("<>")
    record = Record(
        members.at, fields["warc-type"], strip(fields.get("warc-record-id", "")),
        fields.get("warc-target-uri"), strip(fields.get("warc-refers-to")),
    )
    head = members.until(b"\r\n\r\n")
    if len(head) > size:
        raise members.fail("Content longer than its length")
    block.update(head)
    if record.record_type == "revisit":
        record.payload_bytes = _length(members, _fields(head)[1])
        record.payload_digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        return record, len(head)
    payload = hashlib.sha1(usedforsecurity=False)
    for data in members.take(size - len(head)):
        block.update(data)
        payload.update(data)
        record.payload_bytes += len(data)
        if keep_payload:
            record.payload.append(data)
    record.payload_digest = sha1_base32(payload)
    _verify(members, fields, "warc-payload-digest", payload)
    return record, size


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """``(archive, offset, record_type, record_id, target_uri, refers_to, payload_bytes,
    payload_digest, payload)`` of the responses and revisits of a table ``(archive, ...)``.

    Archives are dealt over the tasks and each is read in sequence by one, record after record;
    none is held whole. ``payload`` is null unless asked for, and in revisits. Any damage fails the
    query with the archive and the byte where the record begins. A null name is skipped; an empty
    table gives an empty one; an archive named twice is read twice; other columns are ignored.
    """
    spark = archives.sparkSession
    names = archives.select("archive").filter("archive IS NOT NULL")
    n_tasks = max(1, min(names.count(), 16 * spark.sparkContext.defaultParallelism))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_file(name) as source:
                    yield from _batches(name, read_records(source, name, payloads), payloads)

    return names.repartition(n_tasks).mapInArrow(read, RECORD_SCHEMA)


def _batches(name: str, records: Iterable[Record], payloads: bool) -> Iterator[pa.RecordBatch]:
    """Records in batches of a thousand, or of some megabytes."""
    rows, held = [], 0
    for r in records:
        data = b"".join(r.payload) if payloads and r.record_type == "response" else None
        rows.append((
            name, r.offset, r.record_type, r.record_id, r.target_uri, r.refers_to,
            r.payload_bytes, r.payload_digest, data,
        ))
        held += len(data or b"")
        if len(rows) == 1000 or held > 1 << 22:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


_TEXT, _LONG = pa.string(), pa.int64()
_TYPES = [_TEXT, _LONG, _TEXT, _TEXT, _TEXT, _TEXT, _LONG, _TEXT, pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), _TYPES)]
    return pa.RecordBatch.from_arrays(columns, RECORD_SCHEMA.replace(",", "").split()[::2])


def broken_revisits(records: DataFrame) -> DataFrame:
    """``(refers_to, payload_digest, payload_bytes, n)`` of the revisits whose response is missing,
    or has another payload than they say. Revisits are counted by what they refer to before they
    meet responses, so a payload with very many revisits is one row.
    """
    on = ["refers_to", "payload_digest", "payload_bytes"]
    revisits = records.filter("record_type = 'revisit'").groupBy(*on).agg(F.count("*").alias("n"))
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes"
    )
    return revisits.join(responses, on, "left_anti")
