"""WARC archives: writing, normalising whole-file gzip, and reading by offset.

``write_archives`` writes archives of a given size, each as a single gzip
stream, as crawlers that compress whole files do. ``normalise`` inflates such a stream
once, in steps of bounded size, rewrites every record as a gzip member of its
own and writes a sidecar index of the members' offsets. ``read_records`` then
reads any record by its offset.

Archives are files of a folder that driver and executors share, reached
through ``pyarrow.fs``. A task writes under a name of its own, and the names
that count are those in the tables that the tasks return, so a task that runs
again leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import pick, shared_dir, stored

VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"      # pages carry no date of capture
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 20                     # bytes read or inflated at once
LEVEL = 6
READ_BYTES = 64 << 20              # compressed bytes that one reading task gets
BATCH_BYTES = 4 << 20
ARCHIVE_BYTES = 32 << 20           # payload of an archive, about
ROWS = 256                         # rows of a batch that are Python objects at a time
GZIP = 16 + zlib.MAX_WBITS


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def record_id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """A response record, or with ``refers`` a revisit record: the head of the
    HTTP message without the payload, whose length the head still tells."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: " + str(len(payload)).encode() + b"\r\n\r\n")
    block = head if refers is not None else head + payload
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(page)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: f"%{ord(m.group()):02X}", url)))
    if refers is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
               ("Content-Length", str(len(block)))]
    return _framed(fields, block)


def _framed(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page; a table (archive) of the files.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that of
    the largest id is a response and those of smaller ids, or of none, revisit
    it; pages that repeat the largest id are responses too. A group without
    any id holds responses only. Null payloads are empty, null URLs are left
    out of the record; other columns are ignored. Payloads are compared by
    SHA-1 and length.

    The number of archives follows the bytes of the payloads, not the
    partitions of the table: small partitions share an archive, and a large one
    goes into several. A page larger than ``archive_bytes`` is held as one
    value and makes an archive as large. An empty table gives no archive.
    """
    own = pick(pages, **{id_col: "long", url_col: "string", payload_col: "string"})
    payload = F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8")
    own = own.select(id_col, url_col, payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    size = F.octet_length("payload")
    n_pages = pages.count()
    groups = stored(own.groupBy("sha1", size.alias("size")).agg(F.max(id_col).alias("last"), F.count(F.lit(1)).alias("n")),
                    "payloads", n_pages)
    total = groups.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0
    # only payloads that occur more than once; stored, so that a hot one is split in the join
    repeated = stored(groups.where((F.col("size") >= least_bytes) & (F.col("n") > 1) & F.col("last").isNotNull()).drop("n"),
                      "repeated-payloads", n_pages)
    refers = F.when(~F.col(id_col).eqNullSafe(F.col("last")), F.col("last"))
    rows = (own.withColumn("size", size).join(repeated, ["sha1", "size"], "left")
            .select(id_col, url_col, "payload", refers.alias("refers")).coalesce(max(1, -(-total // archive_bytes))))

    def write(batches):
        out = packer = None
        held, names = 0, []

        def close():
            out.write(packer.flush())
            out.close()

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns)):
                    if out is None or held >= archive_bytes:
                        if out is not None:
                            close()
                        name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        names.append(name)
                        system, path = file_system(name)
                        system.create_dir(path.rpartition("/")[0], recursive=True)
                        out, packer, held = system.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, wbits=GZIP), 0
                        info = b"format: WARC File Format 1.1\r\n"
                        out.write(packer.compress(_framed(
                            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                             ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))], info)))
                    out.write(packer.compress(record(page, url, payload, sha1_base32(payload), refers)))
                    held += len(payload)
        if out is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(names)], names=["archive"])

    return stored(rows.mapInArrow(write, "archive string"), "archives")


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file in steps of bounded size, whether it is one
    stream or several members."""
    unpack, ended = zlib.decompressobj(wbits=GZIP), True
    while data := source.read(STEP):
        while data:
            yield unpack.decompress(data, STEP)
            ended = unpack.eof
            data = unpack.unconsumed_tail
            if unpack.eof:
                # the next member, after zero bytes that some writers pad with
                data = unpack.unused_data.lstrip(b"\0") if not data else data
                unpack = zlib.decompressobj(wbits=GZIP)
    while not ended:  # output that the last step had no room for
        step = unpack.decompress(b"", STEP)
        ended = unpack.eof
        if not step and not ended:
            raise ValueError("truncated gzip stream")
        yield step


class Records:
    """The records of a stream of bytes, each as its header and its bytes in
    steps."""

    def __init__(self, steps: Iterator[bytes]):
        self.steps, self.held = steps, bytearray()

    def _more(self) -> bool:
        step = next(self.steps, None)
        if step is not None:
            self.held += step
        return step is not None

    def header(self) -> bytes | None:
        """Up to and with its empty line; None at the end."""
        while True:
            blank = len(self.held) - len(self.held.lstrip(b"\r\n"))
            del self.held[:blank]
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                head = bytes(self.held[:end + 4])
                del self.held[:end + 4]
                if not head.startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {head[:40]!r}")
                return head
            if not self._more():
                if self.held:
                    raise ValueError("truncated WARC header")
                return None

    def block(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise ValueError("truncated WARC block")
            step = bytes(self.held[:size])
            del self.held[:size]
            size -= len(step)
            if step:
                yield step


def fields(header: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in header.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def split_members(source: BinaryIO, write: Callable[[bytes], object]) -> Iterator[tuple[int, int, str, str]]:
    """Write every record as a gzip member; (offset, length, type, id) of each."""
    records, at = Records(inflated(source)), 0
    while (head := records.header()) is not None:
        own, packer, size = fields(head), zlib.compressobj(LEVEL, wbits=GZIP), 0

        def put(data: bytes) -> None:
            nonlocal size
            write(data)
            size += len(data)

        put(packer.compress(head))
        for step in records.block(int(own["content-length"])):
            put(packer.compress(step))
        put(packer.compress(b"\r\n\r\n"))
        put(packer.flush())
        yield at, size, own.get("warc-type", ""), own.get("warc-record-id", "")
        at += size


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a member per record, and beside it a sidecar
    index ``.idx`` of tab-separated lines; the index of all as a table
    (archive, offset, length, type, record).

    An archive is read and written in steps, never held whole. Empty archives
    give empty ones; a truncated or malformed archive raises.
    """
    def rewrite(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                stem = source.rpartition("/")[2].removesuffix(".warc.gz")
                name = f"{folder}/{stem}-{uuid.uuid4().hex}.warc.gz"
                system, path = file_system(name)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                old, old_path = file_system(source)
                with (old.open_input_stream(old_path, compression=None) as data,
                      system.open_output_stream(path, compression=None) as out,
                      system.open_output_stream(path.removesuffix(".warc.gz") + ".idx", compression=None) as sidecar):
                    rows = []
                    for row in split_members(data, out.write):
                        sidecar.write("\t".join(map(str, row)).encode() + b"\n")
                        rows.append((name, *row))
                        if len(rows) == 10_000:
                            yield _rows(rows, INDEX)
                            rows = []
                    if rows:
                        yield _rows(rows, INDEX)

    n = max(1, archives.count())
    return stored(archives.repartition(n).mapInArrow(
        rewrite, "archive string, offset long, length long, type string, record string"), "archive-index")


INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()),
                   ("record", pa.string())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def parse_member(member: bytes) -> tuple:
    """A row of ``PAGES`` from one gzip member: of a response the payload and
    its own length and digest, of a revisit those that the record tells."""
    data = zlib.decompress(member, wbits=GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    own = fields(head + b"\r\n\r\n")
    http, _, payload = rest[:int(own["content-length"])].partition(b"\r\n\r\n")
    if own["warc-type"] == "revisit":
        return (_page(own["warc-record-id"]), own.get("warc-target-uri"), "revisit", _page(own["warc-refers-to"]), None,
                int(fields(http + b"\r\n")["content-length"]), own["warc-payload-digest"].removeprefix("sha1:"))
    return (_page(own["warc-record-id"]), own.get("warc-target-uri"), "response", None, payload, len(payload),
            sha1_base32(payload))


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The response and revisit records of an index, read by offset: page_id,
    url, record_type, refers_to, payload (null for a revisit; left out without
    ``payloads``), payload_bytes and payload_digest (of the full payload). A
    record is held whole; an empty index gives an empty table."""
    schema = pa.schema([f for f in PAGES if payloads or f.name != "payload"])
    wanted = index.where(F.col("type").isin("response", "revisit")).select("archive", "offset", "length")
    total = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    near = F.floor(F.col("offset") / (READ_BYTES // 16))

    def read(batches):
        name, source, rows, held = None, None, [], 0
        for batch in batches:
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if source is not None:
                        source.close()
                    system, path = file_system(archive)
                    name, source = archive, system.open_input_file(path)
                found = parse_member(source.read_at(length, offset))
                rows.append(found if payloads else found[:4] + found[5:])
                held += len(found[4] or b"") if payloads else 0
                if held >= BATCH_BYTES or len(rows) == 10_000:
                    yield _rows(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _rows(rows, schema)

    payload = "payload binary, " if payloads else ""
    return wanted.repartition(tasks, "archive", near).sortWithinPartitions("archive", "offset").mapInArrow(
        read, f"page_id long, url string, record_type string, refers_to long, {payload}payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", payloads: bool = True) -> DataFrame:
    """Write, normalise and read back; see ``read_records``."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    archives = write_archives(pages, f"{folder}/whole", least_bytes, id_col, url_col, payload_col)
    return read_records(normalise(archives, f"{folder}/members"), payloads)
