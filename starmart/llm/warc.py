"""WARC archives: a writer with revisit records, and a reader that salvages what it can.

Writer. Each task writes the records of its partition into gzip archives, one member a record, and starts a new archive
at ``ROLL_BYTES``. An attempt writes into a folder of its own, which takes the place of the task's folder when it is
whole; so a task run again leaves no archive of an earlier attempt, and readers see no unfinished one. Of records with
equal payloads of at least ``least_bytes`` bytes those with the smallest id are responses, the others revisits without a
payload. The header of a revisit keeps the full length.

Reader. Archives are read as streams, one archive a task, a record at a time. A record begins with a version line, has a
header of any length, a Content-Length that is followed by the end of the record, and a block that agrees with its block
digest. It stands by itself or in a gzip member, which may hold several and must end with its checksum. After a failed
check the reader searches for the next valid member or version line, whichever comes first and whatever came before, and
logs the bytes in between as a quarantined gap. Within a member it searches for the next version line. Of a damaged
member the records before the damage count if their block digest agrees. Memory holds one record, and 16 MB of a member.

A null payload is empty. Null ids are written as such; among equal payloads they sort last. Rows that repeat the
smallest id are all responses. Other columns are never read. An empty table writes no archive; no archive gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import small
from starmart.session import checkpointed

#: An archive that has reached so many bytes is closed and a new one begun.
ROLL_BYTES = 256 << 20
#: Bytes read from an archive at once.
CHUNK = 1 << 20
#: Compressed bytes that are decompressed at once.
FEED = 1 << 14
#: Content of a member that is held in memory.
HELD = 16 << 20
VERSION = b"WARC/1."
MEMBER = b"\x1f\x8b\x08"
FIRST_LINE = re.compile(rb"WARC/1\.\d+\r\n")
VERSION_MARK = re.compile(re.escape(VERSION))
MARKS = re.compile(re.escape(VERSION) + b"|" + re.escape(MEMBER))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "archive string, offset bigint, length bigint, kind string, type string, id string, refers_to string, "
    "uri string, payload_digest string, payload_bytes bigint, payload binary, reason string"
)


def digest(data: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page: str, refers: str | None, uri: str, payload: bytes, payload_digest: str, size: int) -> bytes:
    """One record; ``payload`` is empty for a revisit, ``size`` is that of the full payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---------------------------------------------------------------- writing


def planned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, sha1 (hex), payload_bytes, refers_to (null for a response)."""
    rows = pages.select(
        "page_id",
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"),
    )
    rows = rows.withColumn("sha1", F.sha1("html")).withColumn("payload_bytes", F.length("html").cast("bigint"))
    first = rows.groupBy(F.col("sha1").alias("d"), F.col("payload_bytes").alias("b")).agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Only payloads that occur more than once have revisits. While these are few, the pages do not shuffle.
    first = first.where((F.col("n") > 1) & F.col("first").isNotNull() & (F.col("b") >= least_bytes)).drop("n")
    first = small(checkpointed(first))
    rows = rows.join(first, (rows.sha1 == first.d) & (rows.payload_bytes == first.b), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.select("page_id", "url", "html", "sha1", "payload_bytes", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes archives of all pages below ``folder`` and returns (archive, records) of what was written."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
            fs.LocalFileSystem(),
            folder,
        )
        names, counts, out = [], [], None
        trial = f"{root}/.attempt-{context.taskAttemptId()}"
        store.create_dir(trial, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"part-{len(names):04d}.warc.gz")
                    out = store.open_output_stream(f"{trial}/{names[-1]}", compression=None)
                    counts.append(0)
                refers = row["refers_to"]
                out.write(
                    member(
                        record(
                            "response" if refers is None else "revisit",
                            str(row["page_id"]),
                            None if refers is None else str(refers),
                            " ".join(row["url"].split()),
                            row["html"] if refers is None else b"",
                            base64.b32encode(bytes.fromhex(row["sha1"])).decode(),
                            row["payload_bytes"],
                        )
                    )
                )
                counts[-1] += 1
                if out.tell() >= ROLL_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        task = f"{root}/task-{context.partitionId():06d}"
        if store.get_file_info(task).type != fs.FileType.NotFound:
            store.delete_dir(task)
        if names:
            store.move(trial, task)
        else:
            store.delete_dir(trial)
        names = [f"{task}/{name}" for name in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return planned(pages, least_bytes).mapInArrow(written, "archive string, records bigint")


# ---------------------------------------------------------------- reading


class Damaged(Exception):
    """A failed check; says which."""


class Window:
    """A file seen through a moving buffer; ``at(o, n)`` gives up to n bytes from offset o on."""

    def __init__(self, file):
        self.file, self.size, self.start, self.data = file, file.size(), 0, b""

    def forget(self, offset: int) -> None:
        """Nothing to do, the buffer moves anyway."""

    def at(self, offset: int, count: int) -> bytes:
        if offset >= self.size:
            return b""
        if offset < self.start or offset + count > self.start + len(self.data):
            self.file.seek(offset)
            self.start, self.data = offset, self.file.read(max(count, CHUNK))
        return self.data[offset - self.start : offset - self.start + count]


class Inflated:
    """The content of the gzip member at ``begin``, seen as a window that moves forward.

    ``run`` reads it through: ``end`` is where the member ends or fails, ``failure`` why it fails (None: it does not).
    What precedes a failure can be read. Content up to ``HELD`` bytes stays in memory, longer content is decompressed again.
    """

    def __init__(self, window: Window, begin: int):
        self.window, self.begin = window, begin
        self.restart()

    def restart(self) -> None:
        self.stream, self.next, self.ended, self.reason = zlib.decompressobj(31), self.begin, False, None
        self.start, self.data = 0, bytearray()

    def more(self) -> bool:
        """Decompresses some more; false if there is no more."""
        if self.ended:
            return False
        packed = self.window.at(self.next, FEED)
        try:
            if not packed:
                raise Damaged("member cut off")
            self.data += self.stream.decompress(packed)
            self.next += len(packed) - len(self.stream.unused_data)
            self.ended = self.stream.eof
        except Damaged as e:
            self.ended, self.reason = True, str(e)
        except zlib.error:
            self.ended, self.reason = True, "member does not decompress or fails its checksum"
            self.up_to_failure(packed)
        return True

    def up_to_failure(self, packed: bytes) -> None:
        """What a failed piece holds before the byte that fails."""
        stream = zlib.decompressobj(31)
        for at in range(self.begin, self.next, FEED):
            stream.decompress(self.window.at(at, FEED))
        for i in range(len(packed)):
            try:
                self.data += stream.decompress(packed[i : i + 1])
            except zlib.error:
                self.next += i
                return

    def run(self) -> None:
        whole = True
        while self.more():
            if len(self.data) > HELD:
                whole = False
                self.data.clear()
        self.end, self.failure = self.next, self.reason
        if not whole:
            self.restart()

    def at(self, offset: int, count: int) -> bytes:
        while self.start + len(self.data) < offset + count and self.more():
            pass
        return bytes(self.data[offset - self.start : offset + count - self.start])

    def forget(self, offset: int) -> None:
        """Nothing before the offset is asked for any more."""
        if offset - self.start > CHUNK:
            del self.data[: offset - self.start]
            self.start = offset


def following(source: Window | Inflated, marks: re.Pattern, offset: int) -> int:
    """The next place of a mark from ``offset`` on, or the end."""
    while True:
        source.forget(offset)
        data = source.at(offset, CHUNK)
        hit = marks.search(data)
        if hit:
            return offset + hit.start()
        if len(data) < CHUNK:
            return offset + len(data)
        # A mark may lie across the border.
        offset += len(data) - len(VERSION) + 1


def header(source: Window | Inflated, offset: int) -> tuple[dict[str, str], int]:
    """The fields of the record at ``offset`` and the length of its header, read on until it closes."""
    if not FIRST_LINE.match(source.at(offset, 16)):
        raise Damaged("no version line")
    size = 1 << 12
    while True:
        data = source.at(offset, size)
        length = data.find(b"\r\n\r\n")
        fields: dict[str, str] = {}
        name = ""
        lines = data[: length if length >= 0 else max(0, data.rfind(b"\r\n"))].split(b"\r\n")[1:]
        for line in (x.decode("utf-8", "replace") for x in lines):
            if line[:1] in (" ", "\t") and name:
                fields[name] += " " + line.strip()
                continue
            name, colon, value = line.partition(":")
            if not colon:
                raise Damaged("header line without a colon")
            name = name.strip().lower()
            fields[name] = value.strip()
        if length >= 0:
            return fields, length + 4
        if len(data) < size:
            raise Damaged("header not closed")
        size *= 4


def record_at(source: Window | Inflated, offset: int) -> tuple[dict, int]:
    """The record at ``offset``, as fields and block, and where it ends."""
    fields, begin = header(source, offset)
    stated = fields.get("content-length", "")
    if not (stated.isascii() and stated.isdigit()):
        raise Damaged("no content length")
    length = int(stated)
    # Its last byte first, so that a false length reads no long block.
    if isinstance(source, Window) and source.at(offset + begin + length, 4) != b"\r\n\r\n":
        raise Damaged("block shorter or longer than its length says")
    data = source.at(offset + begin, length + 4)
    block = data[:length]
    if data[length:] != b"\r\n\r\n":
        raise Damaged("block shorter or longer than its length says")
    if fields.get("warc-block-digest", "").startswith("sha1:") and fields["warc-block-digest"][5:] != digest(block):
        raise Damaged("block digest differs")
    return {"fields": fields, "block": block}, offset + begin + length + 4


def records_in(content: Inflated, vouched: bool) -> Iterator[dict]:
    """Records and gaps of a member. One without a checksum does not vouch for records without a block digest."""
    at, gap = 0, None
    while content.at(at, 1):
        content.forget(at)
        try:
            found, end = record_at(content, at)
            if not vouched and "warc-block-digest" not in found["fields"]:
                raise Damaged("no digest, in a damaged member")
        except Damaged as e:
            gap = gap or str(e)
            at = following(content, VERSION_MARK, at + 1)
            continue
        if gap and vouched:
            yield {"reason": gap}
        gap = None
        yield found
        at = end
    if gap and vouched:
        yield {"reason": gap}


def salvaged(file) -> Iterator[dict]:
    """Records and gaps of an open archive, in order; each has offset and length, a gap its reason.

    What lies in a member has the member's offset and length, in a damaged member no length.
    """
    window, at, gap, why, known = Window(file), 0, None, "", 0
    while window.at(at, 1):
        try:
            if window.at(at, 3) == MEMBER:
                content = Inflated(window, at)
                if not content.at(0, len(VERSION)).startswith(VERSION):
                    raise Damaged(content.reason or "no version line")
                content.run()
                end, reason = content.end, content.failure
                if reason:
                    for found in records_in(content, False):
                        known = end
                        yield found | {"offset": at, "length": None}
                    raise Damaged(reason)
                rows = records_in(content, True)
            else:
                found, end = record_at(window, at)
                rows = [found]
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            at = following(window, MARKS, at + 1)
            # Records of a damaged member that is stored rather than compressed have been read already.
            while at < known and window.at(at, 3) != MEMBER:
                at = following(window, MARKS, at + 1)
            continue
        if gap is not None:
            yield {"offset": gap, "length": at - gap, "reason": why}
            gap = None
        for found in rows:
            yield found | {"offset": at, "length": end - at}
        at = end
    if gap is not None:
        yield {"offset": gap, "length": at - gap, "reason": why}


def read(spark: SparkSession, folder: str, pattern: str = "*.warc*") -> DataFrame:
    """Records and gaps of all archives below ``folder``: columns as in ``RECORDS``; kind is record or gap.

    ``payload`` is the HTTP body of a response, null for a revisit; ``payload_bytes`` is the full length in both.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    # Paths and lengths only: the content column is pruned, archives are opened by the tasks.
    paths = files.load(folder).select("path", "length")
    # Random keys, not the path's hash: archives are few and large, and each should get a task.
    tasks = max(1, min(10_000, paths.count()))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    for found in salvaged(file):
                        row = described(found) | {"archive": path, "offset": found["offset"], "length": found["length"]}
                        rows.append(row)
                        held += len(row.get("payload") or b"")
                        if held >= 16 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return paths.repartition(tasks).mapInArrow(records, RECORDS)


SCHEMA = pa.schema(
    [(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in RECORDS.split(", "))]
)


def described(found: dict) -> dict:
    """A row of ``RECORDS`` without its place. A response whose payload differs from its digest is a gap."""
    if "reason" in found:
        return {"kind": "gap", "reason": found["reason"]}
    fields, block = found["fields"], found["block"]
    page = lambda name: fields.get(name, "").removeprefix("<urn:page:").removesuffix(">") or None
    http, _, body = block.partition(b"\r\n\r\n")
    length = next((v for n, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if n.lower() == b"content-length"), b"")
    kind = fields.get("warc-type")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and stated and stated != digest(body):
        return {"kind": "gap", "reason": "payload digest differs"}
    return {
        "kind": "record",
        "type": kind,
        "id": page("warc-record-id"),
        "refers_to": page("warc-refers-to"),
        "uri": fields.get("warc-target-uri"),
        "payload_digest": stated,
        "payload_bytes": int(length) if kind == "revisit" and length.strip().isdigit() else len(body),
        "payload": None if kind == "revisit" else body,
    }
