"""WARC archives: deduplicated writer, and a reader that salvages what damage leaves.

Writing: one record per row, each its own gzip member, in archives of about ``ARCHIVE_BYTES``.  Of
rows with equal payloads of at least ``LEAST_REVISIT`` bytes, those with the largest id are
responses (one, unless rows repeat that id), the others revisits that refer to it.  A task writes an
archive under a name of its own and moves it into place when it is whole, so a task that runs again
replaces its archives.

Reading: a record is taken if it starts with a version line, has all the bytes that its
Content-Length tells, and its block and payload have the digests that its headers tell.  After a
failed check the reader searches on for the next gzip member, or the next version line, that passes
them, inside a member as in the archive; the bytes between are logged as a gap (offset, length,
reason; one inside a whole member has the member's offset and length, and its reason tells the
inflated bytes).  Of a member that is cut off or damaged, the records before that place are taken, if
damaged only those with a digest (which tells nothing of the headers); the last record that inflates goes with the member's checksum.
Archives and members are read in steps through the file system, never whole.

Nulls and edges: a null payload is empty; a null url is written empty, a
url's control characters are left out; a null id is smaller than any
other and is read back as null; repeated rows are written each; an empty table gives no archive and
no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table
from airshed.session import scratch_path

ship_by_value(__name__)

ARCHIVE_BYTES = 32 << 20
LEAST_REVISIT = 1000
STEP = 1 << 20             # bytes read at a time
# bytes of one record; beyond that it counts as damaged.  A Spark value has less than 2 GiB, so no
# record that is written here is larger
MOST_RECORD = (1 << 31) + (1 << 20)
STORES = {"s3a": "s3", "s3n": "s3"}
MAGIC, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
ONCE = {"warc-" + x for x in (
    "type record-id date target-uri payload-digest block-digest ip-address refers-to refers-to-target-uri "
    "refers-to-date truncated warcinfo-id filename profile identified-payload-type segment-origin-id "
    "segment-number segment-total-length").split()} | {"content-length", "content-type"}  # headers that do not repeat
VERSION_LINE = re.compile(r"WARC/1\.\d")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI, and its path there; Hadoop's names for a store are its own name's."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{rest}")


def digest_text(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digest_hex(text: str | None) -> str | None:
    try:
        return base64.b32decode((text or "").removeprefix("sha1:")).hex()
    except ValueError:
        return None


def record(page_id: int | None, url: str, payload: bytes, sha1_hex: str, refers_to: int | None, date: str,
           row: int) -> bytes:
    """One WARC record: a response, or a revisit without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    clean = "".join(c for c in url if c >= " ")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{row}/{sha1_hex}')}>",
            f"WARC-Target-URI: {clean}", f"WARC-Date: {date}", f"WARC-Payload-Digest: {digest_text(sha1_hex)}",
            f"WARC-Block-Digest: {digest_text(hashlib.sha1(block).hexdigest())}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ---------------------------------------------------------------- reading

class Bytes:
    """A file's bytes by place, read in steps."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.at, self.held = 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            self.at, self.held = at, self.file.read_at(min(max(n, STEP), self.size - at), at) if at < self.size else b""
        return self.held[at - self.at:at - self.at + n]

    def find(self, what: bytes, at: int) -> int:
        """The next place of ``what`` from ``at``, or -1."""
        while at < self.size:
            part = self.get(at, min(STEP, self.size - at))
            i = part.find(what)
            if i >= 0:
                return at + i
            if at + len(part) >= self.size:
                return -1
            at += len(part) - len(what) + 1
        return -1


def parse(data: bytes) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and length of the record that ``data`` starts with, or what is wrong."""
    if not data.startswith(VERSION):
        return "no version line"
    end = data.find(END)
    if end < 0:
        return "headers cut off"
    try:
        lines = data[:end].decode().split("\r\n")
    except UnicodeDecodeError:
        return "headers damaged"
    head: dict[str, str] = {}
    for k, colon, v in (x.partition(":") for x in lines[1:]):
        k, v = k.strip().lower(), v.strip()
        # a record that breaks off in its headers would go on with the next one's
        if not colon or k in head and k in ONCE:
            return "headers damaged"
        head[k] = f"{head[k]}, {v}" if k in head else v
    if not VERSION_LINE.fullmatch(lines[0]):
        return "headers damaged"
    size = head.get("content-length", "")
    if not size.isdecimal():
        return "no Content-Length"
    block = data[end + 4:end + 4 + int(size)]
    if len(block) < int(size):
        return "block cut off"
    if data[end + 4 + len(block):end + 8 + len(block)] != END:
        return "no end of record"
    told = head.get("warc-block-digest", "")
    if told.startswith("sha1:") and digest_text(hashlib.sha1(block).hexdigest()) != told:
        return "block digest differs"
    _, _, payload = block.partition(END)
    told = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and told.startswith("sha1:") \
            and digest_text(hashlib.sha1(payload).hexdigest()) != told:
        return "payload digest differs"
    return head, block, end + 8 + len(block)


class Member(Bytes):
    """A gzip member's inflated bytes by place, read in steps and onward only.  ``size`` of them come out
    of the ``used`` bytes of the archive; ``fault`` is what is wrong with it, or empty."""

    def __init__(self, source: Bytes, start: int):
        self.source, self.start, self.size, self.used, self.fault = source, start, 0, 0, ""
        held: list[bytes] | None = []
        for part in self.inflate():
            self.size += len(part)
            if held is not None:
                held.append(part)
                if self.size > 16 * STEP:  # too much to hold: inflated again as it is read
                    held = None
        self.at, self.held = 0, b"".join(held or [])
        self.more = iter(()) if held is not None else self.inflate()

    def inflate(self) -> Iterator[bytes]:
        z, pos, part = zlib.decompressobj(31), self.start, b""
        while not z.eof:
            if not part:
                part = self.source.get(pos, STEP)
                pos += len(part)
            before = z.copy()
            try:
                out = z.decompress(part, 4 * STEP)
            except zlib.error:
                yield from self.until_fault(before, part)
                self.fault = "member damaged"
                return
            if not part and not out and not z.eof:
                self.fault = "member cut off"
                return
            part = z.unconsumed_tail
            if out:
                yield out
        self.used = pos - len(z.unused_data) - self.start

    @staticmethod
    def until_fault(z, part: bytes) -> Iterator[bytes]:
        """What comes out before the byte that does not inflate: an error keeps back a call's output."""
        at, n = 0, len(part)
        while n:
            trial = z.copy()
            try:
                out = trial.decompress(part[at:at + n])
            except zlib.error:
                n //= 2
                continue
            z, at = trial, at + n
            if out:
                yield out

    def get(self, at: int, n: int) -> bytes:
        parts, have = [self.held[at - self.at:]], max(0, self.at + len(self.held) - at)
        if have < n and at < self.size:
            skip = max(0, at - self.at - len(self.held))
            for part in self.more:
                part, skip = part[skip:], max(0, skip - len(part))
                parts.append(part)
                have += len(part)
                if have >= n:
                    break
            self.at, self.held = at, b"".join(parts)
        return self.held[at - self.at:at - self.at + n]

    def taken(self, size: int) -> int:
        """The bytes of the archive that the first ``size`` inflated ones come from."""
        z, pos, part = zlib.decompressobj(31), self.start, b""
        while size:
            if not part:
                part = self.source.get(pos, STEP)
                pos += len(part)
            size -= len(z.decompress(part, min(size, 4 * STEP)))
            part = z.unconsumed_tail
        return pos - len(part) - len(z.unused_data) - self.start


def record_at(source: Bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and length of the plain record at a place, or what is wrong."""
    if source.get(at, len(VERSION)) != VERSION:
        return "no version line"
    size = min(STEP, MOST_RECORD)
    while True:  # as much as the record needs
        data = source.get(at, size)
        one = parse(data)
        if one not in ("headers cut off", "block cut off", "no end of record") or len(data) < size:
            return one
        if size >= MOST_RECORD:
            return "record too large"
        size = min(4 * size, MOST_RECORD)


def vouched(head: dict[str, str]) -> bool:
    """If a digest that ``parse`` checks was told."""
    return head.get("warc-block-digest", "").startswith("sha1:") or \
        head.get("warc-type") == "response" and head.get("warc-payload-digest", "").startswith("sha1:")


def in_member(member: Member) -> Iterator[tuple[str, int, int, object]]:
    """("record", begin, end, (headers, block)) and ("gap", begin, end, reason) of the inflated bytes."""
    at, gap, reason = 0, None, ""
    while at < member.size:
        one = record_at(member, at)
        if not isinstance(one, str):
            head, block, n = one
            if member.fault and at + n >= member.size or member.fault == "member damaged" and not vouched(head):
                one = member.fault
        if not isinstance(one, str):
            if gap is not None:
                yield "gap", gap, at, reason
                gap = None
            yield "record", at, at + n, (head, block)
            at += n
            continue
        if gap is None:
            gap, reason = at, one
        at = member.find(VERSION, at + 1)
        if at < 0:
            break
    if gap is not None:
        yield "gap", gap, member.size, reason


def salvage(file) -> Iterator[tuple[str, int, int, object]]:
    """("record", offset, length, (headers, block)) and ("gap", offset, length, reason), in order."""
    source, at, gap, reason = Bytes(file), 0, None, ""
    starts = {MAGIC: 0, VERSION: 0}  # the next place of each, or the end
    while at < source.size:
        wrong, n, lost = "", 0, at  # bytes that are done with, and where those begin that are lost
        if source.get(at, len(MAGIC)) == MAGIC:
            member, good, inner = Member(source, at), 0, None
            for kind, begin, end, what in in_member(member):
                if kind == "gap":
                    inner = begin, end, what
                    if good:
                        if not member.fault or end < member.size:
                            yield "gap", at, n, f"inflated bytes {begin} to {end}: {what}"
                        inner = None
                    continue
                if gap is not None:
                    yield "gap", gap, at - gap, reason
                    gap = None
                good, n = end, member.used or member.taken(end)
                if inner is not None:
                    yield "gap", at, n, f"inflated bytes {inner[0]} to {inner[1]}: {inner[2]}"
                    inner = None
                yield "record", at, n, what
            if member.fault or not good:
                wrong = member.fault or (inner[2] if inner else "empty member")
                lost, n = at + n, n if member.fault else member.used
        else:
            one = record_at(source, at)
            if isinstance(one, str):
                wrong = "no member or version line" if one == "no version line" else one
            else:
                if gap is not None:
                    yield "gap", gap, at - gap, reason
                    gap = None
                n = one[2]
                yield "record", at, n, one[:2]
        at += n
        if not wrong:
            continue
        if gap is None:
            gap, reason = lost, wrong
        for what, place in starts.items():
            if place < at + (not n):
                place = source.find(what, at + (not n))
                starts[what] = source.size if place < 0 else place
        at = min(starts.values())
    if gap is not None:  # of length 0 if what is lost shares the archive's last byte with a record
        yield "gap", gap, source.size - gap, reason


# ---------------------------------------------------------------- Spark

def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_revisit: int = LEAST_REVISIT,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives into ``folder``; returns the stored list of them: path, bytes, records."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(url_col, F.lit("")).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary")).alias("payload")) \
        .withColumn("sha1", F.sha1("payload"))
    # of each payload the largest id; only those that repeat need to meet their rows
    most = stored(rows.filter(F.octet_length("payload") >= least_revisit).groupBy("sha1")
                  .agg(F.max("id").alias("most"), F.count("*").alias("n")).filter("n > 1")
                  .select(F.col("sha1").alias("_sha1"), "most"), "repeated-payloads")
    refers = F.when(F.col("id").isNull() | (F.col("id") < F.col("most")), F.col("most"))
    typed = rows.join(most, F.col("sha1") == F.col("_sha1"), "left") \
        .select("id", "url", "payload", "sha1", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        done, out, temp, size, records, row = [], None, "", 0, 0, 0

        def close() -> None:
            out.close()
            path = f"{base}/part-{part:06d}-{len(done):05d}.warc.gz"
            fs.move(temp, path)
            done.append((path, size, records))

        for b in batches:
            for i, url, payload, sha1, ref in zip(*(b.column(k) for k in range(5))):
                row += 1
                if out is None:
                    fs.create_dir(base, recursive=True)
                    temp, size, records = f"{base}/_writing-{part:06d}-{attempt}", 0, 0
                    out = fs.open_output_stream(temp, compression=None)
                data = gzip_member(record(i.as_py(), url.as_py(), payload.as_py(), sha1.as_py(), ref.as_py(), date, row))
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        cols = list(zip(*done)) if done else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "bytes", "records"])

    return stored(typed.mapInArrow(run, "path string, bytes long, records long"), "warc-list")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """What the archives of a list (``path``) hold: kind ('record' or 'gap'), path, offset, length, and
    for records type, id, url, digest_hex, refers_to, payload_bytes, payload; for gaps the reason."""
    schema = ("kind string, path string, offset long, length long, type string, id long, url string, "
              "digest_hex string, refers_to long, payload_bytes long, payload binary, reason string")
    arrow = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int64(), pa.int64(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in schema.split(", ")]

    def number(text: str | None) -> int | None:
        return int(text) if text and text.lstrip("-").isdecimal() else None

    def row(path: str, kind: str, offset: int, length: int, what) -> tuple:
        if kind == "gap":
            return (kind, path, offset, length, *[None] * 7, what)
        head, block = what
        http, _, payload = block.partition(END)
        told = digest_hex(head.get("warc-payload-digest"))
        kept = head.get("warc-type") == "response"
        size = len(payload)
        if not kept:
            lines = dict(x.partition(":")[::2] for x in http.decode("latin-1").split("\r\n")[1:])
            size = number(lines.get("Content-Length", "").strip())
        return (kind, path, offset, length, head.get("warc-type"), number(head.get("x-page-id")),
                head.get("warc-target-uri"), hashlib.sha1(payload).hexdigest() if kept else told,
                number(head.get("x-refers-to-page-id")), size, payload if kept else None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), arrow)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                with fs.open_input_file(path) as file:
                    for found in salvage(file):
                        held.append(row(path, *found))
                        size += held[-1][3] + len(held[-1][10] or b"")
                        if size >= 4 * STEP:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    # an archive is a task's work: deal them evenly, by a number that does not depend on their names
    n = max(1, archives.count())
    return archives.select("path").repartition(n, F.xxhash64("path")).mapInArrow(run, schema)


def without_gaps(found: DataFrame) -> DataFrame:
    """What ``read_archives`` found, if all of it is records; a gap is an error."""
    lost = F.concat_ws(" ", F.lit("gap in"), "path", F.lit("at"), "offset", F.lit("of"), "length", F.lit("bytes:"), "reason")
    return found.filter(F.when(F.col("kind") == "record", True).otherwise(F.raise_error(lost).cast("boolean")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records and read back."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    found = without_gaps(read_archives(archives, folder))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest_hex").alias("payload_digest"),
                        F.col("type").alias("record_type"), "refers_to")


QUERIES = {"op10_warc": op10_warc}
ORACLE = {"op10_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
m AS (SELECT html, max(page_id) AS most FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY html)
SELECT page_id, payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id < most THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < most THEN most END AS refers_to
FROM p LEFT JOIN m ON p.html = m.html"""}
