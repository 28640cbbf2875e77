"""WARC archives: a writer in built-in functions, and a reader that salvages damaged files.

Plain archives are written by Spark's own text writer (a record is UTF-8 text here), so they land in
any store Spark writes to and a lost task is simply written again; gzip archives have a member for each
record. The reader checks every record: version line, header, length, digests, end mark. After a
failed check it looks for the next place where a whole record passes (a gzip member or a version line,
whichever comes first), goes on there, and reports the bytes between as a gap. A record whose frame
stands but whose digest fails is one gap as a whole: what lies in its payload is no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch, store

#: The revisit profile of the WARC 1.1 standard; RFC 4648's base32 alphabet beside the digits that conv() uses.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONV_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PAGE_URN = "urn:inkwell:page:"
RECORDS_PER_FILE, BYTES_PER_FILE = 2000, 256 << 20


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are eight groups of five hex digits, four symbols each."""
    h = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32)


def page_records(pages: DataFrame, first_copies: DataFrame, min_bytes: int) -> DataFrame:
    """One row per page with ``value``: the whole record but for its last line end."""
    p = pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_sha1(F.encode("payload", "utf-8")))
    p = p.join(first_copies, "digest", "left").withColumn("bytes", F.octet_length("payload"))
    p = p.withColumn("revisit", F.coalesce((F.col("bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first_id")) & F.col("copies").isNotNull(), F.lit(False)))
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n"), F.when(F.col("revisit"), "").otherwise(F.col("payload"))
    )
    p = p.withColumn("block", block)
    urn = lambda c: F.concat(F.lit(f"<{PAGE_URN}"), F.coalesce(F.col(c), F.lit("")), F.lit(">\r\n"))
    return p.select(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
            F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Record-ID: "), urn("id"),
            F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.col("url"), F.lit("\r\n")), F.lit("")),
            F.when(F.col("revisit"), F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), urn("first_id"))).otherwise(""),
            F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
            F.lit("\r\nWARC-Block-Digest: sha1:"), base32_sha1(F.encode("block", "utf-8")),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block"),
            F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n"),
        ).alias("value")
    )


def size_classes(records_per_file: int, bytes_per_file: int) -> list[tuple[int, int | None, int]]:
    """(least, most, records a file) of payload sizes: the first class fills a file of ``bytes_per_file`` with all its records, each further one holds payloads up to eight times as large, and the last has a file a record."""
    out, least, most, records = [], -1, max(1, bytes_per_file // records_per_file), records_per_file
    while records > 1:
        out.append((least, most, records))
        least, most, records = most, most * 8, records // 8
    return [*out, (least, None, 1)]


def _class_counts(classes: list[tuple[int, int | None, int]]) -> list[Column]:
    size = F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0))
    return [F.count_if((size > least) & (size <= most if most is not None else F.lit(True))).alias(f"n{i}") for i, (least, most, _) in enumerate(classes)]


def _members(path: str, records_per_file: int, bytes_per_file: int):
    """Records to gzip archives, a member each. A file gets its name when it is whole, and a task that runs again writes it anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        folder, root = store(path)
        folder.create_dir(root, recursive=True)
        task, files, out, rows, size = TaskContext.get(), 0, None, 0, 0
        name = lambda: f"part-{task.partitionId():05d}-{files:05d}.warc.gz"
        hidden = lambda: f"{root}/.{name()}.{task.taskAttemptId()}"
        for batch in batches:
            for value in batch.column(0):
                out = out or folder.open_output_stream(hidden(), compression=None)
                member = gzip.compress(value.as_buffer().to_pybytes() + b"\r\n", 6, mtime=0)
                out.write(member)
                rows, size = rows + 1, size + len(member)
                if rows == records_per_file or size >= bytes_per_file:
                    out.close()
                    folder.move(hidden(), f"{root}/{name()}")
                    files, out, rows, size = files + 1, None, 0, 0
        if out:
            out.close()
            folder.move(hidden(), f"{root}/{name()}")
        yield from ()

    return run


def write_warc(
    pages: DataFrame, path: str, first_copies: DataFrame, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE, compression: str = "none", bytes_per_file: int = BYTES_PER_FILE
) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` to archives under ``path``, plain or (``gzip``) with a gzip member for each record.

    ``first_copies(digest, first_id, copies)`` has the payload digests that occur more than once (see
    ``repeated_payloads``). A null html is an empty payload, a null url leaves its header out, and a null
    page_id gives a record id without number. Columns other than these three are not read.

    An archive holds at most ``records_per_file`` records, and payloads of at most ``bytes_per_file`` bytes unless it holds
    a single record (gzip: what its last member takes it to). Plain archives are written a size class at a time (``size_classes``), those
    that have rows; a count beforehand says which, and most tables lie in the first.
    """
    if compression == "gzip":
        page_records(pages, first_copies, min_bytes).mapInArrow(_members(path, records_per_file, bytes_per_file), "written int").write.format("noop").mode("overwrite").save()
        return
    classes = size_classes(records_per_file, bytes_per_file)
    filled = pages.agg(*_class_counts(classes)).first()
    own = [c for c, n in zip(classes, filled, strict=True) if n] or classes[:1]
    size = F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0))
    for i, (least, most, records) in enumerate(own):
        of = pages if len(own) == 1 else pages.filter((size > least) & (size <= most if most is not None else F.lit(True)))
        out = page_records(of, first_copies, min_bytes).write.option("lineSep", "\r\n").option("maxRecordsPerFile", records).option("compression", compression)
        out.mode("append" if i else "errorifexists").text(path)


def repeated_payloads(pages: DataFrame) -> DataFrame:
    """``digest, first_id, copies`` of the payloads that more than one row has: counted before any shuffle, so a payload that a third of the rows share costs one row a task."""
    d = pages.select("page_id", base32_sha1(F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")).alias("digest"))
    return d.groupBy("digest").agg(F.min("page_id").cast("string").alias("first_id"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# ---- reading ---------------------------------------------------------------------------

VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
HEAD_END = re.compile(rb"\r?\n\r?\n")
LENGTH = re.compile(rb"\d{1,18}")
#: Digests that are checked, by their label without hyphens; others are not.
ALGORITHMS = ("sha1", "sha256", "sha512", "md5")


class Damaged(Exception):
    """A record that fails a check; the message is the gap's reason."""


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _agrees(declared: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest, in base32 or hexadecimal digits, is that of ``data``; None where there is none that can be checked."""
    label, colon, value = (declared or "").partition(":")
    label = label.lower().replace("-", "")
    if not colon or label not in ALGORITHMS:
        return None
    raw = hashlib.new(label, data).digest()
    return value.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=") or value.lower() == raw.hex()


class Archive(bytes):
    """An archive's bytes that remember where the next blank line is, so that a run of headers without end is searched once."""

    sought = 0
    blank: re.Match | None = None
    known = False

    def header_end(self, at: int) -> re.Match | None:
        if not self.known or at < self.sought or (self.blank and self.blank.start() < at):
            self.known, self.sought, self.blank = True, at, HEAD_END.search(self, at)
        return self.blank


def _header(data: bytes, at: int, stop: int) -> dict[str, str]:
    """Named fields of the header between two places; only LF, alone or after CR, ends a line, and one that begins with a blank goes on with the field before. It is read up to its first fault: another version line is one."""
    out: dict[str, str] = {}
    key = ""
    while at <= stop:
        end = data.find(b"\n", at, stop)
        end = stop if end < 0 else end
        line, at = data[at:end].removesuffix(b"\r"), end + 1
        if line[:1] in (b" ", b"\t") and key:
            out[key] = f"{out[key]} {line.strip(b' \t').decode('utf-8', 'replace')}".strip(" ")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        key = name.strip(b" \t").decode("utf-8", "replace").lower()
        out[key] = value.strip(b" \t").decode("utf-8", "replace")
    return out


def _frame(data: bytes, at: int) -> tuple[dict, int, int, int]:
    """The header of the record at ``at``, where its block begins and ends, and where the record ends, or ``Damaged``."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("version line")
    end = data.header_end(version.end() - 1) if isinstance(data, Archive) else HEAD_END.search(data, version.end() - 1)
    if not end:
        raise Damaged("header end")
    head = _header(data, version.end(), max(version.end(), end.start()))
    if not head.get("warc-type") or not head.get("warc-record-id"):
        raise Damaged("mandatory header")
    if not LENGTH.fullmatch(head.get("content-length", "").encode()):
        raise Damaged("content length")
    begin, stop = end.end(), end.end() + int(head["content-length"])
    if stop > len(data):
        raise Damaged("truncated")
    if data[stop : stop + 4] == b"\r\n\r\n":
        return head, begin, stop, stop + 4
    if data[stop : stop + 2] == b"\n\n":
        return head, begin, stop, stop + 2
    raise Damaged("end mark")


def _payload(head: dict, block: bytes) -> tuple[bytes, bytes]:
    """A block's payload and, of a message, the message's own header."""
    if head.get("content-type", "").startswith("application/http") and (cut := HEAD_END.search(block)):
        return block[cut.end() :], block[: cut.start()]
    return block, b""


def _wrong_digest(head: dict, block: bytes) -> str:
    """Which declared digest fails, or nothing. The payload's counts where the block's says nothing, the payload is there and the transfer did not encode it."""
    agrees = _agrees(head.get("warc-block-digest"), block)
    if agrees is None and head["warc-type"] != "revisit":
        payload, message = _payload(head, block)
        if not re.search(rb"(?im)^(content|transfer)-encoding:", message) and _agrees(head.get("warc-payload-digest"), payload) is False:
            return "payload digest"
    return "block digest" if agrees is False else ""


def record_at(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and where it ends, or ``Damaged``."""
    head, begin, stop, after = _frame(data, at)
    block = data[begin:stop]
    if wrong := _wrong_digest(head, block):
        raise Damaged(wrong)
    return head | {"": block}, after


def _framed(data: bytes, at: int) -> int | None:
    """Where the record at ``at`` ends, by its own length and end mark, if the archive's end, a member or another framed record follows; its digests may fail."""
    try:
        after = _frame(data, at)[3]
        if after < len(data) and not data.startswith(MAGIC, after):
            _frame(data, after)
    except Damaged:
        return None
    return after


def _plain(data: bytes) -> Iterator[tuple]:
    """(start, end, header or None, reason) over an uncompressed archive, without holes."""
    at = 0
    while at < len(data):
        try:
            head, after = record_at(data, at)
            yield at, after, head, ""
        except Damaged as e:
            after = _framed(data, at) or _next_record(data, at + 1, len(data))
            yield at, after, None, str(e)
        at = after


def _next_record(data: bytes, look: int, end: int) -> int:
    """Where the next whole record starts, before ``end``, or ``end``."""
    while 0 <= (look := data.find(b"WARC/1.", look, end)):
        try:  # anywhere: a record cut short ends in the middle of a line
            record_at(data, look)
            return look
        except Damaged:
            look += 1
    return end


MAGIC, PIECE = b"\x1f\x8b\x08", 1 << 16


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` holds, as far as it can be decompressed, where it ends, and what is wrong with it."""
    view, one, out = memoryview(data), zlib.decompressobj(31), []
    while at < len(data) and not one.eof:
        before = one.copy()
        try:
            out.append(one.decompress(view[at : at + PIECE]))
        except zlib.error:
            for i in range(at, min(at + PIECE, len(data))):  # the output before the error, which the failed call does not return
                try:
                    out.append(before.decompress(view[i : i + 1]))
                except zlib.error:
                    break
            return b"".join(out), len(data), "gzip member"
        at = min(at + PIECE, len(data))
    if not one.eof:
        return b"".join([*out, one.flush()]), len(data), "truncated member"
    return b"".join(out), at - len(one.unused_data), ""


def _member_records(out: bytes, wrong: str) -> Iterator[tuple[dict | None, str]]:
    """(header or None, reason) of a member's records; of a broken one those that end before its output does, and after an error only those that their own digest proves."""
    for _, end, head, reason in _plain(Archive(out)):
        if not wrong:
            yield head, reason
        elif head and end < len(out) and (wrong == "truncated member" or _agrees(head.get("warc-block-digest"), head[""])):
            yield head, ""


def _next_member(data: bytes, look: int) -> int:
    """Where the next member starts that is whole or has a good record."""
    while (look := data.find(MAGIC, look)) >= 0:
        out, _, wrong = _member(data, look)
        if (out and not wrong) or any(head for head, _ in _member_records(out, wrong)):
            return look
        look += 1
    return len(data)


def _mixed(data: bytes) -> Iterator[tuple]:
    """As ``_plain``, over an archive of plain records and gzip members, whichever comes next; a record's place is its member's. A member with damage gives its good records and a gap."""
    at = member = 0
    while at < len(data):
        held: list[tuple] = []
        if data.startswith(MAGIC, at):
            out, after, wrong = _member(data, at)
            held = list(_member_records(out, wrong))
        else:
            try:
                head, after = record_at(data, at)
                held, wrong = [(head, "")], ""
            except Damaged as e:
                wrong = str(e)
        if wrong:
            framed = _framed(data, at)
            if not framed and member <= at:  # else the one found before is still the next
                member = _next_member(data, at + 1)
            after = framed or _next_record(data, at + 1, member)
            held.append((None, wrong))
        for head, reason in held:
            yield at, after, head, reason
        at = after


def salvage(data: bytes) -> Iterator[dict]:
    """Every record and every gap of an archive's bytes, in order."""
    for start, end, head, reason in _mixed(Archive(data)):
        if head is None:
            yield {"kind": "gap", "offset": start, "length": end - start, "reason": reason}
            continue
        block = head.pop("")
        row = {"kind": "record", "offset": start, "length": end - start, "reason": None, "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"), "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to")}
        payload, message = _payload(head, block)
        length, declared = re.search(rb"(?im)^content-length:[ \t]*(\d+)", message), head.get("warc-payload-digest")
        if row["record_type"] == "revisit":
            row |= {"payload": None, "payload_bytes": int(length[1]) if length else None, "payload_digest": declared.removeprefix("sha1:") if declared else None}
        else:
            row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": _digest(payload)}
        yield row


SCHEMA = "path string, kind string, offset long, length long, reason string, record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string"
ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])
FLUSH_ROWS, FLUSH_BYTES = 4096, 16 << 20


def read_warc(spark: SparkSession, path: str, payloads: bool = False, pattern: str = "*") -> DataFrame:
    """Records and quarantined gaps of every archive under ``path``, plain or gzip: one row each, ``kind`` record or gap.

    A gap has its place, length and the check that failed. With ``payloads``, the payload bytes too
    (null for revisits). An archive must fit a task, so writers bound it (``records_per_file``, ``bytes_per_file``); a record
    may have any size within that. Spark refuses a file of 2 GiB or more by name. Empty archives and empty folders give no rows.
    """
    arrow = ARROW.append(pa.field("payload", pa.binary())) if payloads else ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                for row in salvage(content.as_py()):
                    held.append(row | {"path": name.as_py()})
                    size += len(row.get("payload") or b"") if payloads else 0
                    if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInArrow(run, SCHEMA + (", payload binary" if payloads else ""))


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives and read these back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A row per input row. Of the rows whose payloads are equal and have ``min_bytes`` or more, those with
    the smallest page_id are responses (all rows that repeat that id) and the others revisit it; a null
    page_id is the smallest only among nulls. Any gap in the archives just written is an error.
    """
    spark = pages.sparkSession
    with Scratch(spark, "warc") as scratch:
        firsts = scratch.save(repeated_payloads(pages), "firsts")
        write_warc(pages, scratch.path("archives"), firsts, min_bytes)
        rows = read_warc(spark, scratch.path("archives"))
        page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '{PAGE_URN}(-?[0-9]+)', 1) AS bigint)")
        out = rows.select(
            F.when(F.col("kind") == "record", page("record_id")).otherwise(F.raise_error(F.concat(F.lit("gap in "), "path", F.lit(" at "), F.col("offset")))).alias("page_id"),
            "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"),
        )
        return scratch.result(out)
