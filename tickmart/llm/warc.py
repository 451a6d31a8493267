"""WARC archives: a writer with revisit records, and a reader that salvages what damage has left.

The writer makes one gzip member for each record and lets Spark's text sink store them in rows of several members, with a
zero byte after each row (padding that gzip readers skip), so archives land in any file system that Spark writes to and
have a bounded size. The reader checks
each member's and record's structure and digest; after a failed check it searches for the next member or version line
that holds up, reads on from there, and reports the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import folder

MIN_REVISIT_BYTES = 1000
#: An archive is closed after so many rows of the text sink, each of so many bytes of members; a longer member counts as
#: several. So an archive holds 512 MB and its last member at most.
ARCHIVE_ROWS, ROW_BYTES = 128, 4 << 20
#: Copies of one payload are dealt over so many keys.
SALTS = 1 << 16
#: A header that has not ended after so many bytes counts as damaged, unless they are lines of names and values.
MOST_HEADER = 1 << 20
_MEMBER = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_START = re.compile(re.escape(_MEMBER) + b"|" + re.escape(_VERSION))
_END = b"\r\n\r\n"
_NAME = re.compile(rb"[A-Za-z-]{1,64}:")
#: A member is read in steps of so many bytes: what is past its end is copied at most once.
_STEP = 16_384

RECORD = "path string, start long, end long, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"
GAP = "path string, start long, end long, reason string"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, payload binary) with digest (hex SHA-1), bytes, record_type and refers_to.

    Of rows with equal payloads of min_bytes or more, that with the largest page_id is the response; the others revisit
    it. Rows that repeat the largest id are all responses; a null id is the smallest. Other columns are left out. Every
    row has a salt, so neither a payload that a third of all pages share nor all the small ones are one task's work.
    """
    known = pages.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes"), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    salted = known.where(F.col("bytes") >= min_bytes).groupBy("digest", "salt").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
    many = salted.groupBy("digest").agg(F.max("first_id").alias("first_id"), F.sum("n").alias("n")).where("n > 1").select("digest", "first_id")
    joined = known.join(salted.select("digest", "salt").join(many, "digest"), ["digest", "salt"], "left")
    revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first_id")))
    return joined.select("page_id", "url", "payload", "digest", "bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def _named(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record. A revisit holds no payload, but the digest and length of the one it refers to."""
    body = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_named(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_named(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + _END + body + _END


def write(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, archive_rows: int = ARCHIVE_ROWS, row_bytes: int = ROW_BYTES) -> None:
    """Archives of gzip members below path, one record for each row of pages (page_id, url, html); null html is empty.

    Repeated rows and ids, null ids and other columns (which are left out) are as in with_revisits(). Of an empty table no
    record is written.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def row() -> pa.RecordBatch:
            # empty rows, so that a long member counts for its size
            out = pa.RecordBatch.from_pydict({"value": pa.array([b"".join(held), *[b""] * (-(-size // row_bytes) - 1)], pa.binary())})
            held.clear()
            return out

        for b in batches:
            for i in range(b.num_rows):
                page_id, url, payload, digest, kind, refers_to = (b.column(c)[i].as_py() for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to"))
                pack = zlib.compressobj(5, zlib.DEFLATED, 31)
                member = pack.compress(record_bytes(page_id, url, payload, digest, kind, refers_to)) + pack.flush()
                if held and size + len(member) > row_bytes:
                    yield row()
                    size = 0
                held.append(member)
                size += len(member)
        if held:
            yield row()

    packed = with_revisits(rows, min_bytes).mapInArrow(members, "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", archive_rows).text(path)


def _member(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What the gzip member at this place holds, and its end; of a damaged one, what comes before its damage, and None.

    zlib checks CRC and length.
    """
    unpack, out, view, first = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not unpack.eof and at < len(data):
            out.append(unpack.decompress(view[at : at + _STEP]))
            at = min(at + _STEP, len(data))
    except zlib.error:  # zlib gives nothing of the step that failed: take that one again byte by byte
        unpack = zlib.decompressobj(31)
        for k in range(first, at, _STEP):
            unpack.decompress(view[k : k + _STEP])
        try:
            for k in range(at, len(data)):
                out.append(unpack.decompress(view[k : k + 1]))
        except zlib.error:
            return b"".join(out), None
    return b"".join(out), at - len(unpack.unused_data) if unpack.eof else None


def _inside(inner: bytes, whole: bool) -> tuple[list[dict], list[tuple[int, int, str]]]:
    """The records of a member's inflated bytes, and the gaps (start, end, reason) between them.

    After a failed check it reads on from the next version line. Of a member that is not whole, a record counts only if
    its own digest holds.
    """
    got, gaps, place, lost, why = [], [], 0, None, ""
    while place < len(inner):
        parsed = _parse(inner, place, proven=not whole)
        if isinstance(parsed, str):
            if lost is None:
                lost, why = place, parsed
            place = inner.find(_VERSION, place + 1)
            if place < 0:
                break
            continue
        if lost is not None:
            gaps.append((lost, place, why))
            lost = None
        got.append(parsed[0])
        place = parsed[1]
    if lost is not None:
        gaps.append((lost, len(inner), why))
    return got, gaps


def _parse(data: bytes, at: int, proven: bool = False) -> tuple[dict, int] | str:
    """The record at this place and its end, or why there is none. If proven, a digest of its own block has to hold."""
    if not data.startswith(_VERSION, at):
        return "no version line"
    head = data.find(_END, at, at + MOST_HEADER)
    if head < 0 and 0 <= (line := data.rfind(b"\r\n", at, at + MOST_HEADER)) and _NAME.match(data, line + 2):
        head = data.find(_END, at + MOST_HEADER - len(_END))
    if head < 0:
        return "header without end"
    fields: dict[str, str] = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "malformed header"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdecimal():
        return "no content length"
    start = head + 4
    end = start + int(fields["content-length"])
    if data[end : end + 4] != _END:
        return "block does not end where its length says"
    payload, digest = data[start:end], fields.get("warc-payload-digest", "")
    if proven and (fields.get("warc-type") != "response" or digest[:5].lower() != "sha1:"):
        return "no digest to prove it in a damaged member"
    if digest[:5].lower() != "sha1:":
        hexed = hashlib.sha1(payload).hexdigest()
    else:
        try:
            hexed = base64.b32decode(digest[5:]).hex() if len(digest) == 37 else digest[5:].lower()
        except ValueError:
            return "malformed digest"
        if fields.get("warc-type") == "response" and hashlib.sha1(payload).hexdigest() != hexed:
            return "digest does not match"
    length = fields.get("warc-payload-length", "")
    return {
        "record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
        "payload_digest": hexed, "payload_bytes": int(length) if length.isdecimal() else len(payload), "payload": payload,
    }, end + 4


def _next(data: bytes, at: int) -> int:
    """Where the next member or version line after this place may start, or the end."""
    found = _START.search(data, at + 1)
    return found.start() if found else len(data)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", start, end, fields) and ("gap", start, end, reason) over an archive of gzip members, plain records or both.

    Zero bytes between members are padding. Gaps and records are in order. Spans of different members never overlap;
    records of one member that holds several share its span, and so do gaps inside it, whose reason names the inflated
    bytes that are lost. A damaged member that records were salvaged from ends where the next member or version line
    starts.
    """
    at, lost, why = 0, None, ""
    while at < len(data):
        if lost is None and data[at] == 0:
            at += 1
            continue
        got: list[dict] = []
        gaps: list[tuple[int, int, str]] = []
        end, following = at, None
        if data[at : at + 3] == _MEMBER:
            inner, stop = _member(data, at)
            got, gaps = _inside(inner, stop is not None)
            reason = "damaged member" if stop is None else gaps[0][2] if gaps else "empty member"
            if stop is None:
                following = _next(data, at)
                if not gaps:
                    gaps = [(len(inner), len(inner), "damaged member")]
            end = following if stop is None else stop
        elif data[at : at + 2] == _MEMBER[:2]:
            reason = "damaged member"
        else:
            parsed = _parse(data, at)
            if isinstance(parsed, str):
                reason = parsed
            else:
                got, end, reason = [parsed[0]], parsed[1], ""
        if got:
            if lost is not None:
                yield "gap", lost, at, why
                lost = None
            for fields in got:
                yield "record", at, end, fields
            for first, last, reason in gaps:
                yield "gap", at, end, f"inside a {'whole' if following is None else 'damaged'} member, from inflated byte {first} {f'to {last}' if following is None or last < len(inner) else 'on'}: {reason}"
            at = end
        else:
            if lost is None:
                lost, why = at, reason
            at = _next(data, at) if following is None else following
    if lost is not None:
        yield "gap", lost, len(data), why


def read(spark: SparkSession, path: str, with_payload: bool = True, gaps_fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of all archives below path, with the columns of RECORD and GAP. Each archive is one task's input.

    Archives have any name but one that starts with _ or . and are in any subfolder; one of more than 2 GB is refused by
    Spark's reader. Repeated records are all returned. Without with_payload, payloads are checked all the same, but null
    in the result. With gaps_fail, reading the records fails where there is a gap, for archives that should have none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content"), strict=True):
                rows: list[dict] = []
                size = 0
                for kind, start, end, what in salvage(content.as_py()):
                    if kind == "record":
                        rows.append({"path": name.as_py(), "start": start, "end": end, **what, **({} if with_payload else {"payload": None})})
                        size += len(what["payload"]) if with_payload else 0
                    elif gaps_fail:
                        raise ValueError(f"{name.as_py()}, bytes {start} to {end}: {what}")
                    if size > 4 << 20 or len(rows) > 5000:
                        yield pa.RecordBatch.from_pylist(rows, _schema(RECORD))
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _schema(RECORD))

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content"), strict=True):
                rows = [{"path": name.as_py(), "start": s, "end": e, "reason": w} for kind, s, e, w in salvage(content.as_py()) if kind == "gap"]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _schema(GAP))

    return files.mapInArrow(records, RECORD), files.mapInArrow(gaps, GAP)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of pages, written as archives and read back.

    One row for each of pages, null and repeated ids included; a gap in what was written fails the query.
    """
    spark, path = pages.sparkSession, folder(pages.sparkSession)
    write(pages, path)
    number = lambda c: F.nullif(F.regexp_extract(F.col(c), r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")
    records, _ = read(spark, path, with_payload=False, gaps_fail=True)
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
