"""Web archives: writing records in segments, and putting segments together again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from reachmart.llm.common import join_by, stored

_URN = "<urn:page:%s>"  # a page; what follows a # tells records of one page apart
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ---------------------------------------------------------------------------


def chunked(payload: bytes, size: int) -> bytes:
    """A body in chunks, as HTTP/1.1 frames it."""
    parts = []
    for start in range(0, len(payload), size):
        part = payload[start : start + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def _record(kind: str, record_id: str, block: bytes, **fields: str | int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {_DATE}"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _END.encode() + block


def records(
    page: str | None, url: str | None, payload: bytes, refers_to: str | None, chunk: int, segment: int, row: int = 0
) -> Iterator[bytes]:
    """The records of one page, without the two line ends that close each.

    A block above ``segment`` bytes becomes a response with the first part and
    continuations with the others; the last of them states the length of the whole.
    """
    own = f"<urn:page:{quote(page, safe='')}#{row}>" if page is not None else f"<urn:page#{row}>"
    common = {
        "WARC_Target_URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else None,
        "WARC_Payload_Digest": f"sha1:{digest(payload)}",
        "Content_Type": "application/http; msgtype=response",
    }
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        other = _URN % quote(refers_to, safe="")
        yield _record("revisit", own, head + b"\r\n", WARC_Profile=_REVISIT, WARC_Refers_To=other, **common)
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    if len(block) <= segment:
        yield _record("response", own, block, **common)
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield _record("response", own, parts[0], WARC_Segment_Number=1, **common)
    for number, part in enumerate(parts[1:], 2):
        last = len(block) if number == len(parts) else None
        name = f"{own[:-1]}:segment:{number}>"
        yield _record(
            "continuation", name, part, WARC_Segment_Origin_ID=own, WARC_Segment_Number=number, WARC_Segment_Total_Length=last
        )


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = 0,
    chunk: int = 8_192,
    segment: int = 65_536,
    per_file: int = 10_000,
) -> None:
    """Writes gzip archives with a record per row of ``page_id``, ``url`` and ``html``.

    Of rows with equal payloads of at least ``least`` bytes, that with the largest id is
    written whole and the others as revisits of it. ``per_file`` bounds the records of an
    archive, so that a reader can hold one.

    A null html is an empty payload and a null url is left out. A null id revisits a row
    with an id if there is one; rows that share the largest id are all written whole.
    """
    # Numbered copies of the used columns, whatever else the table has.
    rows = pages.select(
        F.col("page_id").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("key", F.sha2("payload", 256))
    heads = rows.filter(F.octet_length("payload") >= least).groupBy("key")
    heads = heads.agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = join_by(rows, stored(heads, "payloads"), "key", "left")
    other = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    refers = F.when(other, F.col("head").cast("string"))
    named = joined.select(F.col("page_id").cast("string").alias("page"), "url", "payload", refers.alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            out, size = [], 0
            for row in zip(*batch.columns):
                page, url, payload, refers_to = (value.as_py() for value in row)
                number += 1
                for made in records(page, url, payload, refers_to, chunk, segment, number):
                    out.append(made)
                    size += len(made)
                if size > 1 << 25:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    written = named.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    written.write.option("maxRecordsPerFile", per_file).text(path, compression="gzip", lineSep=_END)


# --- reading ---------------------------------------------------------------------------


def dechunk(body: bytes) -> bytes:
    """Takes the chunk framing off; a body that is cut short or malformed is an error."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        text = body[at:end].split(b";", 1)[0].strip()
        if not text or text.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("bad chunk size")
        size = int(text, 16)
        at = end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2
    while True:  # trailers
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("end of chunks is missing")
        if end == at:
            break
        at = end + 2
    return b"".join(parts)


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, without chunk framing."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("HTTP header does not end")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower():
            return dechunk(body)
    return body


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("archive is cut short")
        yield fields, block


def _page(name: str | None) -> str | None:
    inner = (name or "").removeprefix("<urn:page").removesuffix(">").partition("#")[0]
    return unquote(inner[1:]) if inner.startswith(":") else None


def _checked(block: bytes, stated: str | None) -> tuple[int | None, str | None, str | None]:
    """Length and digest of a response's payload, and what is wrong with it."""
    try:
        payload = payload_of(block)
    except ValueError as error:
        return None, None, str(error)
    own = digest(payload)
    return len(payload), own, None if stated in (None, own) else "payload digest differs"


_RECORDS = (
    "page string, kind string, refers string, payload_bytes long, payload_digest string, problem string, "
    "origin string, number int, total long, block binary"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.strip().split(" ")[0] for part in _RECORDS.split(",")]
    texts, numbers = pa.string(), pa.int64()
    types = [texts, texts, texts, numbers, texts, texts, texts, pa.int32(), numbers, pa.binary()]
    for batch in batches:
        for value in batch.column(0):
            raw = value.as_buffer()
            stream = pa.BufferReader(raw) if raw.slice(0, 2).to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
            rows, size = [], 0
            for fields, block in parse(io.BufferedReader(stream)):
                kind = fields.get("warc-type")
                stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                own = fields.get("warc-record-id")
                number = fields.get("warc-segment-number")
                if kind == "revisit":
                    rows.append((_page(own), kind, _page(fields.get("warc-refers-to")), None, stated, *[None] * 5))
                elif number is not None:
                    origin = fields.get("warc-segment-origin-id", own)
                    total = fields.get("warc-segment-total-length")
                    total = int(total) if total else None
                    rows.append((_page(origin), kind, None, None, stated, None, origin, int(number), total, block))
                    size += len(block)
                elif kind == "response":
                    rows.append((_page(own), kind, None, *_checked(block, stated), *[None] * 4))
                if size > 1 << 25:
                    yield _batch(rows, names, types)
                    rows, size = [], 0
            yield _batch(rows, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the parts of each record in order and checks numbers and length."""
    for batch in batches:
        sizes, digests, problems = [], [], []
        for parts, total, stated in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            parts = parts.as_py()
            numbers = [part["number"] for part in parts]
            block = b"".join(part["block"] for part in parts)
            if numbers != list(range(1, len(parts) + 1)):
                found = None, None, "segments are missing or repeated"
            elif total != len(block):
                found = None, None, "total length differs"
            else:
                found = _checked(block, stated)
            for column, value in zip((sizes, digests, problems), found):
                column.append(value)
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(problems, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["page", "payload_bytes", "payload_digest", "problem"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per page of the archives below ``path``: ``page``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` and ``problem``.

    Whole records are decoded where they are read. Segments are grouped by the record they
    continue, whichever archives hold them, put in order, checked against the stated total
    length, and freed of the chunk framing. A revisit gets the length of the response it
    refers to. What does not fit is reported in ``problem``: missing or repeated segments,
    a wrong length or digest, a broken frame, a revisit of nothing. An archive that is cut
    short fails the job. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    found = stored(files.select("content").mapInArrow(_read, _RECORDS), "records")
    whole = found.filter("kind = 'response' and origin is null")
    whole = whole.select("page", "payload_bytes", "payload_digest", "problem")
    parts = found.filter("origin is not null").groupBy("origin").agg(
        F.min("page").alias("page"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max("payload_digest").alias("stated"),
    )
    parts = parts.select("page", "parts", "total", "stated")
    joined = parts.mapInArrow(_assemble, "page string, payload_bytes long, payload_digest string, problem string")
    responses = whole.union(joined)
    revisits = found.filter("kind = 'revisit'").select("page", F.col("refers").alias("target"), "payload_digest")
    targets = responses.filter("page is not null and problem is null").groupBy(F.col("page").alias("target"))
    targets = targets.agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("of"))
    resolved = join_by(revisits, targets, "target", "left")
    problem = F.when(F.col("of").isNull(), "revisit of nothing")
    problem = problem.when(F.col("of") != F.col("payload_digest"), "payload digest differs")
    none = F.lit(None).cast("string")
    return responses.select(
        "page", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), none.alias("refers_to"), "problem"
    ).union(
        resolved.select(
            "page", "payload_bytes", "payload_digest", F.lit("revisit"), F.col("target"), problem.alias("problem")
        )
    )
