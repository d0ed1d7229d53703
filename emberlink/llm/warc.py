"""Web archives: pages written as WARC records, and payloads put together again from segments.

**Writing.** A page is an HTTP response in chunked transfer framing. Of pages with equal payloads of
at least ``REVISIT_BYTES`` bytes, the one with the largest id is a ``response``, the others are
``revisit`` records that refer to it and carry no payload. A block of more than ``SEGMENT_BYTES``
bytes is cut, wherever the cut falls, into a first record and ``continuation`` records, which name
their origin and their number; the last one names the total length. Every record is a gzip member
of its own. Tasks write archives under names of their own into the shared folder and report them in
a manifest; only what the manifest of a finished job names is read, so a task that runs again does no
harm. Segments go to archives of their own, so that whole records are not read twice.

**Reading.** Blocks of archives are dealt to tasks, which stream through them record by record. Whole
records are decoded on the spot. Segments meet by their origin, wherever they lie; they are put in order
of their numbers, and the result must have every number from 1, and the total length. Then the chunk
framing is undone and the payload held against the record's digest. Only segments are shuffled.

Folders are opened with ``pyarrow.fs``: local or mounted folders, HDFS, S3 and GCS.

Defined results: null html is an empty payload. A null url gives a record without target; one with
control characters is percent-encoded and decoded. Rows with a null ``page_id`` have a
record without an id; they revisit an equal payload of a page with an id, and else are responses.
Rows with one id and one payload (repeated rows) are alike: if it is the largest id, all are responses.
What cannot be read has no payload and says why in ``problem``: ``truncated`` (a record ends early),
``segments`` (one is missing, double, or the total differs), ``framing`` (head or chunks are broken) or
``digest``. Extra columns are not read. An empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
from pyarrow import fs as filesystems
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from emberlink.llm.common import cut_lineage, scratch_dir, table

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16_384  # of a block; longer ones are cut
CHUNK_BYTES = 4096
BLOCK_BYTES = 1 << 20  # of an archive that one task reads at a time, roughly
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 16 << 20  # of archives a task reads, roughly
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_TO_WRITE = ["page_id", "url", "digest", "payload", "refers_to", "known"]
_MANIFEST = "path string, offset long, length long, segmented boolean, digest string, record_id string"
_RECORD = "record_id string, record_type string, page_id long, uri string, refers_to string, digest string, origin string, number int, total long, block binary, problem string, alone boolean"


# ---- framing ------------------------------------------------------------------------------


def frame(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """An HTTP response with ``payload`` in chunks."""
    chunks = [payload[i : i + size] for i in range(0, len(payload), size)]
    body = b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in chunks)
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + body + b"0\r\n\r\n"


def unframe(block: bytes) -> bytes | None:
    """The payload of an HTTP response, or None if its head or its chunks are broken."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        return None
    if not re.search(rb"\r\ntransfer-encoding:[^\r]*\bchunked[ \t]*(\r\n|$)", head, re.IGNORECASE):
        return body
    parts, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]+)[ \t]*(;.*)?", body[at:stop], re.DOTALL) if stop >= 0 else None
        if not size:
            return None
        n, at = int(size[1], 16), stop + 2
        if n == 0:
            # Trailers may follow the last chunk; an empty line ends it all.
            return b"".join(parts) if body.startswith(b"\r\n", at) or body.find(b"\r\n\r\n", at) >= 0 else None
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        parts.append(body[at : at + n])
        at += n + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes] | None]:
    """(fields in lower case, block) of each record of a decompressed archive; None where one ends early."""
    while True:
        try:
            line = stream.readline()
            while line in (b"\r\n", b"\n"):
                line = stream.readline()
            if not line:
                return
            fields: dict[str, str] = {}
            version = line
            while (line := stream.readline()) not in (b"\r\n", b"\n"):
                if not line.endswith(b"\n"):
                    raise EOFError
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            size = int(fields["content-length"])
            block = stream.read(size)
            if not version.startswith(b"WARC/") or len(block) < size:
                raise EOFError
        except (EOFError, OSError, KeyError, ValueError):
            yield None  # nothing behind this place can be told apart
            return
        yield fields, block


# ---- writing ------------------------------------------------------------------------------


def page_records(record_id: str, page_id: str | None, url: str | None, digest: str, payload: bytes | None, refers_to: str | None, date: str, segment: int) -> list[bytes]:
    """The records of one page: one, or a first one and its continuations. ``payload`` is None for a revisit."""
    fields = [("WARC-Date", date), ("Content-Type", "application/http; msgtype=response")]
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    if url is not None and (_CONTROL.search(url) or url != url.strip()):
        fields += [("WARC-Target-URI", quote(url, safe="")), ("Target-URI-Escaped", "yes")]
    elif url is not None:
        fields.append(("WARC-Target-URI", url))
    if payload is None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>"), *fields], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = frame(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(pieces) > 1:
        fields.append(("WARC-Segment-Number", "1"))
    out = [record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>"), *fields], pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        more = [("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", str(number))]
        if number == len(pieces):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}.{number}>"), *more], piece))
    return out


class _Archive:
    """One task's open archive of a kind, and the blocks it has written."""

    def __init__(self, folder: str, segmented: bool) -> None:
        self.files, self.folder = filesystems.FileSystem.from_uri(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.segmented, self.stream, self.blocks = segmented, None, []

    def write(self, data: bytes) -> None:
        if self.stream is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            self.stream, self.size, self.begin = self.files.open_output_stream(self.path, compression=None), 0, 0
        member = gzip.compress(data, 5, mtime=0)
        self.stream.write(member)
        self.size += len(member)
        if self.size - self.begin >= BLOCK_BYTES:
            self._end_block()
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def _end_block(self) -> None:
        if self.size > self.begin:
            self.blocks.append((self.path, self.begin, self.size - self.begin, self.segmented, None, None))
            self.begin = self.size

    def close(self) -> None:
        if self.stream is not None:
            self._end_block()
            self.stream.close()
            self.stream = None


def _write(rows: DataFrame, folder: str, date: str, segment: int) -> DataFrame:
    """The manifest of records for ``rows`` (``_TO_WRITE``).

    Beside blocks, it holds the record ids of rows that are ``known`` to be referred to.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archives = {kind: _Archive(folder, kind) for kind in (False, True)}
        task, made, known = uuid.uuid4(), 0, []
        try:
            for batch in batches:
                for page_id, url, digest, payload, refers_to, is_known in zip(*(batch[c] for c in _TO_WRITE)):
                    record_id = uuid.uuid5(task, str(made)).urn
                    made += 1
                    page = page_records(record_id, page_id, url, digest, payload, refers_to, date, segment)
                    for part in page:
                        archives[len(page) > 1].write(part)
                    if is_known:
                        known.append((None, None, None, None, digest, record_id))
        finally:
            for archive in archives.values():
                archive.close()
        yield pd.DataFrame([*archives[False].blocks, *archives[True].blocks, *known], columns=["path", "offset", "length", "segmented", "digest", "record_id"], dtype=object)

    # Ids as strings: pandas would make numbers with gaps inexact.
    texts = rows.withColumn("page_id", F.col("page_id").cast("string")).select(*_TO_WRITE)
    return cut_lineage(texts.mapInPandas(write, _MANIFEST), "warc-manifest")


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES, segment: int = SEGMENT_BYTES
) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) below ``folder``; the blocks to read (``path``, ``offset``, ``length``, ``segmented``)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    long = keyed.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("kept_id"), F.count("*").alias("n"))
    shared = cut_lineage(long.where("n > 1 and kept_id is not null").select("digest", "kept_id"), "warc-shared")
    judged = keyed.join(shared, "digest", "left").withColumn("again", F.expr("kept_id is not null and (page_id is null or page_id < kept_id)"))
    none = F.lit(None).cast("string")
    responses = judged.where("not again").select("page_id", "url", "digest", "payload", none.alias("refers_to"), F.expr("kept_id is not null").alias("known"))
    written = _write(responses, folder, date, segment)
    targets = written.where("record_id is not null").groupBy("digest").agg(F.min("record_id").alias("refers_to"))
    again = judged.where("again").select("page_id", "url", "digest").join(targets, "digest")
    revisits = again.select("page_id", "url", "digest", F.lit(None).cast("binary").alias("payload"), "refers_to", F.lit(False).alias("known"))
    blocks = written.unionByName(_write(revisits, folder, date, segment)).where("path is not null")
    return blocks.select("path", "offset", "length", "segmented")


# ---- reading ------------------------------------------------------------------------------


def _bare(name: str | None) -> str | None:
    return name.strip("<>") if name is not None else None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?\d+", text) else None


def _row(fields: dict[str, str], block: bytes) -> tuple:
    digest = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(digest[5:]).hex() if re.fullmatch("sha1:[A-Z2-7]{32}", digest) else None
    uri = fields.get("warc-target-uri")
    uri = unquote(uri) if uri is not None and fields.get("target-uri-escaped") else uri
    return (
        _bare(fields.get("warc-record-id")), fields.get("warc-type"), _number(fields.get("page-id")), uri, _bare(fields.get("warc-refers-to")), digest,
        _bare(fields.get("warc-segment-origin-id")), _number(fields.get("warc-segment-number")), _number(fields.get("warc-segment-total-length")), block, None,
    )


def _read(blocks: DataFrame) -> DataFrame:
    """The records of blocks, as they are."""
    size = blocks.agg(F.sum(F.coalesce("length", F.lit(BLOCK_BYTES)))).first()[0] or 0
    dealt = blocks.select("path", "offset", "length", "segmented").repartition(max(1, int(size) // READ_BYTES), "path", "offset")
    columns = [c.split()[0] for c in _RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, offset, length, alone in zip(*(batch[c] for c in ("path", "offset", "length", "segmented"))):
                files, place = filesystems.FileSystem.from_uri(path)
                with files.open_input_file(place) as file:
                    file.seek(int(offset))
                    raw = io.BytesIO(file.read(int(length))) if pd.notna(length) else file
                    held, weight = [], 0
                    with gzip.GzipFile(fileobj=raw) as stream:
                        for found in records_of(io.BufferedReader(stream, 1 << 16)):
                            held.append(((None,) * 10 + ("truncated",) if found is None else _row(*found)) + (alone,))
                            weight += len(held[-1][9] or b"")
                            if weight >= BLOCK_BYTES:
                                yield pd.DataFrame(held, columns=columns, dtype=object)
                                held, weight = [], 0
                    yield pd.DataFrame(held, columns=columns, dtype=object)

    return dealt.mapInPandas(read, _RECORD)


def _decoded(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    payload = unframe(block)
    if payload is None:
        return None, "framing"
    if digest is not None and hashlib.sha1(payload).hexdigest() != digest:
        return None, "digest"
    return payload, None


def joined(numbers: list[int | None], totals: list[int | None], blocks: list[bytes]) -> bytes | None:
    """The block that segments make up, or None if one is missing, double or the total length differs."""
    if None in numbers:
        return None
    order = np.argsort(numbers)
    total = [t for t in totals if t is not None]
    block = b"".join(blocks[i] for i in order)
    complete = [numbers[i] for i in order] == list(range(1, len(order) + 1)) and total == [len(block)] and totals[order[-1]] is not None
    return block if complete else None


_FOUND = StructType([StructField("payload", BinaryType()), StructField("problem", StringType())])


@F.pandas_udf(_FOUND)
def _decode(blocks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for block, digest in blocks:
        yield pd.DataFrame([(None, None) if b is None else _decoded(b, d) for b, d in zip(block, digest)], columns=["payload", "problem"], dtype=object)


@F.pandas_udf(_FOUND)
def _assemble(groups: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for segments, digest in groups:
        out = []
        for parts, d in zip(segments, digest):
            block = joined([p["number"] for p in parts], [p["total"] for p in parts], [p["block"] for p in parts])
            out.append((None, "segments") if block is None else _decoded(block, d))
        yield pd.DataFrame(out, columns=["payload", "problem"], dtype=object)


_READ = ["record_id", "record_type", "page_id", "uri", "refers_to", "payload", "problem"]


def read_archives(blocks: DataFrame) -> DataFrame:
    """Logical records: ``record_id``, ``record_type``, ``page_id``, ``uri``, ``refers_to`` (a record), ``payload``, ``problem``.

    ``blocks`` names what to read: ``path``, ``offset``, ``length`` (null: to the end) and ``segmented``
    (whether it holds segments only; null if that is not known). Blocks begin where a record begins. A
    revisit has no payload of its own.
    """
    plain = _read(blocks.where("not coalesce(segmented, false)")).where("number is null")
    has_payload = F.expr("record_type <=> 'response' and problem is null")
    whole = plain.withColumn("found", _decode(F.when(has_payload, F.col("block")), "digest"))
    whole = whole.withColumns({"payload": F.col("found.payload"), "problem": F.coalesce("problem", "found.problem")}).select(*_READ)
    # Where an archive holds segments only, nobody else reports what ends early: one row without an id does.
    parts = _read(blocks.where("coalesce(segmented, true)")).where("number is not null or (problem is not null and alone)")
    grouped = parts.groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
        *[F.max(c).alias(c) for c in ("page_id", "uri", "refers_to", "digest")],
        F.collect_list(F.struct("number", "total", "block")).alias("segments"),
        F.max("problem").alias("problem"),
    )
    whole_again = grouped.withColumn("found", _assemble("segments", "digest"))
    return whole.unionByName(whole_again.withColumns({"payload": F.col("found.payload"), "problem": F.coalesce("problem", "found.problem")}).select(*_READ))


def op12_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` as WARC records, read back from the archives."""
    blocks = write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    read = read_archives(blocks).select(
        "record_id", "record_type", "page_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    read = cut_lineage(read, "warc-read")
    whole = read.where("record_type = 'response'")
    target = whole.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"), "payload_bytes", "payload_digest")
    again = read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(target, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return whole.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(again.select(*columns, F.col("target").alias("refers_to")))


OP12_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND kept IS NOT NULL AND coalesce(page_id < kept, true) AS again FROM k)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to FROM r
"""
