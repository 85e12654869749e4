"""WARC archives of pages, each compressed by Zstandard with a dictionary of its own.

An archive is a file of Zstandard frames: first a skippable frame with the dictionary,
then a frame for each WARC record, so that one record can be unpacked without the others.
The dictionary is trained on the records of the archive. Spark's text writer puts the
frames into files, which any store takes and whose commit survives lost executors; what it
writes after each row is an empty skippable frame, which decoders pass over.

Pages with the same payload are stored once: one is a ``response`` record, the others are
``revisit`` records that refer to it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import written

#: Payload bytes in an archive, about; a longer page is an archive of its own.
ARCHIVE_BYTES = 32 << 20
#: Payloads below this many bytes are always stored.
REVISIT_BYTES = 100
DICTIONARY_BYTES = 112_640
#: Records that a dictionary is trained on, in bytes: spread evenly over the archive.
SAMPLE_BYTES = 64 * DICTIONARY_BYTES
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n\r\n"

FRAMES = "archive int, seq int, frame binary"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean"
)
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in text.split(", "))])


# --- Records -------------------------------------------------------------------


def record_id(key: int | None) -> str:
    """The id of a page's record: a UUID of version 8 that spells the page's key, so a
    repeated task writes the same record again."""
    bits = 0 if key is None else key & 0xFFFF_FFFF_FFFF_FFFF
    value = bits >> 16 << 80 | 8 << 76 | (bits >> 4 & 0xFFF) << 64 | 2 << 62
    return f"<urn:uuid:{uuid.UUID(int=value | (bits & 0xF) << 58 | (key is None) << 57)}>"


def key_of(text: str | None) -> int | None:
    """The key in a record id; null for the id of a null key and for foreign ids."""
    try:
        value = uuid.UUID((text or "").strip("<>")).int
    except ValueError:
        return None
    ours = value >> 76 & 0xF == 8 and value >> 62 & 3 == 2 and not value & (1 << 57) - 1
    if not ours or value >> 57 & 1:
        return None
    bits = value >> 80 << 16 | (value >> 64 & 0xFFF) << 4 | value >> 58 & 0xF
    return bits - (1 << 64) if bits >> 63 else bits


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return b"".join([head.encode(), BREAK, block, BREAK])


def _uri(url: str) -> str:
    """Blanks and control characters would end a header line."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def page_record(
    key: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str
) -> bytes:
    """A page as one record: a response, or with ``first`` a revisit of that page."""
    fields = [("WARC-Record-ID", record_id(key)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
    kind, block = "response", b"".join([head.encode(), BREAK, payload])
    if first is not None:
        kind, block = "revisit", head.encode() + BREAK
        fields += [("WARC-Refers-To", record_id(first)), ("WARC-Profile", SAME_PAYLOAD)]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return _record(kind, fields, block)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_record(record: bytes) -> dict | None:
    """What a record says of its page; null for records of other kinds. ``payload`` is null
    for a revisit, whose size and digest are those of the page it refers to."""
    head, _, rest = record.partition(BREAK)
    fields = _fields(head)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = rest[: int(fields["content-length"])].partition(BREAK)
    declared = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    row = {
        "page_id": key_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": declared,
        "refers_to": key_of(fields.get("warc-refers-to")),
        "intact": True,
        "payload": None,
    }
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        row |= {
            "payload_digest": found,
            "intact": found == declared and len(payload) == row["payload_bytes"],
            "payload_bytes": len(payload),
            "payload": payload,
        }
    return row


# --- Archives ------------------------------------------------------------------


def train_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of an archive's records; none where they are too few to train on."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample = records[::step]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, sample)) // 8), sample)
    except (zstandard.ZstdError, ValueError):
        return None


def archive_frames(records: list[bytes]) -> Iterator[bytes]:
    """The frames of an archive: its dictionary in a skippable frame, then every record."""
    trained = train_dictionary(records)
    if trained is not None:
        trained.precompute_compress(level=LEVEL)
        packed = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        yield struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    yield from map(compressor.compress, records)


def open_archive(archive: bytes) -> Iterator[bytes]:
    """The records of an archive. A leading dictionary may itself be compressed; other
    skippable frames are passed over."""
    at, piece, decoder = 0, 1 << 14, zstandard.ZstdDecompressor()
    view = memoryview(archive).cast("B")
    while at < len(view):
        if view[at : at + 4] != ZSTD_MAGIC:
            magic, size = struct.unpack_from("<II", view, at)
            if magic >> 4 != 0x184D2A5:
                raise ValueError(f"neither a frame nor a skippable frame at {at}")
            if magic == DICTIONARY_MAGIC and at == 0:
                held = bytes(view[8 : 8 + size])
                if held[:4] == ZSTD_MAGIC:
                    held = zstandard.ZstdDecompressor().decompress(held)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at += 8 + size
            continue
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(view[at : at + piece]))
            at = min(at + piece, len(view)) - len(frame.unused_data)
        yield b"".join(parts)


# --- Tables --------------------------------------------------------------------


def _payloads(pages: DataFrame, id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    return pages.select(
        F.col(id).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )


def _is_revisit() -> Column:
    return F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))


def write_archives(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = DATE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes a record for every page into compressed archives below ``path``.

    Of pages with one payload of ``REVISIT_BYTES`` bytes or more, that with the smallest
    id is stored, the others refer to it; rows that repeat the smallest id are stored too,
    as no record refers to its own id, and so are pages whose ids are all null. A page
    with a null id refers to a page that has one. A null or empty text is an empty
    payload. Record ids come from page ids, so rows that repeat an id repeat its record
    id. Other columns of ``pages`` are left out. An empty table gives no archive.

    Payload digests shrink to one row each before the shuffle, and only repeated ones are
    kept, as a table; it is broadcast only while its size is below Spark's threshold, beyond
    which pages are shuffled to their digest and a hot one is split by adaptive execution.
    A task holds the records of one archive.
    """
    rows = _payloads(pages, id, url, html)
    repeated = written(
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .drop("n"),
        "warc-repeated",
    )
    first = F.when(_is_revisit(), F.col("first")).alias("first")
    labelled = rows.join(repeated, "digest", "left").select("key", "url", "payload", "digest", first)
    schema = _schema(FRAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, records, held = TaskContext.get().partitionId(), 0, [], 0

        def frames() -> pa.RecordBatch:
            note = f"software: tidegauge\r\nformat: WARC File Format 1.1\r\npart: {task}-{archive}\r\n"
            about = [
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, note)}>"),
                ("WARC-Date", date),
                ("Content-Type", "application/warc-fields"),
            ]
            info = _record("warcinfo", about, note.encode())
            made = list(archive_frames([info, *records]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([archive] * len(made), pa.int32()),
                    pa.array(range(len(made)), pa.int32()),
                    pa.array(made, pa.binary()),
                ],
                schema=schema,
            )

        for batch in batches:
            key, url, payload, digest, first = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                body = payload[i].as_buffer().to_pybytes()
                if records and held + len(body) > archive_bytes:
                    yield frames()
                    archive, records, held = archive + 1, [], 0
                records.append(
                    page_record(
                        key[i].as_py(), url[i].as_py(), body, digest[i].as_py(), first[i].as_py(), date
                    )
                )
                held += len(body)
        if records:
            yield frames()

    (
        labelled.mapInArrow(run, FRAMES)
        .sortWithinPartitions("archive", "seq")
        .select("archive", F.col("frame").cast("string").alias("value"))
        .write.partitionBy("archive")
        .option("lineSep", EMPTY_FRAME)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per page record of the archives below ``path``: what :func:`parse_record`
    finds. ``intact`` says that a stored payload has the length and digest of its header.
    Without ``payloads`` they are checked, but stay in the task. A task reads whole
    archives, one after another."""
    fields = RECORDS + (", payload binary" if payloads else "")
    schema = _schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for record in open_archive(archive.as_buffer()):
                    row = parse_record(record)
                    if row is None:
                        continue
                    rows.append({n: row[n] for n in schema.names})
                    held += len(record) if payloads else 0
                    if len(rows) == 10_000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    archives = found.option("pathGlobFilter", "part-*").load(path).select("content")
    return archives.mapInArrow(run, fields)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records read with payloads, a revisit with the payload of the page it refers to;
    null where no archive holds that page. One shuffle of payloads that are referred to."""
    revisits = records.where("record_type = 'revisit'").drop("payload")
    responses = records.where("record_type = 'response'")
    wanted = revisits.select(F.col("refers_to").alias("page_id")).distinct()
    referred = (
        responses.join(wanted, "page_id", "left_semi")
        .dropDuplicates(["page_id", "payload_digest"])
        .select(F.col("page_id").alias("refers_to"), "payload_digest", "payload")
    )
    found = revisits.join(referred, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(found.select(*records.columns))
