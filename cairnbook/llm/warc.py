"""WARC archives compressed with Zstandard: writing with revisit records, and a validating reader.

An archive is one skippable frame (magic 0x184D2A5D) that holds the dictionary, then one frame per record. The reader
takes archives as rows (name, content), such as ``spark.read.format("binaryFile")`` gives them, loads the dictionary from
the leading frame (plain or itself compressed), decodes frame by frame, and checks each record: version line, header
fields, Content-Length against the block, the closing line ends, block and payload digests, and the length that the
stored HTTP header states. What a record fails is named in its ``error``.

Of pages with equal payloads of ``min_bytes`` or more, the one with the smallest page_id is written as response and the
others as revisits that refer to it. Digests are compared in a shuffle of their own, without payloads, and those that
occur more than once are sent to the pages, if they are few enough.

Null html is an empty payload; a null url has no WARC-Target-URI; pages with null ids are always responses. Pages with
one id and equal payload are all responses if that id is the smallest. An empty table gives no archives, and no records.
Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, prepare, sent_if_small

SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Raw bytes of records in one archive; records that train its dictionary, their bytes at most, and its size.
ARCHIVE_BYTES = 16 << 20
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 1 << 20, 32 << 10
LEVEL = 3


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One record; a revisit of ``first`` unless that is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if first is not None:
        fields += [("WARC-Refers-To", name(first)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The bytes of an archive with a dictionary trained on its first records, where they are enough to train one."""
    samples, size = [], 0
    for r in records[:SAMPLES]:
        part = r[: SAMPLE_BYTES // SAMPLES * 4]
        if size + len(part) > SAMPLE_BYTES:
            break
        samples.append(part)
        size += len(part)
    trained, lead = None, b""
    if len(samples) >= 16 and size > 8 * DICTIONARY_BYTES:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
        except zstandard.ZstdError:
            trained = None
    if trained is not None:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        lead = struct.pack("<II", DICTIONARY, len(body)) + body
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    return lead + b"".join(compressor.compress(r) for r in records)


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, one for each record."""
    at, trained = 0, None
    view = memoryview(content)
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY:
        size = struct.unpack_from("<I", content, 4)[0]
        body = content[8 : 8 + size]
        if len(body) < size:
            raise ValueError("the dictionary frame is cut off")
        if body[:4] == FRAME:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        trained, at = zstandard.ZstdCompressionDict(body), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    while at < len(content):
        if at + 8 <= len(content) and struct.unpack_from("<I", content, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            part = view[at : at + 8192]
            if not part:
                raise ValueError("the last frame is cut off")
            out.append(frame.decompress(part))
            at += len(part)
        at -= len(frame.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> dict:
    """The fields of a record, checked; ``error`` names the first thing wrong."""
    out = {"page_id": None, "url": None, "record_type": None, "payload_bytes": None, "payload_digest": None, "refers_to": None, "payload": None, "error": None}

    def wrong(what: str) -> dict:
        return out | {"error": what}

    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        return wrong("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        key, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return wrong("a header line without a colon")
        fields[key.strip().lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            return wrong(f"no {key}")
    page = lambda x: int(x[10:-1]) if x.startswith("<urn:page:") and x[10:-1] else None
    out |= {"record_type": fields["warc-type"], "page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri")}
    out |= {"refers_to": page(fields.get("warc-refers-to", "")), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        return wrong("Content-Length and block differ")
    block = rest[:-4]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        return wrong("block digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    stated = [x.split(b":")[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not found or len(stated) != 1 or not stated[0].isdigit():
        return wrong("no HTTP header")
    out["payload_bytes"] = int(stated[0])
    if out["record_type"] == "response":
        if len(payload) != out["payload_bytes"]:
            return wrong("HTTP length and payload differ")
        if digest(payload) != out["payload_digest"]:
            return wrong("payload digest differs")
        out["payload"] = payload
    elif out["record_type"] != "revisit" or payload:
        return wrong("not a response or an empty revisit")
    return out


def written(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives (name, content) of pages (page_id, url, html, first); ``first`` is null for responses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, records, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            row = pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{number:04d}.warc.zst"]), pa.array([archive(records)], pa.binary())], ["name", "content"])
            records.clear()
            number, size = number + 1, 0
            return row

        for batch in batches:
            for page_id, url, html, first in zip(*batch.columns, strict=True):
                made = record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), first.as_py())
                records.append(made)
                size += len(made)
                if size >= archive_bytes:
                    yield flush()
        if records:
            yield flush()

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), F.col("first").cast("long")).mapInArrow(run, "name string, content binary")


_COLUMNS = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "refers_to": pa.int64(), "payload": pa.binary(), "error": pa.string(),
}


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archives (content): page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                size = 0

                def flush() -> pa.RecordBatch:
                    made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in _COLUMNS.items()], list(_COLUMNS))  # noqa: B023
                    rows.clear()  # noqa: B023
                    return made

                try:
                    for data in frames(content.as_py()):
                        row = parse(data)
                        size += len(row["payload"] or b"") if payloads else 0
                        rows.append(row if payloads else row | {"payload": None})
                        if size > 4 << 20 or len(rows) >= 1000:
                            yield flush()
                            size = 0
                except (ValueError, zstandard.ZstdError, zlib.error) as e:
                    rows.append(dict.fromkeys(_COLUMNS) | {"error": str(e)})
                if rows:
                    yield flush()

    return archives.select("content").mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, error string")


def with_first(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """pages with ``first``: the page_id that a page's payload is already stored under, null for responses."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    pages = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size"))
    firsts = pages.groupBy("sha").agg(F.min("page_id").alias("least"), F.count("*").alias("n"), F.max("size").alias("size"))
    firsts = firsts.where((F.col("n") > 1) & (F.col("size") >= min_bytes)).select("sha", "least")
    joined = pages.join(sent_if_small(scratch.keep(firsts, "firsts")), "sha", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") > F.col("least"), F.col("least")).alias("first"))


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    prepare(spark)
    scratch = Scratch(spark, "warc")
    archives = scratch.keep(written(with_first(pages, scratch)), "archives", compression="uncompressed")
    return read(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")
