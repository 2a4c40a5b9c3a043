"""WARC archives in Zstandard: one frame per record, after a skippable frame with the dictionary.

Writing decides per payload which record is the response (that with the smallest key) and which revisit it, then
every task writes archives of bounded size. Names depend on the partition only and rows are sorted, so a task that
runs again replaces its own files by equal ones. Reading takes each archive's dictionary from its leading skippable
frame, decodes frame by frame, and checks versions, named fields, lengths and digests of every record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.llm.common import part_of

#: Fixed values of the format.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
DATE = "2026-01-01T00:00:00Z"
#: Payload bytes after which a task begins the next archive; pages (about) and bytes (at most) of the dictionary's sample.
ARCHIVE_BYTES, SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 8 << 20, 1_000, 8 << 20, 64 << 10
LEVEL = 3

RECORDS = "record_id string, type string, uri string, payload binary, payload_length long, payload_digest string, refers_to string, path string, error string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def name_of(key: object) -> str:
    return f"urn:page:{'' if key is None else key}"


def record(key: object, url: str | None, payload: bytes, first: object, revisit: bool) -> bytes:
    """A response record, or a revisit whose block is the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or name_of(key))
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{name_of(key)}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target)]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{name_of(first)}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return head + b"\r\n" + block + b"\r\n\r\n"


def dictionary_of(pages: DataFrame, html: str) -> bytes:
    """A dictionary trained on a bounded sample of pages; empty if they are too few to train one."""
    sample, total = [], 0
    for r in part_of(pages.select(html), F.col(html), SAMPLE_PAGES).filter(F.length(html) <= SAMPLE_BYTES // 16).collect():
        data = r[0].encode("utf-8", "surrogatepass")
        if total + len(data) <= SAMPLE_BYTES:
            sample.append(data)
            total += len(data)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write one record per row below `folder` (a URI that all executors reach) and return one row per archive: path,
    records, payload_bytes.

    A null html is an empty payload. Of records with equal payloads of at least `least_bytes` bytes, those with the
    smallest key are responses and the others revisits; null keys are never the smallest unless all are. A null url
    becomes the record's own name. An empty table writes nothing.
    """
    trained = dictionary_of(pages, html)
    shared = pages.sparkSession.sparkContext.broadcast(trained)  # at most DICTIONARY_BYTES
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    firsts = rows.groupBy("sha").agg(F.min("key").alias("first"))
    revisit = (F.octet_length("html") >= least_bytes) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    rows = rows.join(firsts, "sha").select("key", "url", "html", "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, number = TaskContext.get(), 0
        words = shared.value
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words) if words else None, write_content_size=True)
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number, size
            name = f"{root}/part-{task.partitionId():06d}-{number:04d}.warc.zst"
            lead = zstandard.ZstdCompressor(level=LEVEL).compress(words)
            draft = f"{name}.{task.taskAttemptId()}.draft"
            with store.open_output_stream(draft) as out:
                out.write(struct.pack("<II", DICTIONARY_FRAME, len(lead) if words else 0) + (lead if words else b""))
                for r in held:
                    out.write(press.compress(r))
            store.move(draft, name)
            row = pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "payload_bytes": [size]})
            held.clear()
            number, size = number + 1, 0
            return row

        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200).to_pydict()
                for k, u, text, first, again in zip(*part.values()):
                    payload = text.encode("utf-8", "surrogatepass")
                    held.append(record(k, u, payload, first, again))
                    size += len(payload)
                    if size >= ARCHIVE_BYTES:
                        yield close()
        if held:
            yield close()

    ordered = rows.sortWithinPartitions("key", "first", "url")
    return ordered.mapInArrow(run, "path string, records long, payload_bytes long")


def frames(data: memoryview) -> Iterator[bytes]:
    """Contents of the frames of an archive."""
    at, words = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        length = struct.unpack_from("<I", data, 4)[0]
        if 8 + length > len(data):
            raise ValueError("the dictionary's frame is cut off")
        lead, at = bytes(data[8 : 8 + length]), 8 + length
        if lead:
            packed = struct.unpack_from("<I", lead)[0] == ZSTD_FRAME
            words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(lead) if packed else lead)
    opener = zstandard.ZstdDecompressor(dict_data=words)
    while at < len(data):
        frame, parts = opener.decompressobj(), []
        while not frame.eof:
            piece = data[at : at + 16384]
            if not len(piece):
                raise ValueError("a frame is cut off")
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def parsed(data: bytes) -> dict:
    """Fields of a record; `error` says what is wrong with it, else it is null."""
    out: dict = dict.fromkeys(("record_id", "type", "uri", "payload", "payload_length", "payload_digest", "refers_to", "error"))
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        return out | {"error": "no version line"}
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return out | {"error": f"no field: {name[:40]}"}
        fields[name.strip().lower()] = value.strip()
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    out |= {"record_id": bare("warc-record-id"), "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"), "refers_to": bare("warc-refers-to")}
    if missing := [n for n in NEEDED if n not in fields]:
        return out | {"error": f"missing {', '.join(missing)}"}
    length = fields["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"error": f"{len(rest) - 4} bytes, not {length}"}
    block = rest[:-4]
    if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        return out | {"error": "the block has another digest"}
    http, blank, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if not blank or not stated:
        return out | {"error": "no HTTP header with a length"}
    out |= {"payload_length": int(stated[1]), "payload_digest": named}
    if out["type"] == "revisit":
        return out if not payload else out | {"error": "a revisit with a payload"}
    if len(payload) != int(stated[1]):
        return out | {"error": f"{len(payload)} bytes of payload, not {int(stated[1])}"}
    if named not in (None, digest(payload)):
        return out | {"error": "the payload has another digest"}
    return out | {"payload": payload, "payload_digest": digest(payload)}


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives (*.warc.zst) below a folder, see RECORDS. Whatever is wrong with a record
    is named in error; where frames cannot be followed any more, the archive has a last row that says so. Memory is
    bounded by the archives that one task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(n, {"payload": pa.binary(), "payload_length": pa.int64()}.get(n, pa.string())) for n in (x.split()[0] for x in RECORDS.split(", "))])
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                try:
                    for data in frames(memoryview(content.as_buffer())):
                        rows.append(parsed(data) | {"path": path})
                        if len(rows) >= 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=kind)
                            rows = []
                except (ValueError, zstandard.ZstdError, struct.error) as e:
                    rows.append({"path": path, "error": str(e)})
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORDS)
