"""WARC archives of Zstandard frames: a dictionary in a leading skippable frame, one frame a record."""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.sizes import shared_folder
from shelfwise.llm.common import Work, hint_if_small

#: the skippable frame that holds a dictionary, and the magic numbers of frames and dictionaries
DICTIONARY_FRAME = 0x184D2A5D
FRAME, DICTIONARY = 0xFD2FB528, 0xEC30A437
#: equal payloads of at least this many bytes are stored once
REVISIT_BYTES = 1000
#: payload bytes of an archive, before compression; a larger record has an archive of its own size
ARCHIVE_BYTES = 32 << 20
#: what an archive's dictionary is trained on: its first records, up to so many bytes
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = dt.datetime(2001, 11, 4, tzinfo=dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_BREAK = b"\r\n"


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def _clean(value: str) -> str:
    """A header's value on one line."""
    return re.sub(r"[\r\n\x00]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers: int | None) -> bytes:
    """One WARC/1.1 record. A revisit holds the response's header block without its payload."""
    kind = "response" if refers is None else "revisit"
    own = payload if refers is None else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = hashlib.sha1(http)
    block.update(own)
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid5(_NAMESPACE, sha1)}>"),
        ("WARC-Date", _DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(block.digest()).decode()}"),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if refers is not None:
        fields += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", record_id(refers)),
            ("WARC-Refers-To-Page-ID", str(refers)),
        ]
    fields.append(("Content-Length", str(len(http) + len(own))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return b"".join([head.encode("utf-8", "surrogatepass"), http, own, _BREAK * 2])


class Broken(ValueError):
    """An archive that does not hold what its headers and lengths say."""


def parse(data: bytes) -> dict:
    """The checked fields of one record: headers, kind, size and digest of the payload."""
    head, found, rest = data.partition(_BREAK * 2)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise Broken(f"no WARC header: {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Broken(f"no header field: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise Broken(f"a record without {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 2 * len(_BREAK) or rest[length:] != _BREAK * 2:
        raise Broken(f"{fields['warc-record-id']}: block of {len(rest) - 4} bytes instead of {length}")
    block = rest[:length]
    _check_digest(fields, "warc-block-digest", block)
    http, found, payload = block.partition(_BREAK * 2)
    if not found:
        raise Broken(f"{fields['warc-record-id']}: no HTTP header")
    size = next((int(x.partition(b":")[2]) for x in http.split(_BREAK) if x.lower().startswith(b"content-length:")), -1)
    if fields["warc-type"] == "response":
        if size != len(payload):
            raise Broken(f"{fields['warc-record-id']}: payload of {len(payload)} bytes instead of {size}")
        _check_digest(fields, "warc-payload-digest", payload)
    elif fields["warc-type"] != "revisit" or payload:
        raise Broken(f"{fields['warc-record-id']}: a {fields['warc-type']} with a payload of {len(payload)} bytes")
    return {"fields": fields, "payload": payload, "size": size}


def _check_digest(fields: dict, name: str, data: bytes) -> None:
    if fields.get(name) != "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode():
        raise Broken(f"{fields['warc-record-id']}: {name} is not that of its bytes")


def compress(records: list[bytes]) -> Iterator[bytes]:
    """An archive's bytes: the dictionary's skippable frame, then a frame for each record."""
    sample, total = [], 0
    for data in records:
        if total >= SAMPLE_BYTES:
            break
        sample.append(data[: 64 << 10])
        total += len(sample[-1])
    dictionary = None
    try:
        if len(sample) >= 16:
            dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), sample)
    except zstandard.ZstdError:
        pass  # too little or too uniform a sample: an archive without a dictionary
    packer = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True
    )
    if dictionary is not None:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        yield struct.pack("<II", DICTIONARY_FRAME, len(body)) + body
    for data in records:
        yield packer.compress(data)


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that begins at a place ends, from its header and those of its blocks."""
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    size = (single, 2, 4, 8)[flags >> 6] + (0, 1, 2, 4)[flags & 3] + (not single)
    at += 5 + size
    last = False
    while not last:
        head = int.from_bytes(data[at : at + 3], "little")
        if at + 3 > len(data):
            raise Broken(f"the frame is cut short at byte {at}")
        last, kind, length = head & 1, head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else length)
    at += 4 * checksum
    if at > len(data):
        raise Broken(f"the frame is cut short before byte {at}")
    return at


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive; each is one whole frame, read with the archive's dictionary."""
    view, at, dictionary = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        length = struct.unpack_from("<I", data, 4)[0]
        at = 8 + length
        if at > len(data):
            raise Broken("the dictionary's frame is cut short")
        body = bytes(view[8:at])
        magic = struct.unpack_from("<I", body)[0] if len(body) >= 4 else 0
        if magic == FRAME:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            magic = struct.unpack_from("<I", body)[0] if len(body) >= 4 else 0
        if magic != DICTIONARY:
            raise Broken("the leading frame holds no dictionary")
        dictionary = zstandard.ZstdCompressionDict(body)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if len(data) - at < 5 or struct.unpack_from("<I", data, at)[0] != FRAME:
            raise Broken(f"no frame at byte {at}")
        end = frame_end(data, at)
        reader = unpacker.decompressobj()
        try:
            out = reader.decompress(view[at:end])
        except zstandard.ZstdError as e:
            raise Broken(f"the frame at byte {at}: {e}") from e
        if not reader.eof or reader.unused_data:
            raise Broken(f"the frame at byte {at} does not end where its blocks do")
        at = end
        yield out


def classified(pages: DataFrame, work: Work) -> DataFrame:
    """page_id, url, html, size, sha1 and refers_to (null for responses) of each row of pages.

    Of rows with equal payloads of at least REVISIT_BYTES bytes the one with the largest
    page_id is the response. Digests are grouped with their largest id on the map side; only
    those with several rows are joined back, on the digest. Null ids are smaller than all others; of
    rows that share the largest id too, all are responses.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    seen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload).alias("sha1"),
    )
    large = seen.filter(F.col("size") >= REVISIT_BYTES).select("page_id", "sha1")
    groups = large.groupBy("sha1").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = hint_if_small(groups.filter("n > 1 AND first IS NOT NULL").select("sha1", "first"), work)
    joined = seen.join(shared, "sha1", "left")
    again = (F.col("size") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(again, F.col("first"))).drop("first")


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(pages: DataFrame, folder: str, work: Work) -> DataFrame:
    """Write all rows of pages as archives in folder, which all executors reach; name, records and bytes of each.

    A task cuts its rows into archives of ARCHIVE_BYTES. An archive is written under a
    name of its task's attempt and moved to its own name when it is whole, so a repeated or
    lost task leaves no half archive under that; as rows are sorted within a task, it
    writes the same archives again.
    """
    rows = classified(pages, work).select("page_id", "url", "html", "size", "sha1", "refers_to")
    # a repeated task cuts the same archives only if its rows come in the same order
    rows = rows.sortWithinPartitions("page_id", "sha1", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        task = TaskContext.get()
        number = 0

        def close(records: list[bytes]) -> pa.RecordBatch:
            nonlocal number
            name = f"part-{task.partitionId():06d}-{number:05d}.warc.zst"
            number += 1
            rough = posixpath.join(base, f"_rough-{task.taskAttemptId()}-{name}")
            with files.open_output_stream(rough, compression=None) as out:
                total = sum(out.write(part) or len(part) for part in compress(records))
            files.move(rough, posixpath.join(base, name))
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(records)], "bytes": [total]})

        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                data = record(
                    row["page_id"],
                    row["url"],
                    row["html"].encode("utf-8", "surrogatepass"),
                    row["size"],
                    row["sha1"],
                    row["refers_to"],
                )
                held.append(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return rows.mapInArrow(run, "archive string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives in folder, in any order; an archive is read by one task.

    Headers, lengths, digests and frames are checked; what does not hold raises Broken. A
    revisit's size and digest are those of its response's payload, its payload is null.
    """
    names = "page_id url record_id record_type payload_bytes payload_digest refers_to payload".split()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                held, size = [], 0
                for raw in frames(data):
                    found = parse(raw)
                    fields = found["fields"]
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
                    revisit = fields["warc-type"] == "revisit"
                    payload = found["payload"] if payloads and not revisit else None
                    held.append(
                        (
                            page and int(page),
                            fields.get("warc-target-uri"),
                            fields["warc-record-id"],
                            fields["warc-type"],
                            found["size"],
                            digest,
                            refers and int(refers),
                            payload,
                        )
                    )
                    size += len(raw)
                    if size > 8 << 20:
                        yield _frame(held, names)
                        held, size = [], 0
                if held:
                    yield _frame(held, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    schema = (
        "page_id long, url string, record_id string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, payload binary"
    )
    return files.select("content").mapInPandas(run, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "payload_bytes", "refers_to"):
        frame[name] = pd.array([None if v is None else v for v in (r[names.index(name)] for r in rows)], dtype="Int64")
    return frame


def archive_folder(spark: SparkSession) -> str:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return folder


def round_trip(pages: DataFrame, work: Work) -> DataFrame:
    """Write pages as archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = archive_folder(spark)
    written = write_archives(pages, folder, work).agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    found = read_archives(spark, folder, payloads=False)
    found = work.keep(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    if (read := found.count()) != written:
        raise Broken(f"{read} records read of {written} written")
    return found
