"""WARC archives compressed record by record with an embedded Zstandard dictionary.

Each archive begins with a skippable frame (magic 0x184D2A5D) that holds the
Zstandard-compressed dictionary, built from a bounded sample of the archive's
first records. Every record follows as a Zstandard frame of its own, so it can
be read alone from its offset.
"""
from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle, small_batches
from strata.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D  # fixed value: skippable frame that holds a dictionary
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, sha1: str, first, revisit: bool, date: str) -> bytes:
    head = HTTP_HEAD % len(payload)
    block = head if revisit else head + payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(first)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], max_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary from the sampled records; their plain bytes where there are too few to train on."""
    size = min(max_bytes, sum(map(len, samples)) // 8)
    if size >= 1024 and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples)
        except zstandard.ZstdError:
            pass  # records too alike or too short for the trainer
    return zstandard.ZstdCompressionDict(b"".join(samples)[: max(size, 256)], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Archive:
    """One archive file: records are held back until the dictionary sample is full."""

    def __init__(self, folder: str, sample_records: int, sample_bytes: int, dictionary_bytes: int):
        fs, path = pafs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.limits = (sample_records, sample_bytes, dictionary_bytes)
        self.held: list[bytes] = []
        self.held_bytes = self.raw = self.at = 0
        self.zstd = None
        self.index: list[tuple[int, int]] = []

    def add(self, record: bytes) -> None:
        self.raw += len(record)
        if self.zstd:
            self._put(record)
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if len(self.held) >= self.limits[0] or self.held_bytes >= self.limits[1]:
            self._start()

    def _start(self) -> None:
        dictionary = train(self.held, self.limits[2])
        packed = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
        self.zstd = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
        self.out.write(head)
        self.at = len(head)
        for record in self.held:
            self._put(record)
        self.held = []

    def _put(self, record: bytes) -> None:
        frame = self.zstd.compress(record)
        self.out.write(frame)
        self.index.append((self.at, len(frame)))
        self.at += len(frame)

    def close(self) -> None:
        if not self.zstd:
            self._start()
        self.out.close()


def _writer(folder: str, date: str, archive_bytes: int, sample_records: int, sample_bytes: int, dictionary_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, offsets, lengths = [], [], []
        archive = None

        def finish():
            archive.close()
            names.extend([archive.name] * len(archive.index))
            offsets.extend(o for o, _ in archive.index)
            lengths.extend(n for _, n in archive.index)

        for batch in batches:
            for page_id, url, html, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or _Archive(folder, sample_records, sample_bytes, dictionary_bytes)
                payload = (html or "").encode()
                archive.add(_record(page_id, url, payload, digest(payload), first, bool(revisit), date))
                if archive.raw >= archive_bytes:
                    finish()
                    archive = None
        if archive:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["archive", "offset", "length"])

    return run


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 64 << 20,
    sample_records: int = 1000, sample_bytes: int = 8 << 20, dictionary_bytes: int = 64 << 10, salts: int = 32,
) -> DataFrame:
    """Writes one WARC record per row to archives in ``folder``; returns the index ``archive, offset, length``.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, those with
    the smallest id are responses, the others revisits that refer to it.

    Defined cases: a null payload is empty; a null url gives no target URI; a
    null id sorts after all others and has an empty record name; repeated rows
    of the smallest id are each a response; an empty table gives no archive;
    extra columns are ignored.

    Each task writes its own files under fresh names, and only the index of
    the tasks that Spark committed names them, so that files of lost or repeated
    attempts are never read. A task holds one dictionary sample at a time.
    ``folder`` must be shared; any store that pyarrow's file systems open will do.
    """
    spark = pages.sparkSession
    small_batches(spark)
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    base = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha"), F.octet_length(payload).alias("n"))
    narrow = base.where(F.col("n") >= min_revisit_bytes).select("id", "sha")
    groups = narrow.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    groups = groups.select("sha", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    revisits = (
        narrow.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).join(groups, ["sha", "salt"])
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .select(F.col("id").alias("r_id"), F.col("sha").alias("r_sha"), "first").distinct().withColumn("revisit", F.lit(True)))
    rows = base.join(revisits, base["id"].eqNullSafe(revisits["r_id"]) & (base["sha"] == revisits["r_sha"]), "left")
    write = _writer(folder, date, archive_bytes, sample_records, sample_bytes, dictionary_bytes)
    index = rows.select("id", "url", "payload", "first", "revisit").mapInArrow(write, "archive string, offset long, length long")
    return settle(index, "warc-index")


def _name(value: str):
    return value.strip()[len("<urn:page:"):-1] or None


def _records(stream) -> Iterator[tuple[dict, bytes]]:
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            head[k] = v.strip()
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record isn't closed")
        yield head, block


def open_archive(source) -> io.BufferedReader:
    """A reader over the records of an archive: its dictionary is taken from the leading frame."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(source.read(size), max_output_size=1 << 27))
    return io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True), 1 << 20)


def _reader(folder: str, with_payload: bool):
    fields = [("id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source, open_archive(source) as stream:
                    for head, block in _records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, sha1 = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                        n = int(http.rpartition(b"Content-Length: ")[2])
                        if kind == "response" and (n != len(payload) or sha1 != digest(payload)):
                            raise ValueError(f"a payload of {name} doesn't match its digest")
                        rows.append((_name(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), n, sha1, kind,
                                     _name(head["WARC-Refers-To"]) if kind == "revisit" else None,
                                     payload if with_payload and kind == "response" else None))
                        held += len(block) if with_payload else 0
                        if len(rows) >= 1000 or held >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], [f for f, _ in fields])
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], [f for f, _ in fields])

    return run


def read_warc(index: DataFrame, folder: str, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """Reads the archives that ``index`` names: ``id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Each response is held against its digest; a revisit's size and digest are
    those of the full payload, and its own ``payload`` is null. One archive is
    read by one task as a stream, a record at a time.
    """
    schema = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    archives = index.select("archive").distinct()
    out = archives.mapInArrow(_reader(folder, with_payload), schema)
    return out.select(F.col("id").cast(id_type), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type), "payload")


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Writes ``pages`` to a fresh shared folder and reads the archives back, payloads left out."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_warc(pages, folder, id_col=id_col, **options)
    id_type = pages.schema[id_col].dataType.simpleString()
    return read_warc(index, folder, id_type, with_payload=False).drop("payload", "url").withColumnRenamed("id", id_col)
