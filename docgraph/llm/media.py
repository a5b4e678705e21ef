"""Media columns: a Spark data source over directories of archives.

Texts become payloads (UTF-8 and bytes 0 up to a positive multiple of 64), stored losslessly as PNG images of 8-bit
grey samples, 64 to a row. Writing `media_archive` packs them, one file a task, with an index of offsets beside it;
a manifest, written on commit, names the files of the tasks that succeeded, so what a lost or repeated task left is
never read. Reading plans byte-range partitions over the archives: a member belongs to the range that its offset is
in. A range is read in one request; a member that fails its checksum is read again by its own offset, apart from
the others, and one that never succeeds gives a row with its error instead of failing the partition.
"""

from __future__ import annotations

import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import scratch, table
from .lines import texts

WIDTH = 64
PNG = b"\x89PNG\r\n\x1a\n"
LEVEL = 5
SCHEMA = "doc_id long, n_bytes long, media binary, error string"
MANIFEST = "_manifest.json"
RANGE_BYTES = 8 << 20
ATTEMPTS = 4
BATCH_BYTES = 4 << 20


def payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(data: bytes) -> bytes:
    """PNG, 8-bit grey, each row with filter 0."""
    samples = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)
    rows[:, 1:] = samples
    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)) + chunk(b"IEND", b"")


def decode(media: bytes) -> np.ndarray:
    """The samples, a row each of the image's width."""
    assert media[:8] == PNG, "not a PNG"
    at, data, width = 8, b"", 0
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + size]
        assert zlib.crc32(kind + body) == struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0], "damaged chunk"
        if kind == b"IHDR":
            width = struct.unpack(">I", body[:4])[0]
        elif kind == b"IDAT":
            data += body
        at += size + 12
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(-1, width + 1)[:, 1:]


def features(samples: np.ndarray) -> str:
    """Mean, deviation and entropy of the samples, and a bit for each column brighter than the mean."""
    counts = np.bincount(samples.ravel(), minlength=256)
    share = counts[counts > 0] / samples.size
    mean = float(counts @ np.arange(256)) / samples.size
    deviation = float(np.sqrt(max(0.0, float(counts @ (np.arange(256) ** 2)) / samples.size - mean * mean)))
    bright = samples.sum(axis=0, dtype=np.int64) * samples.shape[1] > samples.sum(dtype=np.int64)
    return f"{mean:.4f} {deviation:.4f} {float(-(share * np.log2(share)).sum()):.4f} {np.packbits(bright).tobytes().hex()}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@dataclass
class Range(InputPartition):
    archive: str
    low: int
    high: int


@dataclass
class Packed(WriterCommitMessage):
    archive: str | None
    size: int = 0
    members: int = 0


def read_index(files: fs.FileSystem, path: str) -> dict:
    with files.open_input_file(f"{path}.index") as f:
        return json.loads(zlib.decompress(f.read()))


class MediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range_bytes = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        self.attempts, self.wait = int(options.get("attempts", ATTEMPTS)), float(options.get("wait", 0.2))

    def partitions(self) -> list[Range]:
        files, path = opened(self.path)
        with files.open_input_file(f"{path}/{MANIFEST}") as f:
            archives = json.loads(f.read())
        return [Range(name, low, min(size, low + self.range_bytes)) for name, size in archives for low in range(0, size, self.range_bytes)] or [Range("", 0, 0)]

    def read_at(self, files: fs.FileSystem, path: str, offset: int, size: int) -> bytes:
        with files.open_input_file(path) as f:
            return f.read_at(size, offset)

    def member(self, files, path: str, offset: int, size: int, crc: int, first: bytes | None) -> tuple[bytes | None, str | None]:
        """The bytes as first read if they are whole; otherwise read again by offset. Or None and the error."""
        error = ""
        for attempt in range(self.attempts):
            try:
                got = first if attempt == 0 and first is not None else self.read_at(files, path, offset, size)
                if len(got) == size and zlib.crc32(got) == crc:
                    return got, None
                error = f"checksum at offset {offset}"
            except OSError as e:
                error = str(e)
            if attempt and attempt + 1 < self.attempts:
                time.sleep(self.wait * 2**attempt)
        return None, error

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        files, folder = opened(self.path)
        path = f"{folder}/{partition.archive}"
        index = read_index(files, path)
        first, last = np.searchsorted(index["offset"], [partition.low, partition.high])
        rows: list[tuple] = []
        for k in range(first, last):
            if not rows:  # one request for the members of a batch
                stop = k
                while stop < last and index["offset"][stop] + index["size"][stop] - index["offset"][k] <= BATCH_BYTES:
                    stop += 1
                stop, base = max(stop, k + 1), index["offset"][k]
                try:
                    block = self.read_at(files, path, base, index["offset"][stop - 1] + index["size"][stop - 1] - base)
                except OSError:
                    block = None
            offset, size = index["offset"][k], index["size"][k]
            media, error = self.member(files, path, offset, size, index["crc"][k], None if block is None else block[offset - base : offset - base + size])
            rows.append((index["doc_id"][k], index["n_bytes"][k], media, error))
            if k + 1 == stop:
                yield self.batch(rows)
                rows = []

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "media", "error"])


class MediaWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Packed:
        files, folder = opened(self.path)
        name, at = f"{uuid.uuid4().hex}.media", 0
        index: dict[str, list] = {"doc_id": [], "n_bytes": [], "offset": [], "size": [], "crc": []}
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                for doc, n, media in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                    out.write(media)
                    for key, value in zip(index, (doc, n, at, len(media), zlib.crc32(media)), strict=True):
                        index[key].append(value)
                    at += len(media)
        if not at:
            files.delete_file(f"{folder}/{name}")
            return Packed(None)
        with files.open_output_stream(f"{folder}/{name}.index") as out:
            out.write(zlib.compress(json.dumps(index).encode()))
        return Packed(name, at, len(index["size"]))

    def commit(self, messages: list) -> None:
        files, folder = opened(self.path)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(sorted((m.archive, m.size) for m in messages if m and m.archive)).encode())

    def abort(self, messages: list) -> None:
        """Without a manifest nothing names the files of the job, so nothing reads them."""


class MediaArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)

    def writer(self, schema, overwrite: bool) -> MediaWriter:
        return MediaWriter(self.options)


def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, data = batch.column(0).to_pylist(), texts(batch)
        for k in range(0, len(ids), 512):
            part = [encode(payload(x)) for x in data[k : k + 512]]
            yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 512], pa.int64()), pa.array([len(x) for x in data[k : k + 512]], pa.int64()), pa.array(part, pa.binary()), pa.nulls(len(part), pa.string())], ["doc_id", "n_bytes", "media", "error"])


def write_archive(docs: DataFrame, path: str) -> None:
    """Stores doc_id and text of every row. Null text is stored as the empty text; repeated rows are stored each."""
    docs.sparkSession.dataSource.register(MediaArchive)
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(encode_texts, SCHEMA)
    rows.write.format("media_archive").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """doc_id, n_bytes, media, error: one row per member. An archive of no rows gives an empty table."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**options).load(path)


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    for batch in batches:
        rows = []
        for doc, n, media, error in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if error:
                raise OSError(f"document {doc}: {error}")
            samples = decode(media)
            data = samples.tobytes()
            rows.append((doc, n, len(data), sha256(data).hexdigest(), zlib.crc32(data[-WIDTH:]), len(media), sha256(media).hexdigest(), features(samples)))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null text is empty; equal texts give equal values in every column but doc_id."""
    path = scratch(spark, "media")
    write_archive(table(spark, sf_dir, "documents"), path)
    return read_archive(spark, path).mapInArrow(digests, DIGESTS)
