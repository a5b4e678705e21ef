"""Line dedup with two Bloom filters, for line keys seen once and seen twice.

Pass 1 reads the texts and sets both filters, task by task; tasks' filters are merged slice by slice: a key is seen
twice if one task saw it twice or two tasks saw it once. Pass 2 reads the texts again and sends on only the keys
that the second filter suspects, with exact counts per batch; a group-by confirms them and picks each key's first
occurrence. Pass 3 drops the lines. A filter never misses a repeat, and a false suspect fails the exact count, so
the filters' size decides only how many suspects shuffle, never the result.

Keys are compared by 128-bit BLAKE2b digests of their bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, lean, table
from .rows import by_group, folders_for, located, noted

SPACE = b" \t\n\x0b\x0c\r"
#: A filter has 16 bits for each line, between these powers of two. At the upper (128 MB a filter, two in a building
#: task) it fills with the corpus, and sends more suspects to the exact count.
FILTER_BITS = (20, 30)
PROBES = 3
SLICE_BITS = 21
MERGERS = 16
#: Up to so many repeated keys (24 bytes each) go to every executor; beyond, each group of rows gets its own.
MOST_BROADCAST = 100_000
NO_DOC = 1 << 62


def digest(line: bytes) -> bytes:
    return blake2b(line.strip(SPACE).lower(), digest_size=16).digest()


def long_enough(line: bytes, least: int) -> bool:
    key = line.strip(SPACE)
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def positions(keys: bytes, bits: int) -> np.ndarray:
    """A column of bit positions for each of PROBES."""
    pair = np.frombuffer(keys, dtype="<u8").reshape(-1, 2)
    step = pair[:, 1] | np.uint64(1)
    return np.stack([(pair[:, 0] + np.uint64(k) * step) >> np.uint64(64 - bits) for k in range(PROBES)], axis=1).astype(np.int64)


def set_bits(words: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(words, at.ravel() >> 6, np.uint64(1) << (at.ravel() & 63).astype(np.uint64))


def has_bits(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


@lean
def build_filters(batches: Iterator[pa.RecordBatch], bits: int, least: int) -> Iterator[pa.RecordBatch]:
    once, twice = np.zeros(1 << (bits - 6), np.uint64), np.zeros(1 << (bits - 6), np.uint64)
    for batch in batches:
        keys: list[bytes] = []
        for text in texts(batch):
            keys += {digest(x) for x in text.split(b"\n") if long_enough(x, least)}
        if keys:
            own, counts = np.unique(np.array(keys, dtype="V16"), return_counts=True)
            at = positions(own.tobytes(), bits)
            repeated = has_bits(once, at) | (counts > 1)
            set_bits(twice, at[repeated])
            set_bits(once, at)
    width = 1 << max(0, min(SLICE_BITS, bits) - 6)
    rows = [(k, a, b) for k, (a, b) in enumerate(zip(once.reshape(-1, width), twice.reshape(-1, width), strict=True)) if a.any()]
    for k, a, b in rows:
        yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zlib.compress(a.tobytes(), 1)], pa.binary()), pa.array([zlib.compress(b.tobytes(), 1)], pa.binary())], ["slice", "once", "twice"])


def merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold over slices as they come; memory holds the slices of this task only."""
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for k, a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            once, twice = (np.frombuffer(zlib.decompress(x), np.uint64) for x in (a, b))
            if k in seen:
                seen[k] = (seen[k][0] | once, seen[k][1] | twice | (seen[k][0] & once))
            else:
                seen[k] = (once, twice)
    for k, (_, twice) in seen.items():
        if twice.any():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["slice", "twice"])


def filter_bits(docs: DataFrame) -> int:
    """The power of two for a filter over these documents' lines."""
    feeds = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    n = docs.agg(F.sum(F.coalesce(feeds, F.lit(0)) + 1)).first()[0] or 0
    return min(max((16 * n).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])


def twice_filter(docs: DataFrame, bits: int, least: int = 1) -> np.ndarray:
    """Bits of the keys in two documents or more, false positives among them. Its size is fixed by bits."""
    parts = docs.select("text").mapInArrow(lambda it: build_filters(it, bits, least), "slice long, once binary, twice binary")
    merged = parts.repartition(MERGERS, "slice").mapInArrow(merge_filters, "slice long, twice binary")
    words = np.zeros(1 << (bits - 6), np.uint64)
    width = 1 << max(0, min(SLICE_BITS, bits) - 6)
    for row in merged.collect():
        words[row.slice * width : (row.slice + 1) * width] = np.frombuffer(zlib.decompress(row.twice), np.uint64)
    return words


def suspected(lines: list[bytes], words: np.ndarray, bits: int, least: int) -> list[tuple[int, bytes]]:
    """(line number, digest) of the lines that the filter suspects."""
    own = [(n, digest(x)) for n, x in enumerate(lines) if long_enough(x, least)]
    if not own:
        return []
    hit = has_bits(words, positions(b"".join(x for _, x in own), bits))
    return [x for x, h in zip(own, hit, strict=True) if h]


def repeated_keys(docs: DataFrame, words: Broadcast, min_docs: int, bits: int, least: int = 1) -> DataFrame:
    """key (digest), first_doc, first_line of the keys found in at least min_docs documents. Rows are documents; words:
    twice_filter's, as a broadcast."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list] = {}
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                doc, here = NO_DOC if doc is None else doc, set()
                for n, key in suspected(text.split(b"\n"), words.value, bits, least):
                    if key in here:
                        continue
                    here.add(key)
                    if x := found.get(key):
                        x[0] += 1
                        x[1] = min(x[1], (doc, n))
                    else:
                        found[key] = [1, (doc, n)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1][0] for x in found.values()], pa.int64()), pa.array([x[1][1] for x in found.values()], pa.int64())], ["key", "n", "doc", "line"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "key binary, n long, doc long, line long")
    first = F.min(F.struct("doc", "line")).alias("first")
    return rows.groupBy("key").agg(F.sum("n").alias("n"), first).where(F.col("n") >= min_docs).select("key", F.col("first.doc").alias("first_doc"), F.col("first.line").alias("first_line"))


def keep_lines(text: bytes, doc: int | None, repeated: dict[bytes, tuple[int, int]], keep_first: bool, least: int) -> tuple[int, list[bytes]]:
    lines = text.split(b"\n")
    doc = NO_DOC if doc is None else doc
    kept = [x for n, x in enumerate(lines) if (at := repeated.get(digest(x))) is None or not long_enough(x, least) or (keep_first and at == (doc, n))]
    return len(lines), kept


def dedup_lines(docs: DataFrame, min_docs: int = 10, keep: str = "none", bits: int | None = None, least: int = 1, most_broadcast: int = MOST_BROADCAST, counted: bool = True) -> DataFrame:
    """The documents' columns with text deduplicated, and n_lines (before), n_dropped; columns so named are replaced.
    Without counted just the documents' columns, whatever their names.

    A text is split at line feeds; a null or empty text is one empty line and stays as it is (null becomes empty).
    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Lines with keys of at least
    `least` code points that are found in at least min_docs documents are dropped: all of them (keep="none") or all
    but the first, by doc_id and line (keep="first"; null ids stand last, and rows that repeat a doc_id share its
    first occurrence). Every row counts as a document. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keep_first = keep == "first"
    bits = bits or filter_bits(docs)
    words = spark.sparkContext.broadcast(twice_filter(docs, bits, least))
    found = cut(repeated_keys(docs, words, min_docs, bits, least))
    n = found.count()
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not counted or c not in ("n_lines", "n_dropped")])
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema]
    at, ids = out.columns.index("text"), out.columns.index("doc_id")

    def rebuilt(batch: pa.RecordBatch, kept: list, width: int) -> pa.RecordBatch:
        columns = list(batch.columns[:width])
        columns[at] = pa.array([b"\n".join(x) for _, x in kept], pa.binary()).cast(pa.string())
        if counted:
            columns += [pa.array([x[0] for x in kept], pa.int64()), pa.array([x[0] - len(x[1]) for x in kept], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:width], "n_lines", "n_dropped"][: len(columns)])

    wanted = ", ".join([*schema, *(["n_lines long", "n_dropped long"] if counted else [])])
    if n <= most_broadcast:
        held = spark.sparkContext.broadcast({bytes(r.key): (r.first_doc, r.first_line) for r in found.collect()})

        @lean
        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column(ids).to_pylist(), texts(batch), strict=True)
                yield rebuilt(batch, [keep_lines(t, d, held.value, keep_first, least) for d, t in pairs], batch.num_columns)

        return out.mapInArrow(drop, wanted)

    # too many for every executor to hold: each group of rows gets the repeated keys among its own suspected lines
    rows = located(out)

    @lean
    def own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, part in by_group(batch, 0):
                own = {key for text in texts(part) for _, key in suspected(text.split(b"\n"), words.value, bits, least)}
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(own), pa.int64()), pa.array(list(own), pa.binary())], ["__g", "key"])

    mine = rows.select("__g", "text").mapInArrow(own_keys, "__g long, key binary").join(found, "key").distinct()
    notes = noted(mine.withColumn("__r", F.lit(0).cast("long")), folders_for(rows.count()), "line-keys")

    @lean
    def drop_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}
        for batch in batches:
            for g, part in by_group(batch, width):
                if g != last:
                    got, last = notes.table(g), g
                    held = {} if got is None else {k: (d, n) for k, d, n in zip(*[got.column(c).to_pylist() for c in ("key", "first_doc", "first_line")], strict=True)}
                pairs = zip(part.column(ids).to_pylist(), texts(part), strict=True)
                yield rebuilt(part, [keep_lines(t, d, held, keep_first, least) for d, t in pairs], width)

    width = len(out.columns)
    return rows.drop("__r").mapInArrow(drop_own, wanted)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key GROUP BY doc_id
"""
