"""SimHash near-dedup by Golay-code fuzzy hashing.

A fingerprint is 64 bits: a bit is 1 if it is set in over half of the XXH64 hashes of the text's word shingles.
Fingerprints that differ in at most 4 bits are linked. Candidates share a key:

* The [23,12,7] Golay code is perfect: each 23-bit word is within 3 bits of one codeword. K(x), the codewords within
  4 bits of x, has one member, or six if the nearest is at distance 3. Words within 2 bits of each other share a
  member of K.
* Four segments of 16 bits: if one of them is free of errors, the other 48 bits hold at most 4 errors, so one of two
  23-bit words taken from them holds at most 2. Keys: each segment as it is, with each member of K of each such word.
* Otherwise each segment has one error, and so its parity differs. Keys: the four parities, up to complement, with
  the codewords nearest to the first two segments on the side where a segment is even, with K where it is odd.

A candidate pair is linked only after its distance is verified.

Copies with edits differ in more bits. `wide_keys` serve a larger distance with good, not full, recall: for each of
COMBOS fixed selections of bits, EXACT bits as they are with each member of K of 23 others, and a MinHash minimum that no
band has. The bits alone have some 20 to tell texts apart by, so that of a million texts each would meet others in most
of its buckets; a minimum adds 16, and near copies share it as often as they are alike. `keep_one` takes what the keys
find and what MinHash bands find as candidates, and decides by the exact Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import minhash
from .common import cut, lean, table
from .components import bucket_links, components
from .lines import texts
from .rows import apart, kept, located, noted

SHINGLE = 4
SEED = 42
DISTANCE = 4
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LENGTH, CHECK = 23, 11
PART = 1 << 15


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    ends = starts[min(size, len(words)) :] - 1
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, n, PART):
        counts += np.unpackbits(hashes[k : k + PART].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the three bytes of a word; for each syndrome the six error patterns of up to 4 bits (equal ones repeat)."""

    def remainder(x: int) -> int:
        for k in range(LENGTH - 1, CHECK - 1, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - CHECK)
        return x

    bit = [remainder(1 << k) for k in range(LENGTH)]
    syndromes = np.zeros((3, 256), np.int64)
    for byte in range(3):
        for x in range(256):
            for k in range(8):
                if x >> k & 1 and byte * 8 + k < LENGTH:
                    syndromes[byte, x] ^= bit[byte * 8 + k]
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for weight in range(5):
        for at in combinations(range(LENGTH), weight):
            s = e = 0
            for k in at:
                s, e = s ^ bit[k], e | 1 << k
            if weight < 4 or len(patterns[s]) != 1 or patterns[s][0].bit_count() == 3:
                patterns[s].append(e)
    errors = np.array([(p + [p[0]] * 6)[:6] for p in patterns], np.int64)
    assert all(len(p) in (1, 6) for p in patterns)
    return syndromes, errors


def codewords(words: np.ndarray) -> np.ndarray:
    """Columns: index of the nearest codeword, then of the others of K; where K has one member it repeats."""
    syndromes, errors = golay()
    s = syndromes[0][words & 255] ^ syndromes[1][words >> 8 & 255] ^ syndromes[2][words >> 16]
    return (words[:, None] ^ errors[s]) >> CHECK


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the row number of each one's fingerprint (uint64); a fingerprint has each of its keys once."""
    keys, rows = [], []
    segment = [(prints >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    number = np.arange(len(prints))
    several = np.zeros((len(prints), 6), bool)

    def distinct(found: np.ndarray) -> np.ndarray:
        several[:] = True
        several[:, 1:] = found[:, 1:] != found[:, :1]
        return several

    for k in range(4):
        a, b, c = (segment[x] for x in range(4) if x != k)
        rest = a | b << 16 | c << 32
        for half in range(2):
            found = codewords(rest >> (24 * half) & ((1 << LENGTH) - 1))
            mask = distinct(found)
            keys.append(((np.int64(2 * k + half) << 28) | (segment[k][:, None] << 12) | found)[mask])
            rows.append(np.broadcast_to(number[:, None], found.shape)[mask])
    odd = [np.bitwise_count(x.astype(np.uint64)).astype(np.int64) & 1 for x in segment]
    parity = odd[0] | odd[1] << 1 | odd[2] << 2 | odd[3] << 3
    parity = np.minimum(parity, 15 - parity)
    masks, found = [], []
    for k in range(2):
        found.append(codewords(segment[k]))
        masks.append(distinct(found[k]) & ((odd[k][:, None] == 1) | (np.arange(6) == 0)))
    mask = masks[0][:, :, None] & masks[1][:, None, :]
    both = (np.int64(1) << 40) | (parity[:, None, None] << 24) | (found[0][:, :, None] << 12) | found[1][:, None, :]
    keys.append(both[mask])
    rows.append(np.broadcast_to(number[:, None, None], both.shape)[mask])
    return np.concatenate(keys), np.concatenate(rows)


COMBOS, EXACT = 24, 8
SPARE = minhash.BANDS * minhash.ROWS  #: The first minimum that no band has.
WIDE_SHINGLE, WIDE_DISTANCE = 5, 10  # about where the Jaccard similarity of five-word shingles is 0.8


def wide_keys(prints: np.ndarray, minima: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """As fuzzy_keys, for WIDE_DISTANCE. minima: COMBOS of each fingerprint's text, of 16 bits; each combination's keys
    have one of them."""
    if minima is None:
        minima = np.zeros((len(prints), COMBOS), np.int64)
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    order = np.random.RandomState(11)
    keys, rows, number = [], [], np.arange(len(prints))
    for k in range(COMBOS):
        chosen = order.permutation(64)[: LENGTH + EXACT]
        found = codewords(bits[:, chosen[:LENGTH]] @ (1 << np.arange(LENGTH)))
        same = bits[:, chosen[LENGTH:]] @ (1 << np.arange(EXACT))
        mask = np.ones(found.shape, bool)
        mask[:, 1:] = found[:, 1:] != found[:, :1]
        keys.append(((np.int64(k) << 40) | (minima[:, k, None] << 24) | (same[:, None] << 12) | found)[mask])
        rows.append(np.broadcast_to(number[:, None], found.shape)[mask])
    return np.concatenate(keys), np.concatenate(rows)


def print_texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(x, size) for x in texts(batch)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "node"])


#: Keys that one task makes, about. A planner that sees the few bytes of the fingerprints would take a few tasks.
KEYS_A_TASK = 1 << 20
WIDE_KEYS, NARROW_KEYS = 6 * 24, 64  #: Of a fingerprint, about.


def spread(prints: DataFrame, keys: int) -> DataFrame:
    """prints (node and others), in so many tasks that none makes more than KEYS_A_TASK of so many keys each."""
    prints = cut(prints)
    least = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prints.repartition(max(least, -(-prints.count() * keys // KEYS_A_TASK)), "node")


@lean
def emit_keys(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        for k in range(0, len(nodes), 4096):
            part = nodes[k : k + 4096]
            keys, rows = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "node"])


@lean
def emit_known_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """print, known, low, high (bytes of COMBOS minima) -> the wide keys, with the print as node, and known."""
    for batch in batches:
        nodes, known = (batch.column(k).to_numpy() for k in range(2))
        for k in range(0, len(nodes), 4096):
            low, high = (np.frombuffer(b"".join(batch.column(c).slice(k, 4096).to_pylist()), np.uint8).reshape(-1, COMBOS).astype(np.int64) for c in (2, 3))
            keys, rows = wide_keys(nodes[k : k + 4096].view(np.uint64), low | high << 8)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes[k : k + 4096][rows]), pa.array(known[k : k + 4096][rows])], ["key", "node", "known"])


def near(nodes: np.ndarray, node: np.int64, distance: int) -> np.ndarray:
    return np.bitwise_count((nodes ^ node).view(np.uint64)) <= distance


def linked_rows(docs: DataFrame, size: int, distance: int, keys_of) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node), a row per document with its fingerprint as node, and (node, root) for each node."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    printed = cut(rows.mapInArrow(lambda it: print_texts(it, size), "doc_id long, node long"))
    nodes = printed.select("node").distinct()
    keys = spread(nodes, NARROW_KEYS).mapInArrow(lambda it: emit_keys(it, keys_of), "key long, node long")
    links = bucket_links(keys, partial(near, distance=distance), lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= distance)
    return printed, nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def near_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links lead to, itself included.

    Input: doc_id, text; other columns are ignored. A text of fewer words than a shingle is one shingle. A null or
    empty text, or one without words, has fingerprint zero, linked like any other. Equal fingerprints are one node,
    however many rows have them; a component whose ids are all null has a null component_id. An empty table gives
    an empty result.
    """
    printed, roots = linked_rows(docs, size, DISTANCE, fuzzy_keys)
    placed = cut(roots.join(printed.groupBy("node").agg(F.min("doc_id").alias("least")), "node"))
    leasts = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = placed.join(leasts, "root").select("node", "component_id")
    return printed.join(of, "node").select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")


def same_print(printed: DataFrame, links: DataFrame) -> DataFrame:
    """Links between fingerprints -> links a, b between nodes, and of nodes with one fingerprint, through its least node."""
    pairs = printed.select("print", "node").distinct()
    lead = cut(pairs.groupBy("print").agg(F.min("node").alias("lead")))
    same = pairs.join(lead, "print").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    left = links.join(lead.select(F.col("print").alias("a"), F.col("lead").alias("x")), "a")
    both = left.join(lead.select(F.col("print").alias("b"), F.col("lead").alias("y")), "b")
    return same.unionByName(both.select(F.col("x").alias("a"), F.col("y").alias("b")))


def wide_links(printed: DataFrame, groups: DataFrame, distance: int) -> DataFrame:
    """Links between fingerprints within distance whose texts share a wide key. groups (node, root): nodes of a root are
    connected already. A fingerprint of several shingle sets has the keys of each of them."""
    spare = [F.expr(f"substring({x}, {SPARE + 1}, {COMBOS})").alias(x) for x in ("low", "high")]
    sets = printed.select("node", "print", *spare).dropDuplicates(["node", "print"])
    placed = cut(sets.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")))
    known = placed.groupBy("print").agg(F.min("root").alias("known"))
    own = placed.drop("root").join(known, "print").select("node", "print", "known", "low", "high")
    keys = spread(own, WIDE_KEYS).drop("node").mapInArrow(emit_known_keys, "key long, node long, known long")
    return bucket_links(keys, partial(near, distance=distance), lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= distance, repeats=True)


def copy_candidates(printed: DataFrame, distance: int) -> DataFrame:
    """What MinHash bands find, and what else fingerprints within distance find: they give no links between fingerprints
    that the bands have connected, so a large group of copies has one link a node and not one for each bucket."""
    bands = cut(minhash.band_candidates(printed))
    links = wide_links(printed, cut(components(bands)), distance)
    return same_print(printed, links).unionByName(bands)


@apart
def keep_one(docs: DataFrame, size: int = WIDE_SHINGLE, distance: int = WIDE_DISTANCE) -> DataFrame:
    """The documents' columns, for one document of each group of near copies: the first by doc_id, null ids last, then
    by its place in the files.

    Of repeated rows one stays. Texts without words (null, empty, white space) are one group. Fingerprints within
    distance and MinHash bands give candidates only: a link is kept where the Jaccard similarity of the shingle sets is
    0.8 or more. Rows are told apart by their address, so none is lost or taken for another. Extra columns stay,
    whatever their names. Empty table: empty result.
    """
    rows = located(docs)
    printed, notes = minhash.print_docs(rows, size, partial(fingerprint, size=size))
    roots = minhash.verified_roots(rows, printed, copy_candidates(printed, distance), size)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__g", "__r")).alias("first")
    ahead = printed.groupBy("node").agg(first).join(roots, "node").groupBy("root").agg(F.min("first").alias("first"))
    return kept(rows, noted(ahead.select("first.__g", "first.__r"), notes.folders, "winners"), docs)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
