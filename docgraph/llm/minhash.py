"""Document fingerprints: MinHash over word shingles, in vectorised numpy.

Words are runs of anything but ASCII white space, A-Z lower-cased; a shingle is five words. A text of fewer words is
one shingle, a text without words has none. Each of PERMUTATIONS universal hashes h(x) = (a x + b mod 2^64) >> 32 of
the 32-bit shingle keys keeps the low 16 bits of its minimum. The likeness of two fingerprints, the share of equal minima,
estimates the Jaccard similarity of the shingle sets.

Near copies: bands of the minima are joined, and a candidate is linked only where the exact Jaccard similarity of the
shingle sets is 0.8 or more.

Texts never move. One scan makes the fingerprints, kept by the rows' addresses; the order of the documents is found
from ids and addresses; a second scan sends each document the start of the next one's text, as much as it needs; a
third edits and compares.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import BATCH_ROWS, cut, lean, settings, table
from .components import components, joining
from .lines import texts
from .rows import Notes, folders_for, located, map_noted, noted

SHINGLE = 5
PERMUTATIONS = 128
NO_SHINGLE = np.uint64(0xFFFFFFFFFFFFFFFF)
_random = np.random.RandomState(20240229)
A = _random.randint(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _random.randint(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
BLOCK = 2048
LEAST = (4, 5)  #: The Jaccard similarity of near copies: 0.8.
BANDS, ROWS = 24, 4  #: A pair of similarity 0.8 shares no band with a chance of (1 - 0.8^4)^24 = 3e-6.
ROUGH = 77  #: Equal minima of 128 in a candidate: fewer have a chance of about 1e-7 at similarity 0.8.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 21
MOST_HASHES = 100_000


class WordHashes(dict):
    """Word -> 64-bit hash; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_HASHES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash for each shingle; repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array([HASHES[w] for w in words], np.uint64)
    n = max(1, len(words) - size + 1)
    mixed = np.full(n, np.uint64(min(len(words), size)))
    for k in range(min(len(words), size)):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def shingle_keys(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """A 32-bit key, as uint64, for each shingle; repeats included."""
    return shingle_hashes(text, size) >> np.uint64(32)


def node_of(shingles: np.ndarray) -> int:
    """The hash of a set of shingles (sorted, distinct), signed."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def signature(keys: np.ndarray) -> np.ndarray:
    """The low 16 bits of PERMUTATIONS minima of 32 bits; all ones for no shingle."""
    least = np.full(PERMUTATIONS, NO_SHINGLE)
    for k in range(0, len(keys), BLOCK):
        hashed = np.multiply.outer(A, keys[k : k + BLOCK])
        hashed += B[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1. Two texts without words are alike, one with and one without are not."""
    return float((a == b).mean())


def fingerprint(of: np.ndarray) -> str:
    """Hex digits of the minima."""
    return of.astype(">u2").tobytes().hex()


def halves(minima: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
    """The low and the high bytes of each fingerprint."""
    return [x.astype(np.uint8).tobytes() for x in minima], [(x >> 8).astype(np.uint8).tobytes() for x in minima]


def whole(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, np.uint8) | np.frombuffer(high, np.uint8).astype(np.uint16) << 8


PRINTED = "doc_id long, __g long, __r long, n_chars long, node long, shingles long, lead boolean, print long, low binary, high binary"


@lean
def print_rows(batches: Iterator[pa.RecordBatch], size: int, print_of) -> Iterator[pa.RecordBatch]:
    """doc_id, __g, __r, text -> PRINTED. node: the hash of the shingle set; lead: the first row of its node in this task."""
    names, seen = [x.split()[0] for x in PRINTED.split(", ")], set()
    for batch in batches:
        for k in range(0, batch.num_rows, 2048):
            part = batch.slice(k, 2048)
            chars, nodes, counts, lead, prints, minima = [], [], [], [], [], []
            for text in texts(part):
                found = np.unique(shingle_hashes(text, size))
                chars.append(len(text.decode()))
                nodes.append(node_of(found))
                lead.append(nodes[-1] not in seen)
                seen.add(nodes[-1])
                counts.append(len(found))
                prints.append(print_of(text))
                minima.append(signature(found >> np.uint64(32)))
            low, high = halves(minima)
            columns = [pa.array(chars, pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(lead, pa.bool_())]
            columns += [pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(low, pa.binary()), pa.array(high, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names)
    HASHES.clear()  # the worker lives on


def print_docs(rows: DataFrame, size: int, print_of) -> tuple[DataFrame, Notes]:
    """The fingerprints of located rows, as a table and as notes."""
    folders = folders_for(rows.count())
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "__g", "__r", "text")
    with settings(rows.sparkSession, execution__arrow__maxRecordsPerBatch=BATCH_ROWS):
        notes = noted(own.mapInArrow(lambda it: print_rows(it, size, print_of), PRINTED), folders, "fingerprints", dealt=True)
    return rows.sparkSession.read.schema(PRINTED).parquet(notes.path), Notes(notes.path, ["low", "high"], folders)


def next_requests(printed: DataFrame, groups: DataFrame | None) -> DataFrame:
    """__g, __r of each row, and of the row that it is the next one of: how many characters that one needs, its address
    and its component. Only ids, lengths and addresses are ordered."""
    own = printed.select("doc_id", "__g", "__r", "n_chars", "node")
    own = own.join(groups, "node") if groups is not None else own.withColumn("component_id", F.lit(None).cast("long"))
    placed = cut(numbered(own.drop("node"), [F.col("doc_id").asc_nulls_first(), F.col("n_chars"), F.col("__g"), F.col("__r")]).drop("before"))
    n = placed.count()
    before = placed.select((F.col("seq") % F.lit(max(1, n)) + 1).alias("seq"), F.floor(F.col("n_chars") / 4).alias("need"), F.col("__g").alias("to_g"), F.col("__r").alias("to_r"), "component_id")
    return placed.select("seq", "__g", "__r").join(before, "seq").drop("seq")


def send_heads(part: pa.RecordBatch, asked: dict[int, tuple], prints: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """__g, __r, text -> for the row before: the start of this text, compressed, this fingerprint, and its own component."""
    pack = zstandard.ZstdCompressor(level=1)
    out = []
    for r, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
        need, to_g, to_r, component = asked[r]
        out.append((to_g, to_r, pack.compress((text or "")[:need].encode()), *prints[r], component))
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["__g", "__r", "head", "low", "high", "component_id"])


FINGERPRINTS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, component_id long"


def edit_and_compare(part: pa.RecordBatch, prints: dict[int, tuple], heads: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """doc_id, __g, __r, text -> FINGERPRINTS."""
    unpack = zstandard.ZstdDecompressor()
    out = []
    for doc, r, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
        text, own = text or "", whole(*prints[r])
        head, low, high, component = heads[r]
        edited = text[: len(text) - len(text) // 4].encode() + unpack.decompress(head)
        changed = signature(np.unique(shingle_keys(edited)))
        out.append((doc, len(text), sha256(edited).hexdigest(), fingerprint(own), fingerprint(changed), likeness(own, changed), likeness(own, whole(low, high)), component))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in FINGERPRINTS.split(", ")])


def fingerprints(docs: DataFrame, with_groups: bool = False) -> DataFrame:
    """Each document's fingerprint, and that of its text with the last quarter exchanged for the next one's start.

    Input: doc_id, text; other columns are ignored. Null text: empty. Documents stand by (doc_id, length), null ids
    first, further ties by their place in the files; repeated rows follow each other. The only document is its own
    next one. Empty table: empty result. with_groups: component_id as of near_duplicates, otherwise null.
    """
    rows = located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    printed, prints = print_docs(rows, SHINGLE, lambda _: 0)
    asked = noted(next_requests(printed, near_groups(rows, printed) if with_groups else None), prints.folders, "next-rows")
    sent = map_noted(rows.select("__g", "__r", "text"), [asked, prints], send_heads, "__g long, __r long, head binary, low binary, high binary, component_id long")
    heads = noted(sent, prints.folders, "next-heads")
    return map_noted(rows.select("doc_id", "__g", "__r", "text"), [prints, heads], edit_and_compare, FINGERPRINTS)


@lean
def payload_links(batches: Iterator[pa.RecordBatch], near_of) -> Iterator[pa.RecordBatch]:
    """Batches of (key, i, j, node, payload, own), sorted -> a, b: of each group the links that joining gives.

    near_of(payloads) gives near(rest, x) on positions. A group may run over several batches.
    """

    def links(held: list[tuple[np.ndarray, list[bytes], np.ndarray]]) -> pa.RecordBatch:
        nodes, first = np.unique(np.concatenate([n for n, _, _ in held]), return_index=True)
        payloads = [p for _, ps, _ in held for p in ps]
        blocks = np.concatenate([o for _, _, o in held])[first]
        ends = [np.empty(0, np.int64)] * 2
        if len(nodes) > 1:
            ends = [nodes[x] for x in joining(np.arange(len(nodes)), blocks, near_of([payloads[k] for k in first]))]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    held: list[tuple[np.ndarray, list[bytes], np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j, node = (batch.column(k).to_numpy() for k in range(4))
        payload, own = batch.column(4).to_pylist(), batch.column(5).to_numpy()
        edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            this = (key[a], i[a], j[a])
            if this != last and held:
                yield links(held)
                held = []
            last = this
            held.append((node[a:b], payload[a:b], own[a:b]))
    if held:
        yield links(held)


def near_sets(payloads: list[bytes]):
    """near(rest, x): which sets have a Jaccard similarity of LEAST or more with set x. Exact, in whole numbers."""
    sizes = np.array([len(p) // 8 for p in payloads], np.int64)
    _, places = np.unique(np.frombuffer(b"".join(payloads), np.uint64), return_inverse=True)
    starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    mark = np.zeros(int(places.max(initial=0)) + 1, bool)
    above, below = LEAST

    def near(rest: np.ndarray, x: np.int64) -> np.ndarray:
        own = places[starts[x] : starts[x + 1]]
        hit = below * np.minimum(sizes[rest], len(own)) >= above * np.maximum(sizes[rest], len(own))
        mark[own] = True
        for k in np.flatnonzero(hit).tolist():
            both = int(np.count_nonzero(mark[places[starts[rest[k]] : starts[rest[k] + 1]]]))
            hit[k] = below * both >= above * (len(own) + int(sizes[rest[k]]) - both)
        mark[own] = False
        return hit

    return near


def dealt(rows: DataFrame) -> DataFrame:
    """key, blocks, node, payload -> key, i, j, node, payload, own: groups of two blocks at most, as bucket_links deals them."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    out = rows.select("key", "node", "payload", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    out = out.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "payload", "own")
    return out.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def emit_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, low, high -> key, node: a key for each band, the hash of its number and its minima. Equal hashes of unequal
    bands only add candidates."""
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            nodes, low, high = (batch.column(n).slice(k, 4096) for n in range(3))
            bytes_of = lambda x: np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, PERMUTATIONS)[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
            parts = bytes_of(low) | bytes_of(high) << np.uint64(8)
            mixed = (parts[:, :, 0] | parts[:, :, 1] << np.uint64(16) | parts[:, :, 2] << np.uint64(32) | parts[:, :, 3] << np.uint64(48)) ^ salt
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64).reshape(-1)), pa.array(np.repeat(nodes.to_numpy(), BANDS))], ["key", "node"])


def near_sketches(payloads: list[bytes]):
    """near(rest, x): which have at least ROUGH minima whose low bytes are equal to those of x."""
    sketches = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, PERMUTATIONS)
    return lambda rest, x: (sketches[rest] == sketches[x]).sum(axis=1) >= ROUGH


def band_candidates(printed: DataFrame) -> DataFrame:
    """Links a, b: within every band's bucket a spanning forest of the nodes that agree in ROUGH minima. Every pair of
    similarity 0.8 or more is connected, but for the chances at BANDS and ROUGH. A node without shingles has no band.

    Of equal sets one row a task gives keys, so a bucket has no more rows of a node than there are tasks.
    """
    banded = printed.where("shingles > 0 AND lead")
    parts = int(printed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = banded.select("node", "low", "high").mapInArrow(emit_bands, "key long, node long").repartition(parts, "key")  # one exchange, for both uses
    several = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("key")
    met = cut(keys.hint("merge").join(several, "key").distinct())  # as in bucket_links, keys are more than the planner thinks
    blocks = met.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    sketches = banded.select("node", F.col("low").alias("payload")).join(met.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    rows = met.join(blocks, "key").join(sketches, "node")
    return dealt(rows).mapInArrow(lambda it: payload_links(it, near_sketches), "a long, b long")


def blocks_of(nodes: Column, shingles: Column) -> Column:
    """How many blocks so many sets of so many shingles take."""
    return F.greatest(F.ceil(nodes / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")


def own_block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node"), blocks).cast("int")


PLACED = "node", "__g", "__r", "shingles", "root"


def verified_links(rows: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """places (node, __g, __r, key, i, j: several rows for a node that is in several groups) -> a, b: within each group
    what joins the nodes whose sets have a Jaccard similarity of LEAST or more. A set is read where its row stands."""
    lists = places.groupBy("__g", "__r", "node").agg(F.sort_array(F.collect_list(F.struct("key", "i", "j"))).alias("into"))
    chosen = noted(lists, folders_for(rows.count()), "chosen")

    def emit(part: pa.RecordBatch, own: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
        mask = [r in own for r in part.column(1).to_pylist()]
        if any(mask):
            part = part.filter(pa.array(mask))
            for r, text in zip(part.column(1).to_pylist(), texts(part), strict=True):
                node, into = own[r]
                payload = np.unique(shingle_hashes(text, size)).tobytes()
                columns = [[x[c] for x in into] for c in ("key", "i", "j")]
                kinds = (pa.int64(), pa.int32(), pa.int32())
                repeated = [pa.array([node] * len(into), pa.int64()), pa.array([payload] * len(into), pa.binary()), pa.array([0] * len(into), pa.int32())]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], *repeated], ["key", "i", "j", "node", "payload", "own"])

    sets = map_noted(rows.select("__g", "__r", "text"), [chosen], emit, "key long, i int, j int, node long, payload binary, own int")
    dealt_out = sets.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    with settings(rows.sparkSession, execution__arrow__maxRecordsPerBatch=BATCH_ROWS):
        return cut(dealt_out.mapInArrow(lambda it: payload_links(it, near_sets), "a long, b long"))


def with_trees(members: DataFrame, links: DataFrame) -> DataFrame:
    """members, and the tree of each: the least node that links lead to, or the node itself."""
    own = links.join(members.select(F.col("node").alias("a")), "a", "left_semi")
    trees = components(own).select("node", F.col("root").alias("tree"))
    return members.join(trees, "node", "left").withColumn("tree", F.coalesce("tree", "node"))


def verified_roots(rows: DataFrame, printed: DataFrame, candidates: DataFrame, size: int = SHINGLE) -> DataFrame:
    """node, root for each node: nodes are linked where the Jaccard similarity of their sets is LEAST or more.

    rows: located. Candidates a, b only say which nodes are compared: all pairs within each of their components, since
    links can't lead out of one. A component of one block is one group. A larger one is compared in three steps, so
    that its sets aren't sent to all its blocks: within each block; two sets of each tree that this gives; and then
    only what is outside the component's largest tree against all of it, and among itself. Nodes of one tree are
    linked already, so no pair is left out.
    """
    groups = cut(components(candidates))
    of = printed.groupBy("node").agg(F.min(F.struct("__g", "__r")).alias("at"), F.min("shingles").alias("shingles")).join(groups, "node")
    members = cut(of.select("node", "at.__g", "at.__r", "shingles", "root"))
    blocks = members.groupBy("root").agg(blocks_of(F.count("*"), F.sum("shingles")).alias("blocks"))
    placed = cut(members.join(blocks, "root"))
    at = lambda df, key, i, j: df.select("node", "__g", "__r", key.alias("key"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    own, no = own_block(F.col("blocks")), F.lit(-1)
    links = verified_links(rows, at(placed, F.col("root"), own, own), size)
    hot = placed.where("blocks > 1").select(*PLACED)
    if not hot.isEmpty():
        trees = cut(with_trees(hot, links))
        mark = F.struct(F.xxhash64(F.lit(7), "node"), *PLACED)
        ends = trees.groupBy("root", "tree").agg(F.array_distinct(F.array(F.min(mark), F.max(mark))).alias("x")).select(F.explode("x").alias("x")).select("x.*")
        among = ends.groupBy("root").agg(blocks_of(F.count("*"), F.sum("shingles")).alias("blocks"))
        links = links.unionByName(verified_links(rows, at(ends.join(among, "root"), F.col("root"), own, own), size))
        trees = cut(with_trees(hot, links))
        sizes = trees.groupBy("root", "tree").agg(F.count("*").alias("n"), F.sum("shingles").alias("s"))
        largest = sizes.groupBy("root").agg(F.max(F.struct("n", "tree", "s")).alias("most"), F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > most.n")
        split = largest.select("root", F.col("most.tree").alias("most"), blocks_of(F.col("most.n"), F.col("most.s")).alias("inner"), blocks_of(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")).alias("outer"))
        rest = cut(trees.join(split, "root"))
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        within = rest.where("tree = most").withColumn("i", own_block(F.col("inner"))).withColumn("j", every(F.col("outer")))
        beside = rest.where("tree <> most").withColumn("j", own_block(F.col("outer")))
        against = beside.withColumn("i", every(F.col("inner")))
        pairs = beside.where("outer > 1").withColumn("other", every(F.col("outer")))
        pairs = at(pairs, F.col("root"), no - F.least("j", "other") - 1, F.greatest("j", "other"))
        both = within.select(*PLACED, "i", "j").unionByName(against.select(*PLACED, "i", "j"))
        links = links.unionByName(verified_links(rows, at(both, F.col("root"), F.col("i"), F.col("j")).unionByName(pairs), size))
    return printed.select("node").distinct().join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def near_groups(rows: DataFrame, printed: DataFrame) -> DataFrame:
    """node, component_id for each node."""
    least = printed.groupBy("node").agg(F.min("doc_id").alias("least"))
    roots = cut(verified_roots(rows, printed, band_candidates(printed)).join(least, "node"))
    return roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id: the smallest doc_id that links lead to, itself included; null where all its ids are.

    Documents are linked where the Jaccard similarity of their sets of five-word shingles is 0.8 or more. Candidates
    share a band of minima. Texts without words are one group. Input and empty table: as for fingerprints.
    """
    rows = located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    printed, _ = print_docs(rows, SHINGLE, lambda _: 0)
    return printed.join(near_groups(rows, printed), "node").select("doc_id", "component_id")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"), with_groups=True)
