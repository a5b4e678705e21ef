"""SentencePiece encoding and decoding by a relational lattice.

Texts are cut into words that no piece reaches across. The distinct words are exploded into their substrings of
bounded length, those are equi-joined to the piece table, the matches are grouped by word as the word's lattice, and
a fold with Spark's higher-order aggregate picks the path. The encodings return to the texts by group: a group is a
block of rows of one input file, its dictionary holds the encodings of just its words, in the shared folder.

Words move as one string for each group and part, in order, and only their ids come back, in that order. A part is a
share of all words by their hash, and there are as many parts as keep the words of one in little memory. A word of more than LIMIT characters without a place where it
can be cut isn't exploded, since the fold's work grows with the square of a word: the task that assembles its text
merges it, by the same rules, with a heap.

The fold follows the model's type. A unigram model takes the path of the highest sum of scores (Viterbi). For a BPE
model that sum gives other pieces than SentencePiece does, so its lattice is folded in merge order instead: edges by
falling score, then from the left, and an edge is taken if it spans exactly two of the symbols so far. One pass is
exact if no merge makes an earlier edge possible; that is tested on all pieces when the model is loaded, and words
with pieces that share a score are folded step by step, the best possible edge each time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.dataset as dataset
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut, lean, scratch, settings, table
from .rows import folders_for, located

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "\u2581"
UNIGRAM, BPE = 1, 2
#: A symbol is one long: where it ends, counted from 0, and its id. An edge is one while it is sorted: rank, start, symbol.
PLACE_BITS, ID_BITS = 10, 18
NO_PIECE = (1 << ID_BITS) - 1  #: The id of a character that is no piece.
GONE = ((1 << PLACE_BITS) - 1) << ID_BITS  #: Stands where no symbol begins; it ends behind every word.
#: With more pieces than so many that share a score, every word is folded step by step.
MOST_TIED = 16
LONG_WORD, LIMIT = 48, 512
#: Documents for each part of the words, some 25,000 distinct ones, up to so many parts. Lattices are grouped in hash
#: tables of up to HASHED_WORDS words a task before sorting takes over.
PART_DOCS, MOST_PARTS = 1500, 50_000
HASHED_WORDS = 60_000
#: So many of the most frequent words of a sample of about SAMPLE_DOCS documents are encoded first and held by every
#: task; the other words, all of them, go to the dictionaries of groups.
FREQUENT, SAMPLE_DOCS = 200_000, 10_000


@dataclass
class Model:
    kind: int
    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    prefix: bool = True
    byte_ids: list[int] = field(default_factory=list)
    ranks: dict[str, int] = field(default_factory=dict)
    tied: set[int] = field(default_factory=set)
    tied_prefix: str = ""
    longest: int = 1
    unknown: int = 0
    in_order: bool = True
    inner: frozenset = frozenset()
    run: int = 0  # after so many spaces a longer run of them can be cut

    def __post_init__(self) -> None:
        self.ids = {p: k for k, p in enumerate(self.pieces) if self.kinds[k] == 1}
        self.unknown = self.kinds.index(2) if 2 in self.kinds else 0
        of_byte = {int(p[3:5], 16): k for k, p in enumerate(self.pieces) if self.kinds[k] == 6}
        self.byte_ids = [of_byte.get(b, self.unknown) for b in range(256)]
        self.longest = max(map(len, self.ids), default=1)
        order = {s: k for k, s in enumerate(sorted({self.scores[k] for k in self.ids.values()}, reverse=True))}
        self.ranks = {p: order[self.scores[k]] for p, k in self.ids.items()}
        counts = np.bincount([r for p, r in self.ranks.items() if len(p) > 1], minlength=len(order)) if self.ids else []
        several = {r for r, n in enumerate(counts) if n > 1}
        self.tied = {self.ids[p] for p, r in self.ranks.items() if len(p) > 1 and r in several}
        self.tied_prefix = commonprefix([self.pieces[k] for k in self.tied])
        self.inner = frozenset(p[k : k + 2] for p in self.ids for k in range(len(p) - 1))
        assert len(self.pieces) < NO_PIECE and LIMIT < 1 << PLACE_BITS
        assert not any(SPACE in p.lstrip(SPACE) for p in self.ids), "a piece reaches across words"
        if self.kind == BPE:
            self.in_order = all(self.merges_in_order(p) for p in self.ids if len(p) > 1)
            most = self.longest
            whole = [[len(x) for x in self.merge(SPACE * n)] for n in range(3 * most + 1)]
            ok = all(whole[n] == whole[most] + whole[n - most] for n in range(most, 3 * most + 1))
            before = [[len(x) for x in self.merge(SPACE * n + "a")] for n in range(2 * most)]
            mixed = all(before[n] == whole[most] + before[n - most] for n in range(most + 1, 2 * most))
            self.run = most if ok and mixed else 0

    def merge(self, word: str) -> list[str]:
        """The symbols of a short word, step by step."""
        symbols = list(word)
        while True:
            best = min(((self.ranks[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.ranks), default=None)
            if best is None:
                return symbols
            k = best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]

    def symbols(self, word: str) -> list[str]:
        """As merge, of a word of any length, with a heap of the possible merges."""
        parts, after, before = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap = [(self.ranks[a + b], k, a + b) for k, (a, b) in enumerate(zip(word, word[1:], strict=False)) if a + b in self.ranks]
        heapify(heap)

        def offer(k: int) -> None:
            if k >= 0 and after[k] < len(word) and (rank := self.ranks.get(both := parts[k] + parts[after[k]])) is not None:
                heappush(heap, (rank, k, both))

        while heap:
            _, k, both = heappop(heap)
            if not parts[k] or after[k] >= len(word) or parts[k] + parts[after[k]] != both:
                continue  # one of its halves was merged meanwhile
            gone = after[k]
            parts[k], parts[gone], after[k] = both, "", after[gone]
            if after[k] < len(word):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [x for x in parts if x]

    def best_path(self, word: str) -> list[str]:
        """The path of the highest sum of scores, as viterbi_fold takes it."""
        least = min((self.scores[k] for k in self.ids.values()), default=0.0) - 10
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            found = [(best[end - n][0] + self.scores[self.ids[p]], n) for n in range(1, min(end, self.longest) + 1) if (p := word[end - n : end]) in self.ids]
            best.append(max(found, default=(0.0, 0)) if word[end - 1] in self.ids else max([*found, (best[end - 1][0] + least, 1)]))
        out, end = [], len(word)
        while end:
            out.append(word[end - best[end][1] : end])
            end -= best[end][1]
        return out[::-1]

    def encode_long(self, word: str) -> bytes:
        """The ids of a word of more than LIMIT characters."""
        out: list[int] = []
        for x in self.best_path(word) if self.kind == UNIGRAM else self.symbols(word):
            if x in self.ids:
                out.append(self.ids[x])
            else:
                out += [self.byte_ids[b] for b in x.encode()] if set(self.byte_ids) != {self.unknown} else [self.unknown]
        return np.array(out, "<i4").tobytes()

    def merges_in_order(self, piece: str) -> bool:
        symbols, last = list(piece), -1
        while len(symbols) > 1:
            best = min(((self.ranks[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.ranks), default=None)
            if best is None:
                return True  # the piece is never made
            if best[0] < last:
                return False
            last, k = best
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return True


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


def load(path: str = MODEL) -> Model:
    """Reads a SentencePiece model file on the driver."""
    files, inner = fs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as f:
        data = f.read()
    pieces, scores, kinds, kind, prefix, extra = [], [], [], UNIGRAM, True, True
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
            kinds.append(own.get(3, 1))
        elif number == 2:
            kind = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(fields(value))
            prefix, extra = bool(own.get(3, 1)), bool(own.get(4, 1))
            assert not own.get(2) and not extra, "only models that keep texts as they are"
    assert 4 not in kinds, "user-defined pieces aren't supported"
    return Model(kind, pieces, scores, kinds, prefix)


class Cutter:
    """Cuts a text into words, in order; their concatenation is the text with spaces as SPACE."""

    def __init__(self, model: Model):
        self.prefix, self.inner, self.run = model.prefix, model.inner, model.run
        self.lines = not any("\n" in p for p in model.inner)
        self.spaces = re.compile(f"(?<={SPACE}{{{self.run}}})(?={SPACE})" if self.run else "(?!)")

    def long(self, word: str) -> list[str]:
        """Cuts where two characters stand side by side in no piece."""
        out, begin = [], 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in self.inner:
                out.append(word[begin:k])
                begin = k
        return [*out, word[begin:]]

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        out: list[str] = []
        text = text.replace(SPACE, " ")
        lines = text.split("\n") if self.lines else [text]
        if self.prefix:
            lines[0] = " " + lines[0]
        for n, line in enumerate(lines):
            if n:
                out.append("\n")
            first, *parts = line.split(" ")
            if first:
                out.append(first)
            if "" not in parts:
                out += [SPACE + p for p in parts]
                continue
            held = ""
            for p in parts:
                held += SPACE + p
                if p:
                    out.append(held)
                    held = ""
            if held:
                out.append(held)
        if max(map(len, out)) > LONG_WORD or "  " in text:
            out = [x for w in out for x in (self.pieces_of(w) if len(w) > LONG_WORD or SPACE * 2 in w else (w,))]
        return out

    def pieces_of(self, word: str) -> list[str]:
        runs = []
        while self.run and word.startswith(SPACE * (self.run + 1)):
            runs.append(word[: self.run])
            word = word[self.run :]
        return runs + (self.long(word) if len(word) > LONG_WORD else [word])


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """known (a piece), id, score, rank, hash: a row per normal piece; the vocabulary bounds its size."""
    ids = list(model.ids.values())
    columns = {"known": pa.array(list(model.ids), pa.string()), "id": pa.array(ids, pa.int32()), "score": pa.array([model.scores[k] for k in ids], pa.float64()), "rank": pa.array([model.ranks[p] for p in model.ids], pa.int32())}
    return spark.createDataFrame(pa.table(columns)).withColumn("hash", F.xxhash64("known"))


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """word -> word, letters, edges. Other columns stay.

    edges: every match of a piece with a substring of two characters or more, as (s, e, symbol), by rank and place; s
    and e count from 0. letters: the symbol of each character, also of those that are no piece. Substrings and pieces
    meet by hash, which Spark looks up as one number, and must then be equal. A unigram model's letters are edges too,
    and edges have scores.
    """
    spark, keys = words.sparkSession, words.columns
    at = words.select(*keys, F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    to = F.sequence(F.lit(1), F.least(F.lit(model.longest), F.length("word") - F.col("start") + 1))
    parts = at.select(*keys, "start", F.explode(to).alias("length")).withColumn("piece", F.expr("substring(word, start, length)"))
    met = parts.withColumn("hash", F.xxhash64("piece")).join(F.broadcast(piece_table(spark, model)), "hash", "left")
    is_piece, one = F.coalesce(F.col("known") == F.col("piece"), F.lit(False)), F.col("length") == 1
    matched = met.where(is_piece | one)
    begin, end = F.col("start") - 1, F.col("start") + F.col("length") - 1
    symbol = F.shiftleft(end.cast("long"), ID_BITS) + F.when(is_piece, F.col("id")).otherwise(F.lit(NO_PIECE))
    if model.kind == UNIGRAM:
        edge = F.struct(begin.alias("s"), end.alias("e"), symbol.alias("symbol"), F.when(is_piece, F.col("score")).alias("score"))
    else:
        low = PLACE_BITS + ID_BITS
        edge = F.when(~one, F.shiftleft(F.col("rank").cast("long"), low + PLACE_BITS) + F.shiftleft(begin.cast("long"), low) + symbol)
    both = matched.select(*keys, F.when(one, symbol).alias("letter"), edge.alias("edge"))
    found = both.groupBy(*keys).agg(F.sort_array(F.collect_list("letter")).alias("letters"), F.sort_array(F.collect_list("edge")).alias("edges"))
    if model.kind == UNIGRAM:
        return found
    place = lambda x: x.bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
    return found.withColumn("edges", F.transform("edges", lambda x: F.struct(place(F.shiftright(x, low)).alias("s"), place(F.shiftright(x, ID_BITS)).alias("e"), x.bitwiseAND((1 << low) - 1).alias("symbol"))))


def end_of(symbol: Column) -> Column:
    return F.shiftright(symbol, ID_BITS).cast("int")


def merge_fold(model: Model) -> Column:
    """A word's symbols, found in merge order: an array with the symbol that begins at each character, or GONE."""

    def fits(symbols: Column, x: Column) -> Column:
        return end_of(F.get(symbols, end_of(F.get(symbols, x["s"])))) == x["e"]

    def taken(symbols: Column, x: Column) -> Column:
        return F.transform(symbols, lambda own, k: F.when(k == x["s"], x["symbol"]).when((k < x["s"]) | (k >= x["e"]), own).otherwise(F.lit(GONE)))

    def step(symbols: Column, _: Column) -> Column:
        best = F.get(F.filter("edges", lambda x: fits(symbols, x)), F.lit(0))
        return F.when(best.isNull(), symbols).otherwise(taken(symbols, best))

    once = F.aggregate("edges", F.col("letters"), lambda symbols, x: F.when(fits(symbols, x), taken(symbols, x)).otherwise(symbols))
    slowly = F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length("word"))), F.col("letters"), step)
    if not model.in_order or len(model.tied) > MOST_TIED:
        return slowly
    if not model.tied:
        return once
    # what tied pieces have in common tells most words apart without a look at their edges
    tied = F.col("word").contains(model.tied_prefix) & F.exists("edges", lambda x: x["symbol"].bitwiseAND(NO_PIECE).isin(*sorted(model.tied)))
    return F.when(tied, slowly).otherwise(once)


def viterbi_fold(model: Model) -> Column:
    """As merge_fold, the symbols on the path with the highest sum of scores. Of equal sums the longer last piece wins."""
    least = min((model.scores[k] for k in model.ids.values()), default=0.0) - 10  # an unknown character's score
    n = F.length("word")
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("symbol")))

    def step(best: Column, end: Column) -> Column:
        arrive = F.filter("edges", lambda x: x["e"] == end)
        paths = F.transform(arrive, lambda x: F.struct((F.get(best, x["s"])["score"] + F.coalesce(x["score"], F.lit(least))).alias("score"), (x["e"] - x["s"]).alias("length"), x["symbol"].alias("symbol")))
        return F.concat(best, F.array(F.array_max(paths)))

    def back(best: Column) -> Column:
        def walk(state: Column, _: Column) -> Column:
            last = F.get(best, state["at"])
            own = F.transform(F.sequence(F.lit(1), last["length"]), lambda k: F.when(k == 1, last["symbol"]).otherwise(F.lit(GONE)))
            return F.when(state["at"] < 1, state).otherwise(F.struct((state["at"] - last["length"]).alias("at"), F.concat(own, state["out"]).alias("out")))

        return F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), F.array().cast("array<bigint>").alias("out")), walk, lambda state: state["out"])

    return F.aggregate(F.sequence(F.lit(1), n), begin, step, back)


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """word (distinct, not empty) -> word, ids. Other columns stay."""
    found = lattice(words, model).withColumn("symbols", viterbi_fold(model) if model.kind == UNIGRAM else merge_fold(model))
    of_byte = F.array(*[F.lit(x) for x in model.byte_ids])
    has_bytes = any(x != model.unknown for x in model.byte_ids)
    id_of = lambda x: x.bitwiseAND(NO_PIECE).cast("int")

    def spelled(k: Column) -> Column:
        digits = F.hex(F.encode(F.col("word").substr(k + 1, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda at: F.get(of_byte, F.conv(F.substring(digits, at, F.lit(2)), 16, 10).cast("int")))

    strange = F.exists("letters", lambda x: id_of(x) == NO_PIECE)
    bytes_ = F.flatten(F.transform("symbols", lambda x, k: F.when(x == GONE, F.array().cast("array<int>")).when(id_of(x) == NO_PIECE, spelled(k) if has_bytes else F.array(F.lit(model.unknown))).otherwise(F.array(id_of(x)))))
    plain = F.transform(F.filter("symbols", lambda x: x != GONE), id_of)
    return found.select(*words.columns, F.when(strange, bytes_).otherwise(plain).alias("ids"))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text, g: the groups of rows that share a dictionary."""
    return located(docs.select("doc_id", "text")).select("doc_id", "text", F.col("__g").alias("g"))


@lean
def rare_words(batches: Iterator[pa.RecordBatch], cutter: Cutter, known: dict[str, bytes], parts: int, folders: int) -> Iterator[pa.RecordBatch]:
    """bucket, g, part, words: the words of each group that aren't known, dealt over parts by their hash, sorted and
    joined by spaces, which no word has.

    Rows of a group follow each other, so a group's words are held until the next one begins. A group that two tasks
    read has rows from both.
    """

    def dealt(g: int, words: set[str]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[str]] = {}
        for w in sorted([w for w in words if w not in known]):
            if len(w) <= LIMIT:
                of.setdefault(zlib.crc32(w.encode()) % parts, []).append(w)
        numbers = list(of)
        for k in range(0, len(numbers), 256):
            now = numbers[k : k + 256]
            columns = [pa.array([g % folders] * len(now), pa.int32()), pa.array([g] * len(now), pa.int64()), pa.array(now, pa.int32()), pa.array([" ".join(of[p]) for p in now], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "g", "part", "words"])

    last, held = 0, set()
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            for text, g in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if g != last:
                    yield from dealt(last, held)
                    last, held = g, set()
                if text:
                    held.update(cutter.words(text))
    yield from dealt(last, held)
    held.clear()  # the worker lives on
    pa.default_memory_pool().release_unused()


@lean
def count_words(batches: Iterator[pa.RecordBatch], cutter: Cutter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(cutter.words(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def frequent_words(docs: DataFrame, n: int, model: Model, cutter: Cutter) -> dict[str, bytes]:
    """Encodings of the words that are frequent in a sample of n docs, FREQUENT at most. Which they are never changes a result."""
    million = 1_000_000
    share = min(million, -(-SAMPLE_DOCS * million // max(1, n)))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(million)) < share).select("text")
    counts = sample.mapInArrow(lambda it: count_words(it, cutter), "word string, n long").where(F.length("word") <= LIMIT).groupBy("word").agg(F.sum("n").alias("n"))
    top = cut(counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).select("word"))
    got = encode_words(top.repartition(-(-FREQUENT // 10_000), "word"), model).toArrow()
    return dict(zip(got["word"].to_pylist(), [np.array(x, "<i4").tobytes() for x in got["ids"].to_pylist()], strict=True))


def rows_of(files: fs.FileSystem, folder: str, g: int, columns: list[str]) -> Iterator[dict]:
    if files.get_file_info(folder).type != fs.FileType.NotFound:
        for batch in dataset.dataset(folder, filesystem=files, format="parquet").scanner(columns=columns, filter=dataset.field("g") == g).to_batches():
            for k in range(batch.num_rows):
                yield {name: batch.column(n)[k] for n, name in enumerate(columns)}


def dictionary(files: fs.FileSystem, words_path: str, ids_path: str, g: int, folders: int) -> dict[str, bytes]:
    """The encodings of a group's words. Where two tasks read the group, a part's words are those of both, sorted."""
    words: dict[int, list[str]] = {}
    for r in rows_of(files, f"{words_path}/bucket={g % folders}", g, ["part", "words"]):
        part, more = r["part"].as_py(), r["words"].as_py().split(" ")
        words[part] = sorted(words[part] + more) if part in words else more
    out: dict[str, bytes] = {}
    for r in rows_of(files, f"{ids_path}/bucket={g % folders}", g, ["part", "sizes", "ids"]):
        values = r["ids"].values.to_numpy().astype("<i4").tobytes()
        ends = (np.cumsum(r["sizes"].values.to_numpy()) * 4).tolist()
        out.update((w, values[a:b]) for w, a, b in zip(words.pop(r["part"].as_py()), [0, *ends], ends, strict=False))
    return out


class Known(dict):
    """The encodings of frequent words; those of others are looked up in the group's dictionary, rare."""

    rare: dict[str, bytes]
    model: Model

    def __missing__(self, word: str) -> bytes:
        return self.rare[word] if len(word) <= LIMIT else self.model.encode_long(word)


def encode(docs: DataFrame, model: Model, with_decoded: bool = False) -> DataFrame:
    """doc_id, text, ids for every row of docs (doc_id, text; other columns are ignored). with_decoded: decoded instead
    of text, what decode gives for ids, and same, whether it is the text, without another pass.

    A null or empty text has no ids. Equal texts have equal ids. SPACE in a text counts as a space. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    own, cutter, n = grouped(docs), Cutter(model), docs.count()
    words_path, path = scratch(spark, "pieces-words"), scratch(spark, "pieces-ids")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, n // PART_DOCS))
    folders = folders_for(n)
    with settings(spark, objectHashAggregate__sortBased__fallbackThreshold=HASHED_WORDS, requireAllClusterKeysForCoPartition=False, execution__arrow__maxRecordsPerBatch=BATCH_ROWS):
        frequent = spark.sparkContext.broadcast(Known(frequent_words(docs, n, model, cutter)))
        schema = "bucket int, g long, part int, words string"
        rare = own.select("text", "g").mapInArrow(lambda it: rare_words(it, cutter, frequent.value, parts, folders), schema)
        rare.write.partitionBy("bucket").option("compression", "zstd").parquet(words_path)
        # one exchange serves the distinct words and the join: it keeps g on either side
        dealt = spark.read.schema(schema).parquet(words_path).select("g", "part", "words").repartitionById(parts, F.col("part")).select("g", "part", F.explode(F.split("words", " ")).alias("word"))
        hint = "shuffle_hash" if n < MOST_PARTS * PART_DOCS else "merge"  # the words of one part fit in memory
        words = dealt.groupBy("part", "word").agg(F.min("g").alias("some")).where("some IS NOT NULL").select("part", "word")
        found = dealt.join(encode_words(words, model).hint(hint), ["part", "word"]).groupBy("g", "part").agg(F.sort_array(F.collect_list(F.struct("word", "ids"))).alias("found"))
        sizes, ids = F.transform("found", lambda x: F.size(x["ids"])), F.flatten(F.transform("found", lambda x: x["ids"]))
        placed = found.select("g", "part", sizes.alias("sizes"), ids.alias("ids"), F.pmod("g", F.lit(folders)).cast("int").alias("bucket"))
        placed.repartition(min(folders, parts), "bucket").sortWithinPartitions("bucket", "g").write.partitionBy("bucket").option("compression", "zstd").parquet(path)

    @lean
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (files, words_at), (_, ids_at) = fs.FileSystem.from_uri(words_path), fs.FileSystem.from_uri(path)
        known, last, spell = frequent.value, None, decoder(model) if with_decoded else None
        known.model = model
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                out, texts = [], part.column(1).to_pylist()
                for text, g in zip(texts, part.column(2).to_pylist(), strict=True):
                    if g != last:
                        known.rare = {}
                        known.rare, last = dictionary(files, words_at, ids_at, g, folders), g
                    out.append(b"".join([known[w] for w in cutter.words(text)]) if text else b"")
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in out])]).astype(np.int32)
                columns = [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(out), "<i4")))]
                if spell:
                    back = [spell(np.frombuffer(x, "<i4").tolist()) for x in out]
                    columns[1] = pa.array(back, pa.string())
                    columns.append(pa.array([a == (b or "").replace(SPACE, " ") for a, b in zip(back, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names)
        known.rare = {}  # the worker lives on

    names = ["doc_id", "decoded", "ids", "same"] if with_decoded else ["doc_id", "text", "ids"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.select("doc_id", "text", "g").mapInArrow(assemble, f"doc_id {kind}, {names[1]} string, ids array<int>{', same boolean' if with_decoded else ''}")


def decoder(model: Model):
    """ids (numpy) -> text. Control and unknown pieces give nothing; bytes that aren't UTF-8 give replacement characters."""
    of = [p.replace(SPACE, " ").encode() if model.kinds[k] == 1 else bytes([int(p[3:5], 16)]) if model.kinds[k] == 6 else b"" for k, p in enumerate(model.pieces)]
    cut = int(model.prefix)

    def decode(ids: list[int]) -> str:
        data = b"".join([of[k] for k in ids])
        return data[cut if data[:1] == b" " else 0 :].decode("utf-8", "replace")

    return decode


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """The columns of encoded and decoded, the text of ids; null ids give null."""
    run = decoder(model)
    at = encoded.columns.index("ids")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 100):  # ids are many times larger as Python's numbers
                part = batch.slice(k, 100)
                texts = [None if x is None else run(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(apply, f"{schema}, decoded string")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = load()
    both = encode(table(spark, sf_dir, "documents"), model, with_decoded=True)
    return both.select("doc_id", "ids", F.size("ids").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"), "same")
