"""Language ID: code lengths against a plain byte-by-byte version, held-out accuracy, and odd inputs."""

import random
from math import log2
from zlib import crc32

import pytest

from docgraph.llm import language
from docgraph.llm.common import table
from docgraph.llm.language import UNIT, Trie, grams


def plain_bits(texts: list[bytes], text: bytes, order: int) -> float:
    """Of text under one language's context tree, from a dictionary of contexts."""
    tree: dict[bytes, dict[int, int]] = {}
    for t in texts:
        for i in range(len(t)):
            for k in range(min(i, order) + 1):
                own = tree.setdefault(t[i - k : i], {})
                own[t[i]] = own.get(t[i], 0) + 1
    total = 0.0
    for i in range(len(text)):
        excluded: set[int] = set()
        for k in range(min(i, order), -1, -1):
            left = {s: n for s, n in tree.get(text[i - k : i], {}).items() if s not in excluded}
            if not left:
                continue
            n, kinds = sum(left.values()), len(left)
            if text[i] in left:
                total -= log2(left[text[i]] / (n + kinds))
                break
            total -= log2(kinds / (n + kinds))
            excluded |= set(left)
        else:
            total += log2(256 - len(excluded))
    return total


def trie_of(langs: list[list[bytes]], order: int) -> Trie:
    counts: dict[bytes, list[int]] = {}
    for k, texts in enumerate(langs):
        for t in texts:
            for n in range(1, order + 2):
                for g in grams(t, n):
                    counts.setdefault(g, [0] * len(langs))[k] += 1
    return Trie([f"l{k}" for k in range(len(langs))], counts, order)


@pytest.mark.parametrize("order", [1, 2, 4])
@pytest.mark.parametrize("most", [1 << 26, 0])
def test_lengths_by_plain_matching(order, most, monkeypatch):
    """Short alphabets, so that contexts meet, miss and escape over several orders; with and without the dense table."""
    monkeypatch.setattr(language, "LARGEST_TABLE", most)
    r = random.Random(order)
    for _ in range(25):
        langs = [[bytes(r.choice(a) for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 4))] for a in (b"abc", b"abxy", b"ab\xff")]
        data = [bytes(r.choice(b"abcxyz\xff") for _ in range(r.randint(0, 40))) for _ in range(4)] + [b"", b"q"]
        for text, row in zip(data, trie_of(langs, order).code(data), strict=True):
            for own, got in zip(langs, row, strict=True):
                assert abs(plain_bits(own, text, order) * UNIT - got) <= len(text)


def test_each_byte_is_a_probability():
    """The code lengths of all 256 next bytes are those of one distribution."""
    langs = [[b"abracadabra", b"abab"], [b"xyzzy"]]
    trie = trie_of(langs, 3)
    for before in (b"", b"a", b"ab", b"abr", b"zzz", b"q"):
        base = trie.code([before])[0]
        ends = trie.code([before + bytes([b]) for b in range(256)])
        for k in range(2):
            assert abs(sum(2.0 ** -((e[k] - base[k]) / UNIT) for e in ends) - 1) < 1e-3


def test_long_texts_in_blocks(monkeypatch):
    r = random.Random(3)
    trie = trie_of([[b"the cat sat on the mat"], [b"le chat est sur le tapis"]], 4)
    data = [bytes(r.choice(b"the cat sel") for _ in range(n)) for n in (0, 1, 5, 999, 4000, 3)]
    want = trie.code(data)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert (trie.code(data) == want).all()


def test_held_out_rows(spark):
    """What teaches and what doesn't, and how often rows that taught nothing are right."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in language.op11_language(spark, "/root/testdata/sf0.01").collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in held} == {k for k, r in got.items() if r.held_out}
    right = sum(got[r.doc_id].lang_pred == r.lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    changed = docs.withColumn("lang", language.F.when(language.held_out(), "zz").otherwise(language.F.col("lang")))
    assert language.train(changed).langs == ["de", "en", "es", "fr"]


ODD = [(1, "the cat sat on the mat", "en"), (2, "the dog and the cat", "en"), (3, "le chat est sur le tapis", "fr"), (4, None, "fr"), (5, "", "en"), (6, "123 456 !?", "en"), (7, "the cat", None), (None, "le chat", None), (8, "日本語", None), (3, "le chat est sur le tapis", "fr")]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in ODD], "doc_id long, text string, lang string, lang_pred string, score double")
    trie = language.train(df.select("doc_id", "text", "lang"))
    got = language.predict(df, trie)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "bits"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert [(by[k].lang_pred, by[k].score) for k in (4, 5, 6)] == [("und", 0.0)] * 3
    assert (by[7].lang_pred, by[None].lang_pred, by[None].held_out) == ("en", "fr", False)
    assert by[8].lang_pred in ("en", "fr")
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 3}) == 1
    empty = df.limit(0)
    nothing = language.train(empty)
    assert nothing.langs == []
    assert {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(empty, trie).count() == 0


def test_a_bounded_sample(spark):
    """Thousands of rows of one language: the sample is bounded, whole texts, each text once."""
    df = spark.range(20_000).selectExpr("id AS doc_id", "CONCAT('word', id % 9000, ' and more') AS text", "IF(id % 3 = 0, 'b', 'a') AS lang")
    got = language.sampled(df, most_rows=50, most_bytes=600).collect()
    for lang in "ab":
        own = [r.text for r in got if r.lang == lang]
        assert 0 < len(own) == len(set(own)) <= 50
        assert sum(map(len, own)) <= 600
        assert all(t.endswith(" and more") for t in own)
