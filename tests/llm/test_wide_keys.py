"""The pipeline's keys for edited copies: chance meetings stay few as texts get more, and no near pair is lost for it."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph.llm import components, minhash, simhash


def unrelated(spark, n):
    """Rows as print_docs makes them, of texts that have nothing in common; the last is a copy of the first with 4 bits
    and a fifth of the minima changed, and no band in common."""
    r = np.random.RandomState(3)
    prints = r.randint(-(1 << 63), 1 << 63, n, dtype=np.int64)
    minima = r.randint(0, 1 << 16, (n, minhash.PERMUTATIONS)).astype(np.uint16)
    prints[-1] = prints[0] ^ 0b1011001
    minima[-1] = minima[0]
    minima[-1, : minhash.BANDS * minhash.ROWS : minhash.ROWS] ^= 1
    minima[-1, 100] ^= 1
    low, high = minhash.halves(list(minima))
    rows = [(k, int(p), 50, True, bytearray(a), bytearray(b)) for k, (p, a, b) in enumerate(zip(prints, low, high, strict=True))]
    return spark.createDataFrame(rows, "node long, print long, shingles long, lead boolean, low binary, high binary")


@pytest.fixture
def buckets(monkeypatch):
    """How many buckets were compared, for each call."""
    found = []

    def counted(df, own=components.cut):
        out = own(df)
        if {"key", "n"} <= set(out.columns):
            found.append(out.count())
        return out

    monkeypatch.setattr(components, "cut", counted)
    return found


def test_unrelated_texts_seldom_share_a_bucket(spark, buckets):
    """With keys of bits alone 10,000 such texts met in thousands of buckets, and five times the texts in 25 times as many."""
    n = 10_000
    links = simhash.copy_candidates(unrelated(spark, n), simhash.WIDE_DISTANCE)
    assert {x.root for x in components.components(links).where(F.col("node").isin(0, n - 1)).collect()} == {0}
    assert links.where("a <> b").distinct().count() == 1
    assert buckets and max(buckets) <= 200  # those of the copy, and a few


def test_near_pairs_share_a_key_as_often_as_before():
    """10 bits changed and a fifth of the minima: bits alone, with two more of them exact, found 0.83 of such pairs."""
    r, n = np.random.RandomState(4), 5000
    a = r.randint(0, 1 << 63, n, dtype=np.uint64)
    b = a.copy()
    for k in np.argsort(r.rand(n, 64), axis=1)[:, : simhash.WIDE_DISTANCE].T:
        b ^= np.uint64(1) << k.astype(np.uint64)
    x = r.randint(0, 1 << 16, (n, simhash.COMBOS))
    y = np.where(r.rand(*x.shape) < 0.8, x, r.randint(0, 1 << 16, x.shape))
    keys, rows = simhash.wide_keys(a, x)
    of = [set() for _ in range(n)]
    for k, at in zip(keys.tolist(), rows.tolist(), strict=True):
        assert k not in of[at]
        of[at].add(k)
    keys, rows = simhash.wide_keys(b, y)
    met = {at for k, at in zip(keys.tolist(), rows.tolist(), strict=True) if k in of[at]}
    assert len(met) >= 0.87 * n


def test_keys_tell_combinations_minima_and_bits_apart():
    prints = np.array([12345], np.uint64)
    minima = np.zeros((1, simhash.COMBOS), np.int64)
    whole = set(simhash.wide_keys(prints, minima)[0].tolist())
    for k in range(simhash.COMBOS):
        other = minima.copy()
        other[0, k] = 0xFFFF
        rest = set(simhash.wide_keys(prints, other)[0].tolist())
        assert whole - rest and {x >> 40 for x in whole - rest} == {x >> 40 for x in rest - whole} == {k}


def test_buckets_of_one_group_are_not_compared(spark, buckets):
    """Bucket 1 has one group; 2 has two groups, with repeated rows; 3 is one node, repeated; 4 is a pair of one group."""
    rows = [(1, k, 0) for k in range(9)] + [(2, 0, 0), (2, 1, 0), (2, 1, 0), (2, 17, 17)] + [(3, 40, 40)] * 5 + [(4, 0, 0), (4, 2, 0)]
    keys = spark.createDataFrame(rows, "key long, node long, known long")
    links = components.bucket_links(keys, partial(simhash.near, distance=1), lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= 1, repeats=True)
    assert [(min(x), max(x)) for x in links.collect()] == [(1, 17)]
    assert buckets == [1]


def test_texts_of_one_fingerprint_have_the_keys_of_each(spark):
    """Two sets with one fingerprint; only the second shares minima with a third set whose fingerprint is near."""
    printed = unrelated(spark, 50).collect()
    one, two, three = (printed[k].asDict() for k in (0, 1, 49))
    two |= {"print": one["print"], "low": one["low"], "high": one["high"]}
    one |= {"low": printed[2].low, "high": printed[2].high}
    links = simhash.copy_candidates(spark.createDataFrame([one, two, three], "node long, print long, shingles long, lead boolean, low binary, high binary"), simhash.WIDE_DISTANCE)
    assert {x.root for x in components.components(links).collect()} == {0}
    assert components.components(links).count() == 3
