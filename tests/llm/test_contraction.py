"""Hot candidate components: the three steps find what all pairs find, and move each set a bounded number of times."""

import random

import pytest
from test_operators import jaccard_roots

from docgraph.llm import minhash
from docgraph.llm.common import scratch
from docgraph.llm.rows import located


def drifting(r, family, n, edits):
    """Texts of 60 words, each made from the one before by a few edits: near its neighbours, far from the first."""
    words = [f"{family}{r.randrange(5000)}" for _ in range(60)]
    out = []
    for _ in range(n):
        for _ in range(edits):
            words[r.randrange(60)] = f"{family}{r.randrange(5000)}"
        out.append(" ".join(words))
    return out


def copies(r, n):
    """Texts of 200 words, each the same but for one word: all of them near each other."""
    words = [f"w{r.randrange(5000)}" for _ in range(200)]
    return [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in r.sample(range(5, 195), n)]


@pytest.mark.parametrize(("families", "n"), [(0, 100), (1, 60), (12, 8)])
def test_a_hot_component_against_all_pairs(spark, monkeypatch, families, n):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 8)
    moved = []
    r = random.Random(families)
    texts = [t for f in range(families) for t in drifting(r, f"{'abcdefghijkl'[f]}", n, 1)] + (copies(r, n) if not families else copies(r, 12))
    r.shuffle(texts)
    path = scratch(spark, "test-texts")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(path)
    rows = located(spark.read.parquet(path))
    printed, _ = minhash.print_docs(rows, 5, lambda _: 0)
    printed = printed.checkpoint()
    nodes = [x.node for x in printed.orderBy("doc_id").collect()]
    chain = sorted(set(nodes))
    candidates = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "a long, b long")  # all in one component
    places = minhash.verified_links

    def counted(rows, at, size):
        moved.append(at.count())
        return places(rows, at, size)

    monkeypatch.setattr(minhash, "verified_links", counted)
    roots = {x.node: x.root for x in minhash.verified_roots(rows, printed, candidates).collect()}
    want = jaccard_roots(texts)
    by_root, by_want = {}, {}
    for k, node in enumerate(nodes):
        by_root.setdefault(roots[node], set()).add(k)
        by_want.setdefault(want[k], set()).add(k)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))
    assert moved[0] == len(chain)
    if not families:
        assert sum(moved) <= 2 * len(chain)  # and not to each of the 13 blocks
