"""What plans may not do, whatever the planner's estimates are."""

from functools import partial

import numpy as np
import pytest

from docgraph.llm import components, minhash, pieces, simhash


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture
def joins(monkeypatch):
    """The physical plans of the tables that were cut."""
    plans = []
    for module in (components, minhash):
        monkeypatch.setattr(module, "cut", lambda df, own=module.cut: plans.append(physical(df)) or own(df))
    return plans


@pytest.mark.parametrize(("keys_of", "distance"), [(simhash.fuzzy_keys, simhash.DISTANCE), (simhash.wide_keys, simhash.WIDE_DISTANCE)])
def test_keys_of_fingerprints_are_not_broadcast(spark, keys_of, distance):
    """Of some bytes a fingerprint, which is what the planner sees, come some thousand of keys."""
    prints = simhash.spread(spark.range(2000).selectExpr("id % 40 * 3 AS node").distinct(), 64)
    keys = prints.mapInArrow(lambda it: simhash.emit_keys(it, keys_of), "key long, node long")
    links = components.bucket_links(keys, partial(simhash.near, distance=distance), lambda a, b: simhash.F.bit_count(a.bitwiseXOR(b)) <= distance)
    assert "BroadcastHashJoin" not in physical(links) and "SortMergeJoin" in physical(links)
    roots = {x.node: x.root for x in components.components(links).collect()}
    nodes = np.arange(40) * 3
    near = [(a, b) for a in nodes.tolist() for b in nodes.tolist() if a < b and (a ^ b).bit_count() <= simhash.DISTANCE]
    assert all(roots[a] == roots[b] for a, b in near)


def test_keys_of_bands_are_not_broadcast(spark, joins):
    texts = [f"{' '.join(f'w{k}' for k in range(60))} {n}" for n in range(30)]
    rows = minhash.located(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    printed, _ = minhash.print_docs(rows, 5, lambda _: 0)
    minhash.band_candidates(printed)
    assert joins and not any("BroadcastHashJoin" in x for x in joins)


def test_words_are_cut_in_small_batches(spark, monkeypatch):
    """No task that cuts words is sent more than BATCH_ROWS texts at once, and the session's setting is as before."""
    sizes = spark.sparkContext.accumulator(0)
    big = 20 * pieces.BATCH_ROWS

    def counted(batches, *args, own=pieces.rare_words):
        def seen():
            for batch in batches:
                sizes.add(batch.num_rows > pieces.BATCH_ROWS)
                yield batch

        return own(seen(), *args)

    monkeypatch.setattr(pieces, "rare_words", counted)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(big).selectExpr("id AS doc_id", "concat('a word ', id % 7) AS text").coalesce(1)
    got = pieces.encode(docs, pieces.load(), with_decoded=True)
    assert got.where("same").count() == big
    assert sizes.value == 0 and spark.conf.get(name) == before
