"""What tasks hold: small batches, addresses instead of texts, and nothing after they end."""

from docgraph.llm import minhash
from docgraph.llm.common import BATCH_ROWS, lean
from docgraph.llm.rows import kept, located, noted


def test_rows_are_kept_without_sending_texts_to_python(spark, tmp_path):
    spark.range(30).selectExpr("id AS doc_id", "concat('text ', id) AS text", "id * 2 AS `odd.name`").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    rows = located(docs)
    winners = noted(rows.where("doc_id % 3 = 0").select("__g", "__r"), 2, "test-winners")
    out = kept(rows, winners, docs)
    assert sorted(tuple(x) for x in out.collect()) == [(k, f"text {k}", k * 2) for k in range(0, 30, 3)]
    assert out.columns == docs.columns
    assert "MapInArrow" not in out._jdf.queryExecution().sparkPlan().toString()


def test_workers_give_freed_memory_back(monkeypatch):
    called = []
    monkeypatch.setattr("docgraph.llm.common.give_back", lambda: called.append(1))

    def run(it):
        yield from it

    assert list(lean(run)([1, 2])) == [1, 2] and called == [1]


def test_sets_are_sent_in_small_batches(spark, tmp_path, monkeypatch):
    big = spark.sparkContext.accumulator(0)
    own = minhash.print_rows

    def counted(batches, *args):
        def seen():
            for batch in batches:
                big.add(batch.num_rows > BATCH_ROWS)
                yield batch

        return own(seen(), *args)

    monkeypatch.setattr(minhash, "print_rows", counted)
    spark.range(3 * BATCH_ROWS).selectExpr("id AS doc_id", "concat('a word ', id % 7) AS text").coalesce(1).write.parquet(f"{tmp_path}/docs")
    printed, _ = minhash.print_docs(located(spark.read.parquet(f"{tmp_path}/docs")), 5, lambda _: 0)
    assert printed.count() == 3 * BATCH_ROWS and big.value == 0
