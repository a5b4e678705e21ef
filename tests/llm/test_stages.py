"""Each stage of the pipeline against a plain version on its own input; op2 and op7 against plain versions."""

import math
from collections import Counter
from hashlib import sha256
from zlib import crc32

import corpus_pipeline as pipeline
import numpy as np
import pytest
from test_operators import jaccard_roots

from docgraph.llm import media, mixing, quality, toxicity
from docgraph.llm.common import scratch, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of each stage."""
    now, found = table(spark, FOLDER, "documents"), []
    for _, stage in pipeline.STAGES:
        path = scratch(spark, "test-stage")
        stage(spark, now, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        found.append((now, after))
        now = after
    return found


def test_toxic_rows_are_those_that_score_so(spark, steps):
    before, after = steps[0]
    chain = toxicity.train_on(before, table(spark, FOLDER, "labels"))
    rows = before.collect()
    kept = Counter(r.doc_id for r in after.collect())
    toxic = {r.doc_id for r in table(spark, FOLDER, "labels").where("toxic = 1").collect()}
    assert set(kept) <= {r.doc_id for r in rows}
    assert not set(kept) & toxic
    again = Counter(r.doc_id for r in toxicity.drop_flagged(before, chain).collect())
    assert kept == again
    assert len(kept) >= 0.85 * len(rows)


def test_lines_stay_where_they_are_first(steps):
    before, after = steps[1]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    docs_of, first = Counter(), {}
    for r in rows:
        for n, line in enumerate((r.text or "").split("\n")):
            if key(line) not in first or first[key(line)][0] != r.doc_id:
                first.setdefault(key(line), (r.doc_id, n))
        docs_of.update({key(x) for x in (r.text or "").split("\n")})
    want = {}
    for r in rows:
        lines = (r.text or "").split("\n")
        want[r.doc_id] = "\n".join(x for n, x in enumerate(lines) if not key(x) or docs_of[key(x)] < 10 or first[key(x)] == (r.doc_id, n))
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_one_of_each_group_of_copies_stays(steps):
    before, after = steps[2]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    roots = jaccard_roots([r.text for r in rows])
    assert sorted(r.doc_id for r in after.collect()) == [r.doc_id for k, r in enumerate(rows) if roots[k] == k]
    assert after.columns == before.columns


def test_rows_come_as_often_as_the_mix_takes_them(steps):
    before, after = steps[3]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    got = Counter(r.doc_id for r in after.collect())
    assert got == Counter({k: n for k, n in copies.items() if n})
    text = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == text[r.doc_id] for r in after.collect())


def test_texts_come_back(steps):
    before, after = steps[4]
    assert Counter((r.doc_id, r.text) for r in after.where("same").collect()) <= Counter((r.doc_id, r.text) for r in before.collect())
    assert after.count() == before.count()
    assert after.where("n_tokens <> size(ids)").count() == 0


def test_media_columns_by_hand(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in table(spark, FOLDER, "documents").collect()}
    for r in media.op2_media_columns(spark, FOLDER).collect():
        text = docs.pop(r.doc_id)
        payload = text + b"\0" * (-len(text) % 64 or (0 if text else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), sha256(payload).hexdigest(), crc32(payload[-64:]))
        counts = Counter(payload)
        share = [n / len(payload) for n in counts.values()]
        mean = sum(payload) / len(payload)
        spread = math.sqrt(sum((b - mean) ** 2 for b in payload) / len(payload))
        got = r.feature.split()
        assert [float(x) for x in got[:3]] == pytest.approx([mean, spread, -sum(p * math.log2(p) for p in share)], abs=2e-4)
        columns = [sum(payload[k::64]) * 64 > sum(payload) for k in range(64)]
        assert got[3] == "".join(f"{int(''.join(str(int(x)) for x in columns[k : k + 8]), 2):02x}" for k in range(0, 64, 8))
    assert not docs


def test_attention_by_hand(spark):
    """Scores by a plain forward pass, a document and a passage at a time."""
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    model = quality.train_on(docs, table(spark, FOLDER, "labels"))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    p = {k: v.tolist() for k, v in model.p.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    sigma = lambda x: 1 / (1 + math.exp(-x))
    for r in docs.orderBy("doc_id").limit(40).collect():
        energies, embedded = [], []
        for x in quality.passages((r.text or "").encode()):
            z = ((x - model.mean) / model.scale).tolist()
            h = [math.tanh(dot(z, col) + b) for col, b in zip(zip(*p["W"], strict=True), p["b"], strict=True)]
            gate = [math.tanh(dot(h, v)) * sigma(dot(h, u)) for v, u in zip(zip(*p["V"], strict=True), zip(*p["U"], strict=True), strict=True)]
            energies.append(dot(gate, p["w"]))
            embedded.append(h)
        weights = [math.exp(e) / sum(math.exp(x) for x in energies) for e in energies]
        score = sigma(dot([dot(weights, col) for col in zip(*embedded, strict=True)], p["c"]) + p["d"][0])
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-9)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)
        assert got[r.doc_id].held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
    assert np.isfinite([r.score for r in got.values()]).all()
