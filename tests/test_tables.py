"""The bucketed table and the mirror: what is rewritten, what a failure leaves, what a check finds."""

import os
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from docgraph.session import run_dir, scratch, stored, sweep
from docgraph.sources import mirror, versioned


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_an_upsert_writes_its_keys_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versioned.current(spark, path) is None
    old = spark.range(200_000).select(F.concat(F.lit("d"), "id").alias("doc"), F.lit(1).alias("v"))
    assert len(versioned.upsert(old, path)) == versioned.BUCKETS
    before = files_of(path)
    new = spark.createDataFrame([(f"d{k * 20_000}", 2) for k in range(9)] + [("new", 2)], "doc string, v int")
    touched = versioned.upsert(new, path)
    assert len(touched) <= 10
    added = set(files_of(path)) - set(before)
    assert {x.split("__bucket=")[1].split("/")[0] for x in added} == set(touched)
    assert {k: v for k, v in files_of(path).items() if k in before} == before
    now = versioned.current(spark, path)
    assert (now.count(), now.where("v = 2").count(), now.select("doc").distinct().count()) == (200_001, 10, 200_001)
    assert versioned.current(spark, path, 1).where("v = 2").count() == 0  # a reader of the former version sees it whole
    versioned.vacuum(spark, path)
    assert versioned.current(spark, path).count() == 200_001
    assert len({x.split("/data/")[1].split("/")[0] for x in files_of(path)}) == 2
    assert len(files_of(path)) < len(before) + len(added)


def test_a_failed_upsert_leaves_the_former_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([("a", v), ("b", v), (None, v)], "doc string, v int")
    versioned.upsert(rows(1), path, buckets=4)
    with pytest.raises(Exception, match="too bad"):
        versioned.upsert(rows(2).withColumn("v", F.when(F.col("doc") == "b", F.raise_error(F.lit("too bad")).cast("int")).otherwise(F.col("v"))), path)
    assert {r.v for r in versioned.current(spark, path).collect()} == {1}
    real = versioned.commit

    def late(*args):
        monkeypatch.setattr(versioned, "commit", real)
        versioned.upsert(rows(3), path)  # another writer is first
        return real(*args)

    monkeypatch.setattr(versioned, "commit", late)
    with pytest.raises(RuntimeError, match="another writer"):
        versioned.upsert(rows(2), path)
    assert sorted((r.doc or "", r.v) for r in versioned.current(spark, path).collect()) == [("", 3), ("a", 3), ("b", 3)]
    with pytest.raises(ValueError, match="other columns"):
        versioned.upsert(rows(4).withColumn("w", F.lit(1)), path)
    assert versioned.upsert(rows(5).limit(0), path) == []
    assert versioned.current(spark, path).count() == 3


def test_mirror_round_trip_and_damage(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [("u1.pdf", b"one"), ("u2.pdf", b"two"), ("u3.png", b"one"), ("u4", None), ("u5", b""), ("u6", b"x" * 50), ("u7", b"seven")]
    files = spark.createDataFrame([(u, None if d is None else bytearray(d)) for u, d in rows], "url string, data binary").repartition(3)
    manifest = mirror.store(files, path, F.lit(20))
    got = {r.url: r for r in manifest.collect()}
    assert (got["u1.pdf"].sha256, got["u1.pdf"].bytes) == (sha256(b"one").hexdigest(), 3)
    assert (got["u4"].stored, got["u4"].missing_reason, got["u6"].missing_reason, got["u5"].stored) == (False, "not-fetched", "over 20 bytes", True)
    assert {r.status for r in mirror.checked(manifest.where("stored"), path).collect()} == {"ok"}
    assert mirror.size_of(spark, f"{path}/files").first().asDict() == {"files": 4, "bytes": 11}
    manifest = mirror.store(files, path, F.lit(20))  # again: the same files
    assert manifest.count() == len(rows)
    assert mirror.size_of(spark, f"{path}/files").first().files == 4
    place = lambda d: mirror.place(f"{path}/files", sha256(d).hexdigest())
    with open(place(b"two"), "wb") as f:
        f.write(b"twx")
    os.remove(place(b"seven"))
    status = {r.url: r.status for r in mirror.checked(manifest, path).collect()}
    assert status == {"u1.pdf": "ok", "u2.pdf": "damaged", "u3.png": "ok", "u4": "not-stored", "u5": "ok", "u6": "not-stored", "u7": "missing"}
    caps = spark.createDataFrame([("a.png",), ("b.pdf",)], "url string").select(mirror.cap_of(F.col("url")).alias("c"))
    assert sorted(r.c for r in caps.collect()) == [12 << 20, 60 << 20]


def test_a_runs_scratch_can_be_swept(spark):
    kept = stored(spark.range(10))
    assert kept.count() == 10
    where = run_dir(spark).removeprefix("file://")
    assert os.path.isdir(where)
    assert scratch(spark, "x").startswith(run_dir(spark))
    sweep(spark)
    assert not os.path.exists(where)
