"""Whole batches, model swap between micro-batches, kept state."""

import glob
import shutil
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ticklab.ml import models as ml
from ticklab.operators import quality
from ticklab.operators.labels import labelled_ticks
from ticklab.plans.jobs import fit_job
from ticklab.schema import FEATURES
from ticklab.sources.ticks import load_ticks
from ticklab.streaming import commits
from ticklab.streaming.live import dedupe_late, score_batches, stream_features, tick_stream


@pytest.fixture(scope="module")
def labelled(spark):
    return labelled_ticks(quality.valid_quote(load_ticks(spark, SF001)), layout="symbol")[0]


def publish(spark, labelled, root, kind="two_score", seed=42, trees=2):
    model, _ = fit_job(spark, labelled, root, kind, ml.GBTParams(max_iter=trees, seed=seed))
    return ml.registry(spark, root).select("model_id").first()[0]


class Replay:
    def __init__(self, spark, tmp_path, registry):
        self.spark, self.src, self.tmp, self.registry = spark, tmp_path / "in", tmp_path, registry
        self.sink = str(tmp_path / "scored")
        self.src.mkdir()
        t = load_ticks(spark, SF001)
        days = F.col("event_time")
        self.parts = [t.where(days < "2024-01-11"), t.where((days >= "2024-01-11") & (days < "2024-01-21")), t.where(days >= "2024-01-21")]

    def land(self, i):
        self.parts[i].coalesce(1).write.parquet(str(self.tmp / f"p{i}"))
        shutil.copy(glob.glob(str(self.tmp / f"p{i}" / "*.parquet"))[0], self.src / f"{i:03d}.parquet")
        time.sleep(1.1)

    def run(self):
        feats = stream_features(dedupe_late(tick_stream(self.spark, str(self.src), 1), "1 day"))
        q = score_batches(feats, self.registry, self.sink, str(self.tmp / "ck"))
        q.awaitTermination()


def test_model_swap_between_batches_keeps_state(spark, tmp_path, labelled):
    root = str(tmp_path / "models")
    one = publish(spark, labelled, root)
    r = Replay(spark, tmp_path, root)
    r.land(0)
    r.land(1)
    r.run()
    first = len(commits.commits(spark, r.sink))
    assert first >= 2 and {m["model_id"] for m in commits.commits(spark, r.sink)} == {one}
    two = publish(spark, labelled, root, kind="one_score", seed=7, trees=4)
    r.land(2)
    r.run()
    done = commits.commits(spark, r.sink)
    assert {m["model_id"] for m in done[first:]} == {two} and {m["kind"] for m in done[first:]} == {"one_score"}
    out = commits.read_committed(spark, r.sink).cache()
    assert out.count() == sum(m["rows"] for m in done) == out.select("tick_id").distinct().count()
    # the batches' rows carry the ids of their models
    for m in done:
        ids = {x[0] for x in out.where(F.col("batch_id") == m["batch_id"]).select("model_id").distinct().collect()}
        assert ids <= {m["model_id"]}
    # positions went on over the swap, and each row's scores are those of its batch's model
    steps = out.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), (F.max("rn") - F.min("rn") + 1).alias("span"), F.min("rn").alias("first"))
    assert steps.where("n <> span or first <> 49").count() == 0
    for model_id in (one, two):
        mine = out.where(F.col("model_id") == model_id)
        again = ml.score(ml.load(spark, root, model_id=model_id), mine.select("tick_id", *FEATURES)).select("tick_id", F.col("det_prob").alias("d"), F.col("per_prob").alias("p"))
        joined = mine.join(again, "tick_id")
        assert joined.count() == mine.count() > 0
        assert joined.where("abs(d - det_prob) > 1e-12 or abs(p - per_prob) > 1e-12").count() == 0


def test_a_killed_batch_is_not_seen_and_runs_again(spark, tmp_path, labelled, monkeypatch):
    root = str(tmp_path / "models")
    publish(spark, labelled, root)
    r = Replay(spark, tmp_path, root)
    for i in range(3):
        r.land(i)
    real, calls = commits.commit, []

    def fail_once(spark_, sink, manifest):
        calls.append(manifest["batch_id"])
        if manifest["batch_id"] == 1 and calls.count(1) == 1:
            raise RuntimeError("killed after the files, before the manifest")
        return real(spark_, sink, manifest)
    monkeypatch.setattr(commits, "commit", fail_once)
    with pytest.raises(Exception):
        r.run()
    assert [m["batch_id"] for m in commits.commits(spark, r.sink)] == [0]
    files = spark.read.parquet(glob.glob(f"{r.sink}/data/batch_id=1/*")[0])  # they are there, and no reader sees them
    assert files.count() > 0 and commits.read_committed(spark, r.sink, files.schema).where("batch_id <> 0").count() == 0
    r.run()  # restart: batch 1 again, then the rest
    done = commits.commits(spark, r.sink)
    out = commits.read_committed(spark, r.sink)
    assert [m["batch_id"] for m in done] == list(range(len(done))) and len(glob.glob(f"{r.sink}/data/batch_id=1/*")) == 2
    assert out.count() == out.select("tick_id").distinct().count() == sum(m["rows"] for m in done)
    # a published batch that is replayed keeps its first result
    assert commits.write_batch(out.limit(1), r.sink, 0) is None and commits.commits(spark, r.sink) == done


def test_empty_sink(spark, tmp_path):
    assert commits.commits(spark, str(tmp_path)) == []
    with pytest.raises(ValueError):
        commits.read_committed(spark, str(tmp_path))
    assert commits.read_committed(spark, str(tmp_path), "a long").count() == 0
    empty = spark.range(0)
    assert commits.write_batch(empty, str(tmp_path / "s"), 5)["rows"] == 0
    assert commits.read_committed(spark, str(tmp_path / "s"), "id long").count() == 0
