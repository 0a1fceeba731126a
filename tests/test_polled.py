"""The polled source: limits, equal times, restarts, late files, odd files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, make_ticks
from ticklab.sources.incremental import read_since
from ticklab.sources.polled import PolledReader, poll_ticks
from ticklab.sources.ticks import load_ticks, write_ticks
from ticklab.schema import TICKS


def drain(spark, stream, tmp_path, name="out"):
    """Polls until nothing is new, stops; (rows, rows a poll)."""
    out = str(tmp_path / name)
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-ck")
         .trigger(processingTime="0 seconds").start())
    try:
        q.processAllAvailable()
        polls = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    return spark.read.schema(stream.schema).parquet(out), polls


def ids(df):
    return sorted(r.tick_id for r in df.select("tick_id").collect())


def test_polls_equal_the_batch_read(spark, tmp_path):
    t = load_ticks(spark, SF001)
    path = str(tmp_path / "ticks")
    write_ticks(t, path)
    since = t.agg(F.expr("max(event_time) - interval 20 days")).first()[0]
    got, polls = drain(spark, poll_ticks(spark, path, limit=300, since=since), tmp_path)
    want = read_since(t, since)
    cols = [c for c in t.columns]
    n = want.count()
    assert polls == [300] * (n // 300) + ([n % 300] if n % 300 else [])
    typed = want.select([F.col(f.name).cast(f.dataType) for f in TICKS.fields])
    assert got.count() == n and got.select(cols).exceptAll(typed.select(cols)).isEmpty()
    # the first poll is the batch form's poll
    first = read_since(t, since, 300)
    one, _ = drain(spark, poll_ticks(spark, path, limit=300, since=since).withColumn("poll", F.lit(1)).limit(300), tmp_path, "one")
    assert ids(one) == ids(first)


def test_equal_times_restarts_and_new_files(spark, tmp_path):
    """Ten rows a time, polls of 17, ids of later files go on at the mark's own time."""
    path = tmp_path / "ticks"

    def land(first, last):
        rows = [{"symbol": "S", "tick_id": i, "event_time": i // 10, "bid_price": 100.0} for i in range(first, last)]
        make_ticks(spark, rows).repartition(3).write.mode("append").parquet(str(path))
    land(0, 95)
    stream = poll_ticks(spark, str(path), limit=17)
    got, polls = drain(spark, stream, tmp_path)
    assert ids(got) == list(range(95)) and polls == [17] * 5 + [10]
    land(95, 120)  # 95 to 99 share their time with the rows before the mark
    got, polls = drain(spark, stream, tmp_path)  # restart from the checkpoint
    assert ids(got) == list(range(120)) and polls == [17, 8]
    got, polls = drain(spark, stream, tmp_path)
    assert ids(got) == list(range(120)) and not polls


def test_a_failed_poll_is_read_again(spark, tmp_path):
    path, seen = tmp_path / "ticks", []
    make_ticks(spark, [{"symbol": "S", "tick_id": i, "event_time": i, "bid_price": 1.0} for i in range(10)]).write.parquet(str(path))

    def run(fail):
        def handle(batch, batch_id):
            rows = ids(batch)
            if fail and batch_id == 1:
                raise RuntimeError("lost")
            seen.append((batch_id, rows))
        q = (poll_ticks(spark, str(path), limit=4).writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    with pytest.raises(Exception):
        run(True)
    run(False)
    assert seen == [(0, [0, 1, 2, 3]), (1, [4, 5, 6, 7]), (2, [8, 9])]


def test_nulls_bad_quotes_odd_files_and_delay(spark, tmp_path):
    path = tmp_path / "ticks"
    rows = [{"symbol": "S", "tick_id": i, "event_time": i, "bid_price": 0.0 if i == 2 else 5.0} for i in range(6)]
    t = make_ticks(spark, rows)
    t = t.withColumn("ask_price", F.when(F.col("tick_id") == 3, F.lit(float("nan"))).when(F.col("tick_id") != 4, F.lit(6.0)))
    t = t.withColumn("event_time", F.when(F.col("tick_id") != 5, F.col("event_time")))
    extra = t.where("tick_id = 1").withColumn("tick_id", F.lit(None).cast("long"))
    t.unionByName(extra).unionByName(extra).withColumn("note", F.lit("x")).drop("market").coalesce(1).write.parquet(str(path))
    (path / "_temporary").mkdir()
    (path / "_temporary" / "half.parquet").write_bytes(b"PAR1")
    (path / ".hidden.parquet").write_bytes(b"x")
    (path / "empty.parquet").write_bytes(b"")
    got, polls = drain(spark, poll_ticks(spark, str(path), limit=2), tmp_path)
    # both rows without an id share a place: one poll, over the limit
    assert sorted((r.tick_id is None, r.tick_id or 0) for r in got.collect()) == [(False, 0), (False, 1), (True, 0), (True, 0)]
    assert got.where("market is not null").isEmpty() and got.columns == TICKS.names and polls == [3, 1]
    every, _ = drain(spark, poll_ticks(spark, str(path), quotes=False), tmp_path, "every")
    assert every.count() == 7  # all but the row without a time
    late, _ = drain(spark, poll_ticks(spark, str(path), quotes=False, delay=2), tmp_path, "late")
    assert late.agg(F.max("tick_id")).first()[0] == 2  # two seconds behind the newest
    none, polls = drain(spark, poll_ticks(spark, str(tmp_path / "nowhere")), tmp_path, "none")
    assert none.isEmpty() and not polls
    with pytest.raises(ValueError):
        PolledReader({"path": str(path), "limit": "0"}, TICKS)


def test_planning_prunes_days_and_row_groups(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ticks")
    write_ticks(load_ticks(spark, SF001), path)
    opened = []
    real = PolledReader._footer
    monkeypatch.setattr(PolledReader, "_footer", lambda self, fs, name: opened.append(name) or real(self, fs, name))
    mark = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
    r = PolledReader({"path": path, "limit": "10"}, TICKS)
    end = r.latestOffset()
    assert len(opened) == sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)
    opened.clear()
    parts = r.partitions(r.initialOffset(), end)
    assert not opened  # footers are kept
    days = {g.file.split("event_date=")[1][:10] for p in parts for g in p.groups}
    assert days == {"2024-01-01"}
    later = PolledReader({"path": path, "limit": "10", "since": str(int(mark.timestamp()) * 10**6)}, TICKS)
    later.latestOffset()
    assert opened and min(n.split("event_date=")[1][:10] for n in opened) >= "2024-01-18"
