"""Replays of tables that Spark reads in several pieces, each over the whole time."""

from conftest import make_ticks
from ticklab.operators import quality
from ticklab.operators.features import add_features
from ticklab.plans import jobs


def _ticks(spark):
    rows = [{"symbol": f"S{i % 2}", "tick_id": i, "event_time": 1800 * i, "bid_price": 100.0 + i * 7 % 13, "ticket_count": 6.0 + i % 9,
             "last_price_weight": i % 5 / 10} for i in range(400)]
    return make_ticks(spark, rows).repartition(4)


def test_arrivals_of_many_files_lose_no_tick(spark, monkeypatch):
    ticks = _ticks(spark)
    monkeypatch.setattr(jobs, "load_ticks", lambda *_: ticks)
    got = {r.tick_id: r for r in jobs.r2_stream_features(spark, "").collect()}
    batch = add_features(quality.ensure_required(ticks), nulls="zero", layout="symbol").where("rn >= 49").collect()
    assert len(batch) == 302 and set(got) == {r.tick_id for r in batch}
    assert all(got[r.tick_id].rn == r.rn and abs(got[r.tick_id].price_momentum_5 - r.price_momentum_5) < 1e-6 for r in batch)


def test_a_larger_table_has_more_arrivals_and_a_session_few_state_stores(spark):
    from ticklab.session import stream_session

    ticks = _ticks(spark)
    seen = []
    for src in jobs.replay(spark, ticks, jobs.job_folder(spark, "arrivals"), arrival_rows=100):
        seen.append(spark.read.parquet(src).count())
    assert len(seen) == 4 and seen[-1] == 400 and all(50 < b - a < 150 for a, b in zip([0, *seen], seen))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        assert int(stream_session(spark).conf.get("spark.sql.shuffle.partitions")) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
