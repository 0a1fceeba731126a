import glob
import os
import shutil
import time

from pyspark.sql import functions as F

from conftest import SF001, make_ticks
from ticklab.operators import quality
from ticklab.operators.evaluate import entry_signal
from ticklab.operators.features import add_features
from ticklab.operators.outcomes import LIVE, trade_log
from ticklab.operators.scoring import rule_scores
from ticklab.plans.inspect import scan_info
from ticklab.schema import FEATURES
from ticklab.sources.ticks import load_ticks
from ticklab.streaming.live import dedupe_late, position_stream, stream_features, tick_stream


def _prep(df):
    return rule_scores(df).withColumn("mid_price", (F.col("bid_price") + F.col("ask_price")) / 2.0).withColumn(
        "signal", entry_signal())


def test_stream_equals_batch_with_restart(spark, tmp_path):
    t = load_ticks(spark, SF001)
    src = tmp_path / "in"
    src.mkdir()
    cuts = ["2024-01-11", "2024-01-21"]
    parts = [t.where(F.col("event_time") < cuts[0]),
             t.where((F.col("event_time") >= cuts[0]) & (F.col("event_time") < cuts[1])),
             t.where(F.col("event_time") >= cuts[1])]
    ck, out = str(tmp_path / "ck"), str(tmp_path / "feat")

    def land(i):
        p = parts[i]
        # a duplicate of a row already delivered must be ignored
        if i == 1:
            p = p.unionByName(parts[0].orderBy(F.col("event_time").desc()).limit(1))
        p.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"stage{i}"))
        f = glob.glob(str(tmp_path / f"stage{i}" / "*.parquet"))[0]
        shutil.copy(f, src / f"{i:03d}.parquet")
        time.sleep(1.1)

    def run():
        q = (stream_features(dedupe_late(tick_stream(spark, str(src), 1), "1 day")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    land(0)
    run()
    land(1)
    land(2)
    run()  # restart from the checkpoint
    got = spark.read.parquet(out)
    batch = add_features(quality.liquidity_filter(quality.valid_quote(t, require_ask=True)), nulls="zero",
                         layout="symbol").where("rn >= 49")
    assert got.count() == batch.count() > 0
    j = got.alias("g").join(batch.alias("b"), "tick_id")
    bad = j.where(" OR ".join(f"abs(g.{c} - b.{c}) > 1e-9" for c in FEATURES) + " OR g.rn != b.rn")
    assert bad.count() == 0

    feats = spark.readStream.schema(got.schema).parquet(out)
    q = (position_stream(_prep(feats)).writeStream.format("parquet").option("path", str(tmp_path / "trades"))
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    st = spark.read.parquet(str(tmp_path / "trades"))
    bt = trade_log(_prep(batch), "signal", LIVE, price="mid_price", det="det_prob", per="per_prob",
                   layout="symbol").where("exit_reason != 'END_OF_DATA'")
    k = ["symbol", "entry_pos", "exit_pos", "exit_reason"]
    assert st.count() == bt.count()
    assert st.select(*k).exceptAll(bt.select(*k)).count() == 0


def test_filters_and_columns_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    df = ev.where(F.col("value") > 10).select("event_id", "ts")
    info = scan_info(df)
    assert "value" in info.get("PushedFilters", "")
    assert "props" not in info.get("ReadSchema", "") and "event_id" in info.get("ReadSchema", "")


def test_tick_reads_push_filters_and_prune_days(spark, tmp_path):
    from ticklab.sources.ticks import read_ticks, write_ticks

    path = str(tmp_path / "ticks")
    write_ticks(load_ticks(spark, SF001), path)
    recent = quality.valid_quote(spark.read.parquet(path)).where(F.col("event_date") >= "2024-01-20").select("tick_id", "bid_price")
    info = scan_info(recent)
    assert "bid_price" in info["PushedFilters"] and "event_date" in info["PartitionFilters"]
    assert "last_price_weight" not in info["ReadSchema"]
    scan = scan_info(quality.valid_quote(read_ticks(spark, path)).select("tick_id", "bid_price"))
    assert "last_price_weight" not in scan["ReadSchema"] and "tick_id" in scan["ReadSchema"]


def _replay(spark, tmp_path, batches, name, **kwargs):
    src, out = tmp_path / f"{name}-in", str(tmp_path / f"{name}-out")
    src.mkdir()
    for i, b in enumerate(batches):
        b.coalesce(1).write.parquet(str(tmp_path / f"{name}-{i}"))
        shutil.copy(glob.glob(str(tmp_path / f"{name}-{i}" / "*.parquet"))[0], src / f"{i:03d}.parquet")
        time.sleep(1.1)
    q = (stream_features(dedupe_late(tick_stream(spark, str(src), 1), "1 day"), **kwargs).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def _live_ticks(spark, n=90):
    rows = [{"symbol": "S", "tick_id": i, "event_time": 600 * i, "bid_price": 100.0 + (i * 7) % 13, "ticket_count": 6.0 + i % 9,
             "last_price_weight": i % 5 / 10} for i in range(n)]
    return make_ticks(spark, rows).withColumn("ask_price", F.col("bid_price") + 1)


def test_late_tick_gives_batch_values(spark, tmp_path):
    t = _live_ticks(spark)
    t = t.withColumn("ask_size", F.when(F.col("tick_id") == 60, F.lit(None).cast("double")).otherwise(F.col("ask_size")))  # P4: counts as 0
    batch = {r.tick_id: r for r in add_features(quality.ensure_required(t), nulls="zero", layout="symbol").where("rn >= 49").collect()}
    late = F.col("tick_id") == 55  # arrives one file late, inside the watermark
    far = make_ticks(spark, [{"symbol": "S", "tick_id": 1000, "event_time": 10**7, "bid_price": 100.0}])
    parts = [t.where((F.col("tick_id") < 70) & ~late), t.where((F.col("tick_id") >= 70) | late), far, far.withColumn("tick_id", F.lit(1001).cast("long"))]
    held = {r.tick_id: r for r in _replay(spark, tmp_path, parts, "held", ordered=True).collect()}
    assert set(batch) <= set(held)
    for i, b in batch.items():
        assert all(abs(held[i][c] - b[c]) < 1e-9 for c in FEATURES) and held[i].rn == b.rn, i
    assert held[60].bid_ask_ratio > 1e8
    # scored at arrival: the late tick and all that come after it have the batch values, in time order
    now = {r.tick_id: r for r in _replay(spark, tmp_path, parts[:2], "now").collect()}
    for i in [55, *range(70, 90)]:
        assert all(abs(now[i][c] - batch[i][c]) < 1e-9 for c in FEATURES), i


def test_warm_start_equals_batch_from_the_first_tick(spark, tmp_path):
    """A stream that starts mid-history, with the batch's last 200 ticks a symbol, gives the batch rows."""
    from ticklab.streaming.live import warm_start

    t = load_ticks(spark, SF001)
    cut = F.col("event_time") < "2024-01-21"
    got = _replay(spark, tmp_path, [t.where(~cut)], "warm", initial=warm_start(t.where(cut)))
    batch = add_features(quality.liquidity_filter(quality.valid_quote(t, require_ask=True)), nulls="zero", layout="symbol").where("rn >= 49").where(~cut)
    assert got.count() == batch.count() > 100
    bad = got.alias("g").join(batch.alias("b"), "tick_id").where(" OR ".join(f"abs(g.{c} - b.{c}) > 1e-9" for c in FEATURES) + " OR g.rn != b.rn")
    assert bad.count() == 0
    cold = _replay(spark, tmp_path, [t.where(~cut)], "cold")
    assert cold.count() < got.count()


def test_ring_is_cut_and_idle_symbols_expire(spark, tmp_path):
    """More ticks than the ring's bound, in several batches: the features of the batch; an idle symbol starts anew."""
    t = _live_ticks(spark, 700)
    batch = {r.tick_id: r for r in add_features(t, nulls="zero", layout="symbol").where("rn >= 49").collect()}
    rows = lambda ids, s: make_ticks(spark, [{"symbol": s, "tick_id": i, "event_time": 600 * 700 + 86_400 * 5 * k, "bid_price": 100.0, "ticket_count": 9.0}
                                             for k, i in enumerate(ids)]).withColumn("ask_price", F.lit(101.0))
    back = make_ticks(spark, [{"symbol": "S", "tick_id": 9000 + i, "event_time": 10**7 + i, "bid_price": 100.0, "ticket_count": 9.0} for i in range(60)])
    parts = [t.where("tick_id < 250"), t.where("tick_id >= 250 and tick_id < 500"), t.where("tick_id >= 500"), rows([8000, 8001, 8002], "B"), rows([8100], "B"),
             back.withColumn("ask_price", F.lit(101.0))]
    got = {r.tick_id: r for r in _replay(spark, tmp_path, parts, "ring", ttl_days=3).collect()}
    assert set(batch) | set(range(9049, 9060)) == set(got)
    for i, b in batch.items():
        assert all(abs(got[i][c] - b[c]) < 1e-9 for c in FEATURES) and got[i].rn == b.rn, i
    assert got[9049].rn == 49


def test_one_score_positions(spark, tmp_path):
    rows = [("A", i, float(px), det) for i, (px, det) in enumerate([(100, 0.9), (99.9, 0.5), (99.7, 0.29), (100, 0.9), (101.2, 0.9), (100, 0.1)])]
    df = spark.createDataFrame(rows, "symbol string, rn long, mid_price double, det_prob double").select(
        "*", F.col("det_prob").alias("per_prob"), (F.col("det_prob") >= 0.85).alias("signal"), F.lit("m").alias("model_id"),
        F.timestamp_seconds("rn").alias("event_time"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (position_stream(stream, kind="one_score").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.entry_pos, r.exit_pos, r.exit_reason) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # the live rule may enter again on the exit tick
    assert got == [(0, 2, "SIGNAL_LOST"), (3, 4, "PROFIT"), (4, 5, "STOP_LOSS")]


def _positions(spark, tmp_path, scored, name, initial=None):
    scored.coalesce(1).write.parquet(str(tmp_path / f"{name}-in"))
    stream = position_stream(spark.readStream.schema(scored.schema).parquet(str(tmp_path / f"{name}-in")), initial=initial)
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_positions_opened_before_the_stream_are_closed_by_it(spark, tmp_path):
    """R4 warm start: batch trades before the cut and the stream's after it are the batch's trades over all ticks."""
    from ticklab.streaming.live import open_positions

    t = quality.liquidity_filter(quality.valid_quote(load_ticks(spark, SF001), require_ask=True))
    scored = _prep(add_features(t, nulls="zero", layout="symbol")).withColumn("model_id", F.lit("m")).cache()
    # every third symbol ends on a signal, which opens a position on its last tick of the history
    cut = (F.col("event_time") < "2024-01-16") | ((F.col("rn") <= F.expr("min(CASE WHEN signal AND event_time >= '2024-01-16' THEN rn END) OVER (PARTITION BY symbol)"))
                                                  & F.col("symbol").rlike("[0369]$"))
    marked = scored.withColumn("old", F.coalesce(cut, F.lit(False))).cache()
    old, new = marked.where("old").drop("old"), marked.where("not old").drop("old")
    start = open_positions(old, model_id="m", layout="symbol").cache()
    ends = old.groupBy("symbol").agg(F.max_by("signal", "rn").alias("s"), F.max("rn").alias("entry_pos"))
    assert start.count() > 3 and start.join(ends.where("s"), ["symbol", "entry_pos"]).count() > 0

    def log(ticks):
        return trade_log(ticks, "signal", LIVE, price="mid_price", det="det_prob", per="per_prob", model_id="m", layout="symbol").where("exit_reason != 'END_OF_DATA'")
    k = ["symbol", "entry_pos", "exit_pos", "exit_reason", "entry_time", "entry_price", "return_pct"]
    both = log(old).select(*k).unionByName(_positions(spark, tmp_path, new, "warm", start).select(*k).withColumn("entry_time", F.col("entry_time").cast(dict(scored.dtypes)["event_time"])))
    rows = lambda df: sorted((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in df.collect())
    want = rows(log(scored).select(*k))
    assert rows(both) == want and want
    cold = log(old).select(*k).count() + _positions(spark, tmp_path, new, "cold").count()
    assert cold < len(want)


def test_streams_in_a_session_with_the_default_state_store(spark):
    """The registered streams bring the state store they need, and leave the caller's session as it is."""
    from ticklab.plans.jobs import r4_stream_positions
    from ticklab.session import STATE_STORE

    plain = spark.newSession()
    plain.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    before = dict(plain.conf.getAll)
    assert r4_stream_positions(plain, SF001).count() > 0
    assert dict(plain.conf.getAll) == before


def test_driver_contract(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    rows = out.collect()
    assert len(rows) == 15 and set(out.columns) == {"symbol", "n_ticks", "detections", "persistences"}
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


def test_entry_without_the_training_data_packages(monkeypatch):
    """The other queries stay when a package of the subpackage, or the subpackage itself, cannot be imported."""
    import builtins
    import importlib.util
    import sys

    import pytest

    import __spark_entry__ as e

    real = builtins.__import__
    installed = importlib.util.find_spec("corpus_pipeline") is not None
    for missing in ("public_tokenizers", "ticklab.llm"):
        for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("ticklab.llm")]:
            monkeypatch.delitem(sys.modules, name)

        def blocked(name, *args, missing=missing, **kwargs):
            if name == missing or name.startswith(missing + "."):
                raise ModuleNotFoundError(f"No module named '{missing}'", name=missing)
            return real(name, *args, **kwargs)
        monkeypatch.setattr(builtins, "__import__", blocked)
        if missing == "public_tokenizers" and installed:
            with pytest.warns(UserWarning, match="public_tokenizers"):
                q = e.queries()
        else:
            q = e.queries()
        monkeypatch.setattr(builtins, "__import__", real)
        assert "t2_trade_log" in q and "pipeline" not in q and "op4_exact_dedup" not in q
