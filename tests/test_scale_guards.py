"""Inputs the fixture lacks: flat and long positions, gapped positions, ties, NaN and zero quotes, sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, make_ticks
from ticklab.operators import layout
from ticklab.operators.labels import exact_quantiles
from ticklab.operators.outcomes import BACKTEST, LIVE, ExitRules, signal_exits, trade_log
from ticklab.operators.quality import ensure_required, jump_filter, valid_quote
from ticklab.sources.ticks import load_ticks, read_ticks


def price_path(spark, prices, signals, symbol="S"):
    rows = [{"symbol": symbol, "tick_id": i, "event_time": i, "bid_price": float(p)} for i, p in enumerate(prices)]
    return make_ticks(spark, rows).withColumn("mid_price", F.col("bid_price")).withColumn("signal", F.col("tick_id").isin(list(signals)))


def walk_exit(prices, s, rules):
    peak = -np.inf
    for t in range(s, len(prices)):
        ret = (prices[t] - prices[s]) / prices[s]
        peak = max(peak, ret)
        if rules.mode == "live":
            if t > s and (ret >= rules.profit_target or ret <= -rules.stop_loss):
                return t, "PROFIT" if ret >= rules.profit_target else "STOP_LOSS"
        elif ret >= rules.profit_target:
            return t, "PROFIT_TARGET"
        elif ret <= -rules.stop_loss:
            return t, "STOP_LOSS"
        elif peak > rules.trailing_min_peak:
            if ret < peak * rules.trailing_keep:
                return t, "TRAILING_STOP"
        elif t - s >= rules.max_hold:
            return t, "MAX_HOLD"
    return len(prices) - 1, "END_OF_DATA"


def test_flat_series_keeps_every_signal(spark):
    ticks = price_path(spark, [100.0] * 5000, range(0, 5000, 500))
    live = signal_exits(ticks, rules=LIVE).collect()
    assert len(live) == 10 and {(r.exit_pos, r.exit_reason) for r in live} == {(4999, "END_OF_DATA")}
    assert [r.entry_pos for r in trade_log(ticks, rules=LIVE).collect()] == [0]
    assert len(signal_exits(ticks, rules=BACKTEST).collect()) == 10


@pytest.mark.parametrize("rules", [BACKTEST, LIVE, ExitRules(mode="backtest", max_hold=3)])
def test_long_positions_match_a_plain_walk(spark, rules):
    rng = np.random.default_rng(5)
    prices = 100 * np.exp(np.cumsum(rng.normal(0, 0.00035, 9000)))  # exits lie hundreds of ticks away
    prices[200:4600] = prices[200] * 1.004 + np.linspace(0, 0.05, 4400)  # armed, then quiet for 4400 ticks
    signals = [0, 10, 150, 199, 200, 201, 3000, 4599, 4600, 8000, 8990, 8999]
    got = {r.entry_pos: (r.exit_pos, r.exit_reason) for r in signal_exits(price_path(spark, prices, signals), rules=rules).collect()}
    assert got == {s: walk_exit(prices.tolist(), s, rules) for s in signals}


def test_partitions_follow_the_input_size(spark, monkeypatch):
    df = load_ticks(spark, SF001)
    base = layout.range_partitions(df)
    monkeypatch.setattr(layout, "TARGET_PARTITION_BYTES", 1024)
    many = layout.range_partitions(df)
    assert many > base == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert layout.range_partitions(df.unionByName(df)) > many
    assert layout.range_partitions(df.crossJoin(df.select("tick_id").toDF("b")).crossJoin(df.select("tick_id").toDF("c"))) <= layout.MAX_PARTITIONS


def test_jump_filter_with_gapped_positions(spark, monkeypatch):
    t = valid_quote(load_ticks(spark, SF001))
    gapped = layout.with_positions(t).where("rn % 3 <> 1")
    want = {r.tick_id for r in jump_filter(gapped.drop("rn")).collect()}
    monkeypatch.setattr(layout, "DEFAULT_LAYOUT", "chunked")
    monkeypatch.setattr(layout, "DEFAULT_CHUNK_ROWS", 64)
    assert {r.tick_id for r in jump_filter(gapped).collect()} == want


@pytest.mark.parametrize("values", [[0.0] * 5000, [0.0] * 5000 + [1.0], [-1e308, 1e308, 0.0, 5e-324], [float("inf"), -1.0, 2.0, 3.0], [7.0]])
def test_quantiles_of_ties_and_extremes_end(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ps = [0.0, 0.3, 0.5, 0.85, 1.0]
    got = exact_quantiles(df, {"x": ps}, max_values=100)
    ordered = sorted(values)
    for p in ps:
        k = p * (len(values) - 1)
        a, b = ordered[int(np.floor(k))], ordered[int(np.ceil(k))]
        want = a if a == b else a + (b - a) * (k - np.floor(k))
        assert got["x", p] == pytest.approx(want, nan_ok=True)


def test_zero_and_nan_quotes(spark, tmp_path):
    from ticklab.operators.evaluate import auc
    from ticklab.operators.features import add_features

    rows = [{"symbol": "A", "tick_id": i, "event_time": i, "bid_price": 100.0 + i} for i in range(20)]
    t = make_ticks(spark, rows).withColumn("bid_price", F.when(F.col("tick_id") == 7, F.lit(None).cast("double"))
                                          .when(F.col("tick_id") == 9, F.lit(float("nan"))).otherwise(F.col("bid_price")))
    t.write.parquet(str(tmp_path / "t"))
    back = read_ticks(spark, str(tmp_path / "t"))
    assert {r.tick_id for r in back.where("bid_price is null").collect()} == {7, 9}
    assert {r.tick_id for r in valid_quote(back).collect()} == set(range(20)) - {7, 9}
    feats = {r.tick_id: r.price_momentum_5 for r in add_features(ensure_required(back)).collect()}
    assert feats[12] is None and feats[14] is None and feats[7] == -1.0  # nothing to divide by after a zero
    # products of class counts beyond the range of long
    big = spark.range(2).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("score"))
    assert auc(big).first().auc == 1.0


def test_checkpoint_folder_is_required_off_local(spark):
    from types import SimpleNamespace

    from ticklab.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)
