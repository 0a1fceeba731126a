"""Bucketed series: no exchange below windows and outcomes, results as on plain ticks."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01, make_ticks
from ticklab.operators.bucketed import bucketed_exits, bucketed_features, drop_bucketed, write_bucketed
from ticklab.operators.features import add_features
from ticklab.operators.outcomes import BACKTEST, ExitRules, signal_exits
from ticklab.operators.quality import valid_quote
from ticklab.schema import FEATURES
from ticklab.sources.ticks import load_ticks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    name = write_bucketed(valid_quote(load_ticks(spark, SF01)), blocks=3)  # 93 positions a chunk: many chunk ends
    yield name
    drop_bucketed(spark, name)


def rounded(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_features_equal_plain_windows_without_exchange(spark, table):
    got = bucketed_features(spark, table, {"price_momentum_5": 5})
    assert "Exchange" not in plan(got) and "Window" in plan(got)
    want = add_features(valid_quote(load_ticks(spark, SF01)), layout="symbol", lookahead={"price_momentum_5": 5})
    cols = ["tick_id", "rn", *[F.coalesce(c, F.lit(-9.0)) for c in [*FEATURES, *(f"price_momentum_5_next{k}" for k in range(1, 6))]]]
    assert rounded(got, cols) == rounded(want, cols)


@pytest.mark.parametrize("rules", [ExitRules(), ExitRules(max_hold=7, trailing=False), ExitRules(profit_target=0.2, stop_loss=0.2, trailing_min_peak=0.2)])
def test_exits_equal_the_band_join_without_exchange(spark, table, rules):
    signal = F.col("tick_id") % 9 == 0
    got = bucketed_exits(bucketed_features(spark, table, halo=True), signal, rules)
    assert not re.search(r"Exchange|Join", plan(got))
    want = signal_exits(valid_quote(load_ticks(spark, SF01)), signal, rules, price="bid_price")
    cols = [c for c in want.columns if not c.endswith("prob")]
    rows = rounded(got, cols)
    assert len(rows) > 1000 and rows == rounded(want, cols)


def test_short_series_and_other_rules(spark, table):
    rows = [{"symbol": "A", "tick_id": k, "event_time": k, "bid_price": 100.0 + (5.0 if k == 40 else 0.0)} for k in range(42)]
    name = write_bucketed(make_ticks(spark, rows), blocks=2, buckets=2)
    out = {r.entry_pos: r for r in bucketed_exits(bucketed_features(spark, name, halo=True), F.col("tick_id").isin(0, 35, 41)).collect()}
    assert (out[0].exit_reason, out[0].ticks_held) == ("MAX_HOLD", 30)
    assert (out[35].exit_reason, out[35].exit_pos) == ("PROFIT_TARGET", 40)
    assert (out[41].exit_reason, out[41].exit_pos) == ("END_OF_DATA", 41)
    empty = write_bucketed(make_ticks(spark, rows).limit(0), buckets=2)
    assert bucketed_features(spark, empty).count() == 0
    for rules in (BACKTEST, ExitRules(max_hold=31)):
        with pytest.raises(ValueError):
            bucketed_exits(spark.table(table), F.lit(True), rules)
