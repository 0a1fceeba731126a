import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01, make_ticks
from ticklab.operators import layout
from ticklab.operators.features import add_features, last_ticks, newest_per_symbol
from ticklab.operators.quality import valid_quote
from ticklab.plans.inspect import count_nodes
from ticklab.schema import FEATURES
from ticklab.sources.ticks import load_ticks


def pandas_features(pdf):
    """Brute-force reference: the same definitions on one ordered pandas frame per symbol."""
    pdf = pdf.sort_values(["symbol", "event_time", "tick_id"]).reset_index(drop=True)
    g = pdf.groupby("symbol")
    out = pdf[["tick_id"]].copy()
    out["price_momentum_5"] = pdf["bid_price"] / g["bid_price"].shift(5) - 1
    out["price_momentum_10"] = pdf["bid_price"] / g["bid_price"].shift(10) - 1
    m = g["ticket_count"].transform(lambda s: s.rolling(50, min_periods=1).mean())
    sd = g["ticket_count"].transform(lambda s: s.rolling(50, min_periods=1).std())
    out["volume_zscore"] = (pdf["ticket_count"] - m) / (sd + 1e-8)
    out["weight_change"] = g["last_price_weight"].diff(1)
    out["weight_velocity"] = g["last_price_weight"].diff(2)
    return out.set_index("tick_id")


def _series(n=60, symbol="A", start_id=0, t0=0):
    rows = []
    for i in range(n):
        rows.append({
            "symbol": symbol, "tick_id": start_id + i, "event_time": t0 + i,
            "bid_price": 100.0 + math.sin(i / 3.0) + i * 0.01,
            "ticket_count": float((i * 7) % 13 + 1), "last_price_weight": float(i % 5) / 2.0,
        })
    return rows


def _compare(spark_df, ref, cols=("price_momentum_5", "price_momentum_10", "volume_zscore", "weight_change", "weight_velocity")):
    got = spark_df.toPandas().set_index("tick_id").sort_index()
    ref = ref.sort_index()
    for c in cols:
        a, b = got[c].to_numpy(dtype=float), ref.loc[got.index, c].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b)), c
        assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)], rtol=1e-9, atol=1e-12), c


def test_single_symbol_edges(spark):
    rows = _series(60)
    df = make_ticks(spark, rows)
    for lay in ("symbol", "chunked"):
        f = add_features(df, layout=lay)
        _compare(f, pandas_features(pd.DataFrame(rows)))
        first = f.where("rn = 0").first()
        assert first.price_momentum_5 is None and first.volume_zscore is None and first.weight_change is None
        assert f.where("rn = 5").first().price_momentum_5 is not None


def test_interleaved_symbols_equal_times_no_leak(spark):
    a = _series(30, "A", 0, 0)
    b = _series(30, "B", 1000, 0)  # same timestamps as A
    rows = a + b
    df = make_ticks(spark, rows)
    f = add_features(df, layout="chunked")
    _compare(f, pandas_features(pd.DataFrame(rows)))
    assert f.where("symbol = 'B' and rn = 0").first().tick_id == 1000


def test_constant_volume_gives_zero_zscore(spark):
    rows = [dict(r, ticket_count=7.0) for r in _series(20)]
    f = add_features(make_ticks(spark, rows), layout="symbol").where("rn > 0")
    assert {r.volume_zscore for r in f.select("volume_zscore").collect()} == {0.0}


def test_chunked_halo_equals_plain_on_driver_data(spark, monkeypatch):
    ticks = valid_quote(load_ticks(spark, SF01))
    plain = add_features(ticks, layout="symbol")
    monkeypatch.setattr(layout, "DEFAULT_CHUNK_ROWS", 64)
    chunked = add_features(ticks, layout="chunked", lookahead={"tick_id": 5})
    j = plain.alias("p").join(chunked.alias("c"), "tick_id")
    assert j.count() == plain.count() == 9900
    cond = " OR ".join(
        f"NOT (p.{c} <=> c.{c}) AND abs(p.{c} - c.{c}) > 1e-9" for c in FEATURES
    )
    assert j.where(cond + " OR p.rn != c.rn").count() == 0


def test_positions_gap_free(spark):
    ticks = valid_quote(load_ticks(spark, SF01))
    p = layout.with_positions(ticks)
    stats = p.groupBy("symbol").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count("*").alias("n"),
                                    F.countDistinct("rn").alias("d")).collect()
    for r in stats:
        assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n


def test_one_exchange_for_all_features(spark):
    ticks = valid_quote(load_ticks(spark, SF01))
    f = add_features(ticks, layout="symbol")
    assert count_nodes(f, "Exchange") == 1
    assert count_nodes(f, "Sort") == 1


def test_last_ticks_and_newest(spark):
    rows = _series(60, "A") + _series(30, "B", 1000) + _series(10, "C", 2000)
    df = make_ticks(spark, rows)
    lt = last_ticks(df, 20, 15)
    counts = {r.symbol: r["count"] for r in lt.groupBy("symbol").count().collect()}
    assert counts == {"A": 20, "B": 20}
    assert set(r.tick_id for r in lt.where("symbol = 'A'").collect()) == set(range(40, 60))
    newest = {r.symbol: r.tick_id for r in newest_per_symbol(df).collect()}
    assert newest == {"A": 59, "B": 1029, "C": 2009}
