"""Daily feature store: equals the full recompute, reads one day and the carry-over."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, make_ticks
from ticklab.operators.daily import read_features, stored_days, update_features, with_lookahead
from ticklab.operators.features import add_features
from ticklab.operators.quality import valid_quote
from ticklab.schema import FEATURES
from ticklab.sources.ticks import load_ticks

COLS = ["tick_id", "symbol", "rn", *FEATURES]


def rows(df, cols=COLS):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("layout", ["symbol", "chunked"])
def test_daily_updates_equal_the_full_recompute(spark, tmp_path, layout, monkeypatch):
    from ticklab.operators import layout as module

    monkeypatch.setattr(module, "DEFAULT_CHUNK_ROWS", 64)
    ticks = valid_quote(load_ticks(spark, SF001)).cache()
    days = sorted(r[0] for r in ticks.select(F.to_date("event_time")).distinct().collect())
    store = str(tmp_path)
    day = F.to_date("event_time")
    cuts = [days[0], days[9], days[20], days[21], days[-1] + dt.timedelta(days=1)]
    for a, b in zip(cuts, cuts[1:]):
        done = update_features(store, ticks.where((day >= F.lit(a)) & (day < F.lit(b))), layout)
        assert done == [d for d in days if a <= d < b]
    want = rows(add_features(ticks, layout="symbol"))
    assert rows(read_features(spark, store)) == want
    # a batch that runs again replaces its days; look-ahead crosses days
    update_features(store, ticks.where(day >= F.lit(days[21])), layout)
    assert rows(read_features(spark, store)) == want and stored_days(spark, store) == days
    ahead = ["tick_id", "tick_id_next1", "tick_id_next5", "volume_zscore_next3"]
    plain = add_features(ticks, layout="symbol", lookahead={"tick_id": 5, "volume_zscore": 5})
    assert rows(with_lookahead(read_features(spark, store), layout=layout), ahead) == rows(plain, ahead)


def test_an_update_reads_its_day_and_the_carry_over(spark, tmp_path):
    ticks = valid_quote(load_ticks(spark, SF001)).cache()
    day = F.to_date("event_time")
    last = ticks.agg(F.max(day)).first()[0]
    store = str(tmp_path)
    update_features(store, ticks.where(day < F.lit(last)))
    for f in (tmp_path / "features").glob("*/*.parquet"):
        f.write_bytes(b"nothing may read this")
    update_features(store, ticks.where(day == F.lit(last)))
    newest = read_features(spark, store, recent=1)  # the other days' files are broken: not opened
    want = add_features(ticks, layout="symbol").where(day == F.lit(last))
    assert rows(newest) == rows(want) and newest.count() > 0


def test_order_of_days_and_empty_batches(spark, tmp_path):
    store = str(tmp_path)
    hour = 3600
    t = [{"symbol": "A", "tick_id": k, "event_time": k * 12 * hour, "bid_price": 100.0 + k} for k in range(8)]  # two a day
    t += [{"symbol": "B", "tick_id": 100, "event_time": 5 * hour, "bid_price": 7.0}, {"symbol": None, "tick_id": 101, "event_time": 5, "bid_price": 7.0}]
    ticks = make_ticks(spark, t).cache()
    day = F.datediff(F.to_date("event_time"), F.lit("2024-01-01"))
    assert update_features(store, ticks.limit(0)) == [] and stored_days(spark, store) == []
    update_features(store, ticks.where(day <= 1))
    update_features(store, ticks.where(day == 2))
    update_features(store, ticks.where(day == 3))  # B has no tick since day 0 and stays carried
    carried = spark.read.parquet(f"{store}/carry").where("as_of = '2024-01-04'")
    assert {(r.symbol, r.rn) for r in carried.collect()} == {("A", k) for k in range(8)} | {("B", 0)}
    with pytest.raises(ValueError):
        update_features(store, ticks.where(day == 2))  # day 3 would keep features of the old day 2
    with pytest.raises(ValueError):
        update_features(store, ticks.where(day >= 1))  # day 0 does not end a batch
    assert update_features(store, ticks.where(day >= 2)) == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    assert rows(read_features(spark, store)) == rows(add_features(ticks.where("symbol is not null"), layout="symbol"))


def test_retrain_from_store_stores_what_it_measures(spark, tmp_path):
    """The metrics recomputed from the stored predictions equal the stored metrics."""
    from ticklab.ml.models import GBTParams
    from ticklab.operators.evaluate import log_loss, metrics
    from ticklab.plans.jobs import retrain_from_store

    from conftest import SF01

    store, root = str(tmp_path / "store"), str(tmp_path / "models")
    update_features(store, valid_quote(load_ticks(spark, SF01)))
    model, table = retrain_from_store(spark, store, root, recent=3, params=GBTParams(max_iter=3))
    preds = spark.read.parquet(f"{root}/results/predictions").drop("run_id")
    stored = spark.read.parquet(f"{root}/results/metrics").drop("run_id")
    again = metrics(preds, ("task", "split")).join(log_loss(preds, ("task", "split")), ["task", "split"])
    cols = sorted(stored.columns)
    assert rows(stored, cols) == rows(again, cols) == rows(table, cols)
    last = read_features(spark, store, recent=3)
    assert last.select(F.to_date("event_time")).distinct().count() == 3
    assert preds.where("task = 'detection'").count() == last.dropna(subset=FEATURES).count()
