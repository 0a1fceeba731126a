import numpy as np
from pyspark.sql import functions as F

from conftest import SF001, SF01, make_ticks
from ticklab.operators.labels import exact_quantiles, label_balance, labelled_ticks
from ticklab.operators.quality import valid_quote
from ticklab.sources.ticks import load_ticks


def test_fixture_counts_sf001(spark):
    lab, t = labelled_ticks(valid_quote(load_ticks(spark, SF01)))
    b = label_balance(lab).first()
    assert (b.n_rows, b.n_detection, b.n_persistence) == (9900, 382, 117)
    assert not t.fallback_used
    assert abs(t.momentum - 0.007843) < 1e-6 and abs(t.zscore - 0.766472) < 1e-6


def test_fallback_below_100_positives(spark):
    lab, t = labelled_ticks(valid_quote(load_ticks(spark, SF001)))
    assert t.fallback_used and t.detections < 100
    # fallback rule: momentum above its 0.90 quantile
    n_fb = lab.where(F.col("price_momentum_5") > t.fallback).count()
    assert lab.agg(F.sum("label_detection")).first()[0] == n_fb
    # persistence only on (fallback) detections
    assert lab.where("label_persistence = 1 AND label_detection = 0").count() == 0


def test_exact_quantiles_match_numpy_with_narrowing(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=20000).round(4)  # many ties
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double")
    ps = [0.0, 0.1, 0.75, 0.85, 0.9, 1.0]
    got = exact_quantiles(df, {"x": ps}, max_values=300, k=200)
    for p in ps:
        assert got[("x", p)] == np.percentile(vals, p * 100, method="linear") or abs(
            got[("x", p)] - np.percentile(vals, p * 100, method="linear")) < 1e-12
    merged = exact_quantiles(df, {"x": ps})
    for p in ps:
        assert abs(merged[("x", p)] - got[("x", p)]) < 1e-12
    hist = exact_quantiles(df, {"x": ps}, method="histogram")
    for p in ps:
        assert abs(hist[("x", p)] - got[("x", p)]) < 1e-12


def test_persistence_needs_five_following_ticks(spark):
    # one symbol: steady rise with spikes in volume so every late tick is a detection
    rows = []
    for i in range(80):
        rows.append({"symbol": "A", "tick_id": i, "event_time": i, "bid_price": 100.0 * (1.002 ** i),
                     "ticket_count": float(10 + (i % 2) * 30)})
    lab, t = labelled_ticks(make_ticks(spark, rows), layout="symbol", method="histogram")
    last = {r.tick_id: r.label_persistence for r in lab.where("tick_id >= 74").collect()}
    # ticks 75..79 have fewer than five successors -> never persistent
    assert all(last[i] == 0 for i in range(75, 80))


def test_quantiles_take_one_pass_with_observed_sketches(spark):
    """The sketches come from the write; one job counts the brackets, whatever the data's shape."""
    from ticklab.operators import labels

    rng = np.random.default_rng(3)
    shapes = {"normal": rng.normal(size=50_000), "ties": rng.integers(0, 5, 50_000).astype(float), "heavy": np.exp(rng.normal(size=50_000) * 40),
              "infinite": np.concatenate([rng.normal(size=49_990), [np.inf] * 5, [-np.inf] * 5])}
    df = spark.createDataFrame(list(zip(*[x.tolist() for x in shapes.values()])), ", ".join(f"{c} double" for c in shapes)).repartition(7).cache()
    wanted = {c: [0.25, 0.75, 0.9] for c in shapes}
    stats = df.agg(*labels.sketch_stats(wanted)).first().asDict()
    jobs = []
    counted = labels._counted
    labels._counted = lambda *a: jobs.append(1) or counted(*a)
    try:
        got = exact_quantiles(df, wanted, stats=stats)
    finally:
        labels._counted = counted
    assert len(jobs) == 1
    for c, x in shapes.items():
        for p in wanted[c]:
            assert got[c, p] == np.percentile(x, 100 * p, method="linear") or abs(got[c, p] / np.percentile(x, 100 * p, method="linear") - 1) < 1e-12
    # brackets too large for the driver: written, and cut into slices there
    few = exact_quantiles(df, wanted, stats=stats, max_values=20)
    assert few == got
    # a sketch that misses its rank on either side: the counts show it and the bracket is widened
    for ends in ([[-9.0, -8.0] * 3, [8.0, 9.0] * 3]):
        missed = stats | {"ends0": ends}
        assert exact_quantiles(df, {"normal": [0.25, 0.75, 0.9]}, stats=missed) == {("normal", p): got["normal", p] for p in (0.25, 0.75, 0.9)}
    empty = exact_quantiles(df.limit(0), {"normal": [0.5]})
    assert empty == {("normal", 0.5): None}


def test_offsets_of_many_series_equal_those_of_few(spark):
    from ticklab.operators import ordering

    df = spark.range(3000).selectExpr("concat('s', id % 40) as symbol", "id as event_time", "id as tick_id").withColumn("rn", F.expr("floor(tick_id / 40)"))
    sizes = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    a, b = (ordering._offset(df, sizes, ["symbol"], "pos", "rn", few) for few in (100, 10))
    rows = sorted(a.select("tick_id", "pos", "n_total").collect())
    assert rows == sorted(b.select("tick_id", "pos", "n_total").collect())
    assert sorted(r.pos for r in rows) == list(range(3000)) and rows[0].n_total == 3000
