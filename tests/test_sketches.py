"""Day sketches: any range of days without reading ticks again, within the stated error."""

import datetime as dt

from pyspark.sql import functions as F

from ticklab.operators.sketches import day_sketches, distinct_in, read_sketches, store_sketches


def test_ranges_within_the_stated_error(spark, tmp_path):
    """40 days of ids that overlap: each range's estimate lies within four standard errors of the exact count."""
    ids = spark.range(200_000).select((F.col("id") % 73_000).cast("string").alias("symbol"), F.expr("timestamp_seconds(1704067200 + (id % 40) * 86400 + id % 86400)").alias("event_time")).cache()
    path = str(tmp_path)
    day = F.datediff(F.to_date("event_time"), F.lit("2024-01-01"))
    store_sketches(day_sketches(ids.where(day < 30)), path)
    store_sketches(day_sketches(ids.where(day >= 30)), path)
    store_sketches(day_sketches(ids.where(day == 3)), path)  # a day again: replaced, not added
    d = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    ranges = [(d(0), d(39), "all"), (d(3), d(3), "day"), (d(5), d(17), "some"), (d(38), d(60), "over the end"), (d(9), d(8), "none"), (None, d(3), "null"), (d(100), d(101), "later")]
    df = spark.createDataFrame(ranges + ranges[:1], "first date, last date, name string")
    out = {r.name: r for r in distinct_in(read_sketches(spark, path), df).collect()}
    assert len(out) == len(ranges)
    for first, last, name in ranges:
        r = out[name]
        if name in ("none", "null", "later"):
            assert (r.n_days, r.n_rows, r.n_distinct) == (0, 0, 0)
            continue
        mine = ids.where(F.to_date("event_time").between(F.lit(first), F.lit(last)))
        exact, n = mine.agg(F.count_distinct("symbol"), F.count(F.lit(1))).first()
        assert r.n_rows == n and abs(r.n_distinct - exact) <= 4 * 0.01625 * exact
    assert out["all"].n_days == 40 and out["over the end"].n_days == 2


def test_few_values_nulls_and_empty(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 2)), (None, dt.datetime(2024, 1, 2)), ("c", None)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp")
    both = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "first date, last date")
    r = distinct_in(day_sketches(df), both).first()
    assert (r.n_days, r.n_rows, r.n_distinct) == (2, 4, 2)
    assert day_sketches(df.limit(0)).count() == 0 and distinct_in(day_sketches(df.limit(0)), both).first().n_rows == 0
