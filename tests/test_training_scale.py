"""What lets the training jobs grow no faster than their tables."""

from pyspark.sql import functions as F

from conftest import make_ticks
from ticklab.ml import models as ml
from ticklab.operators import quality
from ticklab.plans import jobs
from ticklab.schema import FEATURES


def _rows(spark, n, pieces):
    cols = [(F.col("id") * (k + 3) % 101 / 10.0).alias(c) for k, c in enumerate(FEATURES)]
    return spark.range(0, n, 1, pieces).select(*cols, (F.col("id") % 3 == 0).cast("int").alias("label"))


def test_zero_filter_names_a_computed_column_once(spark):
    """A filter that repeats its columns becomes a method that the JVM does not compile."""
    df = spark.range(10).select(*[(F.col("id") * F.lit(k + 0.123)).alias(c) for k, c in enumerate(quality.ZERO_CHECK_COLUMNS)])
    plan = quality.zero_density_filter(df)._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count(" 5.123)") == 1
    assert quality.zero_density_filter(df).count() == 9  # all zero at id 0


def test_fit_has_few_even_partitions(spark, monkeypatch):
    monkeypatch.setattr(ml, "ROWS_A_TASK", 1000)
    uneven = _rows(spark, 2500, 40).unionByName(_rows(spark, 500, 1).repartition(1))
    rows = ml.training_rows(uneven)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert rows.rdd.getNumPartitions() == 3 and sum(sizes) == 3000 and max(sizes) - min(sizes) < 100
    rows.unpersist()
    monkeypatch.setattr(ml, "ROWS_A_PARTITION", 50)
    rows = ml.training_rows(uneven)
    assert rows.rdd.getNumPartitions() == 60
    rows.unpersist()
    small = ml.training_rows(_rows(spark, 1000, 40))
    assert small.rdd.getNumPartitions() == 40 and small.count() == 1000
    small.unpersist()


def test_models_of_a_tick_table_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    together = threading.Barrier(2, timeout=60)
    fit = ml.Pipeline.fit

    def waiting(self, *args):
        together.wait()
        return fit(self, *args)

    monkeypatch.setattr(ml.Pipeline, "fit", waiting)
    train = _rows(spark, 200, 2).withColumns({"label_detection": F.col("label"), "label_persistence": 1 - F.col("label")})
    model = ml.train_two_score(train, ml.GBTParams(max_iter=1, max_depth=1))
    assert list(model.models) == ["detection", "persistence"]
    r = ml.score(model, train).agg(F.max(F.abs(F.col("det_prob") + F.col("per_prob") - 1))).first()[0]
    assert r < 0.2  # each model learned its own label


def test_training_keeps_only_the_columns_it_reads(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "fit_job", lambda s, lab, *a, **k: seen.update(columns=lab.columns))
    ticks = make_ticks(spark, [{"symbol": "S", "tick_id": i, "event_time": i, "bid_price": 100.0 + i % 7} for i in range(30)])
    # ten of the twelve checked columns are null in these rows
    jobs.train_job(spark, ticks.withColumns({c: F.lit(1.0) for c in ("symbol_value", "changed_pct", "available", "in_order")}), "")
    assert set(seen["columns"]) == {*jobs.MODEL_COLUMNS, "label", "label_detection", "label_persistence"}
