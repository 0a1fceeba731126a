from pyspark.sql import functions as F

from conftest import SF001
from ticklab.ml import models as ml
from ticklab.operators.labels import labelled_ticks
from ticklab.operators.ordering import global_positions, positional_split
from ticklab.operators.quality import complete_cases, valid_quote
from ticklab.sources.ticks import load_ticks


def test_train_save_load_score_round_trip(spark, tmp_path):
    lab, _ = labelled_ticks(valid_quote(load_ticks(spark, SF001)))
    split = positional_split(global_positions(complete_cases(lab).drop("rn")))
    train = split.where("split = 'train'")
    params = ml.GBTParams(max_iter=3, max_depth=3)
    model = ml.train_two_score(train, params)
    scored = ml.score(model, split)
    stats = scored.agg(F.min("det_prob"), F.max("det_prob"), F.min("per_prob"), F.max("per_prob"), F.count("*")).first()
    assert 0.0 <= stats[0] <= stats[1] <= 1.0 and 0.0 <= stats[2] <= stats[3] <= 1.0
    assert stats[4] == split.count()

    root = str(tmp_path / "registry")
    first = ml.save(model, spark, root, {"train": 1, "val": 1, "test": 1}, {"auc": 0.5})
    one = ml.train_one_score(train, params)
    second = ml.save(one, spark, root, {"train": 2}, {"auc": 0.6})
    reg = ml.registry(spark, root).collect()
    assert [r.model_id for r in reg][:1] == [second] and {r.kind for r in reg} == {"two_score", "one_score"}
    assert reg[0].feature_cols == ml.FEATURES

    newest = ml.load(spark, root)
    assert newest.model_id == second and newest.kind == "one_score"
    again = ml.load(spark, root, model_id=first)
    a = ml.score(again, split).select("tick_id", "det_prob", "per_prob")
    b = scored.select("tick_id", "det_prob", "per_prob")
    diff = a.alias("a").join(b.alias("b"), "tick_id").where("abs(a.det_prob - b.det_prob) > 1e-12 OR abs(a.per_prob - b.per_prob) > 1e-12")
    assert diff.count() == 0

    preds = ml.predictions(scored, model)
    assert {r.task for r in preds.select("task").distinct().collect()} == {"detection", "persistence"}


def test_registered_jobs_fit_the_reference_number_of_trees(spark):
    from ticklab.plans.jobs import job_params

    key = "spark.ticklab.gbt.maxIter"
    set_before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert job_params(spark) == ml.GBTParams() and job_params(spark).max_iter == 200
        spark.conf.set(key, "3")
        assert job_params(spark) == ml.GBTParams(max_iter=3)
    finally:
        spark.conf.unset(key) if set_before is None else spark.conf.set(key, set_before)


def test_loss_curve_ends_at_the_models_log_loss(spark, tmp_path):
    """One row a task, split and round; the last round equals E6, and an ensemble cut to k trees equals round k."""
    from pyspark.sql import functions as F

    from conftest import SF01
    from ticklab.ml import models as ml
    from ticklab.operators import quality
    from ticklab.operators.labels import labelled_ticks
    from ticklab.plans.jobs import fit_job
    from ticklab.sources.ticks import load_ticks

    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, SF01)), layout="symbol")
    rounds = 4
    for kind in ("two_score", "one_score"):
        root = str(tmp_path / kind)
        _, table = fit_job(spark, lab, root, kind, ml.GBTParams(max_iter=rounds), curve=True)
        curve = spark.read.parquet(f"{root}/results/loss_curve").drop("run_id")
        tasks = 2 if kind == "two_score" else 1
        assert curve.count() == curve.select("task", "split", "round").distinct().count() == tasks * 3 * rounds
        last = curve.where(F.col("round") == rounds).join(table.select("task", "split", F.col("log_loss").alias("e6")), ["task", "split"])
        assert last.count() == tasks * 3 and last.where("abs(log_loss - e6) > 1e-6").count() == 0
    # fewer rounds with the same seed are the same first trees
    _, short = fit_job(spark, lab, str(tmp_path / "short"), "one_score", ml.GBTParams(max_iter=2))
    two = curve.where("round = 2").join(short.select("task", "split", F.col("log_loss").alias("e6")), ["task", "split"])
    assert two.count() == 3 and two.where("abs(log_loss - e6) > 1e-6").count() == 0
