"""Composed jobs: the flagship detection report, the trade-log queries, training (M6),
ingest round trips and streaming replays."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.functions.exprs import mid_price
from ticklab.operators import quality
from ticklab.schema import FEATURES
from ticklab.operators.labels import labelled_ticks
from ticklab.operators.layout import SERIES_KEYS, SERIES_ORDER
from ticklab.operators.outcomes import BACKTEST, LIVE, positioned, trade_log
from ticklab.operators.evaluate import entry_signal
from ticklab.operators.scoring import rule_scores
from ticklab.session import materialize, stream_session
from ticklab.sources.ticks import load_ticks


def detections_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: ticks -> F1 -> W1-W5/P7-P10 -> L1-L4 -> per-symbol label counts."""
    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)))
    return lab.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.sum("label_detection").cast("long").alias("detections"),
        F.sum("label_persistence").cast("long").alias("persistences"),
    )


def scored_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)))
    scored = rule_scores(quality.complete_cases(lab)).drop("rn")
    scored = scored.withColumn("mid_price", mid_price())
    return positioned(scored)


def t2_trade_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest walk (one position per symbol, reference exit order) for the two-score rule."""
    s = scored_ticks(spark, sf_dir)
    return trade_log(s, entry_signal("det_prob", "per_prob", 0.7, 0.5), BACKTEST, price="mid_price",
                     det="det_prob", per="per_prob", model_id="rule_two")


def t3_live_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live exit rule over the same scored ticks."""
    s = scored_ticks(spark, sf_dir)
    return trade_log(s, entry_signal("det_prob", "per_prob", 0.7, 0.5), LIVE, price="mid_price",
                     det="det_prob", per="per_prob", model_id="rule_two")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint location (never machine-local)."""
    from ticklab.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


#: What training and scoring read of a tick: its place in the series and its features.
MODEL_COLUMNS = [*SERIES_KEYS, *SERIES_ORDER, *FEATURES]


def train_job(
    spark: SparkSession,
    ticks: DataFrame,
    root: str,
    recent: int | None = None,
    kind: str = "two_score",
    params=None,
):
    """M6: recent window -> F1 -> F4 -> F3 -> features -> labels -> 60/20/20 split -> fit ->
    evaluate (E7 + E6) -> publish to the registry. Returns (model, metrics DataFrame)."""
    t = quality.valid_quote(ticks)
    if recent:
        t = quality.recent_days(t, recent)
    t = quality.zero_density_filter(t)
    lab, _ = labelled_ticks(t, keep=MODEL_COLUMNS)
    return fit_job(spark, lab, root, kind, params)


def retrain_from_store(spark: SparkSession, store: str, root: str, recent: int, kind: str = "two_score", params=None):
    """M6 on a daily feature store: the newest days' stored features -> labels -> ``fit_job``. No feature of an older
    day is computed or read; the window's first ticks look back into the day before it."""
    from ticklab.operators.daily import read_features, with_lookahead
    from ticklab.operators.labels import label_features

    feats = materialize(with_lookahead(read_features(spark, store, recent)), "recent-features")
    lab, _ = label_features(feats)
    return fit_job(spark, lab, root, kind, params)


def fit_job(spark: SparkSession, lab: DataFrame, root: str, kind: str = "two_score", params=None, curve: bool = False):
    """Labelled features -> 60/20/20 split -> fit -> evaluate (E7 + E6) -> publish to the registry, results stored;
    with ``curve`` also the log loss after every boosting round, as the table ``loss_curve``."""
    from ticklab.ml import models as ml
    from ticklab.operators.evaluate import log_loss, metrics
    from ticklab.operators.ordering import global_positions, positional_split

    params = params or ml.GBTParams()
    cc = quality.complete_cases(lab).drop("rn")
    split = materialize(positional_split(global_positions(cc)), "split")
    train = split.where(F.col("split") == "train")
    model = ml.train_two_score(train, params) if kind == "two_score" else ml.train_one_score(train, params)
    scored = ml.score(model, split)
    preds = materialize(ml.predictions(scored, model), "predictions")
    table = metrics(preds, ("task", "split")).join(log_loss(preds, ("task", "split")), ["task", "split"])
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    flat = {}
    for r in table.collect():
        for m in ("accuracy", "precision", "recall", "f1", "auc", "log_loss"):
            flat[f"{r['task']}_{r['split']}_{m}"] = r[m]
    model_id = ml.save(model, spark, root, counts, flat)
    write_results(root, model_id, predictions=preds, metrics=table, **({"loss_curve": ml.loss_curve(model, split)} if curve else {}))
    return model, table


def write_results(root: str, run_id: str, **tables: DataFrame) -> dict[str, str]:
    """Persist result tables (predictions, trades, metrics, ...) as parquet, one folder per
    table and run; the reference only printed them."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/results/{name}/run_id={run_id}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


RECENT_DAYS = 3  # fixed value: the retrain window


def job_params(spark: SparkSession):
    """Model settings of the registered jobs: GBTParams; the session setting ``spark.ticklab.gbt.maxIter``
    replaces its number of trees."""
    from ticklab.ml.models import GBTParams

    return GBTParams(max_iter=int(spark.conf.get("spark.ticklab.gbt.maxIter", str(GBTParams.max_iter))))


def job_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a job, so runs and jobs do not read each other's tables."""
    import uuid

    return shared_folder(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def m6_retrain_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 on the recent window; returns the metric table."""
    _, table = train_job(spark, load_ticks(spark, sf_dir), job_folder(spark, "m6"), recent=RECENT_DAYS, params=job_params(spark))
    return table


def e6_loss_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training curve of the recent window's models over their training, validation and test rows."""
    root = job_folder(spark, "curve")
    t = quality.recent_days(quality.valid_quote(load_ticks(spark, sf_dir)), RECENT_DAYS)
    lab, _ = labelled_ticks(quality.zero_density_filter(t), keep=MODEL_COLUMNS)
    fit_job(spark, lab, root, params=job_params(spark), curve=True)
    return spark.read.parquet(f"{root}/results/loss_curve").select("task", "split", "round", "log_loss")


def m6_daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of all days, kept by three updates: all but the last two days, then each of them on its own."""
    from ticklab.operators.daily import read_features, update_features

    ticks = quality.valid_quote(load_ticks(spark, sf_dir))
    store = job_folder(spark, "daily")
    last = ticks.agg(F.max(F.to_date("event_time"))).first()[0]
    day = F.datediff(F.lit(last), F.to_date("event_time"))
    for batch in (day >= 2, day == 1, day == 0):
        update_features(store, ticks.where(batch))
    out = read_features(spark, store).select("tick_id", "symbol", "rn", "price_momentum_5", "volume_zscore", "weight_velocity")
    return out.withColumns({c: F.round(c, 6) for c in ("price_momentum_5", "volume_zscore", "weight_velocity")})


def m6_daily_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 from a daily store of cleaned ticks; returns the metric table."""
    from ticklab.operators.daily import update_features

    store = job_folder(spark, "daily")
    update_features(store, quality.zero_density_filter(quality.valid_quote(load_ticks(spark, sf_dir))))
    _, table = retrain_from_store(spark, store, job_folder(spark, "m6"), RECENT_DAYS, params=job_params(spark))
    return table


def a1_distinct_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct symbols and rows of every week that ends on a day with ticks, from stored day sketches; the last day is
    stored by an update of its own."""
    from ticklab.operators.sketches import day_sketches, distinct_in, read_sketches, store_sketches

    ticks = quality.valid_quote(load_ticks(spark, sf_dir))
    path = job_folder(spark, "sketches")
    last = F.to_date("event_time") == F.lit(ticks.agg(F.max(F.to_date("event_time"))).first()[0])
    for part in (~last, last):
        store_sketches(day_sketches(ticks.where(part)), path)
    kept = read_sketches(spark, path)
    weeks = kept.select(F.date_sub("event_date", 6).alias("first"), F.col("event_date").alias("last"))
    return distinct_in(kept, weeks)


def m1_training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the training matrix: one row per complete tick with its split, labels and feature vector's size
    and sum (the vector as the models see it)."""
    from pyspark.ml.functions import vector_to_array

    from ticklab.ml.models import assembler
    from ticklab.operators.ordering import global_positions, positional_split

    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)))
    split = positional_split(global_positions(quality.complete_cases(lab).drop("rn")))
    x = vector_to_array(F.col("features"))
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    return assembler().transform(split).select("tick_id", "split", "label_detection", "label_persistence",
                                               F.size(x).alias("n_features"), F.round(total, 4).alias("feature_sum"))


def m5_registry_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M5: split sizes in the registry row, and rows whose scores differ between the trained model and
    the one loaded back (none)."""
    from ticklab.ml import models as ml

    root = job_folder(spark, "m5")
    model, _ = train_job(spark, load_ticks(spark, sf_dir), root, params=job_params(spark))
    loaded = ml.load(spark, root, kind="two_score")
    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)), keep=MODEL_COLUMNS)
    cols = ["tick_id", "det_prob", "per_prob"]
    both = ml.score(model, lab).select(*cols).alias("a").join(ml.score(loaded, lab).select(*cols).alias("b"), "tick_id")
    differ = ~(F.col("a.det_prob").eqNullSafe(F.col("b.det_prob")) & F.col("a.per_prob").eqNullSafe(F.col("b.per_prob")))
    row = ml.registry(spark, root).where(F.col("model_id") == loaded.model_id)
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(differ).alias("n_differ")).join(
        row.select("kind", "n_train", "n_val", "n_test"))


def m4_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M4 + M5 round trip: train a one-score model, publish, load it back, score all rows."""
    from ticklab.ml import models as ml

    root = job_folder(spark, "m4")
    model, _ = train_job(spark, load_ticks(spark, sf_dir), root, kind="one_score", params=job_params(spark))
    loaded = ml.load(spark, root, model_id=model.model_id)
    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)), keep=MODEL_COLUMNS)
    return ml.score(loaded, lab).select("symbol", "tick_id", "det_prob", "per_prob", "det_pred", "per_pred", "model_id")


def s6_sql_dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tick view written as an INSERT dump (quotes, commas and NULLs included), then
    parsed back by the distributed dump reader."""
    import uuid

    from ticklab.sources.dump import read_sql_dump, write_sql_dump

    path = shared_folder(spark, f"dump-{uuid.uuid4().hex[:8]}")
    t = load_ticks(spark, sf_dir)
    tid = F.col("tick_id")
    t = t.withColumn("changed_by", F.when(tid % 7 == 0, F.lit("it's, (a) feed")).when(tid % 11 == 0, F.lit("NULL"))
                     .otherwise(F.col("changed_by")))
    write_sql_dump(t, path)
    return read_sql_dump(spark, path)


def s2_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned ticks written partitioned by day and read back, every row."""
    import uuid

    from ticklab.sources.ticks import write_ticks

    path = shared_folder(spark, f"ticks-{uuid.uuid4().hex[:8]}")
    clean = quality.zero_density_filter(quality.valid_quote(load_ticks(spark, sf_dir), require_ask=True))
    write_ticks(clean, path)
    return spark.read.parquet(path)


ARRIVALS = 3  # of a replay, at least
ARRIVAL_ROWS = 4_000_000  # ticks of an arrival, about


def replay(spark: SparkSession, ticks: DataFrame, root: str, n_arrivals: int = ARRIVALS, arrival_rows: int = ARRIVAL_ROWS) -> Iterator[str]:
    """Ticks as arrivals in time order (cut at time quantiles), the way a feed lands in a folder; yields that folder after
    each arrival, so that a stream takes the arrival as one micro-batch. Its files cover the same time: read one after
    the other, the first one's watermark would drop the ticks of the others. A larger table has more arrivals of the
    same size, so a micro-batch stays bounded."""
    n = max(n_arrivals, -(-ticks.count() // arrival_rows))
    secs = F.unix_micros(F.col("event_time").cast("timestamp"))
    cuts = ticks.agg(F.percentile_approx(secs, [i / n for i in range(1, n)], 10000).alias("c")).first()["c"]
    bounds = [None, *cuts, None]
    for i in range(n):
        cond = F.lit(True)
        if bounds[i] is not None:
            cond = cond & (secs >= F.lit(bounds[i]))
        if bounds[i + 1] is not None:
            cond = cond & (secs < F.lit(bounds[i + 1]))
        ticks.where(cond).write.mode("overwrite").parquet(f"{root}/in/arrival={i:04d}")
        yield f"{root}/in"


def replay_features(spark: SparkSession, src: str) -> DataFrame:
    """R1 + R6 + R2: all new tick files of a folder in one micro-batch -> watermark/dedupe -> per-symbol buffered
    features."""
    from ticklab.streaming.live import dedupe_late, stream_features, tick_stream

    streams = stream_session(spark)
    # the next arrival takes the watermark on; a batch without ticks would only cost a commit of every state store
    streams.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return stream_features(dedupe_late(tick_stream(streams, src, 1 << 20)))


def _run_to_parquet(stream: DataFrame, root: str, name: str) -> DataFrame:
    """The rows of a stream that ran until nothing was new, in the stream's session."""
    spark = stream.sparkSession
    q = (stream.writeStream.format("parquet").option("path", f"{root}/{name}")
         .option("checkpointLocation", f"{root}/_ck_{name}").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/{name}")


def r1_polled_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + O6 as a stream: all but the last two days of ticks land, then each of them; after each arrival the query
    starts again from its checkpoint and polls until nothing is new."""
    from ticklab.sources.polled import poll_ticks

    ticks = load_ticks(spark, sf_dir)
    root = job_folder(spark, "polled")
    last = ticks.agg(F.max(F.to_date("event_time"))).first()[0]
    day = F.datediff(F.lit(last), F.to_date("event_time"))
    for arrival in (day >= 2, day == 1, day == 0):
        ticks.where(arrival).write.mode("append").parquet(f"{root}/in")
        polls = poll_ticks(spark, f"{root}/in").select("tick_id", "symbol", "bid_price", "ask_price", "ticket_count", "event_time")
        q = (polls.writeStream.format("parquet").option("path", f"{root}/ticks").option("checkpointLocation", f"{root}/_ck")
             .trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return spark.read.schema(polls.schema).parquet(f"{root}/ticks")


def _replayed_features(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """(root folder, the features of the streamed ticks, in the streams' session)"""
    root = job_folder(spark, "replay")
    for src in replay(spark, load_ticks(spark, sf_dir), root):
        done = _run_to_parquet(replay_features(spark, src), root, "features")
    return root, done


def r2_stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R6 + R2: tick files -> watermark/dedupe -> per-symbol buffered features."""
    root, _ = _replayed_features(spark, sf_dir)
    out = spark.read.parquet(f"{root}/features")
    return out.withColumns({c: F.round(c, 6) for c in FEATURES})


def r6_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + R6 on a stream of three arrivals: ticks of every 77th id come twice, and every 50th of the first days comes
    with the last arrival, past the watermark. The counts of all micro-batches, added."""
    from ticklab.functions.exprs import zero_count
    from ticklab.schema import ZERO_CHECK_COLUMNS
    from ticklab.streaming.counts import COUNTS, counted, read_counts, store_counts
    from ticklab.streaming.live import tick_stream

    ticks = load_ticks(spark, sf_dir)
    root = job_folder(spark, "counts")
    newest = ticks.agg(F.max(F.to_date("event_time"))).first()[0]
    day = F.datediff(F.lit(newest), F.to_date("event_time"))
    late = (day >= 21) & (F.col("tick_id") % 50 == 0)
    twice = (F.col("tick_id") % 77 == 0) & ~late
    feed = ticks.withColumn("_copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_copy")
    arrival = F.when(late | (day < 10), 2).when(day < 20, 1).otherwise(0)
    good = (F.col("bid_price") > 0) & (zero_count(ZERO_CHECK_COLUMNS) < 10)
    for i in range(3):
        feed.where(arrival == i).write.mode("append").parquet(f"{root}/in")
        kept = counted(tick_stream(spark, f"{root}/in", 1 << 20), good)
        q = (kept.writeStream.format("parquet").option("path", f"{root}/ticks").option("checkpointLocation", f"{root}/_ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        store_counts(spark, f"{root}/counts", q.recentProgress)
    return read_counts(spark, f"{root}/counts").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _position_folder(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """R2 -> rule scores -> R4 live position lifecycle, as two chained streaming queries; the second reads
    the features file by file, so positions stay open across micro-batches. (root folder, closed trades)"""
    from ticklab.streaming.live import position_stream

    root, done = _replayed_features(spark, sf_dir)
    feats = done.sparkSession.readStream.schema(done.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/features")
    scored = rule_scores(feats).withColumn("mid_price", mid_price())
    return root, _run_to_parquet(position_stream(scored.withColumn("signal", entry_signal())), root, "trades")


def r4_stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.streaming.live import TRADE_OUT

    return spark.read.schema(TRADE_OUT).parquet(f"{_position_folder(spark, sf_dir)[0]}/trades")


def r5_stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running trade statistics over the R4 trade stream, one row per model. Each micro-batch writes the
    models it changed; the newest row of a model counts."""
    from pyspark.sql import Window
    from pyspark.sql.types import IntegerType

    from ticklab.streaming.live import running_stats

    root, trades = _position_folder(spark, sf_dir)
    stats = running_stats(spark.readStream.schema(trades.schema).parquet(f"{root}/trades"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/stats/batch={batch_id}")

    q = (stats.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{root}/_ck_stats")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.schema(stats.schema.add("batch_id", IntegerType())).option("recursiveFileLookup", True).parquet(f"{root}/stats")
    newest = Window.partitionBy("model_id").orderBy(F.desc("batch_id"))
    return rows.withColumn("k", F.row_number().over(newest)).where("k = 1").drop("k", "batch_id").withColumns(
        {c: F.round(c, 6) for c in ("total_return", "avg_return")})


def r3_score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 + M7: micro-batches scored by the newest registered model, each published as a whole."""
    from ticklab.streaming.commits import read_committed
    from ticklab.streaming.live import score_batches

    registry = job_folder(spark, "r3")
    train_job(spark, load_ticks(spark, sf_dir), registry, params=job_params(spark))
    root = job_folder(spark, "replay")
    for src in replay(spark, load_ticks(spark, sf_dir), root):
        q = score_batches(replay_features(spark, src), registry, f"{root}/scored", f"{root}/_ck_scored")
        q.awaitTermination()
    return read_committed(spark, f"{root}/scored")


def compare_trained_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on trained models: a one-score and a two-score model are trained on the train split,
    both score the held-out rows, each runs the non-overlapping backtest (T2 rules, its own entry
    rule: one score >= 0.85, two scores >= 0.7 / 0.5) and the metrics are put side by side."""
    from ticklab.ml import models as ml
    from ticklab.operators.compare import side_by_side
    from ticklab.operators.ordering import global_positions, positional_split

    lab, _ = labelled_ticks(quality.valid_quote(load_ticks(spark, sf_dir)), keep=[*MODEL_COLUMNS, "bid_price", "ask_price"])
    split = materialize(positional_split(global_positions(quality.complete_cases(lab))), "split")
    train = split.where(F.col("split") == "train")
    held_out = split.where(F.col("split") != "train").drop("pos", "n_total")
    params = job_params(spark)
    with ThreadPool(2) as pool:  # side by side: a fit waits for its driver between jobs
        fits = {kind: pool.apply_async(inheritable_thread_target(spark)(fit), (train, params))
                for kind, fit in (("one_score", ml.train_one_score), ("two_score", ml.train_two_score))}
        models = {kind: fit.get() for kind, fit in fits.items()}
    logs = []
    for kind, rule, per in (("one_score", entry_signal("det_prob", None, 0.85), None),
                            ("two_score", entry_signal("det_prob", "per_prob", 0.7, 0.5), "per_prob")):
        scored = ml.score(models[kind], held_out).withColumn("mid_price", mid_price())
        scored = positioned(materialize(scored, f"scored_{kind}"))
        logs.append(trade_log(scored, rule, BACKTEST, price="mid_price", det="det_prob", per=per, model_id=kind))
    root = job_folder(spark, "c1")
    trades = spark.read.parquet(write_results(root, "c1", trades=logs[0].unionByName(logs[1]))["trades"])  # S8
    return side_by_side(trades, "two_score", "one_score")


EXTRA_QUERIES = {
    "m1_training_matrix": m1_training_matrix,
    "m5_registry_round_trip": m5_registry_round_trip,
    "c1_trained_models": compare_trained_models,
    "r1_polled_ticks": r1_polled_ticks,
    "r6_stream_counts": r6_stream_counts,
    "r2_stream_features": r2_stream_features,
    "r3_score_stream": r3_score_stream,
    "r4_stream_positions": r4_stream_positions,
    "r5_stream_stats": r5_stream_stats,
    "s6_sql_dump_roundtrip": s6_sql_dump_roundtrip,
    "s2_write_roundtrip": s2_write_roundtrip,
    "m6_retrain_job": m6_retrain_job,
    "m6_daily_features": m6_daily_features,
    "e6_loss_curve": e6_loss_curve,
    "a1_distinct_by_range": a1_distinct_by_range,
    "m6_daily_retrain": m6_daily_retrain,
    "m4_model_scores": m4_model_scores,
    "flagship_detections_per_symbol": detections_per_symbol,
    "t2_trade_log": t2_trade_log,
    "t3_live_trades": t3_live_trades,
}
