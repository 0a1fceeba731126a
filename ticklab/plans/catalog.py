"""Registered queries: one Spark plan per inventory operator, each with its ANSI SQL twin.

Every query reads the driver tables (the tick view derives from ``events``; evaluation also
reads ``labels``) and runs over all of their rows. Computed doubles are rounded to 6 digits on
both sides; every output column is aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.functions.exprs import mid_price
from ticklab.operators import compare, evaluate, ordering, quality, trades
from ticklab.operators.bucketed import bucketed_exits, bucketed_features, write_bucketed
from ticklab.operators.features import add_features, last_ticks, newest_per_symbol
from ticklab.operators.labels import LABEL_QUANTILES, detection_rule, exact_quantiles, fallback_rule, label_balance, labelled_ticks
from ticklab.operators.layout import run_series, with_positions
from ticklab.operators.outcomes import ExitRules, peak_path, positioned, signal_exits
from ticklab.operators.scoring import RULE_SCORES_SQL, rule_scores
from ticklab.session import materialize
from ticklab.schema import (
    FALLBACK_MIN_POSITIVES, FALLBACK_QUANTILE, FEATURES, MOMENTUM_QUANTILE, PERSIST_AHEAD, PERSIST_FACTOR, REQUIRED_COLUMNS,
    ZERO_CHECK_COLUMNS, ZSCORE_QUANTILE,
)
from ticklab.sources.incremental import current_snapshot, high_water_mark, read_since
from ticklab.sources.ticks import TICK_VIEW_SQL, load_ticks


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# ---------------------------------------------------------------- shared Spark inputs

def _ticks(spark, d):
    return load_ticks(spark, d)


def _valid(spark, d):
    return quality.valid_quote(_ticks(spark, d))


#: Columns of the labelled table that the queries read.
LABELLED = ["symbol", "tick_id", "event_time", "rn", "bid_price", "ask_price", *FEATURES]


def _labelled(spark, d):
    return labelled_ticks(_valid(spark, d), keep=LABELLED)


def _scored(spark, d):
    """Complete-case labelled ticks with rule scores, re-positioned after the drop (as the
    reference scores the frame left after dropna)."""
    lab, _ = _labelled(spark, d)
    return rule_scores(quality.complete_cases(lab)).drop("rn")


def _model_trades(spark, d) -> DataFrame:
    scored = _scored(spark, d).withColumn("mid_price", mid_price())
    scored = positioned(scored)
    two = signal_exits(
        scored, evaluate.entry_signal("det_prob", "per_prob", 0.7, 0.5), ExitRules(), price="mid_price",
        det="det_prob", per="per_prob", model_id="rule_two",
    )
    one = signal_exits(
        scored, evaluate.entry_signal("det_prob", None, 0.85), ExitRules(), price="mid_price",
        det="det_prob", per=None, model_id="rule_one",
    )
    # several statistics read the same trades: written once under the checkpoint folder
    return materialize(two.unionByName(one).drop("s_rn"), "trades")


def _eval_rows(spark, d) -> DataFrame:
    lab = spark.read.parquet(f"{d}/labels.parquet")
    q = lab.select(
        "doc_id", F.lit("quality").alias("task"), F.col("quality").alias("label"),
        ((F.col("doc_id") * 7919 % 1000).cast("double") / F.lit(1000.0)).alias("score"),
    )
    t = lab.select(
        "doc_id", F.lit("toxic").alias("task"), F.col("toxic").alias("label"),
        ((F.col("doc_id") * 104729 % 1000).cast("double") / F.lit(1000.0)).alias("score"),
    )
    rows = q.unionByName(t)
    return rows.withColumn("prediction", (F.col("score") >= F.lit(0.5)).cast("int"))


# ---------------------------------------------------------------- Spark queries

def s1_read_ticks(spark, d):
    return _ticks(spark, d)


def _p1_source(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet")
    eid = F.col("event_id")
    raw = (
        F.when(eid % 5 == 0, F.lit("abc")).when(eid % 5 == 1, F.lit("")).when(eid % 5 == 2, F.lit("1e-11"))
        .when(eid % 5 == 3, F.lit(None).cast("string")).otherwise(F.regexp_extract("props", "([0-9]+)", 1))
    )
    return ev.select(eid.alias("tick_id"), raw.alias("raw"))


def p1_numeric_coercion(spark, d):
    src = _p1_source(spark, d)
    return quality.coerce_numeric(src.withColumn("coerced", F.col("raw")), ["coerced"])


def _p2_source(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet")
    eid = F.col("event_id")
    good = F.concat(
        F.lit("2024-01-"), F.lpad((eid % 28 + 1).cast("string"), 2, "0"), F.lit(" "),
        F.lpad((eid % 24).cast("string"), 2, "0"), F.lit(":00:00"),
    )
    raw = F.when(eid % 4 == 0, F.lit("not a time")).when(eid % 4 == 1, F.lit("2024-02-30 10:00:00")).otherwise(good)
    src = ev.select(eid.alias("tick_id"), raw.alias("raw"))
    out = quality.coerce_time(src.withColumn("parsed", F.col("raw")), "parsed")
    return out.withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


def p2_timestamp_coercion(spark, d):
    return _p2_source(spark, d)


def f2_drop_missing_time(spark, d):
    return quality.drop_missing_time(_p2_source(spark, d), "parsed")


def p4_required_defaults(spark, d):
    cols = REQUIRED_COLUMNS + ["symbol_value_btc", "actual_value"]
    return quality.ensure_required(_ticks(spark, d), cols).select("tick_id", *cols)


def p3_missing_symbol(spark, d):
    """A tick table without a symbol column is one series named 'UNKNOWN'."""
    t = quality.ensure_symbol(_valid(spark, d).drop("symbol"))
    return t.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def p5_live_fill(spark, d):
    """P5: live policy, warm-up rows keep their ticks with features filled with 0."""
    f = add_features(_valid(spark, d), nulls="zero")
    return _r(f.select("tick_id", *FEATURES), "volume_zscore")


def p6_p10_quote_features(spark, d):
    from ticklab.functions import exprs

    v = _valid(spark, d).select(
        "tick_id", exprs.mid_price().alias("mid_price"), exprs.spread_pct().alias("spread_pct"),
        exprs.spread_abs().alias("spread_abs"), exprs.bid_ask_ratio().alias("bid_ask_ratio"),
        exprs.order_flow_imbalance().alias("order_flow_imbalance"),
    )
    return v


def p11_clip_return(spark, d):
    from ticklab.functions.exprs import clip

    f = add_features(_valid(spark, d))
    return f.select("tick_id", clip(F.col("price_momentum_10") * F.lit(1000.0), -10, 50).alias("clipped"))


def p12_mean_score(spark, d):
    from ticklab.functions.exprs import mean_of

    return _scored(spark, d).select("tick_id", mean_of("det_prob", "per_prob").alias("combined_prob"))


def o1_sort_series(spark, d):
    return ordering.sort_series(_valid(spark, d)).select("symbol", "event_time", "tick_id")


def f1_valid_quote(spark, d):
    return quality.valid_quote(_ticks(spark, d), require_ask=True).select("tick_id", "symbol")


def f3_zero_density(spark, d):
    return quality.zero_density_filter(_ticks(spark, d), keep_count=True).select("tick_id", "zero_count")


def s7_load_report(spark, d):
    return quality.zero_report(_ticks(spark, d))


def f4_recent_days(spark, d):
    return quality.recent_days(_valid(spark, d), 3).select("tick_id", "event_time")


def f5_jump_filter(spark, d):
    return quality.jump_filter(_valid(spark, d)).select("tick_id")


def f6_liquidity(spark, d):
    return quality.liquidity_filter(_valid(spark, d)).select("tick_id")


def f7_complete_cases(spark, d):
    f = quality.complete_cases(add_features(_valid(spark, d)))
    return f.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def f8_known_symbol(spark, d):
    t = _ticks(spark, d)
    tid = F.col("tick_id")
    sym = (
        F.when(tid % 53 == 0, F.lit("UNKNOWN")).when(tid % 59 == 0, F.lit("")).when(tid % 61 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("symbol"))
    )
    return quality.known_symbol(t.withColumn("symbol", sym)).select("tick_id", "symbol")


def _mark(df, days):
    return df.agg((F.max("event_time") - F.make_interval(days=F.lit(days))).alias("mark"))


def s4_read_since(spark, d):
    t = _ticks(spark, d)
    return read_since(t, _mark(t, 2)).select("tick_id", "symbol", "event_time")


def a4_high_water_mark(spark, d):
    t = _ticks(spark, d)
    return high_water_mark(read_since(t, _mark(t, 2)))


def o6_poll_batch(spark, d):
    t = _ticks(spark, d)
    return read_since(t, _mark(t, 1), 100).select("tick_id", "symbol", "event_time")


def s5_current_snapshot(spark, d):
    return current_snapshot(_ticks(spark, d)).select("symbol", "tick_id", "bid_price", "ask_price", "event_time")


def a1_load_stats(spark, d):
    return quality.load_stats(_valid(spark, d))


def u1_concat_batches(spark, d):
    v = _valid(spark, d).select("tick_id", "symbol", "bid_price", "market", "event_time")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    a = v.where(F.col("event_time") < cut).drop("event_time")
    b = v.where(F.col("event_time") >= cut).drop("event_time", "market")
    return quality.concat_batches(a, b)


def w1_momentum(spark, d):
    f = add_features(_valid(spark, d))
    return f.select("tick_id", "rn", "price_momentum_5", "price_momentum_10")


def w2_weight_change(spark, d):
    f = add_features(_valid(spark, d))
    return f.select("tick_id", "weight_change", "weight_velocity")


def w5_volume_zscore(spark, d):
    from ticklab.operators.features import rolling

    def compute(frame, w):
        frame50 = rolling(w, 50)
        return frame.withColumns({
            "volume_mean": F.avg("ticket_count").over(frame50),
            "volume_std": F.stddev_samp("ticket_count").over(frame50),
        }).withColumn("volume_zscore", (F.col("ticket_count") - F.col("volume_mean")) / (F.col("volume_std") + F.lit(1e-8)))

    out = run_series(_valid(spark, d), compute, before=49, after=0)
    return _r(out.select("tick_id", "volume_mean", "volume_std", "volume_zscore"), "volume_mean", "volume_std", "volume_zscore")


def w7_series_position(spark, d):
    return with_positions(_valid(spark, d)).select("tick_id", "symbol", "rn")


def w9_last_ticks(spark, d):
    return last_ticks(_valid(spark, d), 200, 50).select("tick_id", "symbol")


def w10_newest_features(spark, d):
    f = add_features(_valid(spark, d)).drop("rn")
    n = newest_per_symbol(f).select("symbol", "tick_id", *FEATURES)
    return _r(n, "volume_zscore")


def l1_thresholds(spark, d):
    _, t = _labelled(spark, d)
    row = [(t.momentum, t.zscore, t.fallback)]
    df = spark.createDataFrame(row, "t_momentum double, t_zscore double, t_fallback double")
    return _r(df, "t_momentum", "t_zscore", "t_fallback")


def l2_detection(spark, d):
    lab, _ = _labelled(spark, d)
    return lab.select("tick_id", "label_detection")


def l3_fallback_rule(spark, d):
    f = add_features(_valid(spark, d))
    q = exact_quantiles(f, {"price_momentum_5": [0.9]})
    return f.withColumn("fb", fallback_rule(q[("price_momentum_5", 0.9)])).groupBy("symbol").agg(
        F.sum("fb").cast("long").alias("n_fallback")
    )


def l4_persistence(spark, d):
    lab, _ = _labelled(spark, d)
    return lab.select("tick_id", "label_persistence")


def w6_lookahead_hits(spark, d):
    f = add_features(_valid(spark, d), lookahead={"price_momentum_5": PERSIST_AHEAD, "volume_zscore": PERSIST_AHEAD, "tick_id": PERSIST_AHEAD})
    q = exact_quantiles(f, {"price_momentum_5": [0.85], "volume_zscore": [0.75]})
    tm, tv = q[("price_momentum_5", 0.85)], q[("volume_zscore", 0.75)]
    mh = sum(F.coalesce(F.col(f"price_momentum_5_next{k}") > F.lit(tm * PERSIST_FACTOR), F.lit(False)).cast("int") for k in range(1, 6))
    vh = sum(F.coalesce(F.col(f"volume_zscore_next{k}") > F.lit(tv * PERSIST_FACTOR), F.lit(False)).cast("int") for k in range(1, 6))
    n_ahead = sum(F.col(f"tick_id_next{k}").isNotNull().cast("int") for k in range(1, 6))
    return f.select("tick_id", mh.alias("momentum_hits"), vh.alias("zscore_hits"), n_ahead.alias("ticks_ahead"))


def l5_label_balance(spark, d):
    lab, _ = _labelled(spark, d)
    return label_balance(lab)


def o2_top_signals(spark, d):
    from ticklab.functions.exprs import mean_of

    s = _scored(spark, d).withColumn("combined_prob", mean_of("det_prob", "per_prob"))
    top = ordering.top_k(s, "combined_prob", 10)
    return top.select("symbol", "tick_id", "det_prob", "per_prob", "combined_prob")


def o3_global_position(spark, d):
    return ordering.global_positions(_valid(spark, d)).select("tick_id", "pos")


def o4_split(spark, d):
    lab, _ = _labelled(spark, d)
    cc = quality.complete_cases(lab).drop("rn")
    return ordering.positional_split(ordering.global_positions(cc)).select("tick_id", "split")


def o5_row_slice(spark, d):
    return ordering.row_slice(ordering.global_positions(_valid(spark, d)), 0.3, 0.35).select("tick_id", "pos")


def e1_confusion(spark, d):
    return evaluate.confusion(_eval_rows(spark, d), ("task",))


def e2_scores(spark, d):
    return evaluate.scores_from_confusion(evaluate.confusion(_eval_rows(spark, d), ("task",)))


def e3_auc(spark, d):
    return evaluate.auc(_eval_rows(spark, d), ("task",))


def e4_class_report(spark, d):
    return evaluate.class_report(_eval_rows(spark, d), ("task",))


def e5_class_distribution(spark, d):
    return evaluate.class_distribution(_eval_rows(spark, d), ("task",))


def e6_log_loss(spark, d):
    return evaluate.log_loss(_eval_rows(spark, d), ("task",))


def _task_split_rows(spark, d):
    lab, _ = _labelled(spark, d)
    cc = rule_scores(quality.complete_cases(lab)).drop("rn")
    sp = ordering.positional_split(ordering.global_positions(cc))
    # one scan for both tasks; metrics() writes only their counts
    task = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.col(f"label_{t}").alias("label"), F.col(p).alias("score"))
                               for t, p in (("detection", "det_prob"), ("persistence", "per_prob"))])).alias("t")
    return sp.select("split", task).select("split", "t.*").withColumn("prediction", (F.col("score") >= F.lit(0.5)).cast("int"))


def e7_metrics_by_task_split(spark, d):
    return evaluate.metrics(_task_split_rows(spark, d), ("task", "split"))


def a2_hit_rates(spark, d):
    return evaluate.hit_rates(_scored(spark, d))


def a3_score_summary(spark, d):
    return evaluate.score_summary(_scored(spark, d))


def f9_entry_signals(spark, d):
    s = _scored(spark, d)
    return s.groupBy("symbol").agg(
        F.count_if(evaluate.entry_signal("det_prob", "per_prob", 0.7, 0.5)).alias("two_score_entries"),
        F.count_if(evaluate.entry_signal("det_prob", None, 0.85)).alias("one_score_entries"),
    )


def f10_agreement(spark, d):
    s = _scored(spark, d).withColumns({
        "det_pred": (F.col("det_prob") >= 0.5).cast("int"), "per_pred": (F.col("per_prob") >= 0.5).cast("int"),
    })
    return s.groupBy("symbol").agg(F.count_if(evaluate.agreement()).alias("n_agree"))


def t1_barrier_outcome(spark, d):
    lab, _ = _labelled(spark, d)
    ex = signal_exits(lab, F.col("label_detection") == 1, ExitRules(), price="bid_price")
    return ex.select("symbol", "entry_pos", "exit_pos", "entry_price", "exit_price", "return_pct", "ticks_held", "exit_reason")


def w5_bucketed_features(spark, d):
    """W1-W5 on a bucketed table: no exchange below the windows."""
    f = bucketed_features(spark, write_bucketed(_valid(spark, d)))
    return _r(f.select("tick_id", "price_momentum_5", "volume_zscore"), "price_momentum_5", "volume_zscore")


def t1_bucketed_outcome(spark, d):
    """T1 on a bucketed table: thresholds from its features, then signals and exits without an exchange."""
    rows = bucketed_features(spark, write_bucketed(_valid(spark, d)), halo=True)
    own = rows.where("_own")
    q = exact_quantiles(own, LABEL_QUANTILES)
    t_m, t_v = q["price_momentum_5", MOMENTUM_QUANTILE], q["volume_zscore", ZSCORE_QUANTILE]
    rule = detection_rule(t_m, t_v)
    if (own.agg(F.sum(rule)).first()[0] or 0) < FALLBACK_MIN_POSITIVES:
        rule = fallback_rule(q["price_momentum_5", FALLBACK_QUANTILE])
    ex = bucketed_exits(rows, rule == 1)
    return ex.select("symbol", "entry_pos", "exit_pos", "entry_price", "exit_price", "return_pct", "ticks_held", "exit_reason")


def w8_peak_return(spark, d):
    lab, _ = _labelled(spark, d)
    lab = lab.withColumn("signal", F.col("label_detection") == 1)
    return peak_path(lab, "signal", 30, "bid_price")


def t4_trade_summary(spark, d):
    return trades.summary(_model_trades(spark, d))


def t5_exit_reasons(spark, d):
    return trades.by_exit_reason(_model_trades(spark, d))


def t6_extremes(spark, d):
    return trades.extremes(_model_trades(spark, d))


def t7_equity_curve(spark, d):
    return trades.equity_curve(_model_trades(spark, d))


def t8_running_stats(spark, d):
    return trades.running_stats(_model_trades(spark, d))


def o2_best_worst_trades(spark, d):
    return trades.best_worst(_model_trades(spark, d), 5)


def c1_side_by_side(spark, d):
    return compare.side_by_side(_model_trades(spark, d), "rule_two", "rule_one")


def c2_winners(spark, d):
    return compare.winners(_model_trades(spark, d), "rule_two", "rule_one")


def c3_recommendation(spark, d):
    return compare.recommendation(_model_trades(spark, d), "rule_two", "rule_one")


QUERIES = {
    name: fn
    for name, fn in list(globals().items())
    if callable(fn) and name[:1] in "spfuawloectr" and name[1:2].isdigit() and not name.startswith("_")
}


# ---------------------------------------------------------------- oracle SQL (DuckDB dialect)

TICKS_CTE = "ticks AS (" + TICK_VIEW_SQL.format(STR="VARCHAR") + ")"
VALID_CTE = "valid AS (SELECT * FROM ticks WHERE bid_price > 0)"
FEAT_CTE = """feat AS (
  SELECT *,
    row_number() OVER w - 1 AS rn,
    bid_price / lag(bid_price, 5) OVER w - 1e0 AS price_momentum_5,
    bid_price / lag(bid_price, 10) OVER w - 1e0 AS price_momentum_10,
    (ticket_count - avg(ticket_count) OVER w50) / (stddev_samp(ticket_count) OVER w50 + 1e-8) AS volume_zscore,
    (ask_price - bid_price) / (bid_price + 1e-8) AS spread_pct,
    ask_price - bid_price AS spread_abs,
    last_price_weight - lag(last_price_weight, 1) OVER w AS weight_change,
    last_price_weight - lag(last_price_weight, 2) OVER w AS weight_velocity,
    bid_size / (ask_size + 1e-8) AS bid_ask_ratio,
    (bid_size - ask_size) / (bid_size + ask_size + 1e-8) AS order_flow_imbalance
  FROM valid
  WINDOW w AS (PARTITION BY symbol ORDER BY event_time, tick_id),
         w50 AS (PARTITION BY symbol ORDER BY event_time, tick_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""
THR_CTE = """thr AS (SELECT quantile_cont(price_momentum_5, 0.85) AS t_m, quantile_cont(volume_zscore, 0.75) AS t_v,
  quantile_cont(price_momentum_5, 0.90) AS t_f FROM feat)"""


def _hits(col, factor_col):
    return " + ".join(
        f"(CASE WHEN lead({col}, {k}) OVER w > {factor_col} * 0.7e0 THEN 1 ELSE 0 END)" for k in range(1, 6)
    )


LAB_CTE = f"""lab0 AS (SELECT f.*, t_m, t_v,
    CASE WHEN coalesce(price_momentum_5 > t_m AND volume_zscore > t_v, false) THEN 1 ELSE 0 END AS det_plain,
    CASE WHEN coalesce(price_momentum_5 > t_f, false) THEN 1 ELSE 0 END AS det_fb
  FROM feat f CROSS JOIN thr),
nplain AS (SELECT sum(det_plain) AS n FROM lab0),
lab1 AS (SELECT lab0.*, CAST(CASE WHEN nplain.n < 100 THEN det_fb ELSE det_plain END AS INTEGER) AS label_detection
  FROM lab0 CROSS JOIN nplain),
lab AS (SELECT *, CAST(CASE WHEN label_detection = 1 AND lead(tick_id, 5) OVER w IS NOT NULL
      AND ({_hits('price_momentum_5', 't_m')}) >= 3
      AND ({_hits('volume_zscore', 't_v')}) >= 3 THEN 1 ELSE 0 END AS INTEGER) AS label_persistence
  FROM lab1 WINDOW w AS (PARTITION BY symbol ORDER BY event_time, tick_id))"""
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
SCORED_CTE = f"""scored AS (SELECT * EXCLUDE (rn), 'rule_two' AS model_id, {RULE_SCORES_SQL},
    row_number() OVER (PARTITION BY symbol ORDER BY event_time, tick_id) - 1 AS rn
  FROM lab WHERE {COMPLETE})"""
EVAL_CTE = """ev AS (
  SELECT doc_id, 'quality' AS task, quality AS label, cast(doc_id * 7919 % 1000 AS double) / 1000e0 AS score FROM labels
  UNION ALL
  SELECT doc_id, 'toxic' AS task, toxic AS label, cast(doc_id * 104729 % 1000 AS double) / 1000e0 AS score FROM labels),
evp AS (SELECT *, CAST(CASE WHEN score >= 0.5e0 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM ev)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (TICKS_CTE, VALID_CTE)
FEATS = BASE + (FEAT_CTE,)
LABS = FEATS + (THR_CTE, LAB_CTE)
SCORES = LABS + (SCORED_CTE,)


def _t1_ctes(name, source, signal, price, det, per, lost, model, H=30, pt="0.01e0", sl="0.005e0"):
    det_e = f"s0.{det}" if det else "CAST(NULL AS DOUBLE)"
    per_e = f"s0.{per}" if per else "CAST(NULL AS DOUBLE)"
    det_x = f"t.{det}" if det else "CAST(NULL AS DOUBLE)"
    per_x = f"t.{per}" if per else "CAST(NULL AS DOUBLE)"
    lost_clause = f"WHEN {lost} THEN 'SIGNAL_LOST'" if lost else ""
    return (
        f"""{name}_last AS (SELECT symbol, max(rn) AS sym_last FROM {source} GROUP BY symbol)""",
        f"""{name}_sig AS (SELECT s0.symbol, s0.rn AS s_rn, s0.{price} AS entry_price, s0.event_time AS entry_time,
    {det_e} AS e_det, {per_e} AS e_per FROM {source} s0 WHERE {signal})""",
        f"""{name}_band AS (SELECT s.*, t.rn, t.event_time AS x_time, t.{price} AS px, {det_x} AS x_det, {per_x} AS x_per,
    (t.{price} - s.entry_price) / s.entry_price AS ret
  FROM {name}_sig s JOIN {source} t ON t.symbol = s.symbol AND t.rn BETWEEN s.s_rn AND s.s_rn + {H})""",
        f"""{name}_b2 AS (SELECT *, max(ret) OVER (PARTITION BY symbol, s_rn ORDER BY rn
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM {name}_band)""",
        f"""{name}_b3 AS (SELECT *, CASE WHEN ret >= {pt} THEN (CASE WHEN ret > 0.5e0 THEN 'PROFIT_TARGET_CAPPED' ELSE 'PROFIT_TARGET' END)
    WHEN ret <= -{sl} OR ret <= -0.1e0 THEN 'STOP_LOSS'
    WHEN peak > 0.003e0 AND ret < peak * 0.5e0 THEN 'TRAILING_STOP'
    WHEN rn - s_rn >= {H} THEN 'MAX_HOLD'
    {lost_clause} END AS reason FROM {name}_b2)""",
        f"""{name}_ex AS (SELECT b.symbol, b.s_rn, min(CASE WHEN reason IS NOT NULL THEN b.rn END) AS x_rn,
    max(b.rn) AS band_end, max(l.sym_last) AS sym_last
  FROM {name}_b3 b JOIN {name}_last l ON l.symbol = b.symbol GROUP BY b.symbol, b.s_rn)""",
        f"""{name} AS (SELECT '{model}' AS model_id, b.symbol, b.s_rn AS entry_pos, b.rn AS exit_pos, b.entry_time,
    b.x_time AS exit_time, b.entry_price, b.px AS exit_price, b.e_det AS entry_det_prob, b.e_per AS entry_per_prob,
    b.x_det AS exit_det_prob, b.x_per AS exit_per_prob, b.ret * 100e0 AS return_pct,
    CAST(b.rn - b.s_rn AS INTEGER) AS ticks_held, coalesce(b.reason, 'END_OF_DATA') AS exit_reason
  FROM {name}_b3 b JOIN {name}_ex e ON b.symbol = e.symbol AND b.s_rn = e.s_rn
  WHERE b.rn = coalesce(e.x_rn, CASE WHEN e.band_end >= e.sym_last THEN e.band_end END))""",
    )


MODEL_TRADES = SCORES + (
    "mscored AS (SELECT *, (bid_price + ask_price) / 2e0 AS mid_price FROM scored)",
) + _t1_ctes(
    "tr_two", "mscored", "s0.det_prob >= 0.7e0 AND s0.per_prob >= 0.5e0", "mid_price", "det_prob", "per_prob",
    "x_det < 0.35e0 AND x_per < 0.25e0 AND ret < -0.002e0", "rule_two",
) + _t1_ctes(
    "tr_one", "mscored", "s0.det_prob >= 0.85e0", "mid_price", "det_prob", None,
    "x_det < 0.3e0 AND ret < -0.002e0", "rule_one",
) + (
    "tr AS (SELECT * FROM tr_two UNION ALL SELECT * FROM tr_one)",
    """trc AS (SELECT *, return_pct AS raw_return_pct,
    CASE WHEN return_pct IS NULL THEN NULL ELSE greatest(-10e0, least(50e0, return_pct)) END AS r FROM tr)""",
)

SUMMARY_SQL = """summ AS (SELECT model_id, count(*) AS n_trades, count_if(r > 0) AS wins, count_if(NOT (r > 0)) AS losses,
    avg(CASE WHEN r > 0 THEN 1e0 ELSE 0e0 END) * 100e0 AS wr, avg(r) AS av, sum(r) AS tot,
    coalesce(avg(CASE WHEN r > 0 THEN r END), 0e0) AS aw, coalesce(avg(CASE WHEN NOT (r > 0) THEN r END), 0e0) AS al,
    count_if(raw_return_pct > 50e0 OR raw_return_pct < -10e0) AS n_extreme
  FROM trc GROUP BY model_id),
summary AS (SELECT model_id, n_trades, wins, losses, round(wr, 6) AS win_rate, round(av, 6) AS avg_return,
    round(tot, 6) AS total_return, round(aw, 6) AS avg_win, round(al, 6) AS avg_loss,
    round(CASE WHEN al <> 0 THEN abs(aw / al) END, 6) AS profit_factor,
    round(av * (wr / 100e0) - abs(al) * (1e0 - wr / 100e0), 6) AS expected_value,
    round(aw * (wr / 100e0) - abs(al) * (1e0 - wr / 100e0), 6) AS expected_value_win, n_extreme
  FROM summ)"""
REASONS_SQL = """reasons AS (SELECT model_id, exit_reason, count(*) AS n,
    round(count(*) * 100e0 / sum(count(*)) OVER (PARTITION BY model_id), 6) AS share_pct,
    round(avg(r), 6) AS avg_return, count_if(r > 0) AS wins, round(avg(ticks_held), 6) AS avg_ticks_held
  FROM trc GROUP BY model_id, exit_reason)"""
METRIC_LONG_SQL = """wide AS (SELECT s.model_id, CAST(s.n_trades AS DOUBLE) AS total_trades, s.win_rate, s.avg_return,
    s.total_return, s.avg_win, s.avg_loss, s.profit_factor, s.expected_value,
    coalesce((SELECT share_pct FROM reasons r WHERE r.model_id = s.model_id AND r.exit_reason = 'SIGNAL_LOST'), 0e0) AS signal_lost_pct,
    coalesce((SELECT share_pct FROM reasons r WHERE r.model_id = s.model_id AND r.exit_reason = 'PROFIT_TARGET'), 0e0) AS profit_target_pct,
    coalesce((SELECT share_pct FROM reasons r WHERE r.model_id = s.model_id AND r.exit_reason = 'STOP_LOSS'), 0e0) AS stop_loss_pct
  FROM summary s),
mlong AS (UNPIVOT wide ON total_trades, win_rate, avg_return, total_return, avg_win, avg_loss, profit_factor,
    expected_value, signal_lost_pct, profit_target_pct, stop_loss_pct INTO NAME metric VALUE value),
sbs AS (SELECT k.metric, max(CASE WHEN l.model_id = 'rule_two' THEN l.value END) AS value_a,
    max(CASE WHEN l.model_id = 'rule_one' THEN l.value END) AS value_b, CAST(max(k.metric_order) AS INTEGER) AS metric_order
  FROM (SELECT unnest(['total_trades','win_rate','avg_return','total_return','avg_win','avg_loss','profit_factor',
      'expected_value','signal_lost_pct','profit_target_pct','stop_loss_pct']) AS metric, unnest(range(11)) AS metric_order) k
  LEFT JOIN mlong l ON l.metric = k.metric GROUP BY k.metric)"""

ORACLE = {
    "s1_read_ticks": _with(*BASE) + "SELECT * FROM ticks",
    "p1_numeric_coercion": """SELECT event_id AS tick_id, raw, TRY_CAST(raw AS DOUBLE) AS coerced FROM (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'abc' WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 = 2 THEN '1e-11'
    WHEN event_id % 5 = 3 THEN NULL ELSE regexp_extract(props, '([0-9]+)', 1) END AS raw FROM events) e""",
    "p2_timestamp_coercion": """SELECT event_id AS tick_id, raw, TRY_CAST(raw AS TIMESTAMP) AS parsed FROM (
  SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'not a time' WHEN event_id % 4 = 1 THEN '2024-02-30 10:00:00'
    ELSE concat('2024-01-', lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0'), ' ', lpad(CAST(event_id % 24 AS VARCHAR), 2, '0'), ':00:00') END AS raw
  FROM events) e""",
    "f2_drop_missing_time": """SELECT * FROM (SELECT event_id AS tick_id, raw, TRY_CAST(raw AS TIMESTAMP) AS parsed FROM (
  SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'not a time' WHEN event_id % 4 = 1 THEN '2024-02-30 10:00:00'
    ELSE concat('2024-01-', lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0'), ' ', lpad(CAST(event_id % 24 AS VARCHAR), 2, '0'), ':00:00') END AS raw
  FROM events) e) p WHERE parsed IS NOT NULL""",
    "p4_required_defaults": _with(*BASE) + "SELECT tick_id, " + ", ".join(
        f"coalesce({c}, 0e0) AS {c}" for c in REQUIRED_COLUMNS + ["symbol_value_btc", "actual_value"]
    ) + " FROM ticks",
    "p3_missing_symbol": _with(*BASE) + "SELECT 'UNKNOWN' AS symbol, count(*) AS n FROM valid",
    "p5_live_fill": _with(*FEATS) + "SELECT tick_id, " + ", ".join(
        f"round(coalesce({c}, 0e0), 6) AS {c}" if c == "volume_zscore" else f"coalesce({c}, 0e0) AS {c}" for c in FEATURES
    ) + " FROM feat",
    "p6_p10_quote_features": _with(*BASE) + """SELECT tick_id, (bid_price + ask_price) / 2e0 AS mid_price,
  (ask_price - bid_price) / (bid_price + 1e-8) AS spread_pct, ask_price - bid_price AS spread_abs,
  bid_size / (ask_size + 1e-8) AS bid_ask_ratio,
  (bid_size - ask_size) / (bid_size + ask_size + 1e-8) AS order_flow_imbalance FROM valid""",
    "p11_clip_return": _with(*FEATS) + """SELECT tick_id, CASE WHEN price_momentum_10 IS NULL THEN NULL
  ELSE greatest(-10e0, least(50e0, price_momentum_10 * 1000e0)) END AS clipped FROM feat""",
    "p12_mean_score": _with(*SCORES) + "SELECT tick_id, (det_prob + per_prob) / 2e0 AS combined_prob FROM scored",
    "o1_sort_series": _with(*BASE) + "SELECT symbol, event_time, tick_id FROM valid ORDER BY symbol, event_time, tick_id",
    "flagship_detections_per_symbol": _with(*LABS) + """SELECT symbol, count(*) AS n_ticks,
  CAST(sum(label_detection) AS BIGINT) AS detections, CAST(sum(label_persistence) AS BIGINT) AS persistences
  FROM lab GROUP BY symbol""",
    "f1_valid_quote": _with(*BASE) + "SELECT tick_id, symbol FROM ticks WHERE bid_price > 0 AND ask_price > 0",
    "f3_zero_density": _with(*BASE) + "SELECT tick_id, zero_count FROM (SELECT tick_id, " + " + ".join(
        f"(CASE WHEN coalesce(abs({c}) < 1e-10, true) THEN 1 ELSE 0 END)" for c in
        ["symbol_value", "changed_pct", "symbol_value_usd", "symbol_value_btc", "available", "in_order",
         "actual_value", "bid_price", "ask_price", "bid_size", "ask_size", "spread"]
    ) + " AS zero_count FROM ticks) z WHERE zero_count < 10",
    "s7_load_report": _with(*BASE) + "SELECT rows_read, rows_kept, rows_read - rows_kept AS rows_removed, "
    "round(rows_kept * 100e0 / rows_read, 6) AS pct_kept FROM (SELECT count(*) AS rows_read, count_if(" + " + ".join(
        f"(CASE WHEN coalesce(abs({c}) < 1e-10, true) THEN 1 ELSE 0 END)" for c in
        ["symbol_value", "changed_pct", "symbol_value_usd", "symbol_value_btc", "available", "in_order",
         "actual_value", "bid_price", "ask_price", "bid_size", "ask_size", "spread"]
    ) + " < 10) AS rows_kept FROM ticks) s",
    "f4_recent_days": _with(*BASE) + """SELECT tick_id, event_time FROM valid
  WHERE event_time >= (SELECT max(event_time) FROM valid) - INTERVAL 3 DAY""",
    "f5_jump_filter": _with(*BASE) + """SELECT tick_id FROM (SELECT tick_id,
  abs(bid_price / lag(bid_price, 1) OVER (PARTITION BY symbol ORDER BY event_time, tick_id) - 1e0) AS mv FROM valid) m WHERE mv < 0.5e0""",
    "f6_liquidity": _with(*BASE) + "SELECT tick_id FROM valid WHERE ticket_count > 5",
    "f7_complete_cases": _with(*FEATS) + f"SELECT symbol, count(*) AS n FROM feat WHERE {COMPLETE} GROUP BY symbol",
    "f8_known_symbol": _with(*BASE) + """SELECT tick_id, symbol FROM (SELECT tick_id, CASE WHEN tick_id % 53 = 0 THEN 'UNKNOWN'
  WHEN tick_id % 59 = 0 THEN '' WHEN tick_id % 61 = 0 THEN NULL ELSE symbol END AS symbol FROM ticks) s
  WHERE symbol IS NOT NULL AND symbol <> '' AND symbol <> 'UNKNOWN'""",
    "s4_read_since": _with(*BASE) + """SELECT tick_id, symbol, event_time FROM ticks
  WHERE bid_price > 0 AND ask_price > 0 AND event_time > (SELECT max(event_time) - INTERVAL 2 DAY FROM ticks)""",
    "a4_high_water_mark": _with(*BASE) + """SELECT count(*) AS n_rows, max(event_time) AS new_mark FROM (
  SELECT tick_id, event_time FROM ticks WHERE bid_price > 0 AND ask_price > 0
    AND event_time > (SELECT max(event_time) - INTERVAL 2 DAY FROM ticks)) b""",
    "o6_poll_batch": _with(*BASE) + """SELECT tick_id, symbol, event_time FROM ticks
  WHERE bid_price > 0 AND ask_price > 0 AND event_time > (SELECT max(event_time) - INTERVAL 1 DAY FROM ticks)
  ORDER BY event_time, tick_id LIMIT 100""",
    "s5_current_snapshot": _with(*BASE) + """SELECT symbol, tick_id, bid_price, ask_price, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, tick_id DESC) AS k
  FROM ticks WHERE bid_price > 0 AND ask_price > 0) s WHERE k = 1""",
    "a1_load_stats": _with(*BASE) + """SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols,
  min(event_time) AS first_time, max(event_time) AS last_time FROM valid""",
    "u1_concat_batches": _with(*BASE) + """SELECT tick_id, symbol, bid_price, market FROM valid WHERE event_time < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL SELECT tick_id, symbol, bid_price, NULL AS market FROM valid WHERE event_time >= TIMESTAMP '2024-01-16 00:00:00'""",
    "w1_momentum": _with(*FEATS) + "SELECT tick_id, rn, price_momentum_5, price_momentum_10 FROM feat",
    "w2_weight_change": _with(*FEATS) + "SELECT tick_id, weight_change, weight_velocity FROM feat",
    "w5_volume_zscore": _with(*BASE) + """SELECT tick_id, round(m, 6) AS volume_mean, round(s, 6) AS volume_std,
  round((ticket_count - m) / (s + 1e-8), 6) AS volume_zscore FROM (SELECT tick_id, ticket_count,
  avg(ticket_count) OVER w50 AS m, stddev_samp(ticket_count) OVER w50 AS s FROM valid
  WINDOW w50 AS (PARTITION BY symbol ORDER BY event_time, tick_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)) z""",
    "w7_series_position": _with(*FEATS) + "SELECT tick_id, symbol, rn FROM feat",
    "w9_last_ticks": _with(*BASE) + """SELECT tick_id, symbol FROM (SELECT tick_id, symbol,
  row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, tick_id DESC) AS k,
  count(*) OVER (PARTITION BY symbol) AS n FROM valid) s WHERE k <= 200 AND least(n, 200) >= 50""",
    "w10_newest_features": _with(*FEATS) + "SELECT symbol, tick_id, " + ", ".join(
        f"round({c}, 6) AS {c}" if c == "volume_zscore" else c for c in FEATURES
    ) + """ FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, tick_id DESC) AS k FROM feat) s WHERE k = 1""",
    "l1_thresholds": _with(*FEATS, THR_CTE) + "SELECT round(t_m, 6) AS t_momentum, round(t_v, 6) AS t_zscore, round(t_f, 6) AS t_fallback FROM thr",
    "l2_detection": _with(*LABS) + "SELECT tick_id, label_detection FROM lab",
    "l3_fallback_rule": _with(*FEATS, THR_CTE) + """SELECT symbol,
  CAST(sum(CASE WHEN coalesce(price_momentum_5 > t_f, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_fallback
  FROM feat CROSS JOIN thr GROUP BY symbol""",
    "l4_persistence": _with(*LABS) + "SELECT tick_id, label_persistence FROM lab",
    "w6_lookahead_hits": _with(*FEATS, THR_CTE) + f"""SELECT tick_id,
  CAST({_hits('price_momentum_5', 't_m')} AS INTEGER) AS momentum_hits,
  CAST({_hits('volume_zscore', 't_v')} AS INTEGER) AS zscore_hits,
  CAST({' + '.join(f'(CASE WHEN lead(tick_id, {k}) OVER w IS NOT NULL THEN 1 ELSE 0 END)' for k in range(1, 6))} AS INTEGER) AS ticks_ahead
  FROM feat CROSS JOIN thr WINDOW w AS (PARTITION BY symbol ORDER BY event_time, tick_id)""",
    "l5_label_balance": _with(*LABS) + """SELECT count(*) AS n_rows, CAST(sum(label_detection) AS BIGINT) AS n_detection,
  round(avg(label_detection), 6) AS rate_detection, CAST(sum(label_persistence) AS BIGINT) AS n_persistence,
  round(avg(label_persistence), 6) AS rate_persistence FROM lab""",
    "o2_top_signals": _with(*SCORES) + """SELECT symbol, tick_id, det_prob, per_prob, (det_prob + per_prob) / 2e0 AS combined_prob FROM scored
  ORDER BY (det_prob + per_prob) / 2e0 DESC, symbol, tick_id LIMIT 10""",
    "o3_global_position": _with(*BASE) + "SELECT tick_id, row_number() OVER (ORDER BY symbol, event_time, tick_id) - 1 AS pos FROM valid",
    "o4_split": _with(*LABS) + f"""SELECT tick_id, CASE WHEN pos < floor(n * 0.6e0) THEN 'train'
  WHEN pos < floor(n * 0.8e0) THEN 'val' ELSE 'test' END AS split FROM (
  SELECT tick_id, row_number() OVER (ORDER BY symbol, event_time, tick_id) - 1 AS pos, count(*) OVER () AS n
  FROM lab WHERE {COMPLETE}) p""",
    "o5_row_slice": _with(*BASE) + """SELECT tick_id, pos FROM (SELECT tick_id,
  row_number() OVER (ORDER BY symbol, event_time, tick_id) - 1 AS pos, count(*) OVER () AS n FROM valid) p
  WHERE pos >= floor(n * 0.3e0) AND pos < floor(n * 0.35e0)""",
    "e1_confusion": _with(EVAL_CTE) + """SELECT task, count_if(label = 0 AND prediction = 0) AS tn,
  count_if(label = 0 AND prediction = 1) AS fp, count_if(label = 1 AND prediction = 0) AS fn,
  count_if(label = 1 AND prediction = 1) AS tp FROM evp GROUP BY task""",
}

_CM = """cm AS (SELECT {g}, count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM {src} GROUP BY {g})"""
_SCORES = """SELECT {g}, tn, fp, fn, tp, tn + fp + fn + tp AS n,
  round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(tn + fp + fn + tp, 0), 0e0), 6) AS accuracy,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0), 6) AS precision,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0), 6) AS recall,
  round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0e0), 6) AS f1 FROM cm"""
_AUC = """bs AS (SELECT {g}, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {src} GROUP BY {g}, score),
rk AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {g} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM bs),
auc AS (SELECT {g}, round(CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN 0e0
  ELSE sum(pos * (nb + neg * 0.5e0)) / CAST(sum(pos) * sum(neg) AS DOUBLE) END, 6) AS auc FROM rk GROUP BY {g})"""

ORACLE["e2_scores"] = _with(EVAL_CTE, _CM.format(g="task", src="evp")) + _SCORES.format(g="task")
ORACLE["e3_auc"] = _with(EVAL_CTE, _AUC.format(g="task", src="evp")) + "SELECT * FROM auc"
ORACLE["e4_class_report"] = _with(EVAL_CTE, _CM.format(g="task", src="evp"), """per AS (
  SELECT task, '0' AS class, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0e0) AS precision,
    coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0e0) AS recall,
    coalesce(CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0), 0e0) AS f1, tn + fp AS support FROM cm
  UNION ALL
  SELECT task, '1', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0), coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0),
    coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0e0), tp + fn FROM cm)""",
    """allr AS (SELECT * FROM per
  UNION ALL SELECT task, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per GROUP BY task
  UNION ALL SELECT task, 'weighted avg', coalesce(sum(precision * support) / nullif(sum(support), 0), 0e0),
    coalesce(sum(recall * support) / nullif(sum(support), 0), 0e0), coalesce(sum(f1 * support) / nullif(sum(support), 0), 0e0),
    sum(support) FROM per GROUP BY task)""") + """SELECT task, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM allr"""
ORACLE["e5_class_distribution"] = _with(EVAL_CTE) + """SELECT task, label, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY task) AS DOUBLE), 6) AS share FROM evp GROUP BY task, label"""
ORACLE["e6_log_loss"] = _with(EVAL_CTE) + """SELECT task, round(-avg(CAST(label AS DOUBLE) * ln(greatest(1e-15, least(1e0 - 1e-15, score)))
  + (1e0 - CAST(label AS DOUBLE)) * ln(1e0 - greatest(1e-15, least(1e0 - 1e-15, score)))), 6) AS log_loss FROM evp GROUP BY task"""

_TS_ROWS = f"""tsp AS (SELECT *, CASE WHEN pos < floor(n * 0.6e0) THEN 'train' WHEN pos < floor(n * 0.8e0) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY symbol, event_time, tick_id) - 1 AS pos, count(*) OVER () AS n FROM scored) p),
tsr AS (SELECT split, 'detection' AS task, label_detection AS label, det_prob AS score FROM tsp
  UNION ALL SELECT split, 'persistence' AS task, label_persistence AS label, per_prob AS score FROM tsp),
tsrp AS (SELECT *, CAST(CASE WHEN score >= 0.5e0 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM tsr)"""
ORACLE["e7_metrics_by_task_split"] = _with(
    *SCORES, _TS_ROWS, _CM.format(g="task, split", src="tsrp"), _AUC.format(g="task, split", src="tsrp")
) + "SELECT m.*, a.auc FROM (" + _SCORES.format(g="task, split") + ") m LEFT JOIN auc a ON a.task = m.task AND a.split = m.split"
ORACLE["a2_hit_rates"] = _with(*SCORES) + """SELECT model_id, count(*) AS n, count_if(det_prob >= 0.7e0) AS det_hits,
  count_if(per_prob >= 0.5e0) AS per_hits, count_if(det_prob >= 0.7e0 AND per_prob >= 0.5e0) AS both_hits,
  round(avg(CASE WHEN det_prob >= 0.7e0 THEN 1e0 ELSE 0e0 END), 6) AS det_rate,
  round(avg(CASE WHEN per_prob >= 0.5e0 THEN 1e0 ELSE 0e0 END), 6) AS per_rate,
  round(avg(CASE WHEN det_prob >= 0.7e0 AND per_prob >= 0.5e0 THEN 1e0 ELSE 0e0 END), 6) AS both_rate FROM scored GROUP BY model_id"""
ORACLE["a3_score_summary"] = _with(*SCORES) + """SELECT model_id, count(*) AS n,
  CAST(sum(CASE WHEN det_prob >= 0.5e0 THEN 1 ELSE 0 END) AS BIGINT) AS det_positive, round(avg(det_prob), 6) AS det_mean_prob,
  CAST(sum(CASE WHEN per_prob >= 0.5e0 THEN 1 ELSE 0 END) AS BIGINT) AS per_positive, round(avg(per_prob), 6) AS per_mean_prob,
  CAST(sum(CASE WHEN det_prob >= 0.5e0 AND per_prob >= 0.5e0 THEN 1 ELSE 0 END) AS BIGINT) AS combined_positive,
  round(avg((det_prob + per_prob) / 2e0), 6) AS combined_mean_prob FROM scored GROUP BY model_id"""
ORACLE["f9_entry_signals"] = _with(*SCORES) + """SELECT symbol, count_if(det_prob >= 0.7e0 AND per_prob >= 0.5e0) AS two_score_entries,
  count_if(det_prob >= 0.85e0) AS one_score_entries FROM scored GROUP BY symbol"""
ORACLE["f10_agreement"] = _with(*SCORES) + "SELECT symbol, count_if(det_prob >= 0.5e0 AND per_prob >= 0.5e0) AS n_agree FROM scored GROUP BY symbol"
ORACLE["t1_barrier_outcome"] = _with(*LABS, *_t1_ctes("det", "lab", "s0.label_detection = 1", "bid_price", None, None, None, "model")) + """
SELECT symbol, entry_pos, exit_pos, entry_price, exit_price, return_pct, ticks_held, exit_reason FROM det"""
ORACLE["t1_bucketed_outcome"] = ORACLE["t1_barrier_outcome"]
ORACLE["w5_bucketed_features"] = _with(*FEATS) + "SELECT tick_id, round(price_momentum_5, 6) AS price_momentum_5, round(volume_zscore, 6) AS volume_zscore FROM feat"
ORACLE["a1_distinct_by_range"] = _with("ticks AS (" + TICK_VIEW_SQL.format(STR="VARCHAR") + ")", "valid AS (SELECT *, CAST(event_time AS DATE) AS d FROM ticks WHERE bid_price > 0)") + """
SELECT w.d - 6 AS first, w.d AS last, count(DISTINCT v.d) AS n_days, count(*) AS n_rows, count(DISTINCT v.symbol) AS n_distinct
FROM (SELECT DISTINCT d FROM valid) w JOIN valid v ON v.d BETWEEN w.d - 6 AND w.d GROUP BY w.d"""
ORACLE["m6_daily_features"] = _with(*FEATS) + """SELECT tick_id, symbol, rn, round(price_momentum_5, 6) AS price_momentum_5,
  round(volume_zscore, 6) AS volume_zscore, round(weight_velocity, 6) AS weight_velocity FROM feat"""
ORACLE["w8_peak_return"] = _with(*LABS) + """SELECT symbol, s_rn, rn, ret,
  max(ret) OVER (PARTITION BY symbol, s_rn ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
  FROM (SELECT s.symbol, s.rn AS s_rn, t.rn, (t.bid_price - s.bid_price) / s.bid_price AS ret
    FROM lab s JOIN lab t ON t.symbol = s.symbol AND t.rn BETWEEN s.rn AND s.rn + 30 WHERE s.label_detection = 1) b"""
ORACLE["t4_trade_summary"] = _with(*MODEL_TRADES, SUMMARY_SQL) + "SELECT * FROM summary"
ORACLE["t5_exit_reasons"] = _with(*MODEL_TRADES, REASONS_SQL) + "SELECT * FROM reasons"
ORACLE["t6_extremes"] = _with(*MODEL_TRADES) + """SELECT model_id, count_if(return_pct > 50e0 OR return_pct < -10e0) AS n_extreme
  FROM tr GROUP BY model_id"""
ORACLE["t7_equity_curve"] = _with(*MODEL_TRADES) + """SELECT model_id, symbol, entry_pos, exit_time,
  round(exp(sum(ln(1e0 + 0.1e0 * r / 100e0)) OVER (PARTITION BY model_id, symbol ORDER BY exit_time, entry_pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS equity FROM trc"""
ORACLE["t8_running_stats"] = _with(*MODEL_TRADES) + """SELECT model_id, count(*) AS n_trades, count_if(return_pct > 0) AS wins,
  count_if(return_pct <= 0) AS losses, round(avg(CASE WHEN return_pct > 0 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS win_rate,
  round(sum(return_pct), 6) AS total_return, round(avg(return_pct), 6) AS avg_return FROM tr GROUP BY model_id"""
ORACLE["o2_best_worst_trades"] = _with(*MODEL_TRADES) + """SELECT model_id, side, CAST(k AS INTEGER) AS rank, symbol,
  round(r, 6) AS return_pct, exit_reason, ticks_held FROM (
  SELECT *, 'best' AS side, row_number() OVER (PARTITION BY model_id ORDER BY r DESC, symbol, entry_pos) AS k FROM trc
  UNION ALL
  SELECT *, 'worst' AS side, row_number() OVER (PARTITION BY model_id ORDER BY r ASC, symbol, entry_pos) AS k FROM trc) x WHERE k <= 5"""
ORACLE["c1_side_by_side"] = _with(*MODEL_TRADES, SUMMARY_SQL, REASONS_SQL, METRIC_LONG_SQL) + "SELECT metric, value_a, value_b, metric_order FROM sbs"
ORACLE["c2_winners"] = _with(*MODEL_TRADES, SUMMARY_SQL, REASONS_SQL, METRIC_LONG_SQL) + """SELECT metric, value_a, value_b,
  CASE WHEN (CASE WHEN metric = 'signal_lost_pct' THEN value_a < value_b ELSE value_a > value_b END) THEN 'rule_two'
       WHEN (CASE WHEN metric = 'signal_lost_pct' THEN value_b < value_a ELSE value_b > value_a END) THEN 'rule_one' END AS winner
  FROM sbs WHERE metric IN ('win_rate', 'profit_factor', 'expected_value', 'signal_lost_pct')"""
ORACLE["c3_recommendation"] = _with(*MODEL_TRADES, SUMMARY_SQL, REASONS_SQL, METRIC_LONG_SQL) + """SELECT value_a AS ev_a, value_b AS ev_b,
  CASE WHEN value_a > value_b * 1.1e0 THEN 'rule_two' WHEN value_b > value_a * 1.1e0 THEN 'rule_one' ELSE 'either' END AS recommended
  FROM sbs WHERE metric = 'expected_value'"""


# ---- T2/T3: every later tick of the symbol per signal, then the walk as a recursive CTE
def _walk_sql(live: bool, scores=SCORES) -> str:
    if live:
        reason = """CASE WHEN rn = s_rn THEN NULL WHEN ret >= 0.01e0 THEN 'PROFIT' WHEN ret <= -0.005e0 THEN 'STOP_LOSS'
    WHEN x_det < 0.35e0 AND x_per < 0.25e0 AND ret < -0.002e0 THEN 'SIGNAL_LOST' END"""
    else:
        reason = """CASE WHEN ret >= 0.01e0 THEN (CASE WHEN ret > 0.5e0 THEN 'PROFIT_TARGET_CAPPED' ELSE 'PROFIT_TARGET' END)
    WHEN ret <= -0.005e0 OR ret <= -0.1e0 THEN 'STOP_LOSS'
    WHEN peak > 0.003e0 THEN (CASE WHEN ret < peak * 0.5e0 THEN 'TRAILING_STOP' END)
    WHEN rn - s_rn >= 30 THEN 'MAX_HOLD'
    WHEN x_det < 0.35e0 AND x_per < 0.25e0 AND ret < -0.002e0 THEN 'SIGNAL_LOST' END"""
    after = ">= x.x_rn AND n.s_rn > x.s_rn" if live else "> x.x_rn"
    return "WITH RECURSIVE " + ",\n".join(scores) + f""",
m AS (SELECT *, (bid_price + ask_price) / 2e0 AS px FROM scored),
sig AS (SELECT symbol, rn AS s_rn, px AS entry_price, event_time AS entry_time, det_prob AS e_det, per_prob AS e_per FROM m
  WHERE det_prob >= 0.7e0 AND per_prob >= 0.5e0),
path AS (SELECT s.*, t.rn, t.event_time AS x_time, t.px, t.det_prob AS x_det, t.per_prob AS x_per, (t.px - s.entry_price) / s.entry_price AS ret
  FROM sig s JOIN m t ON t.symbol = s.symbol AND t.rn >= s.s_rn),
peaks AS (SELECT *, max(ret) OVER (PARTITION BY symbol, s_rn ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM path),
fired AS (SELECT *, {reason} AS reason FROM peaks),
x AS (SELECT symbol, s_rn, coalesce(min(CASE WHEN reason IS NOT NULL THEN rn END), max(rn)) AS x_rn FROM fired GROUP BY symbol, s_rn),
nxt AS (SELECT x.symbol, x.s_rn, x.x_rn, min(n.s_rn) AS n_rn FROM x LEFT JOIN x n ON n.symbol = x.symbol AND n.s_rn {after} GROUP BY ALL),
walk AS (SELECT symbol, min(s_rn) AS s_rn FROM x GROUP BY symbol
  UNION ALL SELECT nxt.symbol, nxt.n_rn FROM walk JOIN nxt ON nxt.symbol = walk.symbol AND nxt.s_rn = walk.s_rn WHERE nxt.n_rn IS NOT NULL)
SELECT 'rule_two' AS model_id, f.symbol, f.s_rn AS entry_pos, f.rn AS exit_pos, f.entry_time, f.x_time AS exit_time, f.entry_price, f.px AS exit_price,
  f.e_det AS entry_det_prob, f.e_per AS entry_per_prob, f.x_det AS exit_det_prob, f.x_per AS exit_per_prob, f.ret * 100e0 AS return_pct,
  CAST(f.rn - f.s_rn AS INTEGER) AS ticks_held, coalesce(f.reason, 'END_OF_DATA') AS exit_reason
FROM walk JOIN x USING (symbol, s_rn) JOIN fired f ON f.symbol = x.symbol AND f.s_rn = x.s_rn AND f.rn = x.x_rn"""


ORACLE["t2_trade_log"] = _walk_sql(live=False)
ORACLE["t3_live_trades"] = _walk_sql(live=True)
_DENSE = " + ".join(f"(CASE WHEN coalesce(abs({c}) < 1e-10, true) THEN 1 ELSE 0 END)" for c in ZERO_CHECK_COLUMNS)
ORACLE["s2_write_roundtrip"] = _with(*BASE) + f"""SELECT *, CAST(event_time AS DATE) AS event_date FROM ticks
  WHERE bid_price > 0 AND ask_price > 0 AND {_DENSE} < 10"""
ORACLE["s6_sql_dump_roundtrip"] = _with(*BASE) + """SELECT * REPLACE (CASE WHEN tick_id % 7 = 0 THEN 'it''s, (a) feed'
  WHEN tick_id % 11 = 0 THEN 'NULL' ELSE changed_by END AS changed_by) FROM ticks"""
_SPLIT = f"""(SELECT *, CASE WHEN pos < floor(n * 0.6e0) THEN 'train' WHEN pos < floor(n * 0.8e0) THEN 'val' ELSE 'test' END AS split FROM (
  SELECT *, row_number() OVER (ORDER BY symbol, event_time, tick_id) - 1 AS pos, count(*) OVER () AS n FROM lab WHERE {COMPLETE}) p)"""
ORACLE["m1_training_matrix"] = _with(*LABS) + f"""SELECT tick_id, split, label_detection, label_persistence,
  CAST({len(FEATURES)} AS INTEGER) AS n_features, round({' + '.join(FEATURES)}, 4) AS feature_sum FROM {_SPLIT} s"""
_DENSE_BASE = (TICKS_CTE, f"valid AS (SELECT * FROM ticks WHERE bid_price > 0 AND {_DENSE} < 10)")
ORACLE["m5_registry_round_trip"] = _with(*LABS) + f"""SELECT (SELECT count(*) FROM lab WHERE {COMPLETE}) AS n_scored, CAST(0 AS BIGINT) AS n_differ,
  'two_score' AS kind, c.* FROM ({_with(*_DENSE_BASE, FEAT_CTE, THR_CTE, LAB_CTE)} SELECT count_if(split = 'train') AS n_train,
  count_if(split = 'val') AS n_val, count_if(split = 'test') AS n_test FROM {_SPLIT} s) c"""

# ---- R2/R4/R5: the streams give the batch features of live quotes from the 50th tick on
_LIVE_BASE = (TICKS_CTE, """valid AS (SELECT * REPLACE (coalesce(bid_size, 0e0) AS bid_size, coalesce(ask_size, 0e0) AS ask_size)
  FROM ticks WHERE bid_price > 0 AND ask_price > 0 AND ticket_count > 5)""", FEAT_CTE)
_LIVE_FEATURES = ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in FEATURES)
ORACLE["r1_polled_ticks"] = _with(*BASE) + "SELECT tick_id, symbol, bid_price, ask_price, ticket_count, event_time FROM ticks WHERE bid_price > 0 AND ask_price > 0"
ORACLE["r6_stream_counts"] = _with(*BASE) + f"""SELECT n + repeated AS rows_read, kept AS rows_kept, rejected AS rows_rejected, late AS rows_late,
  repeated AS rows_repeated FROM (SELECT count(*) AS n, count_if(late) AS late, count_if(tick_id % 77 = 0 AND NOT late) AS repeated,
  count_if(good AND NOT late) AS kept, count_if(NOT good AND NOT late) AS rejected FROM (SELECT tick_id, bid_price > 0 AND {_DENSE} < 10 AS good,
  date_diff('day', CAST(event_time AS DATE), CAST(max(event_time) OVER () AS DATE)) >= 21 AND tick_id % 50 = 0 AS late FROM ticks) t) c"""
ORACLE["r2_stream_features"] = _with(*_LIVE_BASE) + "SELECT symbol, tick_id, event_time, rn, bid_price, ask_price, " + ", ".join(
    f"round(coalesce({c}, 0e0), 6) AS {c}" for c in FEATURES) + " FROM feat WHERE rn >= 49"
_LIVE_SCORES = _LIVE_BASE + (f"live AS (SELECT * REPLACE ({_LIVE_FEATURES}) FROM feat WHERE rn >= 49)",
                             f"scored AS (SELECT *, 'rule_two' AS model_id, {RULE_SCORES_SQL} FROM live)")
_LIVE_TRADES = f"""SELECT model_id, symbol, entry_pos, exit_pos, entry_time, exit_time, entry_price, exit_price, return_pct, exit_reason,
  epoch_us(exit_time) / 1e6 - epoch_us(entry_time) / 1e6 AS duration_s FROM ({_walk_sql(True, _LIVE_SCORES)}) t WHERE exit_reason <> 'END_OF_DATA'"""
ORACLE["r4_stream_positions"] = _LIVE_TRADES.replace("epoch_us(exit_time) / 1e6 - epoch_us(entry_time) / 1e6", "(epoch_us(exit_time) - epoch_us(entry_time)) / 1e6")
ORACLE["r5_stream_stats"] = f"""SELECT model_id, count(*) AS n_trades, count_if(return_pct > 0) AS wins, count_if(return_pct <= 0) AS losses,
  avg(CASE WHEN return_pct > 0 THEN 1e0 ELSE 0e0 END) * 100e0 AS win_rate, round(sum(return_pct), 6) AS total_return,
  round(avg(return_pct), 6) AS avg_return FROM ({_LIVE_TRADES}) x GROUP BY model_id"""
