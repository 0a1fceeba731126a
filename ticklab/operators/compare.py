"""Side-by-side model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.operators.trades import by_exit_reason, summary

# Compared metrics, in report order, with the direction that wins.
METRICS = [
    ("total_trades", None),
    ("win_rate", "high"),
    ("avg_return", None),
    ("total_return", None),
    ("avg_win", None),
    ("avg_loss", None),
    ("profit_factor", "high"),
    ("expected_value", "high"),
    ("signal_lost_pct", "low"),
    ("profit_target_pct", None),
    ("stop_loss_pct", None),
]


def metric_table(trades: DataFrame) -> DataFrame:
    """C1 input: the 11 compared metrics per model as (model_id, metric, value)."""
    s = summary(trades)
    reasons = by_exit_reason(trades).groupBy("model_id").pivot(
        "exit_reason", ["SIGNAL_LOST", "PROFIT_TARGET", "STOP_LOSS"]
    ).agg(F.first("share_pct"))
    wide = s.join(reasons, "model_id", "left").select(
        "model_id",
        F.col("n_trades").cast("double").alias("total_trades"),
        "win_rate", "avg_return", "total_return", "avg_win", "avg_loss", "profit_factor", "expected_value",
        F.coalesce(F.col("SIGNAL_LOST"), F.lit(0.0)).alias("signal_lost_pct"),
        F.coalesce(F.col("PROFIT_TARGET"), F.lit(0.0)).alias("profit_target_pct"),
        F.coalesce(F.col("STOP_LOSS"), F.lit(0.0)).alias("stop_loss_pct"),
    )
    pairs = ", ".join(f"'{m}', `{m}`" for m, _ in METRICS)
    return wide.selectExpr("model_id", f"stack({len(METRICS)}, {pairs}) AS (metric, value)")


def side_by_side(trades: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """One row per metric, one column per model."""
    long = metric_table(trades)
    order = F.create_map(*[x for i, (m, _) in enumerate(METRICS) for x in (F.lit(m), F.lit(i))])
    return (
        long.groupBy("metric").pivot("model_id", [model_a, model_b]).agg(F.first("value"))
        .withColumnsRenamed({model_a: "value_a", model_b: "value_b"})
        .withColumn("metric_order", order[F.col("metric")])
    )


def winners(trades: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Winner per directional metric (higher wins, or lower for the signal-lost share);
    a tie has no winner."""
    wide = side_by_side(trades, model_a, model_b)
    direction = F.create_map(*[x for m, d in METRICS if d for x in (F.lit(m), F.lit(d))])
    d = direction[F.col("metric")]
    a, b = F.col("value_a"), F.col("value_b")
    a_wins = F.when(d == "high", a > b).otherwise(a < b)
    b_wins = F.when(d == "high", b > a).otherwise(b < a)
    return wide.where(d.isNotNull()).select(
        "metric", "value_a", "value_b",
        F.when(a_wins, F.lit(model_a)).when(b_wins, F.lit(model_b)).alias("winner"),
    )


def recommendation(trades: DataFrame, model_a: str, model_b: str, margin: float = 1.1) -> DataFrame:
    """Prefer a model whose expected value beats the other's by more than 10 %."""
    wide = side_by_side(trades, model_a, model_b).where(F.col("metric") == "expected_value")
    a, b = F.col("value_a"), F.col("value_b")
    return wide.select(
        F.col("value_a").alias("ev_a"), F.col("value_b").alias("ev_b"),
        F.when(a > b * F.lit(margin), F.lit(model_a)).when(b > a * F.lit(margin), F.lit(model_b))
        .otherwise(F.lit("either")).alias("recommended"),
    )
