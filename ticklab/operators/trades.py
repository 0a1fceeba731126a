"""Trade statistics (T4-T8) over a ``trades`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklab.functions.exprs import clip

RETURN_LOW, RETURN_HIGH = -10.0, 50.0
STAKE = 0.1


def _r(c: Column) -> Column:
    return F.round(c, 6)


def capped(trades: DataFrame, column: str = "return_pct") -> DataFrame:
    """P11 on trades: keep the raw return and clip the analysed one to [-10, 50] percent."""
    return trades.withColumn("raw_return_pct", F.col(column)).withColumn(column, clip(column, RETURN_LOW, RETURN_HIGH))


def summary(trades: DataFrame, groups=("model_id",)) -> DataFrame:
    """T4 + T6: count, wins, losses, win rate, mean/total return, mean win, mean loss,
    profit factor |mean win / mean loss| (NULL when mean loss is 0), expected value, extremes.

    ``expected_value`` = mean return x win share - |mean loss| x loss share (the one-score
    report's form); ``expected_value_win`` uses the mean win instead of the mean return."""
    t = capped(trades)
    r = F.col("return_pct")
    raw = F.col("raw_return_pct")
    win = r > 0
    s = t.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(win).alias("wins"),
        F.count_if(~win).alias("losses"),
        (F.avg(win.cast("double")) * F.lit(100.0)).alias("_wr"),
        F.avg(r).alias("_avg"),
        F.sum(r).alias("_tot"),
        F.coalesce(F.avg(F.when(win, r)), F.lit(0.0)).alias("_aw"),
        F.coalesce(F.avg(F.when(~win, r)), F.lit(0.0)).alias("_al"),
        F.count_if((raw > RETURN_HIGH) | (raw < RETURN_LOW)).alias("n_extreme"),
    )
    wr = F.col("_wr") / F.lit(100.0)
    return s.select(
        *groups, "n_trades", "wins", "losses",
        _r(F.col("_wr")).alias("win_rate"),
        _r(F.col("_avg")).alias("avg_return"),
        _r(F.col("_tot")).alias("total_return"),
        _r(F.col("_aw")).alias("avg_win"),
        _r(F.col("_al")).alias("avg_loss"),
        _r(F.when(F.col("_al") != 0, F.abs(F.col("_aw") / F.col("_al")))).alias("profit_factor"),
        _r(F.col("_avg") * wr - F.abs(F.col("_al")) * (F.lit(1.0) - wr)).alias("expected_value"),
        _r(F.col("_aw") * wr - F.abs(F.col("_al")) * (F.lit(1.0) - wr)).alias("expected_value_win"),
        "n_extreme",
    )


def by_exit_reason(trades: DataFrame, groups=("model_id",)) -> DataFrame:
    """T5: per exit reason: count, share of trades (%), mean return, wins, mean ticks held."""
    t = capped(trades)
    g = t.groupBy(*groups, "exit_reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("return_pct").alias("_avg"),
        F.count_if(F.col("return_pct") > 0).alias("wins"),
        F.avg("ticks_held").alias("_held"),
    )
    share = F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy(*groups)).cast("double")
    return g.select(
        *groups, "exit_reason", "n", _r(share).alias("share_pct"), _r(F.col("_avg")).alias("avg_return"),
        "wins", _r(F.col("_held")).alias("avg_ticks_held"),
    )


def extremes(trades: DataFrame, groups=("model_id",)) -> DataFrame:
    """Trades with a raw return above 50 % or below -10 %."""
    r = F.col("return_pct")
    return trades.groupBy(*groups).agg(F.count_if((r > RETURN_HIGH) | (r < RETURN_LOW)).alias("n_extreme"))


def equity_curve(trades: DataFrame, stake: float = STAKE, layout: str | None = None) -> DataFrame:
    """Compounded equity per (model, symbol), staking ``stake`` of equity on each trade in
    exit-time order: exp(running sum of ln(1 + stake * return)). The running sum is the
    skew-safe one (no task holds all trades of a hot symbol)."""
    from ticklab.operators.layout import resolve_layout, running_sum, with_positions

    keys = ("model_id", "symbol")
    t = capped(trades).withColumn("_g", F.log(F.lit(1.0) + F.lit(stake) * F.col("return_pct") / F.lit(100.0)))
    lay = resolve_layout(t, layout, keys)
    if lay == "symbol":
        t = t.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("exit_time", "entry_pos")))
    else:
        t = with_positions(t, keys, ("exit_time", "entry_pos"), "_k")
    t = running_sum(t, "_g", "_cum", keys, "_k", inclusive=True, layout=lay)
    return t.select("model_id", "symbol", "entry_pos", "exit_time", _r(F.exp(F.col("_cum"))).alias("equity"))


def running_stats(trades: DataFrame, groups=("model_id",)) -> DataFrame:
    """Trades, wins, losses, win rate, summed and mean return (batch form of the live report)."""
    r = F.col("return_pct")
    return trades.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(r > 0).alias("wins"),
        F.count_if(r <= 0).alias("losses"),
        _r(F.avg((r > 0).cast("double")) * F.lit(100.0)).alias("win_rate"),
        _r(F.sum(r)).alias("total_return"),
        _r(F.avg(r)).alias("avg_return"),
    )


def best_worst(trades: DataFrame, k: int = 5) -> DataFrame:
    """O2 on trades: the k best and k worst trades per model by (capped) return."""
    t = capped(trades)
    best = Window.partitionBy("model_id").orderBy(F.col("return_pct").desc(), "symbol", "entry_pos")
    worst = Window.partitionBy("model_id").orderBy(F.col("return_pct").asc(), "symbol", "entry_pos")
    b = t.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= k).withColumn("side", F.lit("best"))
    w = t.withColumn("_k", F.row_number().over(worst)).where(F.col("_k") <= k).withColumn("side", F.lit("worst"))
    return b.unionByName(w).select(
        "model_id", "side", F.col("_k").alias("rank"), "symbol", _r(F.col("return_pct")).alias("return_pct"),
        "exit_reason", "ticks_held",
    )
