"""Per-symbol microstructure features over tick-count windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklab.functions import exprs
from ticklab.operators.layout import SERIES_KEYS, SERIES_ORDER, run_series
from ticklab.operators.quality import complete_cases, fill_features
from ticklab.schema import EPS, FEATURES, ZSCORE_WINDOW


def pct_change(c: str, n: int, w) -> Column:
    """X / x[n ticks back] - 1 (no forward padding); NULL after a zero."""
    return F.try_divide(F.col(c), F.lag(c, n).over(w)) - F.lit(1.0)


def diff(c: str, n: int, w) -> Column:
    """X - x[n ticks back]."""
    return F.col(c) - F.lag(c, n).over(w)


def rolling(w, size: int):
    """Frame of the last ``size`` ticks including the current one (pandas rolling, min_periods=1)."""
    return w.rowsBetween(-(size - 1), 0)


def zscore(c: str, w, size: int = ZSCORE_WINDOW) -> Column:
    """(x - rolling mean) / (rolling sample std + 1e-8); NULL on a series' first tick."""
    frame = rolling(w, size)
    return (F.col(c) - F.avg(c).over(frame)) / (F.stddev_samp(c).over(frame) + F.lit(EPS))


def feature_columns(w) -> dict[str, Column]:
    return {
        "price_momentum_5": pct_change("bid_price", 5, w),
        "price_momentum_10": pct_change("bid_price", 10, w),
        "volume_zscore": zscore("ticket_count", w),
        "spread_pct": exprs.spread_pct(),
        "spread_abs": exprs.spread_abs(),
        "weight_change": diff("last_price_weight", 1, w),
        "weight_velocity": diff("last_price_weight", 2, w),
        "bid_ask_ratio": exprs.bid_ask_ratio(),
        "order_flow_imbalance": exprs.order_flow_imbalance(),
    }


def add_features(
    df: DataFrame,
    nulls: str = "keep",
    layout: str | None = None,
    lookahead: dict[str, int] | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """All nine features plus ``rn`` (W7), in one windowed pass over one shuffle.

    ``nulls``: "keep" (warm-up rows carry NULL), "drop" (batch, F7) or "zero" (live, P5).
    ``lookahead``: {column: k} adds ``<column>_next1..k`` (lead) columns in the same pass, used by
    the persistence label (W6) so labels need no second shuffle.
    """
    lookahead = lookahead or {}
    ahead = max(lookahead.values(), default=0)

    def compute(frame: DataFrame, w) -> DataFrame:
        out = frame.withColumns(feature_columns(w))
        leads = {
            f"{c}_next{k}": F.lead(c, k).over(w) for c, n in lookahead.items() for k in range(1, n + 1)
        }
        return out.withColumns(leads) if leads else out

    kwargs = {"chunk_rows": chunk_rows} if chunk_rows else {}
    out = run_series(df, compute, before=ZSCORE_WINDOW - 1, after=ahead, layout=layout, **kwargs)
    if nulls == "drop":
        out = complete_cases(out)
    elif nulls == "zero":
        out = fill_features(out)
    return out


def last_ticks(df: DataFrame, n: int = 200, warmup: int = 50, keys=SERIES_KEYS, order=SERIES_ORDER) -> DataFrame:
    """The newest ``n`` ticks of each symbol, only for symbols with at least ``warmup`` of them.

    Ranks newest-first per symbol; the rank window is the one place a per-symbol sort is needed,
    and the kept set is bounded by n rows per symbol."""
    desc = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.withColumn("_back", F.row_number().over(desc))
    kept = ranked.where(F.col("_back") <= n)
    sizes = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    return kept.join(sizes.where(F.col("_size") >= warmup), list(keys), "left_semi").drop("_back")


def newest_per_symbol(df: DataFrame, keys=SERIES_KEYS, order=SERIES_ORDER) -> DataFrame:
    """The newest row of each symbol with all its columns: one row number a symbol, cut to the
    first on the map side (WindowGroupLimit), so a task ships one row a symbol and no symbol gathers."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") == 1).drop("_back")


__all__ = ["add_features", "last_ticks", "newest_per_symbol", "pct_change", "diff", "zscore", "FEATURES"]
