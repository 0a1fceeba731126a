"""Coercion, cleaning filters and load statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklab.functions.exprs import nan_to_null, zero_count
from ticklab.schema import FEATURES, NUMERIC_COLUMNS, REQUIRED_COLUMNS, TICK_COLUMNS, ZERO_CHECK_COLUMNS


def coerce_numeric(df: DataFrame, columns=None) -> DataFrame:
    """text/decimal to double in one projection; unparsable values become NULL, NaN too."""
    columns = [c for c in (columns or NUMERIC_COLUMNS) if c in df.columns]
    casts = {c: nan_to_null(F.col(c).try_cast("double")) for c in columns}
    return df.withColumns(casts)


def coerce_time(df: DataFrame, column: str = "event_time", fmt: str | None = None) -> DataFrame:
    """Text to timestamp; unparsable values become NULL."""
    c = F.col(column).cast("string")
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return df.withColumn(column, parsed)


def coerce_ticks(raw: DataFrame) -> DataFrame:
    """P1 + P2 on a text tick table, keeping the declared column order."""
    out = coerce_numeric(raw)
    out = coerce_time(out)
    casts = {}
    for name, dtype in TICK_COLUMNS:
        if name in out.columns and name not in NUMERIC_COLUMNS and name != "event_time":
            casts[name] = F.col(name).try_cast(dtype.simpleString())
    return out.withColumns(casts)


def ensure_symbol(df: DataFrame, column: str = "symbol") -> DataFrame:
    """A table without a symbol column is one series named 'UNKNOWN' (decided at plan time)."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit("UNKNOWN"))


def ensure_required(df: DataFrame, columns=None) -> DataFrame:
    """Required quote columns default to 0.0 when absent or null."""
    columns = columns or REQUIRED_COLUMNS
    missing = {c: F.lit(0.0) for c in columns if c not in df.columns}
    out = df.withColumns(missing) if missing else df
    return out.fillna(0.0, subset=list(columns))


def fill_features(df: DataFrame, columns=None) -> DataFrame:
    """P5: live policy, null features become 0.0."""
    columns = [c for c in (columns or FEATURES) if c in df.columns]
    return df.fillna(0.0, subset=columns)


def valid_quote(df: DataFrame, require_ask: bool = False) -> DataFrame:
    """bid > 0 (batch) or bid > 0 and ask > 0 (extract, live). Pushed to the scan."""
    cond = F.col("bid_price") > 0
    if require_ask:
        cond = cond & (F.col("ask_price") > 0)
    return df.where(cond)


def drop_missing_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """F2."""
    return df.where(F.col(column).isNotNull())


def zero_density_filter(df: DataFrame, max_zero: int = 10, columns=None, keep_count: bool = False) -> DataFrame:
    """keep rows where fewer than ``max_zero`` checked columns are null or |x| < 1e-10."""
    columns = [c for c in (columns or ZERO_CHECK_COLUMNS) if c in df.columns]
    out = df.withColumn("zero_count", zero_count(columns)).where(F.col("zero_count") < max_zero)
    return out if keep_count else out.drop("zero_count")


def recent_days(df: DataFrame, days: int, column: str = "event_time", now: Column | None = None) -> DataFrame:
    """rows at or after max(time) - N days (or ``now`` - N days).

    The cutoff is a scalar subquery (computed once, no driver round trip, no join); Spark pushes
    the comparison into the parquet scan, and day-partitioned tables prune partitions at runtime.
    """
    if now is not None:
        return df.where(F.col(column) >= now - F.make_interval(days=F.lit(days)))
    cutoff = df.agg((F.max(column) - F.make_interval(days=F.lit(days))).alias("_cutoff")).scalar()
    return df.where(F.col(column) >= cutoff)


def jump_filter(df: DataFrame, max_move: float = 0.5, price: str = "bid_price", window=None) -> DataFrame:
    """keep rows whose 1-tick relative move is below ``max_move``; each symbol's first row drops."""
    from ticklab.operators.layout import run_series

    def compute(frame, w):
        return frame.withColumn("_move", F.abs(F.try_divide(F.col(price), F.lag(price, 1).over(window or w)) - F.lit(1.0)))

    had_rn = "rn" in df.columns
    out = run_series(df, compute, before=1, after=0).where(F.col("_move") < max_move).drop("_move")
    return out if had_rn else out.drop("rn")


def liquidity_filter(df: DataFrame, min_tickets: float = 5) -> DataFrame:
    """ticket_count > 5."""
    return df.where(F.col("ticket_count") > min_tickets)


def complete_cases(df: DataFrame, columns=None) -> DataFrame:
    """drop rows with any null (or NaN) feature."""
    columns = [c for c in (columns or FEATURES) if c in df.columns]
    return df.dropna(subset=columns)


def known_symbol(df: DataFrame, column: str = "symbol") -> DataFrame:
    """F8: skip null, empty or 'UNKNOWN' symbols."""
    c = F.col(column)
    return df.where(c.isNotNull() & (c != "") & (c != "UNKNOWN"))


def load_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows read, kept, removed and percent kept, from one pass over each side."""
    b = before.agg(F.count(F.lit(1))).scalar()
    a = after.agg(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(b.alias("rows_read"), a.alias("rows_kept")).select(
        "rows_read",
        "rows_kept",
        (F.col("rows_read") - F.col("rows_kept")).alias("rows_removed"),
        F.round(F.try_divide(F.col("rows_kept") * F.lit(100.0), F.col("rows_read")), 6).alias("pct_kept"),
    )


def zero_report(df: DataFrame, max_zero: int = 10, columns=None) -> DataFrame:
    """S7 for F3 in a single aggregate: read, kept, removed, percent kept."""
    columns = [c for c in (columns or ZERO_CHECK_COLUMNS) if c in df.columns]
    kept = zero_count(columns) < max_zero
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(kept).alias("rows_kept"),
    ).select(
        "rows_read",
        "rows_kept",
        (F.col("rows_read") - F.col("rows_kept")).alias("rows_removed"),
        F.round(F.try_divide(F.col("rows_kept") * F.lit(100.0), F.col("rows_read")), 6).alias("pct_kept"),
    )


def load_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """A1: rows, distinct symbols, first and last time."""
    distinct = F.approx_count_distinct("symbol") if approx else F.countDistinct("symbol")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct.alias("n_symbols"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    )


def concat_batches(*batches: DataFrame) -> DataFrame:
    """Concatenate batches by column name; a column missing from a batch becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


__all__ = [
    "coerce_numeric", "coerce_time", "coerce_ticks", "ensure_symbol", "ensure_required", "fill_features",
    "valid_quote", "drop_missing_time", "zero_density_filter", "recent_days", "jump_filter",
    "liquidity_filter", "complete_cases", "known_symbol", "load_report", "zero_report", "load_stats",
    "concat_batches",
]
