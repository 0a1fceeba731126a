"""Incremental reads after a high-water mark and the current snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklab.operators.features import newest_per_symbol
from ticklab.operators.ordering import first_n_after
from ticklab.operators.quality import valid_quote


def read_since(df: DataFrame, since, limit: int | None = None, column: str = "event_time") -> DataFrame:
    """Valid quotes strictly after the mark; with ``limit`` (a poll batch) the oldest so many, in order.

    ``since`` is a literal, a Column, or a one-row DataFrame with a ``mark`` column (used as a
    scalar subquery). Either way the comparison reaches the parquet scan."""
    rows = valid_quote(df, require_ask=True)
    if isinstance(since, DataFrame):
        rows = rows.where(F.col(column) > since.select("mark").scalar())
    else:
        mark = since if isinstance(since, Column) else F.lit(since)
        rows = rows.where(F.col(column) > mark)
    return first_n_after(rows, limit) if limit else rows


def high_water_mark(batch: DataFrame, column: str = "event_time") -> DataFrame:
    """A4: rows in the batch and the new mark (max time)."""
    return batch.agg(F.count(F.lit(1)).alias("n_rows"), F.max(column).alias("new_mark"))


def current_snapshot(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """Newest valid quote per symbol, newest first. A snapshot table whose columns carry a
    prefix (``ast_``) is renamed to the history names first."""
    if prefix:
        df = df.withColumnsRenamed({c: c[len(prefix):] for c in df.columns if c.startswith(prefix)})
    return newest_per_symbol(valid_quote(df, require_ask=True)).orderBy(F.col("event_time").desc(), "symbol")
