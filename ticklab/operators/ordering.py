"""Sorts, positions, splits, slices and limits."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklab.operators.layout import SERIES_KEYS, SERIES_ORDER, resolve_layout, with_positions
from ticklab.session import materialize


def sort_series(df: DataFrame, keys=SERIES_KEYS, order=SERIES_ORDER) -> DataFrame:
    """O1: (symbol, time, id) order; used at sinks only (range-partitioned global sort)."""
    return df.orderBy(*keys, *order)


def top_k(df: DataFrame, score: str, k: int, tiebreak=("symbol", "tick_id"), ascending: bool = False) -> DataFrame:
    """O2: the k best (or worst) rows by ``score`` with a deterministic tie-break (TakeOrdered)."""
    first = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in tiebreak]).limit(k)


def global_positions(
    df: DataFrame, keys=SERIES_KEYS, order=SERIES_ORDER, pos_col: str = "pos", series_pos: str = "rn", layout: str | None = None
) -> DataFrame:
    """O3: 0-based position of each row in the global (symbol, time, id) order.

    Per-symbol positions (skew-safe, see layout) plus per-symbol offsets, one row a symbol."""
    if series_pos not in df.columns:
        if resolve_layout(df, layout, keys) == "symbol":
            w = Window.partitionBy(*keys).orderBy(*order)
            df = df.withColumn(series_pos, F.row_number().over(w) - 1)
        else:
            df = with_positions(df, keys, order, series_pos)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _offset(df, sizes, keys, pos_col, series_pos)


FEW_SERIES = 10_000  # series sizes that may come to the driver


def _offset(df: DataFrame, sizes: DataFrame, keys, pos_col: str, series_pos: str, few: int = FEW_SERIES) -> DataFrame:
    """Adds the rows of all earlier series (``sizes``: keys, _n). Up to ``few`` series: their sizes are summed on the
    driver, in one job. More: the sizes are written and summed range by range."""
    head = sizes.limit(few + 1).collect()
    if len(head) <= few:
        head = sorted(head, key=lambda r: [(r[k] is not None, r[k]) for k in keys])
        ends = list(itertools.accumulate(r["_n"] for r in head))
        rows = [(*(r[k] for k in keys), end - r["_n"], ends[-1]) for r, end in zip(head, ends)]
        kinds = ", ".join([*(f"`{k}` {dict(sizes.dtypes)[k]}" for k in keys), "_off long", "_total long"])
        offsets = df.sparkSession.createDataFrame(rows, kinds)
    else:
        sizes = materialize(sizes, "series-sizes")
        # series in order, dealt to ranges: a window per range plus the ranges before it
        ranged = materialize(sizes.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()), "series-ranges")
        prior = Window.partitionBy("_p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        parts = ranged.groupBy("_p").agg(F.sum("_n").alias("_pn"))  # at most one row a partition
        earlier = parts.select("_p", F.coalesce(F.sum("_pn").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
        offsets = ranged.join(earlier, "_p").select(
            *keys, (F.coalesce(F.sum("_n").over(prior), F.lit(0)) + F.col("_before")).alias("_off"),
            sizes.agg(F.sum("_n")).scalar().alias("_total"))
    return (
        df.join(offsets, list(keys))
        .withColumn(pos_col, F.col("_off") + F.col(series_pos))
        .withColumnRenamed("_total", "n_total")
        .drop("_off")
    )


def positional_split(positioned: DataFrame, pos_col: str = "pos", total_col: str = "n_total",
                     train: float = 0.6, val: float = 0.8) -> DataFrame:
    """Train rows [0, int(0.6 n)), validation [int(0.6 n), int(0.8 n)), test the rest."""
    n = F.col(total_col)
    cut1 = F.floor(n * F.lit(train))
    cut2 = F.floor(n * F.lit(val))
    return positioned.withColumn(
        "split",
        F.when(F.col(pos_col) < cut1, F.lit("train")).when(F.col(pos_col) < cut2, F.lit("val")).otherwise(F.lit("test")),
    )


def row_slice(positioned: DataFrame, start, end, pos_col: str = "pos", total_col: str = "n_total") -> DataFrame:
    """Rows with start <= position < end. Bounds are row numbers, or fractions of the total
    when given as floats in [0, 1] (never a bare ``limit``: that is not deterministic)."""
    def bound(b):
        if isinstance(b, float) and 0.0 <= b <= 1.0:
            return F.floor(F.col(total_col) * F.lit(b))
        return F.lit(int(b))

    return positioned.where((F.col(pos_col) >= bound(start)) & (F.col(pos_col) < bound(end)))


def first_n_after(df: DataFrame, n: int, order=("event_time", "tick_id")) -> DataFrame:
    """The oldest ``n`` rows in (time, id) order: TakeOrdered, n rows per task at most."""
    return df.orderBy(*order).limit(n)
