"""Series layout: per-symbol positions and tick-count windows that stay parallel on hot symbols.

A plain ``Window.partitionBy("symbol")`` sends every tick of a symbol to one task; when one
symbol holds a third of 100 TB that task is the job. Instead:

* ``with_positions`` (O3/W7) range-partitions on (symbol, time, id), numbers rows inside each
  range partition, and adds the per-(symbol, partition) prefix offsets. The offsets table has at
  most ``partitions + symbols`` rows (each range partition is one contiguous slice of the sort
  order). The numbered frame is checkpointed to the shared checkpoint folder
  first: two independently planned range exchanges may sample different bounds, so the offsets
  must be computed from the same materialized numbering the rows carry (it also cuts lineage,
  so a lost executor never re-numbers rows).
* ``run_series`` cuts each symbol into chunks of ``chunk_rows`` positions and copies ``before``
  look-back and ``after`` look-ahead halo rows into the neighbouring chunk, so a ROWS frame of
  bounded size sees exactly the rows it would see in the whole series. Windows then partition by
  (symbol, chunk): bounded tasks, one shuffle, exact results.

``layout="symbol"`` keeps the textbook per-symbol window (one Exchange + Sort) for small inputs.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES_KEYS = ("symbol",)
SERIES_ORDER = ("event_time", "tick_id")
DEFAULT_CHUNK_ROWS = 1 << 20

# Layout used when a caller does not choose one; bench/tests may override.
# "auto": per-symbol windows when every symbol fits one task (<= chunk_rows rows), else chunked.
DEFAULT_LAYOUT = "auto"


def resolve_layout(df: DataFrame, layout: str | None = None, keys=SERIES_KEYS, chunk_rows: int | None = None) -> str:
    """Pick the layout; "auto" runs one partial aggregate (rows of the largest series)."""
    layout = layout or DEFAULT_LAYOUT
    if layout != "auto":
        return layout
    biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return "symbol" if biggest <= (chunk_rows or DEFAULT_CHUNK_ROWS) else "chunked"


def series_window(keys=SERIES_KEYS, order=SERIES_ORDER):
    return Window.partitionBy(*keys).orderBy(*order)


TARGET_PARTITION_BYTES = 256 << 20
MAX_PARTITIONS = 1 << 20


def range_partitions(df: DataFrame) -> int:
    """Range partitions for numbering: the optimizer's size estimate / 256 MB (100 TB: ~400k partitions),
    at least ``spark.sql.shuffle.partitions`` and at most MAX_PARTITIONS (estimates of joins multiply
    their sides and may be far too large)."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = getattr(df, "_jdf", None)
    if plan is None:  # no JVM plan to ask (Spark Connect)
        return base
    size = int(plan.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(MAX_PARTITIONS, max(base, -(-size // TARGET_PARTITION_BYTES)))


def with_positions(
    df: DataFrame,
    keys=SERIES_KEYS,
    order=SERIES_ORDER,
    pos_col: str = "rn",
    num_partitions: int | None = None,
    materialize: bool = True,
) -> DataFrame:
    """Add ``pos_col`` = 0-based position of the row in its series, ordered by ``order``.

    No single-partition window and no per-symbol task: see module docstring. The offsets table is
    written once, so its true size decides between a broadcast and a shuffle join (Spark's own
    threshold; no hint).
    """
    n = num_partitions or range_partitions(df)
    sort_cols = [*keys, *order]
    ranged = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
    )
    if materialize:
        from ticklab.session import materialize as write_once

        ranged = write_once(ranged, "positions")
    stats = ranged.groupBy(*keys, "_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        *keys, "_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    if materialize:
        offsets = write_once(offsets, "offsets")
    return (
        ranged.join(offsets, [*keys, "_pid"])
        .withColumn(pos_col, F.col("_off") + F.col("_local") - F.col("_first"))
        .drop("_pid", "_local", "_first", "_off")
    )


def with_chunks(positioned: DataFrame, chunk_rows: int, before: int, after: int, pos_col: str = "rn") -> DataFrame:
    """Assign each row to its chunk, plus halo copies: the last ``before`` rows of chunk c are
    copied into c+1 and the first ``after`` rows of chunk c into c-1. ``_own`` marks the original."""
    if before >= chunk_rows or after >= chunk_rows:
        raise ValueError("halo must be smaller than the chunk")
    rn = F.col(pos_col)
    own = F.floor(rn / F.lit(chunk_rows))
    offset = rn - own * F.lit(chunk_rows)
    targets = F.array(
        own,
        F.when(offset >= F.lit(chunk_rows - before), own + 1),
        F.when((offset < F.lit(after)) & (own > 0), own - 1),
    )
    return (
        positioned.withColumn("_chunk", F.explode(F.filter(targets, lambda x: x.isNotNull())))
        .withColumn("_own", F.col("_chunk") == own)
    )


def run_series(
    df: DataFrame,
    compute: Callable[[DataFrame, object], DataFrame],
    before: int,
    after: int,
    layout: str | None = None,
    keys=SERIES_KEYS,
    order=SERIES_ORDER,
    pos_col: str = "rn",
    chunk_rows: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """Apply ``compute(df, window)`` whose windows look at most ``before`` rows back and
    ``after`` rows ahead. The result carries ``pos_col`` (W7) and no helper columns.

    ``df`` may already carry ``pos_col``: it is the order then and stays as it is. Chunks need positions
    without gaps; a carried one counts as gapped (a filter may have run) unless ``dense`` says otherwise,
    and rows are numbered afresh for the chunks."""
    chunk_rows = chunk_rows or DEFAULT_CHUNK_ROWS
    layout = resolve_layout(df, layout, keys, chunk_rows)
    if layout == "symbol":
        if pos_col in df.columns:
            return compute(df, Window.partitionBy(*keys).orderBy(pos_col))
        w = Window.partitionBy(*keys).orderBy(*order)
        return compute(df.withColumn(pos_col, F.row_number().over(w) - 1), w)
    if layout != "chunked":
        raise ValueError(f"unknown layout {layout!r}")
    at = pos_col
    if pos_col in df.columns and not dense:
        at = "_dense"
        positioned = with_positions(df, keys, (pos_col,), at)
    else:
        positioned = df if pos_col in df.columns else with_positions(df, keys, order, pos_col)
    chunked = with_chunks(positioned, chunk_rows, before, after, at)
    w = Window.partitionBy(*keys, "_chunk").orderBy(at)
    return compute(chunked, w).where(F.col("_own")).drop("_chunk", "_own", "_dense")


def running_agg(
    df: DataFrame,
    value_col: str,
    out_col: str,
    keys=SERIES_KEYS,
    pos_col: str = "rn",
    inclusive: bool = True,
    how: str = "max",
    layout: str | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running max or sum of ``value_col`` along ``pos_col`` within each key (up to and including
    the row, or strictly before it). Chunked form: a window inside each (key, chunk) plus the
    aggregate of all earlier chunks (a per-key table with one row per chunk), so no task holds a
    whole series."""
    agg = {"max": F.max, "sum": F.sum}[how]
    end = 0 if inclusive else -1
    lay = resolve_layout(df, layout, keys, chunk_rows)
    if lay == "symbol":
        w = Window.partitionBy(*keys).orderBy(pos_col).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumn(out_col, agg(value_col).over(w))
    size = chunk_rows or DEFAULT_CHUNK_ROWS
    d = df.withColumn("_c", F.floor(F.col(pos_col) / F.lit(size)))
    inner = Window.partitionBy(*keys, "_c").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, end)
    local = d.withColumn("_lm", agg(value_col).over(inner))
    per_chunk = d.groupBy(*keys, "_c").agg(agg(value_col).alias("_cm"))
    earlier = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    prior = per_chunk.select(*keys, "_c", agg("_cm").over(earlier).alias("_pm"))
    joined = local.join(prior, [*keys, "_c"], "left")
    if how == "max":
        value = F.greatest(F.col("_pm"), F.col("_lm"))
    else:
        value = F.when(F.col("_pm").isNull() & F.col("_lm").isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col("_pm"), F.lit(0)) + F.coalesce(F.col("_lm"), F.lit(0))
        )
    return joined.withColumn(out_col, value).drop("_c", "_lm", "_pm")


def running_max(df: DataFrame, value_col: str, out_col: str, keys=SERIES_KEYS, pos_col: str = "rn",
                inclusive: bool = True, layout: str | None = None, chunk_rows: int | None = None) -> DataFrame:
    return running_agg(df, value_col, out_col, keys, pos_col, inclusive, "max", layout, chunk_rows)


def running_sum(df: DataFrame, value_col: str, out_col: str, keys=SERIES_KEYS, pos_col: str = "rn",
                inclusive: bool = True, layout: str | None = None, chunk_rows: int | None = None) -> DataFrame:
    return running_agg(df, value_col, out_col, keys, pos_col, inclusive, "sum", layout, chunk_rows)
