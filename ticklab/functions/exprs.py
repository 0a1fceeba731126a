"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklab.schema import EPS, ZERO_CHECK_COLUMNS, ZERO_EPS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mid_price(bid="bid_price", ask="ask_price") -> Column:
    """(bid + ask) / 2."""
    return (col(bid) + col(ask)) / F.lit(2.0)


def spread_pct(bid="bid_price", ask="ask_price") -> Column:
    """(ask - bid) / (bid + 1e-8)."""
    return (col(ask) - col(bid)) / (col(bid) + F.lit(EPS))


def spread_abs(bid="bid_price", ask="ask_price") -> Column:
    """Ask - bid."""
    return col(ask) - col(bid)


def bid_ask_ratio(bid_size="bid_size", ask_size="ask_size") -> Column:
    """bid_size / (ask_size + 1e-8)."""
    return col(bid_size) / (col(ask_size) + F.lit(EPS))


def order_flow_imbalance(bid_size="bid_size", ask_size="ask_size") -> Column:
    """P10: (bs - as) / (bs + as + 1e-8)."""
    return (col(bid_size) - col(ask_size)) / (col(bid_size) + col(ask_size) + F.lit(EPS))


def clip(c, lower: float, upper: float) -> Column:
    """Clamp to [lower, upper]; null stays null."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(lower)), F.least(F.lit(float(upper)), c))
    )


def mean_of(*cols) -> Column:
    """Arithmetic mean of score columns."""
    total = col(cols[0])
    for c in cols[1:]:
        total = total + col(c)
    return total / F.lit(float(len(cols)))


def is_zero(c) -> Column:
    """True when a value is missing or |x| < 1e-10 (NaN counts as missing).

    The value is named once: Spark copies a computed column into each mention."""
    return F.abs(F.coalesce(F.nanvl(col(c), F.lit(None).cast("double")), F.lit(0.0))) < F.lit(ZERO_EPS)


def zero_count(columns=None) -> Column:
    """F3 helper: number of checked columns that are null or effectively zero.

    Counted over an array: a sum of a dozen tests is generated code beyond the size that the JVM compiles, and a row
    then costs fifty times as much."""
    values = F.array(*[col(c).cast("double") for c in columns or ZERO_CHECK_COLUMNS])
    return F.size(F.filter(values, is_zero))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
