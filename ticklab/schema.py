"""Fixed schemas and column lists of the tick data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Tick table columns in source order, with their Spark types.
TICK_COLUMNS: list[tuple[str, T.DataType]] = [
    ("tick_id", T.LongType()),
    ("symbol", T.StringType()),
    ("market", T.StringType()),
    ("symbol_value", T.DoubleType()),
    ("changed_pct", T.DoubleType()),
    ("symbol_value_usd", T.DoubleType()),
    ("symbol_value_btc", T.DoubleType()),
    ("available", T.DoubleType()),
    ("in_order", T.DoubleType()),
    ("actual_value", T.DoubleType()),
    ("bid_price", T.DoubleType()),
    ("ask_price", T.DoubleType()),
    ("bid_size", T.DoubleType()),
    ("ask_size", T.DoubleType()),
    ("spread", T.DoubleType()),
    ("price_precision", T.DoubleType()),
    ("ticket_count", T.DoubleType()),
    ("last_price_weight", T.DoubleType()),
    ("last_price_count", T.DoubleType()),
    ("hide", T.StringType()),
    ("changed_by", T.StringType()),
    ("changed_cnt", T.LongType()),
    ("event_time", T.TimestampType()),
]

TICKS = T.StructType([T.StructField(n, t, True) for n, t in TICK_COLUMNS])

# Same columns, all read as text: the shape of CSV exports and SQL dumps before coercion.
TICKS_RAW = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in TICK_COLUMNS])

# The 16 columns coerced to double.
NUMERIC_COLUMNS = [
    "bid_price", "ask_price", "bid_size", "ask_size", "ticket_count",
    "last_price_weight", "spread", "symbol_value", "changed_pct", "symbol_value_usd",
    "symbol_value_btc", "available", "in_order", "actual_value", "price_precision",
    "last_price_count",
]

# Columns excluded from the zero-density check.
ZERO_CHECK_EXCLUDED = [
    "tick_id", "symbol", "market", "changed_by", "event_time", "changed_cnt", "hide",
    "price_precision", "ticket_count", "last_price_weight", "last_price_count",
]
ZERO_CHECK_COLUMNS = [n for n, _ in TICK_COLUMNS if n not in ZERO_CHECK_EXCLUDED]

# Columns the live path requires, defaulting to 0.0 when absent or null.
REQUIRED_COLUMNS = ["bid_price", "ask_price", "ticket_count", "last_price_weight", "bid_size", "ask_size"]

# Model features, in vector order.
FEATURES = [
    "price_momentum_5", "price_momentum_10",
    "volume_zscore",
    "spread_pct", "spread_abs",
    "weight_change", "weight_velocity",
    "bid_ask_ratio", "order_flow_imbalance",
]

# Numeric guards and rule constants.
EPS = 1e-8
ZERO_EPS = 1e-10
ZSCORE_WINDOW = 50
MOMENTUM_QUANTILE = 0.85
ZSCORE_QUANTILE = 0.75
FALLBACK_QUANTILE = 0.90
FALLBACK_MIN_POSITIVES = 100
PERSIST_AHEAD = 5
PERSIST_MIN_HITS = 3
PERSIST_FACTOR = 0.7

TRADES = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("entry_pos", T.LongType()),
    T.StructField("exit_pos", T.LongType()),
    T.StructField("entry_time", T.TimestampType()),
    T.StructField("exit_time", T.TimestampType()),
    T.StructField("entry_price", T.DoubleType()),
    T.StructField("exit_price", T.DoubleType()),
    T.StructField("entry_det_prob", T.DoubleType()),
    T.StructField("entry_per_prob", T.DoubleType()),
    T.StructField("exit_det_prob", T.DoubleType()),
    T.StructField("exit_per_prob", T.DoubleType()),
    T.StructField("return_pct", T.DoubleType()),
    T.StructField("ticks_held", T.IntegerType()),
    T.StructField("exit_reason", T.StringType()),
])
