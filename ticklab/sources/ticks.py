"""Tick sources and sinks (S1, S2) and the tick view derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.functions.exprs import nan_to_null
from ticklab.schema import TICKS, TICKS_RAW


def read_ticks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a tick table with an explicit schema (never inferred).

    CSV exports hold text; they are read as strings and coerced (P1, P2) so a bad value
    becomes NULL instead of failing the job.
    """
    from ticklab.operators.quality import coerce_ticks

    if fmt == "csv":
        raw = (
            spark.read.schema(TICKS_RAW)
            .option("header", True)
            .option("nullValue", "")
            .option("mode", "PERMISSIVE")
            .csv(path)
        )
        return coerce_ticks(raw)
    if fmt == "parquet":
        return _numbers(spark.read.schema(TICKS).parquet(path))
    return _numbers(spark.read.format(fmt).schema(TICKS).load(path))


def _numbers(ticks: DataFrame) -> DataFrame:
    """NaN to NULL in every double column: NaN compares above all numbers and would pass filters."""
    return ticks.withColumns({f.name: nan_to_null(F.col(f.name)) for f in TICKS.fields if f.dataType.simpleString() == "double"})


def write_ticks(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write cleaned ticks, partitioned by day so recent-day reads prune partitions.

    Rows are range-partitioned on (day, symbol, time) -- not hash-partitioned by day, which would
    send a whole day to one task: each task writes a bounded, sorted slice, so a day becomes many
    balanced files whose row-group statistics on symbol and time make pushed filters effective."""
    from ticklab.operators.layout import range_partitions

    out = df.withColumn("event_date", F.to_date("event_time"))
    n = range_partitions(out)
    ranged = out.repartitionByRange(n, "event_date", "symbol", "event_time", "tick_id")
    writer = ranged.sortWithinPartitions("event_date", "symbol", "event_time", "tick_id").write.mode(mode)
    if fmt == "csv":
        writer.partitionBy("event_date").option("header", True).csv(path)
    else:
        writer.partitionBy("event_date").format(fmt).save(path)


# Schema of the driver's `events` table (declared, so no footer inference per read).
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Tick view over the ``events`` table (integer arithmetic on event_id, see FIXTURES.md).

    Rows with event_id % 101 = 0 carry a zero bid (removed by F1); rows with
    event_id % 97 = 0 are sparse: ten of the twelve zero-check columns are 0 or NULL.
    """
    eid = F.col("event_id")
    value = nan_to_null(F.col("value"))
    sparse = eid % 97 == 0
    null = F.lit(None).cast("double")

    def dense(c):
        return F.when(sparse, F.lit(0.0)).otherwise(c)

    bid = F.when(eid % 101 == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) + value / F.lit(200.0) + F.abs(eid % 900 - 450).cast("double") / F.lit(150.0)
    )
    step = (eid % 7 + 1).cast("double") / F.lit(1000.0)
    digits = F.regexp_extract(F.col("props"), "([0-9]+)", 1).try_cast("double")
    return events.select(
        eid.alias("tick_id"),
        F.concat(F.lit("S"), F.lpad((F.col("user_id") % 20).cast("string"), 2, "0")).alias("symbol"),
        F.col("event_type").alias("market"),
        dense(value).alias("symbol_value"),
        dense((eid % 21 - 10).cast("double") / F.lit(10.0)).alias("changed_pct"),
        dense(value * F.lit(1.08)).alias("symbol_value_usd"),
        F.when(sparse, null).otherwise(value / F.lit(40000.0)).alias("symbol_value_btc"),
        dense((eid % 13).cast("double")).alias("available"),
        dense((eid % 3).cast("double")).alias("in_order"),
        F.when(sparse, null).otherwise(value * F.lit(2.0)).alias("actual_value"),
        bid.alias("bid_price"),
        (bid * (F.lit(1.0) + step)).alias("ask_price"),
        dense((eid * 37 % 101 + 1).cast("double")).alias("bid_size"),
        dense((eid * 53 % 89 + 1).cast("double")).alias("ask_size"),
        dense(bid * step).alias("spread"),
        F.lit(8.0).alias("price_precision"),
        (F.abs(eid % 400 - 200).cast("double") / F.lit(4.0) + F.floor(digits / F.lit(4.0)).cast("double")).alias(
            "ticket_count"
        ),
        ((eid * 17 % 41).cast("double") / F.lit(10.0)).alias("last_price_weight"),
        (eid % 50).cast("double").alias("last_price_count"),
        F.when(eid % 2 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("hide"),
        F.lit("feed").alias("changed_by"),
        (eid % 5).alias("changed_cnt"),
        F.col("ts").alias("event_time"),
    )


def load_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(events_table(spark, sf_dir))


# DuckDB/ANSI form of the same view, used by the oracle side; {STR} is the string type name.
TICK_VIEW_SQL = """
SELECT event_id AS tick_id,
  concat('S', lpad(cast(user_id % 20 AS {STR}), 2, '0')) AS symbol,
  event_type AS market,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE value END AS symbol_value,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE cast(event_id % 21 - 10 AS double)/10e0 END AS changed_pct,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE value*1.08e0 END AS symbol_value_usd,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value/40000e0 END AS symbol_value_btc,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE cast(event_id % 13 AS double) END AS available,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE cast(event_id % 3 AS double) END AS in_order,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value*2e0 END AS actual_value,
  bid AS bid_price,
  bid * (1e0 + cast(event_id % 7 + 1 AS double)/1000e0) AS ask_price,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE cast(event_id*37 % 101 + 1 AS double) END AS bid_size,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE cast(event_id*53 % 89 + 1 AS double) END AS ask_size,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE bid * (cast(event_id % 7 + 1 AS double)/1000e0) END AS spread,
  8e0 AS price_precision,
  cast(abs(event_id % 400 - 200) AS double)/4e0
    + cast(floor(cast(regexp_extract(props, '([0-9]+)', 1) AS double)/4e0) AS double) AS ticket_count,
  cast(event_id*17 % 41 AS double)/10e0 AS last_price_weight,
  cast(event_id % 50 AS double) AS last_price_count,
  CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'Y' END AS hide,
  'feed' AS changed_by,
  event_id % 5 AS changed_cnt,
  ts AS event_time
FROM (SELECT *, CASE WHEN event_id % 101 = 0 THEN 0e0
        ELSE 100e0 + value/200e0 + cast(abs(event_id % 900 - 450) AS double)/150e0 END AS bid
      FROM events) ev
"""
