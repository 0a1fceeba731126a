"""Features kept day by day (M6 on new days without recomputing old ones).

A store is a folder with two tables:

- ``features``, partitioned by ``event_date``: ticks with their features and positions;
- ``carry``, partitioned by ``as_of``: the last 49 ticks of every symbol seen so far, with their positions, as of the
  end of a stored day. It is all that a later day's look-back windows need.

An update reads its own days and one carry-over partition, whatever the store holds, and replaces exactly the
partitions it computes, so running it again gives the same store.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.operators.features import add_features, last_ticks
from ticklab.operators.layout import resolve_layout, run_series
from ticklab.schema import PERSIST_AHEAD, ZSCORE_WINDOW
from ticklab.session import materialize

CARRY = ZSCORE_WINDOW - 1


def stored_days(spark: SparkSession, store: str, table: str = "features") -> list[dt.date]:
    """Days of a store's table, ascending, from the folder names; none if there is no store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/{table}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(dt.date.fromisoformat(n.split("=")[1]) for n in names if "=" in n)


def _overwrite(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that ``df`` holds and no others. Rows are dealt by range, so a day is many balanced
    files and not one task."""
    sort = [by, "symbol", "rn"]
    (df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def update_features(store: str, ticks: DataFrame, layout: str | None = None) -> list[dt.date]:
    """Compute the features of whole new days (cleaned ``ticks`` of one day or several) and store them; the days.

    Days have to come in order: a batch replaces its own days and has to hold every stored day from its first one on
    (a correction of day d is a batch of d and all later days). It starts from the carry-over of the last stored day
    before it; that day has to be the end of an earlier batch. ValueError otherwise. Ticks without a symbol or a time
    are left out (F2, F8). An empty batch changes nothing."""
    spark = ticks.sparkSession
    store = store.rstrip("/")
    new = ticks.drop("rn").withColumn("event_date", F.to_date("event_time")).where("symbol is not null and event_time is not null")
    days = sorted(r[0] for r in new.select("event_date").distinct().collect())  # as many as the batch has days
    if not days:
        return []
    stored = stored_days(spark, store)
    late = [d for d in stored if d >= days[0] and d not in days]
    if late:
        raise ValueError(f"the batch starts on {days[0]} and lacks the stored days {late}")
    before = [d for d in stored if d < days[0]]
    rows = new.withColumn("_old", F.lit(None).cast("long"))
    if before:
        if before[-1] not in stored_days(spark, store, "carry"):
            raise ValueError(f"{before[-1]} is not the end of a batch")
        carry = spark.read.parquet(f"{store}/carry/as_of={before[-1]}").withColumnRenamed("rn", "_old")
        rows = rows.unionByName(carry.withColumn("event_date", F.to_date("event_time")))
    feats = add_features(rows, nulls="keep", layout=resolve_layout(rows, layout))
    # positions go on from the carried ones: old and new position of a symbol's carried rows differ by one number
    shift = feats.where("_old is not null").groupBy("symbol").agg(F.max(F.col("_old") - F.col("rn")).alias("_shift"))
    feats = feats.join(shift, "symbol", "left").withColumn("rn", F.col("rn") + F.coalesce("_shift", F.lit(0))).drop("_shift")
    feats = materialize(feats, "daily-features")
    _overwrite(feats.where("_old is null").drop("_old"), f"{store}/features", "event_date")
    own = [*ticks.drop("rn").columns, "rn"]
    last = last_ticks(feats, CARRY, warmup=0).select(*own).withColumn("as_of", F.lit(days[-1]))
    _overwrite(last, f"{store}/carry", "as_of")
    return days


def read_features(spark: SparkSession, store: str, recent: int | None = None) -> DataFrame:
    """The stored features, of the ``recent`` newest days (by calendar, F4); other days' files are not opened."""
    path = f"{store.rstrip('/')}/features"
    days = stored_days(spark, store.rstrip("/")) if recent else []
    folders = [f"{path}/event_date={d}" for d in days if d > days[-1] - dt.timedelta(days=recent)]
    return spark.read.option("basePath", path).parquet(*(folders or [path]))


def with_lookahead(features: DataFrame, columns=("price_momentum_5", "volume_zscore", "tick_id"), ahead: int = PERSIST_AHEAD,
                   layout: str | None = None) -> DataFrame:
    """Stored features with the look-ahead columns of the persistence label (W6): a day's last ticks find their next
    ones in the following day."""
    def compute(frame, w):
        return frame.withColumns({f"{c}_next{k}": F.lead(c, k).over(w) for c in columns for k in range(1, ahead + 1)})
    return run_series(features, compute, before=0, after=ahead, layout=resolve_layout(features, layout))
