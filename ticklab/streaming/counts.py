"""S7 on streams: how many ticks each micro-batch read, kept, rejected, found late and found repeated, from the one pass
that writes them.

Every number comes from the stage behind the deduplication's exchange, the one that writes: it counts once, also when
executors are lost and map tasks run again. Rejected ticks therefore pass the deduplication too, marked, under a key of
their own, and are left out behind the count.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ticklab.streaming import commits

NAME = "tick_counts"
COUNTS = ["rows_read", "rows_kept", "rows_rejected", "rows_late", "rows_repeated"]


def counted(ticks: DataFrame, keep: Column, delay: str = "10 minutes") -> DataFrame:
    """R6 with counts: ticks that satisfy ``keep``, not later than the watermark and not repeated within it.

    Late and repeated ticks count as such whether they satisfy ``keep`` or not; null counts as not satisfied. A
    rejected tick does not stand for a good one of the same id."""
    marked = ticks.withColumn("_keep", F.coalesce(keep, F.lit(False))).withWatermark("event_time", delay)
    once = marked.dropDuplicatesWithinWatermark(["tick_id", "_keep"])
    seen = once.observe(NAME, F.count_if("_keep").alias("kept"), F.count_if(~F.col("_keep")).alias("rejected"))
    return seen.where("_keep").drop("_keep")


def batch_counts(progress) -> dict | None:
    """The counts of one micro-batch of a ``counted`` stream from its StreamingQueryProgress; None for other queries."""
    seen = progress["observedMetrics"].get(NAME)
    dedupe = [s for s in progress["stateOperators"] if s["operatorName"] == "dedupeWithinWatermark"]
    if seen is None or not dedupe:
        return None
    kept, rejected = (seen[k] or 0 for k in ("kept", "rejected"))
    late, repeated = dedupe[0]["numRowsDroppedByWatermark"], dedupe[0]["customMetrics"]["numDroppedDuplicateRows"]
    return dict(zip(COUNTS, (kept + rejected + late + repeated, kept, rejected, late, repeated)), batch_id=progress["batchId"])


def store_counts(spark: SparkSession, folder: str, progresses: Iterable) -> None:
    """Keep the counts of these micro-batches, each once: a batch stored before is left as it is."""
    for progress in progresses:
        counts = batch_counts(progress)
        if counts is not None and not commits.committed(spark, folder, counts["batch_id"]):
            commits.commit(spark, folder, counts)


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, counts) of all stored micro-batches. A batch whose driver was lost between its end and the store is
    missing: ids then have a gap."""
    rows = [(m["batch_id"], *[m[c] for c in COUNTS]) for m in commits.commits(spark, folder)]
    return spark.createDataFrame(rows, "batch_id long, " + ", ".join(f"{c} long" for c in COUNTS))


class CountLog(StreamingQueryListener):
    """Stores the counts of the query called ``name`` while it runs: ``spark.streams.addListener(CountLog(...))``."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            store_counts(self.spark, self.folder, [event.progress])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
