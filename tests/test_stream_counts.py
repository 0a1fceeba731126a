"""S7 and R6 counts of streams."""

import time

from pyspark.sql import functions as F

from conftest import make_ticks
from ticklab.streaming.counts import COUNTS, CountLog, batch_counts, counted, read_counts, store_counts
from ticklab.streaming.live import tick_stream


def test_counts_of_late_repeated_and_rejected_ticks(spark, tmp_path):
    src, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")

    def tick(i, at, bid=1.0):
        return {"symbol": "S", "tick_id": i, "event_time": at, "bid_price": bid}
    arrivals = [
        [tick(1, 0), tick(1, 0), tick(2, 10, 0.0), tick(2, 10), tick(3, 100_000), tick(4, 90_000, None)],  # 1 twice; 2 rejected, then good
        [tick(5, 200_000), tick(3, 100_000)],  # 3 again
        [tick(6, 50_000), tick(7, 60_000, 0.0), tick(8, 200_001), tick(9, 199_900)],  # 6 and 7 late, 9 within the delay
    ]
    listener = CountLog(spark, log + "-live", "counted-ticks")
    spark.streams.addListener(listener)
    inputs = 0
    try:
        for rows in arrivals:
            make_ticks(spark, rows).coalesce(1).write.mode("append").parquet(src)
            q = (counted(tick_stream(spark, src, 100), F.col("bid_price") > 0).writeStream.format("parquet").queryName("counted-ticks")
                 .option("path", out).option("checkpointLocation", out + "-ck").trigger(availableNow=True).start())
            q.awaitTermination()
            inputs += sum(p["numInputRows"] for p in q.recentProgress)
            store_counts(spark, log, q.recentProgress)
            store_counts(spark, log, q.recentProgress)  # counted once
        for _ in range(100):  # the listener is told later
            if read_counts(spark, log + "-live").count() == read_counts(spark, log).count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    total = read_counts(spark, log).agg(*[F.sum(c).alias(c) for c in COUNTS]).first().asDict()
    assert total == {"rows_read": 12, "rows_kept": 6, "rows_rejected": 2, "rows_late": 2, "rows_repeated": 2}
    assert inputs == 12
    assert sorted(r.tick_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 5, 8, 9]
    assert read_counts(spark, log + "-live").exceptAll(read_counts(spark, log)).isEmpty()
    assert read_counts(spark, log + "-live").count() == read_counts(spark, log).count()


def test_other_queries_have_no_counts(spark, tmp_path):
    assert batch_counts({"observedMetrics": {}, "stateOperators": [], "batchId": 0}) is None
    assert read_counts(spark, str(tmp_path / "none")).columns == ["batch_id", *COUNTS]
    assert read_counts(spark, str(tmp_path / "none")).isEmpty()
