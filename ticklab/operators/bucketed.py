"""Series kept as a bucketed, sorted table, so that windows (W1-W10) and barrier outcomes (T1) need no exchange.

A series is cut into chunks of ``blocks`` x (horizon + 1) positions; every chunk also holds copies of the 49 rows
before it and of the block after it. The table is bucketed by (symbol, chunk) and sorted by position: one shuffle when
it is written, none for whatever reads it. A hot symbol is many chunks, so no bucket holds a whole one.

T1 needs no join on this layout: a chunk's rows are gathered in blocks of horizon + 1 rows, each block meets the next
one through a ``lead``, and a signal's path is a slice of the two.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklab.operators.features import feature_columns
from ticklab.operators.layout import SERIES_ORDER, range_partitions, with_chunks, with_positions
from ticklab.operators.outcomes import ExitRules, _reason
from ticklab.schema import ZSCORE_WINDOW
from ticklab.session import ensure_checkpoint_dir

KEYS = ("symbol", "_chunk")


def write_bucketed(ticks: DataFrame, name: str | None = None, horizon: int = 30, blocks: int = 1 << 15, buckets: int | None = None) -> str:
    """Write ``ticks`` (symbol, event_time, tick_id, ...) as a bucketed table; its name.

    ``buckets``: by the size of the input (256 MB each), at least the session's shuffle partitions. Every bucket is
    one file, sorted by symbol, chunk and position. The files lie in the shared checkpoint folder. Rows are numbered
    by (event_time, tick_id) in their symbol, column ``rn``; rows without a symbol are left out (F8). An empty table
    gives an empty table."""
    spark = ticks.sparkSession
    name = name or f"ticks_{uuid.uuid4().hex[:12]}"
    n = buckets or range_partitions(ticks)
    placed = with_positions(ticks.drop("rn"), ("symbol",), SERIES_ORDER, "rn")
    rows = with_chunks(placed, (horizon + 1) * blocks, ZSCORE_WINDOW - 1, horizon + 1)
    (rows.repartition(n, *KEYS).sortWithinPartitions(*KEYS, "rn").write.bucketBy(n, *KEYS).sortBy(*KEYS, "rn").mode("overwrite")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/bucketed/{name}-{uuid.uuid4().hex[:8]}").saveAsTable(name))
    return name


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay until the checkpoint folder is cleaned."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed_features(spark: SparkSession, name: str, lookahead: dict[str, int] | None = None, halo: bool = False) -> DataFrame:
    """W1-W5, W7, P7-P10 and look-ahead columns on a bucketed table, without an exchange; the copied rows are left out
    unless ``halo`` (their features are not valid)."""
    w = Window.partitionBy(*KEYS).orderBy("rn")
    out = spark.table(name).withColumns(feature_columns(w))
    leads = {f"{c}_next{k}": F.lead(c, k).over(w) for c, n in (lookahead or {}).items() for k in range(1, n + 1)}
    out = out.withColumns(leads) if leads else out
    return out if halo else out.where("_own").drop("_chunk", "_own")


def bucketed_exits(rows: DataFrame, signal: Column, rules: ExitRules = ExitRules(), price: str = "bid_price", det: str | None = None,
                   per: str | None = None, model_id: str = "model", horizon: int = 30) -> DataFrame:
    """T1 on a bucketed table's rows (``halo`` kept): the exit of every signal, as ``outcomes.signal_exits``.

    Only independent rules with ``max_hold`` up to the table's horizon end inside the next block. A signal near the
    end of its series exits there (END_OF_DATA)."""
    if rules.mode != "independent" or rules.max_hold > horizon:
        raise ValueError("a bucketed table holds the paths of independent rules up to its horizon")
    none = F.lit(None).cast("double")
    tick = F.struct("rn", F.col(price).alias("px"), "event_time", (F.col(det) if det else none).alias("det"), (F.col(per) if per else none).alias("per"),
                    (F.coalesce(signal, F.lit(False)) & F.col("_own")).alias("signal"))
    size = horizon + 1
    block = rows.groupBy(*KEYS, F.floor(F.col("rn") / size).alias("_bkt")).agg(F.array_sort(F.collect_list(tick)).alias("cur"))
    after = Window.partitionBy(*KEYS).orderBy("_bkt")
    near = F.when(F.lead("_bkt").over(after) == F.col("_bkt") + 1, F.lead("cur").over(after))
    both = F.concat("cur", F.coalesce(near, F.expr("slice(cur, 1, 0)")))
    block = block.withColumn("both", both).where(F.exists("cur", lambda t: t["signal"]))
    sig = block.select("symbol", "both", F.explode(F.filter("cur", lambda t: t["signal"])).alias("s"))
    path = F.filter("both", lambda t: t["rn"].between(F.col("s.rn"), F.col("s.rn") + rules.max_hold))
    sig = sig.select("symbol", "s", path.alias("path"))

    def ret(t):
        return F.try_divide(t["px"] - F.col("s.px"), F.col("s.px"))

    def walk(acc, t):
        peak = F.greatest(acc["peak"], ret(t))
        reason = _reason(rules, ret(t), peak, t["rn"] - F.col("s.rn"), t["det"] if det else None, t["per"] if per else None)
        step = F.struct(peak.alias("peak"), F.when(reason.isNotNull(), t["rn"]).alias("at"), reason.alias("reason"))
        return F.when(acc["at"].isNotNull(), acc).otherwise(step)
    start = F.struct(none.alias("peak"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("reason"))
    out = sig.withColumn("found", F.aggregate("path", start, walk))
    last = F.element_at("path", -1)
    x = F.when(F.col("found.at").isNotNull(), F.get("path", (F.col("found.at") - F.col("s.rn")).cast("int"))).otherwise(last)
    out = out.withColumn("x", x).withColumn("_ret", ret(F.col("x")))
    return out.select(
        F.lit(model_id).alias("model_id"), "symbol", F.col("s.rn").alias("s_rn"), F.col("s.rn").alias("entry_pos"), F.col("x.rn").alias("exit_pos"),
        F.col("s.event_time").alias("entry_time"), F.col("x.event_time").alias("exit_time"), F.col("s.px").alias("entry_price"), F.col("x.px").alias("exit_price"),
        F.col("s.det").alias("entry_det_prob"), F.col("s.per").alias("entry_per_prob"), F.col("x.det").alias("exit_det_prob"), F.col("x.per").alias("exit_per_prob"),
        (F.col("_ret") * 100.0).alias("return_pct"), (F.col("x.rn") - F.col("s.rn")).cast("int").alias("ticks_held"),
        F.coalesce("found.reason", F.lit("END_OF_DATA")).alias("exit_reason"))
