"""Signal outcomes: barrier exits per signal (T1, W8), the non-overlapping trade log (T2) and the
live exit rule (T3).

All three share one engine: signals are band-joined to the ticks that follow them on an equi key
(symbol, bucket) with bucket = rn // (h + 1), so each signal meets at most 2 (h + 1) ticks instead
of its whole symbol. Per signal, a window over its band gives the running peak (W8) and the first
tick whose rule fires is picked with ``min_by``.

* T1 tests the exits independently in priority order inside a fixed horizon H (max hold fires at H).
* T2 reproduces the backtest walk: one position per symbol, trailing branch shadows max hold and
  signal lost once the peak exceeds 0.3 %. Such a position can stay open past H: signals not
  resolved inside the band go on in a barrier search over a tree of block summaries (``_search``),
  which skips every block whose lowest and highest price cannot fire a rule. No signal is dropped
  and none rereads the ticks it has passed; a search costs about 2 log64(ticks) small joins.
  The walk's choice of which signals become trades is a chain: next(i) = i + 1 + (signals inside
  trade i). It is followed by pointer doubling (log2 of the chain length rounds of joins) -- no
  per-symbol sequential task.
* T3 is the live rule (profit / stop / signal lost, no trailing, no hold limit): no exit on the
  entry tick, and a new entry may happen on the exit tick.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklab.operators.layout import SERIES_KEYS, SERIES_ORDER, resolve_layout, with_positions
from ticklab.session import materialize


# The rules' numbers and, in _reason, the names of the exits.
@dataclass
class ExitRules:
    profit_target: float = 0.01
    stop_loss: float = 0.005
    max_hold: int = 30
    trailing: bool = True
    trailing_min_peak: float = 0.003
    trailing_keep: float = 0.5
    hard_stop: float = 0.1
    capped_above: float = 0.5
    lost_return: float = -0.002
    det_threshold: float = 0.7
    per_threshold: float = 0.5
    single_lost_below: float = 0.3
    mode: str = "independent"  # "independent" (T1) | "backtest" (T2, reference order) | "live" (T3)

    @property
    def exit_on_entry_tick(self) -> bool:
        return self.mode != "live"

    @property
    def reenter_on_exit_tick(self) -> bool:
        return self.mode == "live"


BACKTEST = ExitRules(mode="backtest")
LIVE = ExitRules(mode="live")


def positioned(ticks: DataFrame, layout: str | None = None, keys=SERIES_KEYS, order=SERIES_ORDER) -> DataFrame:
    if "rn" in ticks.columns:
        return ticks
    if resolve_layout(ticks, layout, keys) == "symbol":
        return ticks.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return with_positions(ticks, keys, order, "rn")


def _reason(rules: ExitRules, ret: Column, peak: Column, held: Column, det: Column | None, per: Column | None) -> Column:
    profit = ret >= F.lit(rules.profit_target)
    profit_name = F.when(ret > F.lit(rules.capped_above), F.lit("PROFIT_TARGET_CAPPED")).otherwise(F.lit("PROFIT_TARGET"))
    if rules.mode == "live":
        stop = ret <= F.lit(-rules.stop_loss)
    else:
        stop = (ret <= F.lit(-rules.stop_loss)) | (ret <= F.lit(-rules.hard_stop))
    if det is None:
        lost = F.lit(False)
    elif per is None:
        lost = (det < F.lit(rules.single_lost_below)) & (ret < F.lit(rules.lost_return))
    else:
        lost = (det < F.lit(rules.det_threshold * 0.5)) & (per < F.lit(rules.per_threshold * 0.5)) & (
            ret < F.lit(rules.lost_return)
        )
    lost = F.coalesce(lost, F.lit(False))
    if rules.mode == "live":
        return (
            F.when(profit, F.lit("PROFIT")).when(stop, F.lit("STOP_LOSS")).when(lost, F.lit("SIGNAL_LOST"))
        )
    trailing_armed = F.lit(rules.trailing) & (peak > F.lit(rules.trailing_min_peak))
    trailing_fires = trailing_armed & (ret < peak * F.lit(rules.trailing_keep))
    hold = held >= F.lit(rules.max_hold)
    reason = F.when(profit, profit_name).when(stop, F.lit("STOP_LOSS"))
    if rules.mode == "backtest":
        # Reference order: once trailing is armed, hold and signal-lost are not looked at.
        reason = reason.when(trailing_armed, F.when(trailing_fires, F.lit("TRAILING_STOP")))
    else:
        reason = reason.when(trailing_fires, F.lit("TRAILING_STOP"))
    return reason.when(hold, F.lit("MAX_HOLD")).when(lost, F.lit("SIGNAL_LOST"))


def _band_exits(ticks: DataFrame, sigs: DataFrame, horizon: int, rules: ExitRules, price: str,
                det: str | None, per: str | None, last_rn: DataFrame) -> DataFrame:
    """First exit of each signal within [s, s + horizon]; NULL exit when unresolved, and the peak so far."""
    b = horizon + 1
    tick_side = ticks.select(
        "symbol", "rn", F.col(price).alias("_px"), "event_time",
        *( [F.col(det).alias("_det")] if det else [] ), *( [F.col(per).alias("_per")] if per else [] ),
        F.floor(F.col("rn") / F.lit(b)).alias("_bkt"),
    )
    sig_side = sigs.select(
        "symbol", "s_rn", "entry_price",
        F.explode(F.array_distinct(F.array(F.floor(F.col("s_rn") / F.lit(b)), F.floor((F.col("s_rn") + F.lit(horizon)) / F.lit(b))))).alias("_bkt"),
    )
    band = sig_side.join(tick_side, ["symbol", "_bkt"]).where(
        (F.col("rn") >= F.col("s_rn")) & (F.col("rn") <= F.col("s_rn") + F.lit(horizon))
    )
    ret = F.try_divide(F.col("_px") - F.col("entry_price"), F.col("entry_price"))
    per_signal = Window.partitionBy("symbol", "s_rn").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    band = band.withColumn("_ret", ret).withColumn("_peak", F.max("_ret").over(per_signal))
    held = F.col("rn") - F.col("s_rn")
    reason = _reason(rules, F.col("_ret"), F.col("_peak"), held,
                     F.col("_det") if det else None, F.col("_per") if per else None)
    if not rules.exit_on_entry_tick:
        reason = F.when(held > 0, reason)
    band = band.withColumn("_reason", reason)
    exit_row = _exit_row("_det" if det else None, "_per" if per else None)
    fired = F.col("_reason").isNotNull()
    agg = band.groupBy("symbol", "s_rn").agg(
        F.min_by(exit_row, F.when(fired, F.col("rn"))).alias("_exit"),
        F.max_by(exit_row, F.col("rn")).alias("_last"),
        F.max("rn").alias("_band_end"), F.max("_ret").alias("_peak"),
    )
    agg = agg.join(last_rn, "symbol")
    resolved_exit = F.coalesce(
        F.col("_exit"),
        F.when(F.col("_band_end") >= F.col("_sym_last"), F.col("_last").withField("exit_reason", F.lit("END_OF_DATA"))),
    )
    return agg.select("symbol", "s_rn", resolved_exit.alias("_x"), "_peak")


def _exit_row(det: str | None, per: str | None) -> Column:
    none = F.lit(None).cast("double")
    return F.struct(
        F.col("rn").alias("exit_pos"), F.col("event_time").alias("exit_time"), F.col("_px").alias("exit_price"),
        (F.col(det) if det else none).alias("exit_det_prob"), (F.col(per) if per else none).alias("exit_per_prob"),
        F.col("_ret").alias("_ret"), F.col("_reason").alias("exit_reason"),
    )


FANOUT = 64  # children per block of the summary tree


def _summary_tree(ticks: DataFrame, rules: ExitRules, price: str, det: str | None, per: str | None, last: int) -> DataFrame:
    """(level, symbol, parent, kids): kids are the up to FANOUT blocks of one parent in order, each with its
    lowest, highest and lowest lost-signal price. Level 0 blocks are single ticks, a level-l block spans
    FANOUT^l positions. Every level is FANOUT times smaller than the one below."""
    if det is None:
        lost = F.lit(False)
    elif per is None:
        lost = F.col(det) < F.lit(rules.single_lost_below)
    else:
        lost = (F.col(det) < F.lit(rules.det_threshold * 0.5)) & (F.col(per) < F.lit(rules.per_threshold * 0.5))
    px = F.col(price)
    level = ticks.select("symbol", F.col("rn").alias("blk"), px.alias("lo"), px.alias("hi"), F.when(lost, px).alias("lost"))
    tree, depth, span = None, 0, 1
    while True:
        kids = level.groupBy("symbol", F.floor(F.col("blk") / FANOUT).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("blk", "lo", "hi", "lost"))).alias("kids"))
        kids = materialize(kids.select(F.lit(depth).alias("level"), "symbol", "parent", "kids"), "summary")
        tree = kids if tree is None else tree.unionByName(kids)
        span *= FANOUT
        if span > last:
            return tree
        each = lambda f: F.transform("kids", lambda k: k[f])
        level = kids.select("symbol", F.col("parent").alias("blk"), F.array_min(each("lo")).alias("lo"),
                            F.array_max(each("hi")).alias("hi"), F.array_min(each("lost")).alias("lost"))
        depth += 1


def _search(open_: DataFrame, tree: DataFrame, rules: ExitRules, last: int) -> DataFrame:
    """(symbol, s_rn, exit_pos, _peak): first position at or after ``blk`` whose tick fires a rule, NULL at the
    end of the series. ``open_``: symbol, s_rn, entry_price, blk, _peak.

    State per signal: tree level and next block there. A round looks at the rest of the current parent's
    blocks (one equi-join, at most FANOUT per signal): a block that may fire is entered (on level 0 it is the
    exit), else the search goes on behind the parent, one level up. Positions only grow, so it ends."""
    top = max(0, math.ceil(math.log(last + 1, FANOUT)) - 1) if last else 0

    def fires(kid, peak):
        a = F.try_divide(kid["lo"] - F.col("entry_price"), F.col("entry_price"))
        b = F.try_divide(kid["hi"] - F.col("entry_price"), F.col("entry_price"))
        low, high = F.least(a, b), F.greatest(a, b)
        hit = (high >= F.lit(rules.profit_target)) | (low <= F.lit(-rules.stop_loss))
        if rules.mode == "live":
            lost = F.try_divide(kid["lost"] - F.col("entry_price"), F.col("entry_price"))
            return F.coalesce(hit, F.lit(False)) | F.coalesce(lost < F.lit(rules.lost_return), F.lit(False)), high
        # behind the band the trailing stop is armed (else max hold would have fired)
        hit = hit | (low <= F.lit(-rules.hard_stop)) | (low < F.greatest(peak, high) * F.lit(rules.trailing_keep))
        return F.coalesce(hit, F.lit(False)), high

    def step(acc, kid):
        hit, high = fires(kid, acc["peak"])
        over = acc["found"].isNotNull() | (kid["blk"] < F.col("blk"))
        return F.struct(
            F.when(over, acc["found"]).when(hit, kid["blk"]).alias("found"),
            F.when(over | (hit & (F.col("level") > 0)), acc["peak"]).otherwise(F.greatest(acc["peak"], high)).alias("peak"))

    state = open_.select("symbol", "s_rn", "entry_price", F.lit(0).alias("level"), "blk", "_peak")
    done = None
    while True:
        start = F.struct(F.lit(None).cast("long").alias("found"), F.col("_peak").alias("peak"))
        seen = (state.withColumn("parent", F.floor(F.col("blk") / FANOUT)).join(tree, ["level", "symbol", "parent"], "left")
                .withColumn("r", F.aggregate(F.coalesce("kids", F.array().cast(dict(tree.dtypes)["kids"])), start, step)))
        found, level = F.col("r.found"), F.col("level")
        over = (found.isNotNull() & (level == 0)) | (found.isNull() & (level == top))
        moved = materialize(seen.select(
            "symbol", "s_rn", "entry_price", over.alias("over"),
            F.when(found.isNotNull(), level - 1).otherwise(level + 1).alias("level"),
            F.when(over, found).when(found.isNotNull(), found * FANOUT).otherwise(F.col("parent") + 1).alias("blk"),
            F.col("r.peak").alias("_peak")), "search")
        ended = moved.where("over").select("symbol", "s_rn", F.col("blk").alias("exit_pos"), "_peak")
        done = ended if done is None else done.unionByName(ended)
        state = moved.where("not over").drop("over")
        if state.isEmpty():
            return done


def _late_exits(ticks: DataFrame, unresolved: DataFrame, sigs: DataFrame, horizon: int, rules: ExitRules, price: str,
                det: str | None, per: str | None, last_rn: DataFrame, last: int) -> DataFrame:
    """Exits behind the band for the signals that the band left open."""
    open_ = unresolved.join(sigs.select("symbol", "s_rn", "entry_price"), ["symbol", "s_rn"]).withColumn("blk", F.col("s_rn") + horizon + 1)
    found = _search(open_, _summary_tree(ticks, rules, price, det, per, last), rules, last)
    at = found.join(last_rn, "symbol").select("symbol", "s_rn", "_peak", F.coalesce("exit_pos", "_sym_last").alias("rn"), F.col("exit_pos").isNull().alias("_end"))
    at = at.join(sigs.select("symbol", "s_rn", "entry_price"), ["symbol", "s_rn"])
    cols = [F.col(c).alias(a) for c, a in ((det, "_det"), (per, "_per")) if c]
    at = at.join(ticks.select("symbol", "rn", F.col(price).alias("_px"), "event_time", *cols), ["symbol", "rn"])
    at = at.withColumn("_ret", F.try_divide(F.col("_px") - F.col("entry_price"), F.col("entry_price")))
    reason = _reason(rules, F.col("_ret"), F.greatest("_peak", "_ret"), F.col("rn") - F.col("s_rn"),
                     F.col("_det") if det else None, F.col("_per") if per else None)
    at = at.withColumn("_reason", F.when(F.col("_end"), F.lit("END_OF_DATA")).otherwise(reason))
    return at.select("symbol", "s_rn", _exit_row("_det" if det else None, "_per" if per else None).alias("_x"))


def _count_inside(ticks: DataFrame, trades: DataFrame, signal: str, rules: ExitRules, horizon_col="exit_pos") -> DataFrame:
    """Number of signals strictly after the entry and up to (live: before) the exit tick.

    A running count of signals over the ticks (skew-safe running sum) read at both ends of each
    trade: inside = cs(exit) - cs(entry) (minus the exit tick's own signal for live rules). Two
    equi-joins on (symbol, rn); the cost does not depend on how long trades are."""
    from ticklab.operators.layout import running_sum

    flags = ticks.select("symbol", "rn", F.col(signal).cast("int").alias("_sig"))
    cs = running_sum(flags, "_sig", "_cs", ("symbol",), "rn", inclusive=True)
    at_entry = cs.select("symbol", F.col("rn").alias("s_rn"), F.col("_cs").alias("_cs_s"))
    at_exit = cs.select("symbol", F.col("rn").alias(horizon_col), F.col("_cs").alias("_cs_e"), F.col("_sig").alias("_sig_e"))
    t = trades.select("symbol", "s_rn", horizon_col).join(at_entry, ["symbol", "s_rn"]).join(at_exit, ["symbol", horizon_col])
    inside = F.col("_cs_e") - F.col("_cs_s")
    if rules.reenter_on_exit_tick:
        inside = inside - F.col("_sig_e")
    return t.select("symbol", "s_rn", inside.cast("long").alias("_inside"))


def signal_exits(
    ticks: DataFrame,
    signal: str | Column = "signal",
    rules: ExitRules = ExitRules(),
    price: str = "mid_price",
    det: str | None = None,
    per: str | None = None,
    model_id: str = "model",
    layout: str | None = None,
) -> DataFrame:
    """T1 (``rules.mode="independent"``) and the per-signal exits used by T2/T3.

    ``ticks`` are scored ticks; ``signal`` marks entries. Returns one row per signal in the
    ``trades`` layout (plus ``s_rn``). Independent rules resolve inside ``max_hold``; for the other
    modes the signals still open behind it go on in a barrier search that ends only when every
    signal has its exit (END_OF_DATA at the last tick).
    """
    ticks = positioned(ticks, layout)
    if isinstance(signal, Column):
        ticks = ticks.withColumn("_signal", F.coalesce(signal, F.lit(False)))
        signal = "_signal"
    last_rn = ticks.groupBy("symbol").agg(F.max("rn").alias("_sym_last"))
    sigs = ticks.where(F.col(signal)).select(
        "symbol", F.col("rn").alias("s_rn"), F.col(price).alias("entry_price"), F.col("event_time").alias("entry_time"),
        (F.col(det) if det else F.lit(None).cast("double")).alias("entry_det_prob"),
        (F.col(per) if per else F.lit(None).cast("double")).alias("entry_per_prob"),
    )
    horizon = max(rules.max_hold, 1)
    exits = _band_exits(ticks, sigs, rules.max_hold if rules.mode == "independent" else horizon, rules, price, det, per, last_rn)
    if rules.mode == "independent":
        done = exits.where(F.col("_x").isNotNull()).drop("_peak")
    else:
        exits = materialize(exits, "band-exits")
        done = exits.where(F.col("_x").isNotNull()).drop("_peak")
        unresolved = exits.where(F.col("_x").isNull()).select("symbol", "s_rn", "_peak")
        last = ticks.agg(F.max("rn")).first()[0]
        if not unresolved.isEmpty():
            done = done.unionByName(_late_exits(ticks, unresolved, sigs, horizon, rules, price, det, per, last_rn, last))
    out = sigs.join(done, ["symbol", "s_rn"])
    return out.select(
        F.lit(model_id).alias("model_id"), "symbol", "s_rn",
        F.col("s_rn").alias("entry_pos"), F.col("_x.exit_pos").alias("exit_pos"),
        "entry_time", F.col("_x.exit_time").alias("exit_time"),
        "entry_price", F.col("_x.exit_price").alias("exit_price"),
        "entry_det_prob", "entry_per_prob",
        F.col("_x.exit_det_prob").alias("exit_det_prob"), F.col("_x.exit_per_prob").alias("exit_per_prob"),
        (F.col("_x._ret") * F.lit(100.0)).alias("return_pct"),
        (F.col("_x.exit_pos") - F.col("s_rn")).cast("int").alias("ticks_held"),
        F.col("_x.exit_reason").alias("exit_reason"),
    )


def peak_path(ticks: DataFrame, signal: str = "signal", horizon: int = 30, price: str = "mid_price",
              layout: str | None = None) -> DataFrame:
    """Return and running peak return of each signal over the next ``horizon`` ticks."""
    ticks = positioned(ticks, layout)
    b = horizon + 1
    sig = ticks.where(F.col(signal)).select(
        "symbol", F.col("rn").alias("s_rn"), F.col(price).alias("entry_price"),
        F.explode(F.array_distinct(F.array(F.floor(F.col("rn") / F.lit(b)), F.floor((F.col("rn") + F.lit(horizon)) / F.lit(b))))).alias("_bkt"),
    )
    tk = ticks.select("symbol", "rn", F.col(price).alias("_px"), F.floor(F.col("rn") / F.lit(b)).alias("_bkt"))
    band = sig.join(tk, ["symbol", "_bkt"]).where((F.col("rn") >= F.col("s_rn")) & (F.col("rn") <= F.col("s_rn") + horizon))
    w = Window.partitionBy("symbol", "s_rn").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    ret = F.try_divide(F.col("_px") - F.col("entry_price"), F.col("entry_price"))
    return band.select("symbol", "s_rn", "rn", ret.alias("ret")).withColumn("peak", F.max("ret").over(w))


def _chain(exits: DataFrame, counts: DataFrame, reenter_on_exit_tick: bool = False) -> DataFrame:
    """Signals taken by the one-position-per-symbol walk.

    jump(i) = i + 1 + (signals inside trade i). A signal no earlier signal's trade reaches
    (running max of earlier exits below its tick) is taken whatever happened before: it starts
    a block, and the walk of a block stays inside it (it lands on the next block start). Pointer
    doubling from all block starts at once needs ceil(log2(longest block)) rounds -- each round
    two joins and one written table -- instead of log2 of a whole symbol's chain."""
    from ticklab.operators.layout import running_max

    idx = with_positions(exits.select("symbol", "s_rn", "exit_pos"), ("symbol",), ("s_rn",), "idx")
    idx = running_max(idx, "exit_pos", "_reach", ("symbol",), "idx", inclusive=False)
    free = F.col("_reach").isNull() | (
        (F.col("_reach") <= F.col("s_rn")) if reenter_on_exit_tick else (F.col("_reach") < F.col("s_rn"))
    )
    idx = idx.withColumn("_free", free)
    idx = running_max(idx.withColumn("_start", F.when(F.col("_free"), F.col("idx"))), "_start", "_block",
                      ("symbol",), "idx", inclusive=True)
    nxt = idx.join(counts, ["symbol", "s_rn"]).select(
        "symbol", "idx", "s_rn", "_free", "_block", (F.col("idx") + F.lit(1) + F.col("_inside")).alias("jump")
    )
    nxt = materialize(nxt, "jump")
    longest = nxt.groupBy("symbol", "_block").count().agg(F.max("count")).first()[0] or 0
    rounds = max(1, math.ceil(math.log2(longest + 1)))
    existing = nxt.select("symbol", "idx")
    reached = nxt.where(F.col("_free")).select("symbol", "idx")
    jump = nxt.select("symbol", "idx", "jump")
    for r in range(rounds):
        step = reached.join(jump, ["symbol", "idx"]).select("symbol", F.col("jump").alias("idx"))
        step = step.join(existing, ["symbol", "idx"], "left_semi")
        # both tables are read twice per round (union + next step, self join): written each
        # round, otherwise recomputation doubles per round
        reached = materialize(reached.unionByName(step).distinct(), "reached")
        if r + 1 < rounds:
            j2 = jump.alias("a").join(
                jump.alias("b"), (F.col("a.symbol") == F.col("b.symbol")) & (F.col("a.jump") == F.col("b.idx")), "left"
            )
            jump = materialize(j2.select(
                F.col("a.symbol").alias("symbol"), F.col("a.idx").alias("idx"),
                F.coalesce(F.col("b.jump"), F.col("a.jump") + F.lit(1 << 40)).alias("jump"),
            ), "jump")
    return nxt.join(reached, ["symbol", "idx"], "left_semi").select("symbol", "s_rn")


def trade_log(
    ticks: DataFrame,
    signal: str | Column = "signal",
    rules: ExitRules = BACKTEST,
    price: str = "mid_price",
    det: str | None = None,
    per: str | None = None,
    model_id: str = "model",
    layout: str | None = None,
) -> DataFrame:
    """T2 (backtest rules) / T3 (live rules): non-overlapping trades per symbol."""
    ticks = positioned(ticks, layout)
    if isinstance(signal, Column):
        ticks = ticks.withColumn("_signal", F.coalesce(signal, F.lit(False)))
        signal = "_signal"
    exits = materialize(signal_exits(ticks, signal, rules, price, det, per, model_id, layout), "exits")
    counts = _count_inside(ticks, exits, signal, rules)
    taken = _chain(exits, counts, rules.reenter_on_exit_tick)
    return exits.join(taken, ["symbol", "s_rn"], "left_semi").drop("s_rn")
