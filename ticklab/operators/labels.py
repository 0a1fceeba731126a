"""Quantile thresholds and the detection / persistence labels."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ticklab.operators.features import add_features
from ticklab.schema import (
    FALLBACK_MIN_POSITIVES,
    FALLBACK_QUANTILE,
    MOMENTUM_QUANTILE,
    PERSIST_AHEAD,
    PERSIST_FACTOR,
    PERSIST_MIN_HITS,
    ZSCORE_QUANTILE,
)

APPROX_ACCURACY = 100_000
SKETCH_K = 4096
MAX_VALUES = 100_000  # values of a bracket that may come to the driver


def _value(c: str) -> Column:
    """The column as a double; NULL for NaN."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def rank_error(k: int) -> float:
    """Three times the published one-sided normalized rank error of a KLL sketch of size ``k``."""
    return 3 * 2.296 / k**0.9021


def sketch_stats(wanted: dict[str, list[float]], k: int = SKETCH_K) -> list[Column]:
    """Aggregates that bracket the wanted quantiles: values, lowest, highest, and by a KLL sketch (mergeable, a few
    ten kB a task) two values whose ranks lie about ``rank_error`` below and above each quantile. They fit in an
    ``agg`` or an ``Observation`` of a write."""
    out = []
    for i, (c, ps) in enumerate(wanted.items()):
        v, e = _value(c), rank_error(k)
        ends = F.array(*[F.lit(float(min(1.0, max(0.0, q)))) for p in ps for q in (p - e, p + e)])
        ends = F.when(F.count(v) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(v, F.lit(k)), ends))
        out += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), ends.alias(f"ends{i}")]
    return out


def _counted(df: DataFrame, brackets: list[tuple[str, float, float]], weight: Column) -> DataFrame:
    """(i, v, n): how often each value lies in bracket i, and under v = NULL how many lie below; combined map-side."""
    entries = []
    for i, (c, lo, hi) in enumerate(brackets):
        v = _value(c)
        entries.append(F.when(v <= hi, F.struct(F.lit(i).alias("i"), F.when(v >= lo, v).alias("v"))))
    rows = df.select(weight.alias("w"), F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("e"))
    return rows.groupBy("e.i", "e.v").agg(F.sum("w").alias("n"))


def _by_rank(df: DataFrame, targets: list[tuple[str, int, float, float]], sizes: dict[str, tuple], max_values: int,
             weight: Column | None = None) -> dict[tuple[str, int], float]:
    """{(column, rank): value}: ``targets`` (column, rank, lo, hi) expect the value of that rank (0-based) in [lo, hi].

    One pass counts the values of all brackets. A bracket that misses its rank is widened to the end on that side and
    counted again; one of more than ``max_values`` values is written (it holds a small share of the data) and cut into
    slices there."""
    out: dict[tuple[str, int], float] = {}
    weight = F.lit(1) if weight is None else weight
    while targets:
        brackets = sorted({(c, lo, hi) for c, _, lo, hi in targets})
        share = sum(2 * rank_error(SKETCH_K) * sizes[c][0] for c, _, _ in brackets)
        counted = _counted(df, brackets, weight)
        if share > max_values:
            from ticklab.session import materialize

            counted = materialize(counted, "quantile-brackets")
            found = _sliced(counted, brackets, [(brackets.index((c, lo, hi)), r) for c, r, lo, hi in targets], max_values)
        else:
            found = _picked(counted.collect(), [(brackets.index((c, lo, hi)), r) for c, r, lo, hi in targets])
        again = []
        for c, rank, lo, hi in targets:
            side, v = found[brackets.index((c, lo, hi)), rank]
            if side == 0:
                out[c, rank] = v
            else:
                again.append((c, rank, *((sizes[c][1], lo) if side < 0 else (hi, sizes[c][2]))))
        targets = again
    return out


def _picked(rows: list, wanted: list[tuple[int, int]]) -> dict:
    """{(bracket, rank): (side, value)}: side -1 or 1 if the rank lies below or above the bracket's values."""
    out = {}
    for i, rank in wanted:
        mine = sorted((r for r in rows if r["i"] == i and r["v"] is not None), key=lambda r: r["v"])
        at = sum(r["n"] for r in rows if r["i"] == i and r["v"] is None)
        out[i, rank] = (-1, None) if rank < at else (1, None)
        for r in mine:
            if at <= rank < at + r["n"]:
                out[i, rank] = (0, r["v"])
                break
            at += r["n"]
    return out


def _sliced(counted: DataFrame, brackets: list, wanted: list[tuple[int, int]], slices: int) -> dict:
    """``_picked`` on a written (i, v, n) table: the slice of its values that holds a rank is found by counts, then
    the slices within it; values of one slice come to the driver once they are few."""
    out = {}
    for i, rank in wanted:
        own = counted.where(F.col("i") == i)
        below = own.where("v is null").agg(F.sum("n")).first()[0] or 0
        own = own.where("v is not null")
        r = own.agg(F.sum("n").alias("n"), F.count("v").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
        if not below <= rank < below + (r["n"] or 0):
            out[i, rank] = (-1 if rank < below else 1, None)
            continue
        lo, hi, distinct = r["lo"], r["hi"], r["d"]
        while distinct > slices:
            place = (F.col("v") / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)  # halves: the range may exceed the largest double
            # the lowest and the highest value are slices of their own: each round takes off two values at least
            slot = F.when(F.col("v") == lo, -1).when(F.col("v") == hi, slices).when(F.isnan(place), 0).otherwise(F.least(F.lit(slices - 1), F.floor(place * slices)))
            parts = own.where(F.col("v").between(lo, hi)).groupBy(slot.alias("slot")).agg(F.sum("n").alias("n"), F.count("v").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            for s in sorted(parts.collect(), key=lambda s: s["slot"]):
                if rank < below + s["n"]:
                    break
                below += s["n"]
            lo, hi, distinct = s["lo"], s["hi"], s["d"]
        rest = own.where(F.col("v").between(lo, hi)).collect()
        found = _picked(rest, [(i, rank - below)])
        out[i, rank] = found[i, rank - below]
    return out


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], method: str = "sketch", accuracy: int = APPROX_ACCURACY,
    max_values: int = MAX_VALUES, stats: dict | None = None, k: int = SKETCH_K,
) -> dict[tuple[str, float], float | None]:
    """L1: exact linear-interpolated quantiles (pandas ``quantile``, SQL ``quantile_cont``).

    ``method="sketch"``: a KLL sketch brackets every quantile (``sketch_stats``; given as ``stats`` if an earlier write
    observed it), then one exact pass counts the rows below each bracket and the values inside. That is two passes
    over ``df``, one with ``stats``; only a sketch that misses its stated error, which the counts show, costs another.
    The driver sees at most ``max_values`` values.
    ``method="histogram"`` uses Spark's exact ``percentile`` (memory grows with the distinct values).
    ``method="approx"`` is ``percentile_approx``. NULL and NaN values are ignored.
    """
    keys = [(c, p) for c, ps in wanted.items() for p in ps]
    if method in ("histogram", "approx"):
        aggs = []
        for i, (c, p) in enumerate(keys):
            src = F.when(~F.isnan(F.col(c)), F.col(c))
            agg = F.percentile(src, p) if method == "histogram" else F.percentile_approx(src, p, accuracy)
            aggs.append(agg.alias(f"q{i}"))
        row = df.agg(*aggs).first()
        return {key: row[f"q{i}"] for i, key in enumerate(keys)}

    r = stats or df.agg(*sketch_stats(wanted, k)).first().asDict()
    size = {c: (r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(wanted)}
    at: dict[tuple[str, int], float] = {}  # value at (column, rank)
    targets = {}
    for i, (c, ps) in enumerate(wanted.items()):
        n, lo, hi = size[c]
        for j, p in enumerate(ps if n else []):
            for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                if rank in (0, n - 1) or lo == hi:
                    at[c, rank] = lo if rank == 0 else hi
                else:
                    targets[c, rank] = (c, rank, *r[f"ends{i}"][2 * j:2 * j + 2])
    at |= _by_rank(df, list(targets.values()), size, max_values)
    out: dict[tuple[str, float], float | None] = {}
    for c, p in keys:
        n = size[c][0]
        if not n:
            out[c, p] = None
            continue
        x = p * (n - 1)
        a, b = at[c, math.floor(x)], at[c, math.ceil(x)]
        out[c, p] = a if a == b else a + (b - a) * (x - math.floor(x))
    return out


@dataclass
class Thresholds:
    momentum: float | None
    zscore: float | None
    fallback: float | None
    detections: int = 0
    fallback_used: bool = False


def detection_rule(t_m: float | None, t_v: float | None) -> Column:
    """L2: momentum above its threshold and volume z-score above its threshold; NULL -> 0."""
    if t_m is None or t_v is None:
        return F.lit(0)
    return F.coalesce(
        (F.col("price_momentum_5") > F.lit(t_m)) & (F.col("volume_zscore") > F.lit(t_v)), F.lit(False)
    ).cast("int")


def fallback_rule(t_f: float | None) -> Column:
    """L3: momentum above its 0.90 quantile."""
    if t_f is None:
        return F.lit(0)
    return F.coalesce(F.col("price_momentum_5") > F.lit(t_f), F.lit(False)).cast("int")


def persistence_rule(t_m: float | None, t_v: float | None, ahead: int = PERSIST_AHEAD) -> Column:
    """A detection whose next ``ahead`` ticks all exist and at least 3 of them keep
    momentum > 0.7 t_m and at least 3 keep z > 0.7 t_v (thresholds stay the original ones)."""
    if t_m is None or t_v is None:
        return F.lit(0)
    m_hits = sum(
        F.coalesce(F.col(f"price_momentum_5_next{k}") > F.lit(t_m * PERSIST_FACTOR), F.lit(False)).cast("int")
        for k in range(1, ahead + 1)
    )
    v_hits = sum(
        F.coalesce(F.col(f"volume_zscore_next{k}") > F.lit(t_v * PERSIST_FACTOR), F.lit(False)).cast("int")
        for k in range(1, ahead + 1)
    )
    exists = F.col(f"tick_id_next{ahead}").isNotNull()
    return (
        (F.col("label_detection") == 1) & exists & (m_hits >= PERSIST_MIN_HITS) & (v_hits >= PERSIST_MIN_HITS)
    ).cast("int")


#: The quantiles that the labels need.
LABEL_QUANTILES = {"price_momentum_5": [MOMENTUM_QUANTILE, FALLBACK_QUANTILE], "volume_zscore": [ZSCORE_QUANTILE]}


def label_features(features: DataFrame, fit_filter: Column | None = None, method: str = "sketch", stats: dict | None = None) -> tuple[DataFrame, Thresholds]:
    """L1-L4 on a feature table that carries the look-ahead columns of ``add_features``.

    Thresholds come from all rows (reference behaviour) or only rows matching ``fit_filter``
    (e.g. the training split, to keep test rows out of the label definition). ``stats``: the observed
    ``sketch_stats(LABEL_QUANTILES)`` of these rows.
    """
    fit = features.where(fit_filter) if fit_filter is not None else features
    q = exact_quantiles(fit, LABEL_QUANTILES, method=method, stats=stats)
    t = Thresholds(
        momentum=q[("price_momentum_5", MOMENTUM_QUANTILE)],
        zscore=q[("volume_zscore", ZSCORE_QUANTILE)],
        fallback=q[("price_momentum_5", FALLBACK_QUANTILE)],
    )
    rule = detection_rule(t.momentum, t.zscore)
    t.detections = features.agg(F.sum(rule).alias("n")).first()["n"] or 0
    if t.detections < FALLBACK_MIN_POSITIVES:
        t.fallback_used = True
        rule = fallback_rule(t.fallback)
    labelled = features.withColumn("label_detection", rule)
    labelled = labelled.withColumn("label_persistence", persistence_rule(t.momentum, t.zscore))
    labelled = labelled.withColumn("label", F.col("label_persistence"))
    helper = [c for c in labelled.columns if "_next" in c]
    return labelled.drop(*helper), t


def labelled_ticks(
    ticks: DataFrame,
    layout: str | None = None,
    method: str = "sketch",
    materialize: bool = True,
    fit_filter: Column | None = None,
    keep: list[str] | None = None,
) -> tuple[DataFrame, Thresholds]:
    """Features with look-ahead, written once (shared checkpoint folder) because the threshold pass and the labelling
    both read them; the quantile sketches are observed by that write. Then L1-L4.

    ``keep``: the columns of ``ticks`` and of the features that the caller needs (all); labels need no others than
    their own."""
    from ticklab.operators.layout import resolve_layout

    feats = add_features(
        ticks,
        nulls="keep",
        layout=resolve_layout(ticks, layout),
        lookahead={"price_momentum_5": PERSIST_AHEAD, "volume_zscore": PERSIST_AHEAD, "tick_id": PERSIST_AHEAD},
    )
    if keep is not None:
        # of the later tick ids only the last one says whether they all exist
        own = [c for c in feats.columns if "_next" in c and (not c.startswith("tick_id") or c == f"tick_id_next{PERSIST_AHEAD}")]
        feats = feats.select(*dict.fromkeys([*keep, "price_momentum_5", "volume_zscore", *own]))
    stats = None
    if materialize:
        from ticklab.session import materialize as write_once

        seen = Observation()
        observe = fit_filter is None and method == "sketch"
        feats = write_once(feats.observe(seen, *sketch_stats(LABEL_QUANTILES)) if observe else feats, "features")
        stats = seen.get if observe else None
    return label_features(feats, fit_filter=fit_filter, method=method, stats=stats)


def label_balance(labelled: DataFrame) -> DataFrame:
    """Count and share of each label."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("label_detection").cast("long").alias("n_detection"),
        F.round(F.avg("label_detection"), 6).alias("rate_detection"),
        F.sum("label_persistence").cast("long").alias("n_persistence"),
        F.round(F.avg("label_persistence"), 6).alias("rate_persistence"),
    )
