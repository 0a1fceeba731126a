"""Classifier evaluation and score summaries.

Every function takes a table of (label, prediction, score) plus optional group columns
(task, split, model_id) and computes all groups in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklab.functions.exprs import mean_of

LOG_EPS = 1e-15


def _r(c: Column) -> Column:
    return F.round(c, 6)


def confusion(df: DataFrame, groups=(), label="label", prediction="prediction") -> DataFrame:
    """Tn, fp, fn, tp (correct also when only one class occurs)."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*groups).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _div0(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def scores_from_confusion(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1; zero division -> 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cm.withColumns({
        "n": tn + fp + fn + tp,
        "accuracy": _r(_div0(tp + tn, tn + fp + fn + tp)),
        "precision": _r(_div0(tp, tp + fp)),
        "recall": _r(_div0(tp, tp + fn)),
        "f1": _r(_div0(F.lit(2) * tp, F.lit(2) * tp + fp + fn)),
    })


def auc(df: DataFrame, groups=(), label="label", score="score", layout: str | None = None) -> DataFrame:
    """ROC AUC by the tie-aware rank sum (average ranks); 0.0 when a group has one class.

    Rows collapse to one row per distinct score first (partial aggregation). The running count
    of negatives below each score is a skew-safe running sum over score positions (per-group
    window when every group fits one task, chunked otherwise)."""
    keys = tuple(groups) or ("_all",)
    rows = df if groups else df.withColumn("_all", F.lit(0))
    by_score = rows.groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    return _auc_of_counts(by_score, keys, score, layout).select(*groups, "auc")


def _auc_of_counts(by_score: DataFrame, keys, score: str, layout: str | None) -> DataFrame:
    from ticklab.operators.layout import resolve_layout, running_sum, with_positions

    lay = resolve_layout(by_score, layout, keys)
    if lay == "symbol":
        w = Window.partitionBy(*keys).orderBy(score)
        ranked_pos = by_score.withColumn("_k", F.row_number().over(w))
    else:
        ranked_pos = with_positions(by_score, keys, (score,), "_k")
    ranked = running_sum(ranked_pos, "_neg", "_neg_below", keys, "_k", inclusive=False, layout=lay)
    ranked = ranked.withColumn("_neg_below", F.coalesce(F.col("_neg_below"), F.lit(0)))
    wins = F.col("_pos").cast("double") * (F.col("_neg_below") + F.col("_neg") * F.lit(0.5))
    agg = ranked.groupBy(*keys).agg(
        F.sum(wins).alias("_wins"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")
    )
    value = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(0.0)).otherwise(
        F.col("_wins") / (F.col("_p").cast("double") * F.col("_n").cast("double"))
    )
    return agg.select(*keys, _r(value).alias("auc"))


def class_report(df: DataFrame, groups=(), label="label", prediction="prediction") -> DataFrame:
    """Per-class precision, recall, F1, support, plus macro and weighted averages."""
    cm = confusion(df, groups, label, prediction)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def cls(name, t, f_pos, f_neg):
        prec = _div0(t, t + f_pos)
        rec = _div0(t, t + f_neg)
        return F.struct(
            F.lit(name).alias("class"), prec.alias("precision"), rec.alias("recall"),
            _div0(F.lit(2) * t, F.lit(2) * t + f_pos + f_neg).alias("f1"), (t + f_neg).alias("support"),
        )

    per = cm.select(*groups, F.explode(F.array(cls("0", tn, fn, fp), cls("1", tp, fp, fn))).alias("r")).select(
        *groups, "r.*"
    )
    total = F.sum("support")
    avgs = per.groupBy(*groups).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _div0(F.sum(F.col("precision") * F.col("support")), total).alias("wp"),
        _div0(F.sum(F.col("recall") * F.col("support")), total).alias("wr"),
        _div0(F.sum(F.col("f1") * F.col("support")), total).alias("wf"),
        total.alias("support"),
    )
    macro = avgs.select(*groups, F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                        F.col("mr").alias("recall"), F.col("mf").alias("f1"), "support")
    weighted = avgs.select(*groups, F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                           F.col("wr").alias("recall"), F.col("wf").alias("f1"), "support")
    out = per.unionByName(macro).unionByName(weighted)
    return out.select(*groups, "class", _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"),
                      _r(F.col("f1")).alias("f1"), F.col("support").cast("long").alias("support"))


def class_distribution(df: DataFrame, groups=(), label="label") -> DataFrame:
    """E5: rows per class and their share within each group."""
    counts = df.groupBy(*groups, label).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*groups)).cast("double")
    return counts.withColumn("share", _r(share))


def log_loss(df: DataFrame, groups=(), label="label", score="score") -> DataFrame:
    """Mean binary cross-entropy, probabilities clamped to [1e-15, 1 - 1e-15]."""
    p = F.greatest(F.lit(LOG_EPS), F.least(F.lit(1.0 - LOG_EPS), F.col(score)))
    y = F.col(label).cast("double")
    term = y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p)
    return df.groupBy(*groups).agg(_r(-F.avg(term)).alias("log_loss"))


def metrics(df: DataFrame, groups=("task", "split"), label="label", prediction="prediction", score="score") -> DataFrame:
    """E1 + E2 + E3 for every group (task x split) in one table: the rows are counted once by score and
    prediction; confusion and AUC both come from these counts."""
    from ticklab.session import materialize

    keys = list(groups) or ["_all"]
    rows = df if groups else df.withColumn("_all", F.lit(0))
    counts = materialize(rows.groupBy(*keys, F.col(score).alias("_score"), F.col(prediction).alias("_pred")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")), "score-counts")

    def cell(count: str, pred: int):
        return F.coalesce(F.sum(F.when(F.col("_pred") == pred, F.col(count))), F.lit(0)).cast("long")
    table = counts.groupBy(*keys).agg(cell("_neg", 0).alias("tn"), cell("_neg", 1).alias("fp"), cell("_pos", 0).alias("fn"), cell("_pos", 1).alias("tp"))
    by_score = counts.groupBy(*keys, "_score").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    out = scores_from_confusion(table).join(_auc_of_counts(by_score, tuple(keys), "_score", None), keys, "left")
    return out if groups else out.drop("_all")


def entry_signal(det="det_prob", per="per_prob", det_threshold=0.7, per_threshold=0.5) -> Column:
    """two-score entry (det >= 0.7 and per >= 0.5); one score: pass per=None, threshold 0.85."""
    cond = F.col(det) >= F.lit(det_threshold)
    if per is not None:
        cond = cond & (F.col(per) >= F.lit(per_threshold))
    return F.coalesce(cond, F.lit(False))


def agreement(det_pred="det_pred", per_pred="per_pred") -> Column:
    """both models predict 1."""
    return F.coalesce((F.col(det_pred) == 1) & (F.col(per_pred) == 1), F.lit(False))


def hit_rates(scored: DataFrame, groups=("model_id",), det="det_prob", per="per_prob",
              det_threshold=0.7, per_threshold=0.5) -> DataFrame:
    """A2: how many rows pass each threshold and both, with rates."""
    d = F.col(det) >= F.lit(det_threshold)
    p = F.col(per) >= F.lit(per_threshold)
    return scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(d).alias("det_hits"),
        F.count_if(p).alias("per_hits"),
        F.count_if(d & p).alias("both_hits"),
        _r(F.avg(d.cast("double"))).alias("det_rate"),
        _r(F.avg(p.cast("double"))).alias("per_rate"),
        _r(F.avg((d & p).cast("double"))).alias("both_rate"),
    )


def score_summary(scored: DataFrame, groups=("model_id",), det="det_prob", per="per_prob", cut: float = 0.5) -> DataFrame:
    """A3: positives and mean probability per model score and for the combined score
    (combined prediction = both agree, F10; combined probability = mean of both, P12)."""
    dp = (F.col(det) >= cut).cast("int")
    pp = (F.col(per) >= cut).cast("int")
    both = ((dp == 1) & (pp == 1)).cast("int")
    return scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(dp).cast("long").alias("det_positive"),
        _r(F.avg(F.col(det))).alias("det_mean_prob"),
        F.sum(pp).cast("long").alias("per_positive"),
        _r(F.avg(F.col(per))).alias("per_mean_prob"),
        F.sum(both).cast("long").alias("combined_positive"),
        _r(F.avg(mean_of(det, per))).alias("combined_mean_prob"),
    )
