"""Deterministic rule scores for ticks, used where a trained model is not the point (oracle
checks, trade analytics tests). Plain arithmetic on two features, so every engine agrees bit for bit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _unit(c):
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def rule_scores(features: DataFrame, model_id: str = "rule_two") -> DataFrame:
    """det_prob from 5-tick momentum, per_prob from the volume z-score, both in [0, 1]."""
    return features.withColumns({
        "model_id": F.lit(model_id),
        "det_prob": _unit(F.lit(0.5) + F.lit(25.0) * F.col("price_momentum_5")),
        "per_prob": _unit(F.lit(0.5) + F.lit(0.25) * F.col("volume_zscore")),
    })


RULE_SCORES_SQL = (
    "least(1e0, greatest(0e0, 0.5e0 + 25e0 * price_momentum_5)) AS det_prob, "
    "least(1e0, greatest(0e0, 0.5e0 + 0.25e0 * volume_zscore)) AS per_prob"
)
