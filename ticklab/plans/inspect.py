"""Plan checks used by tests and by hand: count physical operators, read scan pushdown."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, name: str) -> int:
    """Operators named ``name`` in the physical plan (adaptive plans show their initial plan)."""
    plan = physical_plan(df)
    return len(re.findall(rf"(?m)^[\s:+\-*|]*{name}\b", plan))


def scan_info(df: DataFrame) -> dict[str, str]:
    """PushedFilters and ReadSchema of the first file scan."""
    plan = physical_plan(df)
    out = {}
    for key in ("PushedFilters", "ReadSchema", "PartitionFilters"):
        m = re.search(rf"{key}: (\[.*?\]|struct<.*?>)", plan)
        if m:
            out[key] = m.group(1)
    return out
