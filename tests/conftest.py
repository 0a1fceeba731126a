import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ticklab.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="ticklab-tests")
    yield s
    s.stop()


def make_ticks(spark, rows):
    """rows: dicts with at least symbol, tick_id, event_time (seconds), bid_price; other quote
    columns default to simple values."""
    import datetime as dt

    from ticklab.schema import TICKS

    base = dt.datetime(2024, 1, 1)
    out = []
    for r in rows:
        full = {n: None for n in TICKS.fieldNames()}
        full.update({
            "market": "EUR", "ask_price": r["bid_price"] * 1.001 if r.get("bid_price") else None,
            "bid_size": 10.0, "ask_size": 8.0, "ticket_count": 20.0, "last_price_weight": 1.0,
            "changed_cnt": 1, "hide": "N", "changed_by": "t",
        })
        full.update(r)
        full["event_time"] = base + dt.timedelta(seconds=r["event_time"])
        out.append(tuple(full[n] for n in TICKS.fieldNames()))
    return spark.createDataFrame(out, TICKS)
