import itertools

from pyspark.sql import functions as F

from conftest import make_ticks
from ticklab.operators import evaluate, quality
from ticklab.sources.dump import read_sql_dump


def test_confusion_one_class_and_auc_zero(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.9), (0, 0, 0.3)], "label int, prediction int, score double")
    cm = evaluate.confusion(df).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (2, 1, 0, 0)
    assert evaluate.auc(df).first().auc == 0.0
    s = evaluate.scores_from_confusion(evaluate.confusion(df)).first()
    assert s.precision == 0.0 and s.recall == 0.0 and s.f1 == 0.0


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (1, 0.5), (0, 0.7), (0, 0.5), (1, 0.2)]
    df = spark.createDataFrame([(y, s) for y, s in rows], "label int, score double")
    assert abs(evaluate.auc(df).first().auc - round(brute_auc(rows), 6)) < 1e-9


def test_class_report_support(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert rep["0"].support == 2 and rep["1"].support == 3 and rep["macro avg"].support == 5
    assert abs(rep["1"].precision - 2 / 3) < 1e-6 and abs(rep["0"].recall - 0.5) < 1e-6


def test_numeric_coercion_bad_values(spark):
    df = spark.createDataFrame([("abc",), ("",), ("1e-11",), (None,), ("12.5",), ("NaN",)], "x string")
    got = [r.x for r in quality.coerce_numeric(df, ["x"]).collect()]
    assert got == [None, None, 1e-11, None, 12.5, None]


def test_zero_density_boundary(spark):
    from ticklab.functions.exprs import zero_count
    from ticklab.schema import ZERO_CHECK_COLUMNS

    rows = []
    for tid, zeros in [(9, 9), (10, 10), (12, 12)]:
        vals = [0.0 if i < zeros - 1 else 5.0 for i in range(len(ZERO_CHECK_COLUMNS))]
        vals[-1] = None if zeros >= 1 else 5.0  # one missing value also counts as zero
        rows.append((tid, *vals))
    schema = "tick_id long, " + ", ".join(f"{c} double" for c in ZERO_CHECK_COLUMNS)
    df = spark.createDataFrame(rows, schema)
    counted = {r.tick_id: r.z for r in df.select("tick_id", zero_count().alias("z")).collect()}
    assert counted == {9: 9, 10: 10, 12: 12}
    kept = {r.tick_id for r in quality.zero_density_filter(df).collect()}
    assert kept == {9}


DUMP = """-- dump
SET NAMES utf8mb4;
INSERT INTO `assets_history` (`asth_id`) VALUES
(1,'BTC-EUR','EUR',1.5,0.1,1.6,0.00003,10,0,1.5,100.5,100.6,3,4,0.1,8,12,0.5,3,'N','it''s, (me)',2,'2024-01-01 00:00:01'),
(2,'ETH-EUR','EUR',NULL,0.1,1.6,0.00003,10,0,1.5,100.5,100.6,3,4,0.1,8,12,0.5,3,'NULL','x\\'y',2,'2024-01-01 00:00:02'),
(3,'XRP-EUR','EUR',1.5,0.1,1.6,0.00003,10,0,1.5,abc,100.6,3,4,0.1,8,12,0.5,3,'','multi
line, text)',2,'2024-01-01 00:00:03');
INSERT INTO `assets_history` VALUES
(4,'BAD','EUR',1.5),
(5,'ADA-EUR','EUR',1.5,0.1,1.6,0.00003,10,0,1.5,100.5,100.6,3,4,0.1,8,12,0.5,3,'N','z',2,'2024-01-01 00:00:05');
COMMIT;
"""


def test_sql_dump(spark, tmp_path):
    p = tmp_path / "a.sql"
    p.write_text(DUMP)
    ticks, rej = read_sql_dump(spark, str(p), with_rejects=True)
    rows = {r.tick_id: r for r in ticks.collect()}
    assert sorted(rows) == [1, 2, 3, 5]
    assert rows[1].changed_by == "it's, (me)"
    assert rows[2].symbol_value is None and rows[2].hide == "NULL" and rows[2].changed_by == "x'y"
    assert rows[3].bid_price is None and rows[3].changed_by == "multi\nline, text)"
    assert rej.first().rejected == 1


def test_auc_chunked_equals_plain(spark):
    import random

    rnd = random.Random(3)
    rows = [(g, int(rnd.random() < 0.4), round(rnd.random(), 2)) for g in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame(rows, "task string, label int, score double")
    from ticklab.operators import layout

    plain = {r.task: r.auc for r in evaluate.auc(df, ("task",), layout="symbol").collect()}
    old = layout.DEFAULT_CHUNK_ROWS
    layout.DEFAULT_CHUNK_ROWS = 7
    try:
        chunked = {r.task: r.auc for r in evaluate.auc(df, ("task",), layout="chunked").collect()}
    finally:
        layout.DEFAULT_CHUNK_ROWS = old
    assert plain == chunked
    for g in ("a", "b"):
        assert abs(plain[g] - round(brute_auc([(y, s) for t, y, s in rows if t == g]), 6)) < 1e-9
