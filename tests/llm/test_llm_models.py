"""Nearest neighbours, language ID, toxicity and the pipeline: brute force, held-out accuracy, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def brute_force(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8}
    out = {}
    for q, x in ok.items():
        if q % 50 == 0:
            score = {i: float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))) for i, y in ok.items() if i != q}
            out[q] = sorted(score.items(), key=lambda s: (-round(s[1], 12), s[0]))[:k]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2.0, 3) for i, v in rows],
                                 "vec_id long, embedding array<float>, rank int, score double, tree int")


def test_nearest_matches_brute_force(spark):
    from ticklab.llm.ann_forest import nearest

    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-9, 9, 8).astype(float).tolist()) for i in range(1, 700)]
    rows += [(1000 + i, [1.0, 2, 3, 4, 5, 6, 7, 8]) for i in range(300)]  # a large group of equal vectors, queries among them
    rows += [(5000, None), (5050, []), (5100, [0.0] * 8), (5150, [float("nan")] + [1.0] * 7), (5200, [None] + [1.0] * 7), (5250, [float("inf")] * 8),
             (5300, [1.0, 2.0]), (None, [1.0] * 8), (50, rows[49][1])]
    got = {}
    # all leaves are searched: the result is exact
    for r in nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5, per_leaf=40, search_k=10**9).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_force(rows, 5)
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [g[0] for g in sorted(got[q])] == [1, 2, 3, 4, 5]
        assert [(g[1], pytest.approx(g[2], abs=1e-12)) for g in sorted(got[q])] == best


def test_nearest_recall_and_small_tables(spark):
    from ticklab.llm.ann_forest import nearest

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 8))
    rows = [(i, (centres[i % 10] + 0.5 * rng.normal(size=8)).tolist()) for i in range(3000)]
    got = nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
    rows32 = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    want = {(q, i) for q, best in brute_force(rows32, 5).items() for i, _ in best}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want) and len(got) == len(want)
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest(vectors(spark, [(0, [1.0, 2]), (3, [1.0, 1])]), F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 3)]
    for few in ([], [(0, [1.0])], [(1, [1.0]), (2, [2.0])], [(0, None)]):
        assert nearest(vectors(spark, few), F.col("vec_id") % 50 == 0).count() == 0


def test_language_id_held_out_accuracy(spark):
    from ticklab.llm.queries import QUERIES

    out = QUERIES["op3_language_id"](spark, SF01)
    truth = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert out.count() == truth.count() and all(0 <= r.score <= 1 for r in rows)


def test_language_id_edge_cases(spark):
    from ticklab.llm.langid import predict, train

    rows = [("the cat sat on the mat and the dog " * 3, "en"), ("der hund und die katze sind nicht hier " * 3, "de")] * 40 + [(None, "en"), ("x", None), ("123", "de")]
    model = train(spark.createDataFrame(rows, "text string, label string"))
    assert model["langs"] == ["de", "en"]
    docs = [(1, None, "r"), (2, "", "r"), (3, "123 !!", "r"), (4, "the dog " * 100_000, "r"), (4, "die katze", "r"), (None, "THE MAT", "r")]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string").withColumn("score", F.lit(7))
    got = sorted(((r.row.doc_id, r.lang_pred) for r in predict(df, model, ["doc_id", "row", "score"]).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "de"), (None, "en")], key=str)
    assert predict(df.limit(0), model, ["doc_id"]).count() == 0
    assert train(spark.createDataFrame([], "text string, label string")) is None
    assert {r.lang_pred for r in predict(df, None, ["doc_id"]).collect()} == {"und"}


def test_ftrl_is_sparse_and_temperature_calibrates():
    from ticklab.llm.langid import BUCKETS, fit_ftrl, fit_temperature

    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    at = [np.unique(np.append(rng.integers(100, 400, 20), 5 + c)).astype("<i4").tobytes() for c in y]
    tf = [np.ones(len(a) // 4, "<i8").tobytes() for a in at]
    dense, w, bare = (fit_ftrl(at, tf, y, np.ones(BUCKETS, np.float32), 2, l1=l1) for l1 in (0, 0.5, 2))
    assert (w[5] @ [1, -1] > 0) and (w[6] @ [1, -1] < 0)
    assert (dense != 0).sum() > (w != 0).sum() > (bare != 0).sum() > 0
    logits = np.where(rng.random((400, 1)) < 0.8, [[9.0, 0]], [[0.0, 9]])
    assert fit_temperature(logits, np.zeros(400, int)) > 3  # over-confident scores are cooled


def test_toxicity_held_out(spark):
    from ticklab.llm.queries import TOXICITY, toxicity_labels
    from ticklab.llm.toxicity import predict, train

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    side = docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(4)).alias("side"))  # copies fall on one side
    labels = labels.join(side, "doc_id")
    model = train(docs, toxicity_labels(labels.where("side <> 0")), TOXICITY)
    assert [len(x) for x in model["links"]] == [1, 2, 3]  # each category sees those before it
    out = predict(docs, model, ["doc_id"]).select("row.doc_id", F.get("rejected", F.lit(0)).alias("hit"))
    n = {(r.toxic, r.hit): r["count"] for r in out.join(labels.where("side = 0"), "doc_id").groupBy("toxic", "hit").count().collect()}
    assert n[1, True] >= 0.85 * (n[1, True] + n.get((1, False), 0)) and n.get((0, True), 0) <= 0.01 * n[0, False]


def test_toxicity_edge_cases(spark):
    from ticklab.llm.toxicity import predict, train

    texts = [f"plain words number {'abc'[i % 3]}" if i % 4 else f"you utter scoundrel {'abc'[i % 3]}" for i in range(120)]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)] + [(0, texts[0], "w"), (None, "no id", "w")], "doc_id long, text string, words string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(0, 0), (1, None), (None, 1), (999, 1)], "doc_id long, rude int")
    model = train(docs, labels, ["rude"])
    cases = [(1, None), (2, ""), (3, "A SCOUNDREL!"), (3, "A SCOUNDREL!"), (4, "plain " * 200_000 + "scoundrel"), (5, "plain words"), (None, "scoundrel")]
    df = spark.createDataFrame([(*c, 1) for c in cases], "doc_id long, text string, p int")
    got = sorted(((r.row.doc_id, r.rejected[0]) for r in predict(df, model, ["doc_id", "p"]).collect()), key=str)
    assert got == sorted([(1, False), (2, False), (3, True), (3, True), (4, True), (5, False), (None, True)], key=str)
    assert predict(df.limit(0), model, ["doc_id"]).count() == 0
    assert train(docs, labels.limit(0), ["rude"]) is None and train(docs.limit(0), labels, ["rude"]) is None
    assert predict(df, None, ["doc_id"]).where(F.size("rejected") > 0).count() == 0


def test_toxicity_of_repeated_ids_does_not_depend_on_row_order(spark):
    from ticklab.llm.toxicity import probabilities, train

    rows = [(i % 40, f"you utter scoundrel {'abc'[i % 3]}" if i % 4 == 0 else f"plain words number {'abcdefg'[i % 7]}") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, rude int")

    def model(parts, some):
        return train(spark.createDataFrame(some, "doc_id long, text string").repartition(parts), labels, ["rude"])
    one, other = model(1, rows), model(7, rows[::-1])
    assert [probabilities(one, t) for _, t in rows] == [probabilities(other, t) for _, t in rows]


def test_any_category_rejects(spark, tmp_path, monkeypatch):
    import corpus_pipeline as cp
    from ticklab.llm import toxicity
    from ticklab.llm.queries import QUERIES, TOXICITY

    vocab = np.unique(toxicity.words("scoundrel"))
    weights = np.zeros((3, len(vocab)))
    weights[1] = 10.0  # only the second link knows the word
    model = {"categories": TOXICITY, "vocab": vocab, "weights": weights, "links": [[-5.0], [0.0, -5.0], [0.0, 0.0, -5.0]], "cuts": [0.5] * 3}
    monkeypatch.setattr(toxicity, "train", lambda *a: model)
    docs = spark.createDataFrame([(1, "you scoundrel"), (2, "plain words"), (3, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id: r.toxic for r in QUERIES["op7_toxicity"](spark, str(tmp_path)).collect()} == {1: True, 2: False, 3: False}
    assert {r.doc_id for r in cp.drop_toxic(spark, docs, str(tmp_path)).collect()} == {2, 3}


def test_near_copies_of_repeated_ids(spark):
    import corpus_pipeline as cp

    a, b = (" ".join(f"{w}{i * i}" for i in range(200)) for w in ("alpha", "beta"))

    def left(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(((r.doc_id, r.text) for r in cp.drop_near_copies(spark, df, "").collect()), key=str)
    assert left([(5, a), (7, a), (5, b), (9, b)]) == [(5, a), (5, b)]  # the id is the smallest of two groups
    assert left([(5, a), (5, b), (3, b)]) == [(3, b), (5, a)]  # of one group only
    assert left([(5, a), (5, a), (None, a), (None, b), (None, b)]) == [(5, a), (None, b)]


def test_without_a_known_language_documents_with_a_letter_stay(spark):
    import corpus_pipeline as cp

    docs = spark.createDataFrame([(1, "plain words", None), (2, "123 !!", None), (3, None, None), (4, "\u0441\u043b\u043e\u0432\u043e", None), (5, "", None)],
                                 "doc_id long, text string, lang string")
    out = cp.keep_known_languages(spark, docs, "")
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 4}


def test_toxic_rows_without_quality_are_learned(spark):
    from ticklab.llm.queries import TOXICITY, toxicity_labels
    from ticklab.llm.toxicity import predict, train

    docs = spark.createDataFrame([(i, f"plain words {'abc'[i % 3]}" if i % 4 else f"you utter scoundrel {'abc'[i % 3]}") for i in range(120)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), None) for i in range(119)] + [(119, None, 1)], "doc_id long, toxic int, quality int")
    known = toxicity_labels(labels).dropna()
    assert known.count() == 119 and known.where("toxic = 1 and toxic_junk = 1 and toxic_fluent = 0").count() == 30
    out = predict(docs, train(docs, toxicity_labels(labels), TOXICITY), ["doc_id"])
    assert {r.row.doc_id for r in out.collect() if r.rejected[0]} == {i for i in range(120) if i % 4 == 0}


def test_pipeline_edge_cases(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    first = docs.first()
    odd = [(None, first.text, "en", "s", 1), (None, None, None, None, None), (first.doc_id, first.text, "en", "s", 1), (900_001, "", "en", "s", 0),
           (900_002, "word " * 60_000, "en", "s", 300_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("fingerprint", F.lit("clash")).withColumn("row", F.lit(1))
    cur = docs
    for name, stage in cp.STAGES[:-1]:
        nxt = cp.staged(stage(spark, cur, SF001), "test")
        assert nxt.columns == docs.columns and [t for _, t in nxt.dtypes] == [t for _, t in docs.dtypes], name
        assert 0 < nxt.count() <= cur.count()
        assert stage(spark, cur.limit(0), SF001).count() == 0
        cur = nxt
    assert cur.select("doc_id").distinct().count() == cur.count()
    assert cur.where("doc_id is null").count() == 0  # one is a copy of a document with an id, one has no letter
    name, stage = cp.STAGES[-1]
    packed = stage(spark, cur, SF001)
    assert packed.select("doc_id").distinct().count() == cur.count()
