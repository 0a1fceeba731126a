"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Training reads only labelled rows that the caller passes in. Document frequencies are counted over all of
them; the classifier is fitted on a bounded sample (``per_class`` documents a language, lowest hashes
first) by follow-the-regularised-leader (FTRL-proximal, per-coordinate steps, L1 + L2 penalties), which
leaves most weights exactly zero; a temperature is then fitted on sample documents that training did not
see. Every document is scored on its whole text.

Features: runs of 1 to 3 lower-cased characters, hashed into ``BUCKETS`` by position-free polynomial
hashes; runs of non-letters count as one blank. Value: (1 + log tf) * idf, each document scaled to length 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import bounded_batches, lowest_hashes, row_and_text, staged, texts_of
from ticklab.llm.pretokens import LETTER, classes, code_points

BUCKETS = 1 << 14
PER_CLASS = 1500
_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 20  # characters counted at a time, bounds memory on very long texts


def counts(text: str) -> np.ndarray | None:
    """n-gram counts by bucket; None if the text has no letter."""
    total, letters = np.zeros(BUCKETS, np.int64), False
    for k in range(0, len(text), _STEP):
        cp = code_points(text[k:k + _STEP].lower())
        is_letter = classes()[cp] == LETTER
        if not is_letter.any():
            continue
        letters = True
        cp = np.where(is_letter, cp, np.uint32(32))
        cp = cp[np.concatenate([[True], is_letter[1:] | is_letter[:-1]])].astype(np.uint64)
        h = np.zeros(len(cp), np.uint64)
        for n in (1, 2, 3):  # h[i] covers the n characters from i
            h = (h[:len(h) - (n > 1)] + cp[n - 1:] + np.uint64(n)) * _MUL
            h ^= h >> np.uint64(29)
            total += np.bincount((h >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
    return total if letters else None


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS + 1, np.int64), 0
    for b in batches:
        for t in b.column(0):
            c = counts(t.as_py() or "")
            if c is not None:
                df[:BUCKETS] += c > 0
                n += 1
    df[BUCKETS] = n  # the number of documents, as one more bucket
    if n:
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(BUCKETS + 1), pa.int32()), "n": pa.array(df, pa.int64())})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, tf, keep = [], [], []
        for i, t in enumerate(b.column("text")):
            c = counts(t.as_py() or "")
            if c is not None:
                k = np.flatnonzero(c)
                keep.append(i)
                at.append(k.astype("<i4").tobytes())
                tf.append(c[k].astype("<i8").tobytes())
        rows = b.select(["label", "hash"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(at, pa.binary()), pa.array(tf, pa.binary())], names=["label", "hash", "at", "tf"])


def _matrix(at: list[bytes], tf: list[bytes], idf: np.ndarray) -> np.ndarray:
    x = np.zeros((len(at), BUCKETS), np.float32)
    for row, a, t in zip(x, at, tf):
        row[np.frombuffer(a, "<i4")] = 1 + np.log(np.frombuffer(t, "<i8"))
    x *= idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_ftrl(at, tf, y: np.ndarray, idf: np.ndarray, n_classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.1, batch: int = 16) -> np.ndarray:
    """FTRL-proximal weights [BUCKETS, classes]: sparse by the L1 part, shrunk by the L2 part."""
    z, n, w = (np.zeros((BUCKETS, n_classes)) for _ in range(3))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        rows = order.permutation(len(y))
        for k in range(0, len(rows), batch):
            r = rows[k:k + batch]
            x = _matrix([at[i] for i in r], [tf[i] for i in r], idf)
            seen = np.flatnonzero(x.any(0))
            x = x[:, seen]
            p = softmax(x @ w[seen])
            p[np.arange(len(r)), y[r]] -= 1
            g = x.T @ p
            zs, ns = z[seen], n[seen]
            step = (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha
            zs += g - step * w[seen]
            ns += g * g
            z[seen], n[seen] = zs, ns
            w[seen] = np.where(np.abs(zs) <= l1, 0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))
    return w


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss on held-back rows, between 1/20 and 20."""
    grid = np.exp(np.linspace(-3, 3, 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _trainer(idf: np.ndarray):
    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["hash", "label"], kind="stable").reset_index(drop=True)
        langs = sorted(pdf["label"].unique())
        y = pdf["label"].map({v: i for i, v in enumerate(langs)}).to_numpy(np.int64)
        at, tf = pdf["at"].tolist(), pdf["tf"].tolist()
        held = (np.arange(len(y)) % 6 == 5) if len(y) >= 60 else np.zeros(len(y), bool)
        fit = np.flatnonzero(~held)
        w = fit_ftrl([at[i] for i in fit], [tf[i] for i in fit], y[fit], idf, len(langs))
        temperature = 1.0
        if held.any() and len(langs) > 1:
            rows = np.flatnonzero(held)
            logits = np.concatenate([_matrix([at[i] for i in r], [tf[i] for i in r], idf) @ w for r in np.array_split(rows, -(-len(rows) // 64))])
            temperature = fit_temperature(logits, y[rows])
        return pd.DataFrame({"langs": [langs], "weights": [w.astype("<f4").tobytes()], "temperature": [temperature]})
    return train


def train(labelled: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """Model of a (text, label) table, None if no row has a letter. The model is bounded: BUCKETS x languages.

    Rows with a null label or text teach nothing. Document frequencies cover every row; the fitted sample
    has at most ``per_class`` documents a language."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("label").cast("string").alias("label")).where("text is not null and label is not null")
    df = rows.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(df):
        return None
    freq = np.zeros(BUCKETS + 1, np.int64)
    freq[df["bucket"]] = df["n"]
    idf = (np.log((1 + freq[BUCKETS]) / (1 + freq[:BUCKETS])) + 1).astype(np.float32)
    # a text's hash orders the sample: neither ids nor file order matter
    rows = rows.withColumn("hash", F.xxhash64("text"))
    pick, _ = lowest_hashes(rows.select("label", "hash").distinct(), ["label"], "hash", "hash", per_class)
    sample = rows.join(staged(pick, "langid-sample"), ["label", "hash"], "left_semi").dropDuplicates(["label", "hash"])
    feats = staged(sample.mapInArrow(_features, "label string, hash long, at binary, tf binary"), "langid-features")
    fitted = feats.groupBy().applyInPandas(_trainer(idf), "langs array<string>, weights binary, temperature double").collect()
    if not fitted:
        return None
    fitted = fitted[0]
    w = np.frombuffer(fitted["weights"], "<f4").reshape(BUCKETS, -1)
    return {"langs": list(fitted["langs"]), "weights": w * idf[:, None], "idf": idf, "temperature": fitted["temperature"]}


def _predictor(model: dict | None, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in texts_of(b, text_col):
                c = counts(t.as_py() or "")
                if c is None or model is None:
                    out.append(("und", 0.0))
                    continue
                k = np.flatnonzero(c)
                tf = 1 + np.log(c[k])
                z = tf @ model["weights"][k] / max(np.linalg.norm(tf * model["idf"][k]), 1e-12)
                p = softmax(z[None, :] / model["temperature"])[0]
                best = int(p.argmax())
                out.append((model["langs"][best], float(p[best])))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                                             names=["row", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: dict | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` as a struct ``row``, lang_pred and score (the calibrated probability of lang_pred),
    one row per input row.

    Defined cases: null, empty or letterless text, or no model, gives ``und`` with score 0; ties go to the
    first language in order; columns of any name only travel in ``row``; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = row_and_text(docs, keep, text_col)
    kind = dict(rows.dtypes)["row"]
    return rows.mapInArrow(_predictor(model, text_col), f"row {kind}, lang_pred string, score double")
