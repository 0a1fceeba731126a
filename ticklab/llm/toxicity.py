"""Toxicity by a classifier chain of sparse linear models over the words of a text.

Categories are predicted one after the other: each model sees which words and word beginnings occur and the probabilities of
the categories before it. Those inputs are out-of-fold predictions in training (a fold's rows are scored
by models that never saw them, folds by text hash, so that copies share one), as the final chain's own
fitted probabilities would be too good.

Each link is a logistic regression with L1 and L2 penalties (accelerated proximal gradient), fitted on a
bounded sample of labelled documents (``per_kind`` for every combination of labels, lowest id hashes
first) with weights that restore the combinations' true shares. Words are 64-bit hashes that the model
stores in full, so unknown words never share a weight with known ones; it keeps at most ``MAX_WORDS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import bounded_batches, lowest_hashes, row_and_text, staged, texts_of
from ticklab.llm.pretokens import LETTER, classes, code_points

PER_KIND = 3000
MAX_WORDS = 4000
FOLDS = 5
_BASE = 0xD1342543DE82EF95  # odd: invertible modulo 2^64
_STEP = 1 << 20
PREFIXES = (4, 5, 6, 7)  # letters; word beginnings carry inflected and compound forms


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_STEP, _BASE)
_DOWN = _powers(_STEP, pow(_BASE, -1, 1 << 64))


def words(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs of letters, lower-cased) and of their PREFIXES, repeats included."""
    out, text = [], text.lower()
    k = 0
    while k < len(text):
        stop = min(len(text), k + _STEP)
        while stop < len(text) and stop > k + _STEP // 2 and text[stop - 1].isalpha():
            stop -= 1  # do not cut a word (unless it is half a million letters long)
        cp = code_points(text[k:stop])
        edge = np.diff(np.concatenate([[False], classes()[cp] == LETTER, [False]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        x = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum((x ^ (x >> np.uint64(31))) * _UP[:len(cp)], out=total[1:])
        out.append((total[end] - total[begin]) * _DOWN[begin])
        for n in PREFIXES:
            b = begin[end - begin > n]
            out.append((total[b + n] - total[b]) * _DOWN[b] + np.uint64(n))
        k = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class _Rows:
    """Sparse 0/1 matrix of documents by words (row and column of each entry)."""

    def __init__(self, row: np.ndarray, col: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.shape = row, col, shape

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.shape[0])

    def t_dot(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.shape[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_link(x: _Rows, extra: np.ndarray, y: np.ndarray, weight: np.ndarray, l1: float = 1e-5, l2: float = 1e-5, rounds: int = 300):
    """Word weights, weights of ``extra`` (earlier probabilities) and bias of one category."""
    weight = weight / weight.sum()
    dense = np.column_stack([extra, np.ones(len(y))])
    w, d = np.zeros(x.shape[1]), np.zeros(dense.shape[1])
    v, u = np.random.default_rng(3).normal(size=x.shape[1]), np.ones(dense.shape[1])
    for _ in range(12):  # largest curvature by power iteration
        norm = np.sqrt((v**2).sum() + (u**2).sum())
        v, u = v / norm, u / norm
        r = weight * (x.dot(v) + dense @ u)
        v, u = x.t_dot(r), dense.T @ r
    step = 1 / (0.25 * np.sqrt((v**2).sum() + (u**2).sum()) * 1.05 + l2)
    a, b, t = w, d, 1.0
    for _ in range(rounds):
        r = weight * (_sigmoid(x.dot(a) + dense @ b) - y)
        w_new = a - step * (x.t_dot(r) + l2 * a)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * l1, 0)
        d_new = b - step * (dense.T @ r + l2 * np.append(b[:-1], 0))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        a, b = w_new + (t - 1) / t_new * (w_new - w), d_new + (t - 1) / t_new * (d_new - d)
        w, d, t = w_new, d_new, t_new
    return w, d


def _select(row, col, n_words: int, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The MAX_WORDS words that the label depends on most (z-score of its share among their documents)."""
    n = np.bincount(col, weight[row], n_words)
    pos = np.bincount(col, (weight * y)[row], n_words)
    share = (weight * y).sum() / weight.sum()
    z = np.abs(pos - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    z[np.bincount(col, minlength=n_words) < 3] = 0
    return np.sort(np.argsort(-z, kind="stable")[:min(MAX_WORDS, int((z > 0).sum()))])


def _fit(row, col, n_words, extra, y, weight, rows: np.ndarray):
    """(selected words, their weights, extra weights and bias) from the documents ``rows`` (a mask)."""
    use = rows[row]
    keep = _select(row[use], col[use], n_words, y * rows, weight * rows)
    place = np.full(n_words, -1)
    place[keep] = np.arange(len(keep))
    use &= place[col] >= 0
    new = np.cumsum(rows) - 1
    x = _Rows(new[row[use]], place[col[use]], (int(rows.sum()), len(keep)))
    w, d = fit_link(x, extra[rows], y[rows], weight[rows])
    full = np.zeros(n_words)
    full[keep] = w
    return full, d


def threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Cut of best F1 on out-of-fold probabilities, half way to the next lower one, within 0.4 and 0.95; 0.5 without positives."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum((weight * y)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * y).sum())
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal scores fall on one side
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float(np.clip((p[order][k] + below) / 2, 0.4, 0.95))


def _trainer(categories: list[str]):
    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fold", "doc_id"]).reset_index(drop=True)
        hashes = [np.unique(np.frombuffer(h, "<u8")) for h in pdf["words"]]
        row = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        vocab, col = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_inverse=True)
        weight, fold = pdf["weight"].to_numpy(float), pdf["fold"].to_numpy()
        extra, out, used = np.zeros((len(pdf), 0)), [], np.zeros(len(vocab), bool)
        for c in categories:
            y = pdf[c].to_numpy(float)
            args = (row, col, len(vocab), extra, y, weight)
            oof = np.zeros(len(pdf))
            for k in range(FOLDS):
                rest = fold != k
                if rest.any() and not rest.all():
                    w, d = _fit(*args, rest)
                    z = np.bincount(row, w[col], len(pdf)) + np.column_stack([extra, np.ones(len(pdf))]) @ d
                    oof[~rest] = _sigmoid(z)[~rest]
            w, d = _fit(*args, np.ones(len(pdf), bool))
            used |= w != 0
            out.append((w, d, threshold(oof, y, weight)))
            extra = np.column_stack([extra, oof])
        return pd.DataFrame({"vocab": [vocab[used].astype("<u8").tobytes()],
                             "weights": [np.array([w[used] for w, _, _ in out], "<f8").tobytes()],
                             "links": [[d.tolist() for _, d, _ in out]], "cuts": [[t for *_, t in out]]})
    return train


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [np.unique(words(t.as_py() or "")).astype("<u8").tobytes() for t in b.column("text")]
        keep = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(out, pa.binary())], names=[*keep, "words"])


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
          per_kind: int = PER_KIND) -> dict | None:
    """Chain model; None without labelled documents.

    ``labels``: doc_id and one 0/1 column a category, in chain order. A document with several label rows
    has a category if any row has it; rows with a null id or a null in any category are left out. Of several
    texts with one id that of the lowest hash is learned, wherever its row lies.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select("doc_id", *[F.col(c).cast("int").alias(c) for c in categories]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    pick, sizes = lowest_hashes(known.withColumn("h", F.xxhash64("doc_id")), categories, "h", "doc_id", per_kind)
    pick = pick.join(sizes, categories).withColumn("weight", F.greatest(F.lit(1.0), F.col("size") / per_kind)).drop("h", "size")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most per_kind x 2^categories ids: bounded, so the texts stay where they are
    sample = texts.join(F.broadcast(staged(pick, "toxicity-sample")), "doc_id")
    sample = sample.groupBy("doc_id", *categories, "weight").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    sample = sample.select("doc_id", *categories, "weight", F.pmod("one.h", F.lit(FOLDS)).alias("fold"), "one.text")
    feats = staged(sample.mapInArrow(_hash_words, f"doc_id long, {', '.join(f'{c} int' for c in categories)}, weight double, fold long, words binary"),
                   "toxicity-features")
    m = feats.groupBy().applyInPandas(_trainer(categories), "vocab binary, weights binary, links array<array<double>>, cuts array<double>").collect()
    if not m:
        return None
    m = m[0]
    return {"categories": categories, "vocab": np.frombuffer(m["vocab"], "<u8"), "cuts": list(m["cuts"]), "links": [list(x) for x in m["links"]],
            "weights": np.frombuffer(m["weights"], "<f8").reshape(len(categories), -1)}


def probabilities(model: dict, text: str) -> list[float]:
    h = np.unique(words(text))
    at = np.searchsorted(model["vocab"], h)
    at = at[(at < len(model["vocab"])) & (model["vocab"][np.minimum(at, len(model["vocab"]) - 1)] == h)] if len(model["vocab"]) else at[:0]
    p: list[float] = []
    for w, link in zip(model["weights"], model["links"]):
        p.append(float(_sigmoid(w[at].sum() + np.dot(link[:-1], p) + link[-1])))
    return p


def _scorer(model: dict | None, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [probabilities(model, t.as_py() or "") if model else [] for t in texts_of(b, text_col)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.list_(pa.float64()))], names=["row", "p"])
    return run


def any_rejected() -> Column:
    """Whether any category of the chain reaches its cut, from ``rejected`` of ``predict``; false without a model."""
    return F.exists("rejected", lambda hit: hit)


def predict(docs: DataFrame, model: dict | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` as a struct ``row``, p (array of probabilities in chain order) and rejected (array of
    booleans: the category's probability reaches its cut), one row per input row.

    Defined cases: null or empty text is scored as a text without words; without a model both arrays are
    empty; columns of any name only travel in ``row``; an empty table gives no rows."""
    bounded_batches(docs.sparkSession)
    rows = row_and_text(docs, keep, text_col)
    out = rows.mapInArrow(_scorer(model, text_col), f"row {dict(rows.dtypes)['row']}, p array<double>")
    cuts = F.array(*[F.lit(c) for c in (model["cuts"] if model else [])]).cast("array<double>")
    return out.withColumn("rejected", F.transform("p", lambda p, i: p >= F.get(cuts, i)))
