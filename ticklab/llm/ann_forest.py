"""Approximate nearest neighbours by a forest of random-projection trees.

1. The trees are grown on a bounded sample (``sample`` vectors): a node splits along the difference of two
   random members at the median projection, so it needs one direction and one cut.
2. Every vector is routed down every tree to a leaf; equal vectors are one entry that keeps its k + 1
   smallest ids (no other id of theirs can be among k nearest with ties to smaller ids).
3. A query searches all trees through one shared priority queue, ordered by the smallest margin to any
   cut on the way: the most promising branches of the whole forest come first, until the leaves visited
   hold ``search_k`` entries.
4. Requests meet their leaves by (tree, leaf, part); large leaves are split into parts of ``PART`` entries
   and every part is one matrix product in double precision. Exact cosines of all distinct candidates
   are ranked at the end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklab.llm.common import staged

SAMPLE = 32768
PART = 4096


class Tree:
    """Inner nodes: direction, cut and two children (>= 0: node, < 0: leaf -1 - child)."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals, self.cuts, self.kids, self.leaves = [], [], [], 0
        self.root = self._grow(x, np.arange(len(x)), leaf, rng)
        self.normals = np.array(self.normals, np.float32).reshape(-1, x.shape[1])
        self.cuts = np.array(self.cuts, np.float32)
        self.kids = np.array(self.kids, np.int64).reshape(-1, 2)

    def _grow(self, x: np.ndarray, rows: np.ndarray, leaf: int, rng) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                a, b = x[rng.choice(rows, 2, replace=False)]
                p = x[rows] @ (a - b)
                cut = np.median(p)
                right = p > cut
                if 0 < right.sum() < len(rows):
                    node = len(self.cuts)
                    self.normals.append(a - b)
                    self.cuts.append(cut)
                    self.kids.append((0, 0))
                    self.kids[node] = (self._grow(x, rows[~right], leaf, rng), self._grow(x, rows[right], leaf, rng))
                    return node
        self.leaves += 1
        return -self.leaves

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every vector."""
        at = np.full(len(x), self.root)
        while (live := np.flatnonzero(at >= 0)).size:
            node = at[live]
            right = np.einsum("ij,ij->i", x[live], self.normals[node]) > self.cuts[node]
            at[live] = self.kids[node, right.astype(int)]
        return -1 - at


def search(trees: list[Tree], sizes: list[np.ndarray], q: np.ndarray, search_k: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs for one query, best first, until their leaves hold search_k entries."""
    dots = [t.normals @ q - t.cuts for t in trees]  # margins of all nodes
    queue = [(-np.inf, i, t.root) for i, t in enumerate(trees)]
    heapq.heapify(queue)
    out, found = [], 0
    while queue and found < search_k:
        worst, i, node = heapq.heappop(queue)  # worst: minus the smallest margin on the way
        kids, dot = trees[i].kids, dots[i]
        while node >= 0:
            m = float(dot[node])
            heapq.heappush(queue, (max(worst, abs(m)), i, int(kids[node, 0 if m > 0 else 1])))
            node = int(kids[node, 1 if m > 0 else 0])
        if n := int(sizes[i][-1 - node]):
            out.append((i, -1 - node))
            found += n
    return out


def budget(trees: list[Tree], sizes: list[np.ndarray], q: np.ndarray, wanted: list[np.ndarray]) -> list[int]:
    """Entries that a search from ``q`` has visited when it meets each wanted neighbour (its leaf by tree)."""
    at, seen = {}, 0
    for i, leaf in search(trees, sizes, q, int(sum(s.sum() for s in sizes)) + 1):
        seen += int(sizes[i][leaf])
        at[i, leaf] = seen
    return [min(at[i, int(leaf)] for i, leaf in enumerate(leaves)) for leaves in wanted]


def _unit(vecs) -> np.ndarray:
    x = np.array(list(vecs), np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _grower(sample, leaf: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["id"].iloc[0])
        t = Tree(sample.value, leaf, np.random.default_rng(k + 1))
        return pd.DataFrame({"id": [k], "normals": [t.normals.tobytes()], "cuts": [t.cuts.tobytes()], "kids": [t.kids.tobytes()],
                             "leaves": [t.leaves], "root": [t.root]})
    return grow


def _tree(row, dim: int) -> Tree:
    t = Tree.__new__(Tree)
    t.normals = np.frombuffer(row["normals"], np.float32).reshape(-1, dim)
    t.cuts, t.kids = np.frombuffer(row["cuts"], np.float32), np.frombuffer(row["kids"], np.int64).reshape(-1, 2)
    t.leaves, t.root = row["leaves"], row["root"]
    return t


def _router(forest):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = _unit(pdf["vec"]) if len(pdf) else np.zeros((0, 1), np.float32)
            leaves = np.array([t.route(x) for t in forest.value], np.int64).T if len(pdf) else []
            yield pdf.assign(leaves=list(leaves))
    return run


def _prober(probes: np.ndarray, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                s = probes @ _unit(pdf["vec"]).T
                best = np.argsort(-s, axis=1, kind="stable")[:, :k + 1]
                yield pd.DataFrame({"probe": np.repeat(np.arange(len(probes)), best.shape[1]), "score": np.take_along_axis(s, best, 1).ravel().astype(float),
                                    "rep": pdf["rep"].to_numpy()[best.ravel()], "leaves": [pdf["leaves"].iloc[i] for i in best.ravel()]})
    return run


def _searcher(forest, sizes: list[np.ndarray], search_k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for j in range(0, len(pdf), 256):
                part = pdf.iloc[j:j + 256]
                x = _unit(part["vec"]) if len(part) else []
                hits = [search(forest.value, sizes, q, search_k) for q in x]
                n = [len(h) for h in hits]
                yield pd.DataFrame({"tree": [i for h in hits for i, _ in h], "leaf": [f for h in hits for _, f in h],
                                    "query": np.repeat(part["rep"].to_numpy(), n), "vec": list(part["vec"].repeat(n))})
    return run


def _scorer(k: int):
    def run(entries: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(asks):
            x, q = np.array(entries["vec"].tolist(), np.float64), np.array(asks["vec"].tolist(), np.float64)
            nx, nq = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
            reps = entries["rep"].to_numpy()
            for j in range(0, len(q), 256):
                s = (q[j:j + 256] @ x.T) / (nq[j:j + 256, None] * nx)
                for row, (query, v, n) in zip(s, zip(asks["query"].to_numpy()[j:j + 256], q[j:j + 256], nq[j:j + 256])):
                    # all that may tie with the last place, then exact scores
                    at = np.flatnonzero(row >= np.partition(row, -k)[-k] - 1e-12) if len(row) > k else np.arange(len(row))
                    exact = (x[at] * v).sum(1) / (n * nx[at])
                    out += [(query, int(reps[i]), float(e)) for i, e in zip(at, exact)]
        return pd.DataFrame(out, columns=["query", "rep", "score"]).astype({"query": "int64", "rep": "int64", "score": "float64"})
    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, trees: int = 8, per_leaf: int | None = None, recall: float = 0.95, probes: int = 100,
            sample: int = SAMPLE, search_k: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where the column ``is_query`` holds.

    ``search_k``: entries a query visits; None measures it: ``probes`` queries are solved by brute force
    over all rows, and search_k becomes the visits that find ``recall`` of their neighbours. Trees have
    about ``per_leaf`` entries a leaf, but at least 8 sample vectors; None: twice the square root of the
    number of entries, so that the leaves a query visits and the entries in one grow at the same pace. Bounds: the forest holds at most
    trees x sample/8 directions; it and the probes are all that passes through the driver.
    Defined cases: vectors that are null, of zero length, or hold a null or non-finite component take no
    part, nor do vectors of another dimension than the most frequent (ties: the smaller); null ids take no
    part; a repeated id with an equal vector is one row; other columns are ignored; fewer candidates than
    k are all returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<double>")
    good = F.col("id").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), vec.alias("d"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).select("id", F.col("d").alias("vec"), F.coalesce("q", F.lit(False)).alias("q")).where(good)
    dims = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dims is None:
        return empty
    rows = staged(rows.where(F.size("vec") == dims["dim"]).distinct(), "ann-rows")
    # equal vectors: k + 1 smallest ids, cut to that number before the shuffle
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    entries = (rows.select("id", "vec").withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("vec")
               .agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("rep"), "ids", "vec"))
    entries = staged(entries, "ann-entries")
    n = entries.count()
    picked = entries.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vec").toPandas()["vec"]
    shared = spark.sparkContext.broadcast(_unit(picked))
    per_leaf = per_leaf or max(64, round(2 * n**0.5))
    leaf = max(8, min(len(picked), round(len(picked) * per_leaf / n)))
    grown = (spark.range(trees).groupBy("id").applyInPandas(_grower(shared, leaf), "id long, normals binary, cuts binary, kids binary, leaves int, root int"))
    forest_ = [_tree(r, dims["dim"]) for r in sorted(grown.collect(), key=lambda r: r["id"])]
    forest = spark.sparkContext.broadcast(forest_)
    routed = staged(entries.mapInPandas(_router(forest), "rep long, ids array<long>, vec array<double>, leaves array<long>"), "ann-routed")
    placed = routed.select("rep", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = [np.zeros(t.leaves, np.int64) for t in forest_]
    for r in placed.groupBy("tree", "leaf").count().collect():  # at most trees x leaves
        sizes[r["tree"]][r["leaf"]] = r["count"]
    own = staged(rows.where("q").select(F.col("id").alias("query_id"), "vec").join(entries.select("rep", "vec"), "vec").select("query_id", "rep"), "ann-queries")
    asked = routed.join(own.select("rep").distinct(), "rep", "left_semi").select("rep", "vec")
    if search_k is None:
        some = asked.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(probes).collect()
        if not some:
            return empty
        unit = _unit([r["vec"] for r in some])
        best = (routed.select("rep", "vec", "leaves").mapInPandas(_prober(unit, k), "probe int, score double, rep long, leaves array<long>")
                .withColumn("r", F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "rep"))).where(F.col("r") <= k + 1).collect())
        need = []
        for i, q in enumerate(unit):
            wanted = [np.array(r["leaves"]) for r in best if r["probe"] == i and r["rep"] != some[i]["rep"]]
            need += budget(forest_, sizes, q, wanted[:k])
        search_k = int(np.quantile(need, recall, method="higher")) if need else 1
    asks = staged(asked.mapInPandas(_searcher(forest, sizes, max(1, search_k)), "tree int, leaf long, query long, vec array<double>"), "ann-asks")
    # a leaf's entries and requests are split into parts of bounded size; every pair of parts is a task's group
    load = asks.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("asks")).join(placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")), ["tree", "leaf"])
    load = staged(load.select("tree", "leaf", F.ceil(F.col("n") / PART).cast("int").alias("parts"), F.ceil(F.col("asks") / PART).cast("int").alias("ask_parts")), "ann-load")
    left = (routed.select("rep", "vec", F.posexplode("leaves").alias("tree", "leaf")).join(load, ["tree", "leaf"])
            .select("tree", "leaf", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"), F.explode(F.sequence(F.lit(0), F.col("ask_parts") - 1)).alias("ask"), "rep", "vec"))
    right = (asks.join(load, ["tree", "leaf"])
             .select("tree", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"),
                     F.pmod(F.xxhash64("query"), F.col("ask_parts")).cast("int").alias("ask"), "query", "vec"))
    cell = ["tree", "leaf", "part", "ask"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_scorer(k + 1), "query long, rep long, score double")
    found = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = found.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
    ids = found.join(entries.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    answers = own.join(ids, own["rep"] == ids["query"]).where("query_id <> vec_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
