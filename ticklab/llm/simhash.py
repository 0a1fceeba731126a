"""SimHash near-duplicates by bit-sliced comparison.

1. Fingerprints: 64 bits over the XXH64 (seed 42) of every word shingle, a bit is 1 if set in over half.
2. Equal fingerprints collapse. The 64 bits are cut into ``blocks`` parts; two fingerprints within
   ``radius`` bits agree on at least blocks - radius parts, so every choice of that many parts gives a
   bucket key, and every close pair shares a bucket (pigeonhole: exact, no candidate is lost).
3. A bucket's fingerprints are compared bit-sliced: bit planes are stored vertically (one 64-lane word per
   plane), the distances of many pairs advance together through two carry-save counter planes and one
   sticky "exceeds" plane, and a block is abandoned once all its lanes exceed the radius. Small buckets
   lie next to each other, sorted, and are compared with themselves shifted by 1, 2, ... lanes. Buckets
   above ``TILE`` fingerprints are cut into tiles, and each pair of tiles is a task of its own.
4. Each comparison emits a spanning forest of its links (never all pairs of a group), and distributed
   connected components join them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import bounded_batches, staged
from ticklab.llm.components import connected_components

BITS = 64
TILE = 2048
TASK_ROWS = 1 << 22  # bucket rows (16 bytes each) of one comparing task
SHORT = 32  # buckets up to this size are compared by shifting
LANES = 1 << 13  # lanes compared and abandoned together
SHINGLES = 1 << 16  # hashes counted at a time, bounds memory on very long texts


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash; null text or a text without words gives 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    stops = (ends[words - 1:] - 1).tolist() if len(tokens) >= words else [len(joined)]
    begins = [0, *ends[:len(stops) - 1].tolist()]
    h64 = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(stops)
    for k in range(0, n, SHINGLES):
        h = np.array([h64(joined[i:j], seed) for i, j in zip(begins[k:k + SHINGLES], stops[k:k + SHINGLES])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])
    return run


def _planes(fps: np.ndarray) -> np.ndarray:
    """[64, words] bit planes of the fingerprints, 64 lanes a word (lane i of a word is its bit i)."""
    lanes = -(-len(fps) // 64) * 64
    bits = np.zeros((lanes, BITS), np.uint8)
    bits[:len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose distance is at most ``radius``, as words: left and right are [64, ...] bit planes that
    broadcast against each other. Carry-save counting modulo 4 with a sticky plane (radius up to 3)."""
    shape = np.broadcast_shapes(left.shape[1:], right.shape[1:])
    one, two, over = (np.zeros(shape, np.uint64) for _ in range(3))
    for b in range(BITS):
        x = left[b] ^ right[b]
        carry = one & x
        one ^= x
        x = two & carry
        two ^= carry
        over |= x  # the fourth difference
        if b % 8 == 7 and b >= 15 and over.all() and (over == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
            break  # every lane exceeds the radius
    if radius == 3:
        return ~over
    value = [~over & ~one & ~two, ~over & one & ~two, ~over & ~one & two]
    return np.bitwise_or.reduce(value[:radius + 1])


def _lanes(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


class _Forest:
    """Union-find that reports only the links that join two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_sorted(keys: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between fingerprints of equal (adjacent) keys, by comparing the sequence with itself shifted."""
    out, forest = [], _Forest()
    for begin in range(0, len(fps), LANES):
        # runs that begin in this block may end behind it: at most SHORT lanes more
        stop = min(len(fps), begin + LANES + SHORT)
        k, f = keys[begin:stop], fps[begin:stop]
        planes = _planes(f)
        n = min(LANES, len(f))
        for shift in range(1, SHORT):
            m = min(n, len(f) - shift)
            if m <= 0 or not (same := k[:m] == k[shift:shift + m]).any():
                break
            shifted = _planes(f[shift:])
            w = -(-m // 64)
            for i in _lanes(within(planes[:, :w], shifted[:, :w], radius)):
                if i < m and same[i] and forest.link(int(f[i]), int(f[i + shift])):
                    out.append((int(f[i]), int(f[i + shift])))
    return out


def links_tiles(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links inside tile ``a`` (b None) or between the tiles; each query row meets all lanes of a tile."""
    out, forest = [], _Forest()
    right = _planes(a if b is None else b)
    other = a if b is None else b
    for begin in range(0, len(a), 256):
        q = a[begin:begin + 256]
        bits = np.unpackbits(q.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        masks = (np.uint64(0) - bits.T.astype(np.uint64))[:, :, None]  # [64, queries, 1], all ones or zeros
        near = within(masks, right[:, None, :], radius)
        for i, row in enumerate(near):
            if not row.any():
                continue
            for j in _lanes(row):
                if j < len(other) and (b is not None or j > begin + i) and forest.link(int(q[i]), int(other[j])):
                    out.append((int(q[i]), int(other[j])))
    return out


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _small(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_k, keep_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            k = np.concatenate([keep_k, b.column("key").to_numpy(zero_copy_only=False)])
            f = np.concatenate([keep_f, b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last run may go on in the next batch
            keep_k, keep_f = k[cut:], f[cut:]
            yield _link_batch(links_sorted(k[:cut], f[:cut], radius))
        yield _link_batch(links_sorted(keep_k, keep_f, radius))
    return run


def _tiles(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, side = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["side"].to_numpy()
        one = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        links = links_tiles(fp, None, radius) if one else links_tiles(fp[side == 0], fp[side == 1], radius)
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
    return run


def close_links(fps: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(a, b): links that connect all fingerprints (distinct column fp, signed) within ``radius`` bits."""
    if not 0 <= radius <= 3:
        raise ValueError("radius 0 to 3: the counters hold two bits")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    part = [((1 << (hi - lo)) - 1) << lo for lo, hi in itertools.pairwise(edges)]
    masks = [sum(part[i] for i in c) for c in itertools.combinations(range(blocks), blocks - radius)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    keys = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(signed(m)))) for t, m in enumerate(masks)])
    # the key is a hash of (table, masked bits): a collision only adds a comparison
    rows = staged(fps.select("fp", F.explode(F.array_distinct(keys)).alias("key")), "simhash-keys")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = rows.join(staged(sizes, "simhash-buckets"), "key")
    small = full.where(F.col("n") <= SHORT).select("key", "fp")
    # a task's rows are bounded however many there are; the session's number is the least
    parts = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))
    near = (small.repartition(parts, "key").sortWithinPartitions("key", "fp")
            .mapInArrow(_small(radius), "a long, b long"))
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    large = full.where(F.col("n") > SHORT).withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    cells = (large.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("key", "fp", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), (F.col("t") > F.col("o")).cast("int").alias("side")))
    far = cells.groupBy("key", "i", "j").applyInPandas(_tiles(radius), "a long, b long")
    return near.unionByName(far)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3,
                   seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row; component_id is the smallest id that
    links of ``radius`` bits or fewer reach, the row's own included.

    Defined cases: null, empty or blank text has fingerprint 0 and links like any other; a text with
    fewer words is one shingle; a null id is never a component_id unless its whole group has no other
    (then null); repeated rows share their group; other columns are ignored; an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    rows = staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(_fingerprints(words, seed), "doc_id long, fp long"), "simhash")
    reps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    groups = connected_components(close_links(reps.select("fp"), radius))
    in_group = reps.join(groups, reps["fp"] == groups["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = in_group.groupBy("component").agg(F.min("least").alias("component_id"))
    named = staged(in_group.join(least, "component").select("fp", "component_id"), "simhash-groups")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
