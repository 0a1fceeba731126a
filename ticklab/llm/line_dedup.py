"""Line deduplication through a sharded minimal perfect hash.

1. Every line's key (stripped of [\\x20\\x09-\\x0D], A-Z lower-cased, ``min_chars`` code points or more)
   is hashed to 128 bits; (key, document) pairs are counted with map-side combining.
2. The distinct keys are dealt into shards by hash; each shard builds a minimal perfect hash (a cascade
   of collision-free bit levels, ~3 bits a key) that indexes three arrays: a fingerprint, the document
   count and the largest document id. One row per shard holds them all.
3. Documents probe the arrays: line references meet their shard in a cogroup, look up their slot, check
   the fingerprint and come back only if their line goes. A shard with many references (one line may be
   a third of all) is split into as many probe groups as its exact reference count asks for, each with
   a copy of the arrays.

All distinct keys are in the arrays, so every probe finds its own slot: no false positives but for
equal 128-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import BLANKS, lower_ascii, staged

SHARD_KEYS = 1 << 17
PROBE_ROWS = 1 << 18
_GAMMA = 2  # bits per key on each level


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    x = h ^ np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _spot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return ((_mix(h1, level) + _mix(h2, level + 1000)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys (two uint64 halves) onto 0..n-1.

    Level l has a bit array twice as long as the keys that reach it; a key that is alone on its bit is
    placed there, the others go on. A key's index is the number of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bool arrays
        ones = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(ones) - ones
        self.starts = np.cumsum([0, *(len(x) for x in levels)])

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        while len(h1):
            size = _GAMMA * len(h1)
            pos = _spot(h1, h2, len(levels), size)
            alone = np.bincount(pos, minlength=size) == 1
            levels.append(alone)
            left = ~alone[pos]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that fall through all levels (never for keys built in)."""
        out = np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for k, bits in enumerate(self.levels):
            if not len(todo):
                break
            pos = _spot(h1[todo], h2[todo], k, len(bits))
            hit = bits[pos]
            out[todo[hit]] = self.rank[self.starts[k] + pos[hit]]
            todo = todo[~hit]
        return out

    def pack(self) -> bytes:
        head = np.array([len(self.levels), *(len(x) for x in self.levels)], "<i8").tobytes()
        bits = np.concatenate(self.levels) if self.levels else np.zeros(0, bool)
        return head + np.packbits(bits).tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=8 + 8 * n), count=int(sizes.sum())).astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1])) if n else cls([])


def _halves(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["h1"].to_numpy(np.int64).view(np.uint64), pdf["h2"].to_numpy(np.int64).view(np.uint64)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = _halves(pdf)
    mph = PerfectHash.build(h1, h2)
    slot = mph.index(h1, h2)
    fps, counts, tops, known = np.zeros(len(pdf), "<u4"), np.zeros(len(pdf), "<i8"), np.zeros(len(pdf), "<i8"), np.zeros(len(pdf), np.uint8)
    fps[slot], counts[slot] = h2.astype(np.uint32), pdf["n_docs"].to_numpy()
    tops[slot], known[slot] = pdf["top_doc"].to_numpy(), pdf["top_known"].to_numpy()
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "mph": [mph.pack()], "fps": [fps.tobytes()], "counts": [counts.tobytes()],
                         "tops": [tops.tobytes()], "known": [known.tobytes()]})


def _prober(min_docs: int):
    def probe(refs: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        out = refs[["doc", "doc_known", "text_hash", "line"]]
        if not len(refs) or not len(arrays):
            return out.iloc[:0]
        a = arrays.iloc[0]
        h1, h2 = _halves(refs)
        slot = PerfectHash.unpack(a["mph"]).index(h1, h2)
        if not (np.frombuffer(a["fps"], "<u4")[slot] == h2.astype(np.uint32)).all():
            raise ValueError("a line is missing from its shard")
        many = np.frombuffer(a["counts"], "<i8")[slot] >= min_docs
        top, top_known = np.frombuffer(a["tops"], "<i8")[slot], np.frombuffer(a["known"], np.uint8)[slot].astype(bool)
        known = refs["doc_known"].to_numpy(bool)
        stays = np.where(top_known, known & (refs["doc"].to_numpy() == top), ~known)
        return out[many & ~stays]
    return probe


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                        min_docs: int = 5) -> DataFrame:
    """(row, doc_id, text, n_lines, n_dropped), one row per input row: row is the input row without its text
    as a struct, text lacks the dropped lines.

    A key found in ``min_docs`` documents (distinct ids) or more loses all its lines except in the
    largest id that holds it. Defined cases: null or empty text is one empty line; a document that loses
    every line has empty text; a null id is smaller than any other (a line that only null ids hold
    stays); repeated rows of one id count once and are treated alike; extra columns of any name only
    travel in ``row``; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.struct(*[c for c in docs.columns if c != text_col]).alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    lines = base.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line", "t"))
    keyed = (lines.select("doc_id", "text_hash", "line", lower_ascii(F.btrim("t", F.lit(BLANKS))).alias("k"))
             .where(F.length("k") >= min_chars))
    refs = staged(keyed.select(F.coalesce("doc_id", F.lit(0)).alias("doc"), F.col("doc_id").isNotNull().alias("doc_known"), "text_hash", "line",
                               F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("#"), "k").alias("h2")), "line-refs")
    # (key, document) first: the pairs of a hot key are spread over all tasks, then combined map-side
    pairs = refs.groupBy("h1", "h2", "doc", "doc_known").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("doc_known", "doc"))
    keys = staged(pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_refs"), top.alias("top"))
                  .select("h1", "h2", "n_docs", "n_refs", F.col("top.doc").alias("top_doc"), F.col("top.doc_known").alias("top_known")), "line-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    shard = F.pmod("h1", F.lit(shards)).alias("shard")
    arrays = (keys.select(shard, "h1", "h2", "n_docs", "top_doc", "top_known").groupBy("shard")
              .applyInPandas(_build, "shard long, mph binary, fps binary, counts binary, tops binary, known binary"))
    parts = (keys.select(shard, "n_refs").groupBy("shard").agg(F.sum("n_refs").alias("n_refs"))
             .select("shard", F.ceil(F.col("n_refs") / PROBE_ROWS).cast("long").alias("parts")))
    arrays = arrays.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = (refs.withColumn("shard", shard).join(parts, "shard")
             .withColumn("part", F.pmod(F.xxhash64("doc", "text_hash", "line"), F.col("parts"))).drop("parts"))
    gone = (dealt.groupBy("shard", "part").cogroup(arrays.drop("parts").groupBy("shard", "part"))
            .applyInPandas(_prober(min_docs), "doc long, doc_known boolean, text_hash long, line int"))
    doc_id = F.when(F.col("doc_known"), F.col("doc")).alias("doc_id")
    gone = staged(gone.groupBy(doc_id, "text_hash").agg(F.collect_set("line").alias("gone")), "line-drops")  # at most a document's lines
    rows = base.withColumn("text_hash", F.xxhash64("text")).alias("d").join(
        gone.alias("g").hint("merge"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_hash") == F.col("g.text_hash")), "left")
    lines = F.split("d.text", "\n")

    def without(ls):  # ls is a lambda's variable: the text is split once, not once a line
        left = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "gone")
        return F.array_join(F.transform(left, lambda i: F.get(ls, i)), "\n")
    kept = F.when(F.col("gone").isNull(), F.col("d.text")).otherwise(F.get(F.transform(F.array(lines), without), F.lit(0)))
    return rows.select("d.row", "d.doc_id", kept.alias("text"), F.size(lines).cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
