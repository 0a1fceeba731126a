"""Harmonic packing of documents into sequences of ``capacity`` tokens.

A document's ids (text ids, then the end id) are cut into full sequences, then powers of two down to
``min_head``, then a tail. Class k holds the pieces with capacity/(k+1) < length <= capacity/k, and every
bin of class k takes exactly k pieces - for the powers of two that fills it to the last token. Tails are
classes of their own, also where a power of two has the same k. Workers (hash shares of the pieces) number
their classes independently of each other.

What does not fill a bin, fewer than k pieces per worker and class, is settled without padding: left-over
powers of two form sequences that are powers of two themselves, and left-over tails are chained and cut
at sequence ends (the chain's rest at powers of two).
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticklab.llm.bpe import gather
from ticklab.llm.common import bounded_batches, staged
from ticklab.llm.pretokens import split_batches

WORKER_PIECES = 100_000
CACHED_WORDS = 600_000  # a worker's word cache starts afresh beyond this
_JOINED = 4096


class WordIds:
    """Ids of pre-tokens, each new one encoded once; bounded by CACHED_WORDS."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.size, self.begin, self.flat = (np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32))
        self.used = 0

    def _grow(self, words: int, ids: int) -> None:
        while len(self.size) < words:
            self.size, self.begin = np.concatenate([self.size, self.size]), np.concatenate([self.begin, self.begin])
        while len(self.flat) < ids:
            self.flat = np.concatenate([self.flat, self.flat])

    def _add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.index)
        self._grow(n + len(words), self.used + len(ids))
        self.size[n:n + len(words)] = sizes
        self.begin[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(words, range(n, n + len(words))))

    def _encode(self, words: list[str]) -> None:
        # words of a space and letters split again as they were when written one after the other
        plain = [w for w in words if w[0] == " " and w[1:].isalpha()]
        for k in range(0, len(plain), _JOINED):
            part = plain[k:k + _JOINED]
            e = self.tok.encode("".join(part), add_special_tokens=False)
            sizes = np.bincount(np.array(e.word_ids, np.int64), minlength=len(part))
            if len(sizes) == len(part):
                self._add(part, sizes, np.array(e.ids, np.uint32))
        rest = [w for w in words if w not in self.index]
        if rest:
            found = [e.ids for e in self.tok.encode_batch(rest, add_special_tokens=False)]
            self._add(rest, np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], np.uint32))

    def ids(self, words: list[str], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens ``words[which]`` one after the other, and how many each has."""
        if len(self.index) > CACHED_WORDS:
            self.clear()
        index = self.index
        new = list(dict.fromkeys(w for w in words if w not in index))
        if new:
            self._encode(new)
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))[which]
        return gather(self.flat, self.begin, self.size, at), self.size[at]


@functools.cache
def word_ids(path: str) -> WordIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return WordIds(path)


def cuts(n: int, capacity: int, min_head: int) -> list[int]:
    """Lengths of a document's pieces: full sequences, powers of two from capacity/2 to min_head, tail."""
    out = [capacity] * (n // capacity)
    n %= capacity
    bit = capacity // 2
    while bit >= min_head:
        if n & bit:
            out.append(bit)
        bit //= 2
    tail = n % min_head
    return out + [tail] if tail else out


def _pieces(path: str, end_id: int, capacity: int, min_head: int, added_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_ids(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                b = whole.slice(k, 512)
                docs, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                rows: list[tuple] = []
                whole_text = {i for i, t in enumerate(texts) if added_tokens and any(a in t for a in enc.added)}
                for i, j, words, which, counts in split_batches(["" if i in whole_text else t for i, t in enumerate(texts)]):
                    ids, sizes = enc.ids(words, which)
                    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
                    for at_text, a, z in zip(range(i, j), [0, *ends[:-1].tolist()], ends.tolist()):
                        doc, own = docs[at_text], ids[a:z]
                        if at_text in whole_text:  # an added token's string: the library finds where it counts
                            own = np.array(enc.library.encode(texts[at_text], add_special_tokens=False).ids, np.uint32)
                        data = own.astype("<u4").tobytes() + np.array([end_id], "<u4").tobytes()
                        at, n = 0, len(own) + 1
                        for size in cuts(n, capacity, min_head):
                            part = data[4 * at:4 * (at + size)]
                            rows.append((doc, at, size, zlib.crc32(part), n, part if size < min_head else None))
                            at += size
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "tail"])
    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, min_head: int = 64, id_col: str = "doc_id",
         text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    ``path``: a tokenizer file of the `tokenizers` library; capacity and min_head are powers of two.
    ``added_tokens``: strings of the file's added tokens in a text get the tokens' ids, as the library's
    ``encode`` does; without it they are ordinary text.
    Every sequence holds exactly ``capacity`` tokens, or a power of two, or (bins of tails) at most
    capacity and over capacity - capacity/(k+1) for class k >= capacity/min_head.
    Defined cases: null or empty text is the end id alone; repeated ids are separate documents; a null id
    stays null; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = texts.mapInArrow(_pieces(path, end_id, capacity, min_head, added_tokens),
                              "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, tail binary")
    pieces = staged(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    # class 1: every piece is a bin of its own, which needs no numbering within a worker
    single = F.col("length") * 2 > capacity
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    alone = pieces.where(single).select(*cols, (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    workers = max(1, -(-pieces.where(~single).count() // WORKER_PIECES))
    mine = Window.partitionBy("worker", "k", "head")
    dealt = (pieces.where(~single).withColumn("worker", F.pmod(F.xxhash64("rid"), F.lit(workers))).drop("rid")
             .withColumn("k", F.floor(F.lit(capacity) / F.col("length"))).withColumn("head", F.col("length") >= min_head)
             .withColumn("r", F.row_number().over(mine.orderBy("doc_id", "start", "ids_crc32")) - 1)
             .withColumn("left", F.count(F.lit(1)).over(mine) % F.col("k"))
             .withColumn("i", F.col("r") - (F.count(F.lit(1)).over(mine) - F.col("left")).cast("int")))
    dealt = staged(dealt, "pieces-dealt")

    def number(kind: int, k, place):
        """worker, kind, class and place in one long"""
        return (F.shiftleft(F.col("worker"), 38) + F.shiftleft(F.lit(kind).cast("long"), 36) + F.shiftleft(k.cast("long"), 24) + place.cast("long"))

    full = dealt.where("i < 0").withColumn("bin", F.floor(F.col("r") / F.col("k")))
    before = Window.partitionBy("worker", "k", "head", "bin").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    bin_id = F.when(F.col("head"), number(3, F.col("k"), F.col("bin"))).otherwise(number(0, F.col("k"), F.col("bin")))
    full = full.select(*cols, bin_id.alias("sequence_id"),
                       F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))

    def floor_bits(x, b):  # x without its bits below b; b may be a column
        return x - x % F.pow(F.lit(2), b).cast("long")

    # left-over powers of two: the binary digits of their number give the sequences
    bits = F.sequence(F.lit(0), F.lit(capacity.bit_length()))
    digit = F.array_max(F.filter(bits, lambda b: floor_bits(F.col("left"), b) > F.col("i")))
    heads = dealt.where((F.col("i") >= 0) & F.col("head")).withColumn("digit", digit)
    heads = heads.select(*cols, number(1, F.col("k"), F.col("digit")).alias("sequence_id"),
                         ((F.col("i") - floor_bits(F.col("left"), F.col("digit") + 1)) * F.col("length")).alias("offset"))

    # left-over tails: a chain per worker, cut where sequences end
    chain = Window.partitionBy("worker").orderBy("k", "r")
    tails = (dealt.where((F.col("i") >= 0) & ~F.col("head"))
             .withColumn("p", F.coalesce(F.sum("length").over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("total", F.sum("length").over(Window.partitionBy("worker")))
             .withColumn("rest", F.col("total") % capacity).withColumn("base", F.col("total") - F.col("rest"))
             .withColumn("end", F.col("p") + F.col("length")))
    whole = F.transform(F.sequence(F.floor(F.col("p") / capacity), F.floor((F.col("end") - 1) / capacity)),
                        lambda s: F.struct((s * capacity).alias("lo"), F.least((s + 1) * capacity, F.col("base")).alias("hi"), (s + 64).alias("place")))
    powers = F.transform(bits, lambda b: F.struct((F.col("base") + floor_bits(F.col("rest"), b + 1)).alias("lo"),
                                                  (F.col("base") + floor_bits(F.col("rest"), b)).alias("hi"), b.cast("long").alias("place")))
    inside = F.filter(F.concat(whole, powers), lambda s: F.least(s["hi"], F.col("end")) > F.greatest(s["lo"], F.col("p")))
    tails = (tails.withColumn("s", F.explode(inside)).withColumn("lo", F.greatest("s.lo", "p"))
             .withColumn("n", F.least("s.hi", "end") - F.col("lo")).withColumn("skip", F.col("lo") - F.col("p")))
    part = F.substring("tail", (F.col("skip") * 4 + 1).cast("int"), (F.col("n") * 4).cast("int"))
    tails = tails.select("doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("n").alias("length"), F.crc32(part).alias("ids_crc32"),
                         "doc_tokens", number(2, F.lit(0), F.col("s.place")).alias("sequence_id"), (F.col("lo") - F.col("s.lo")).alias("offset"))
    return alone.unionByName(full).unionByName(heads).unionByName(tails)
