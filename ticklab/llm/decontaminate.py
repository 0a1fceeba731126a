"""Benchmark decontamination through a generalised suffix automaton of the test items.

1. Items are cut into words and, if long, into overlapping parts; parts are dealt into blocks of about
   ``BLOCK_WORDS`` words. One task builds a block's automaton: a state stands for all item substrings with the
   same end positions, its length is that of the longest of them, its link leads to the next shorter ones.
   States that hold a substring of ``window`` words, or a whole shorter item, know the items it occurs in.
2. Automata are shared one after the other (a block bounds their size) and every document streams through
   each once, word by word: the automaton keeps the longest suffix of the words read that any item holds.
   Where its length reaches a window, the window's words are hit and its items are named.
3. A word that no item has, or two neighbours that no item has, end every match: only runs of words between
   such places that are long enough for a window are walked, which gives the same result.

Documents never leave their task: their texts are not shuffled.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklab.llm.common import bounded_batches, row_and_text, staged, texts_of

BLOCK_WORDS = 1 << 20
PART_WORDS = 1 << 12
PASSES_A_STAGE = 4  # automata that are in memory beside each other; then the documents are written
#: Fixed: [^\x00-\x2F\x3A-\x60\x7B-\x7F] are the word characters once A-Z are lower-cased.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return data.translate(_FOLD).split()


def word_ends(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the words of ``words_of`` begin and end."""
    inside = np.frombuffer(data.translate(_FOLD), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of small integers."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]

    def _state(self, length: int, link: int, nxt: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.length) - 1

    def _target(self, p: int, word: int) -> int:
        """The state of p's longest string followed by ``word``, which p leads to: split off where that state
        also holds longer strings."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        return twin

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            if w in self.next[last]:  # another item has it already
                last = self._target(last, w)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._target(p, w)
            last = new

    def walk(self, words: list[int]) -> Iterator[int]:
        """States of the prefixes of an added sequence."""
        at = 0
        for w in words:
            at = self.next[at][w]
            yield at


def _build(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One block: parts (item, words joined by spaces, whole) -> the automaton's arrays."""
        index: dict[bytes, int] = {}
        parts = [[index.setdefault(w, len(index) + 1) for w in t.split(b" ")] for t in pdf["words"]]
        names, own = np.unique(pdf["item"].fillna("").to_numpy(object).astype(str), return_inverse=True)
        known = pdf["item"].notna().to_numpy()
        a = SuffixAutomaton()
        for p in parts:
            a.add(p)
        n = len(a.length)
        length, link = np.array(a.length, np.int32), np.array(a.link, np.int32)
        top, short = np.zeros(n, np.int32), np.zeros(n, np.int32)  # state of the window, next shorter whole item
        items: dict[int, set] = {}
        whole = np.zeros(n, bool)
        order = np.argsort(length, kind="stable")
        for s in order.tolist():
            if length[s] >= window:
                up = link[s]
                top[s] = s if length[up] < window else top[up]
        for p, item, has in zip(parts, own.tolist(), known.tolist()):
            states = list(a.walk(p))
            ends = states[-1:] if len(p) < window else states[window - 1:]
            for s in ends:
                s = s if len(p) < window else int(top[s])
                whole[s] |= len(p) < window
                found = items.setdefault(s, set())
                if has:
                    found.add(item)
        for s in order.tolist()[1:]:
            short[s] = s if whole[s] else short[link[s]]
        keys = np.array([s * (len(index) + 1) + w for s, nxt in enumerate(a.next) for w in nxt], np.int64)
        to = np.array([t for nxt in a.next for t in nxt.values()], np.int32)
        by = np.argsort(keys)
        pairs = np.unique(np.array([x * (len(index) + 1) + y for p in parts for x, y in zip(p, p[1:])], np.int64))
        sets = sorted(items.items())
        rows = {"length": length, "link": link, "top": top, "short": short, "whole": whole.astype(np.int8), "keys": keys[by], "to": to[by], "pairs": pairs,
                "holders": np.array([s for s, _ in sets], np.int32), "sizes": np.array([len(x) for _, x in sets], np.int64),
                "held": np.array([i for _, x in sets for i in sorted(x)], np.int32),
                "last": np.array(sorted({p[-1] for p in parts if len(p) < window}), np.int64)}
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "names": [list(names)], "words": [b" ".join(index)]}
                            | {k: [v.tobytes()] for k, v in rows.items()})
    return run


_DTYPES = {"length": np.int32, "link": np.int32, "top": np.int32, "short": np.int32, "whole": np.int8, "keys": np.int64, "to": np.int32, "pairs": np.int64,
           "holders": np.int32, "sizes": np.int64, "held": np.int32, "last": np.int64}
_SCHEMA = "block long, names array<string>, words binary, " + ", ".join(f"{k} binary" for k in _DTYPES)


class Matcher:
    """A block's automaton, ready to read documents."""

    def __init__(self, block: dict, window: int):
        a = {k: np.frombuffer(block[k], t) for k, t in _DTYPES.items()}
        self.window = window
        self.index = {w: i for i, w in enumerate(block["words"].split(b" "), 1)}
        self.base = len(self.index) + 1
        self.pairs, self.last = a["pairs"], a["last"]
        self.keys, self.to = array("q", a["keys"].tobytes()), array("i", a["to"].tobytes())
        self.length, self.link, self.top, self.short = (array("i", a[k].tobytes()) for k in ("length", "link", "top", "short"))
        ends = np.cumsum(a["sizes"])
        self.names, self.held = block["names"], a["held"]
        self.slices = dict(zip(a["holders"].tolist(), zip((ends - a["sizes"]).tolist(), ends.tolist())))

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of known words whose neighbours occur in some item, if a window fits in."""
        n = len(ids)
        if not n:
            return []
        joined = np.zeros(n + 1, bool)  # word i goes on from word i - 1
        both = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
        if len(both) and len(self.pairs):
            pair = ids[both] * self.base + ids[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[both[self.pairs[at] == pair] + 1] = True
        first = np.flatnonzero(~joined[:n])
        stop = np.append(first[1:], n)
        good = stop - first >= self.window
        if len(self.last):  # a shorter item may end here
            ends = np.concatenate([[0], np.cumsum(np.isin(ids, self.last))])
            good |= ends[stop] > ends[first]
        good &= ids[first] > 0
        return list(zip(first[good].tolist(), stop[good].tolist()))

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """(first word, words, longest match) of every maximal stretch of hit words, and the items found."""
        get = self.index.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        spans: list[list[int]] = []
        found: set[int] = set()
        keys, to, length, link, top, short = self.keys, self.to, self.length, self.link, self.top, self.short
        base, window, count = self.base, self.window, len(self.keys)
        for a, z in self.runs(ids):
            state = size = 0
            for i, w in enumerate(ids[a:z].tolist(), a):
                while True:
                    key = state * base + w
                    at = bisect_left(keys, key)
                    if at < count and keys[at] == key:
                        state, size = to[at], size + 1
                        break
                    if not state:
                        size = 0
                        break
                    state = link[state]
                    size = length[state]
                hit = 0
                if size >= window:
                    hit = window
                    found.add(top[state])
                s = short[state]
                if s and length[s] > size:  # the state's own item is longer than what was read
                    s = short[link[s]]
                while s:
                    hit = max(hit, length[s])
                    found.add(s)
                    s = short[link[s]]
                if hit:
                    self._mark(spans, i + 1 - hit, i + 1, size)
        held = [self.held[slice(*self.slices[s])] for s in found]
        return [(a, z - a, best) for a, z, best in spans], {self.names[i] for x in held for i in x.tolist()}

    @staticmethod
    def _mark(spans: list[list[int]], a: int, z: int, size: int) -> None:
        while spans and spans[-1][1] >= a:  # touches what was hit before
            b, _, best = spans.pop()
            a, size = min(a, b), max(size, best)
        spans.append([a, z, size])


def merge(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal stretches of the spans of several blocks."""
    out: list[list[int]] = []
    for a, n, best in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1][1], out[-1][2] = max(out[-1][1], a + n), max(out[-1][2], best)
        else:
            out.append([a, a + n, best])
    return [(a, z - a, best) for a, z, best in out]


def cut_out(data: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text without the spans' bytes, from first to last character of each."""
    first, last = word_ends(data)
    at, kept = 0, []
    for a, n, _ in spans:
        kept.append(data[at:first[a]])
        at = int(last[a + n - 1])
    return b"".join([*kept, data[at:]])


_SPAN = pa.struct([("first", pa.int32()), ("words", pa.int32()), ("longest", pa.int32())])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def _scan(shared: list, window: int, text_col: str, with_text: bool):
    """Reads every text through the automata and adds what they find to ``found``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(s.value, window) for s in shared]
        for b in batches:
            out = []
            for data, old in zip(texts_of(b, text_col).cast(pa.binary()).to_pylist(), b.column("found").to_pylist()):
                words = words_of(data or b"")
                spans, items = [tuple(s.values()) for s in old["spans"]], set(old["items"])
                for m in matchers:
                    more, names = m.read(words)
                    spans += more
                    items |= names
                out.append({"n_words": len(words), "spans": [dict(zip(("first", "words", "longest"), s)) for s in merge(spans)], "items": sorted(items)})
            names = [n for n in b.schema.names if n == "row" or n == "text" and with_text]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(out, _FOUND)], names=[*names, "found"])
    return run


def _free(texts: pd.Series, firsts: pd.Series, counts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else cut_out(t.encode(), list(zip(a, n, n))).decode() for t, a, n in zip(texts, firsts, counts)], dtype=object)


def item_parts(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, words): the items' normalised words joined by spaces; an item of more than PART_WORDS words as
    parts that overlap by window - 1 words, so that each window lies in one."""
    step = PART_WORDS - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, data in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                w = words_of(data or b"")
                for k in range(0, max(1, len(w) - window + 1) if w else 0, step):
                    part = w[k:k + PART_WORDS]
                    rows.append((item, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64()))] if rows
                                             else [pa.array([], t) for t in (pa.string(), pa.binary(), pa.int64())], names=["item", "words", "n"])
    texts = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "item string, words binary, n long")


def find_items(docs: DataFrame, items: DataFrame, window: int = 10, keep: list[str] | None = None, text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(row, n_words, spans, items), one row per input row: its columns ``keep`` (all) as a struct, its words, the
    maximal stretches (first, words, longest) of words inside any occurrence of a window, and the items with
    occurring windows, sorted as strings.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    ``longest`` is the longest match with an item (with a part of PART_WORDS, if it is longer) that ends in the
    stretch. Defined cases: null texts have no words; an item without id marks words but is not named; repeated
    items count once; documents keep repeated rows; without items nothing is found; extra columns of any name
    only travel in ``row``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = staged(item_parts(items, window, item_col, item_text).distinct(), "item-parts")
    blocks = max(1, math.ceil((parts.agg(F.sum("n")).first()[0] or 0) / BLOCK_WORDS))
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    automata = staged(dealt.groupBy("block").applyInPandas(_build(window), _SCHEMA), "automata")
    nothing = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<first:int,words:int,longest:int>>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    rows = row_and_text(docs, docs.columns if keep is None else keep, text_col).withColumn("found", nothing)
    for k in range(0, blocks, PASSES_A_STAGE):
        shared = [spark.sparkContext.broadcast(r.asDict()) for r in automata.where(F.col("block").between(k, k + PASSES_A_STAGE - 1)).collect()]
        last = k + PASSES_A_STAGE >= blocks
        out = T.StructType([f for f in rows.schema if not (last and f.name == "text")])
        rows = rows.mapInArrow(_scan(shared, window, text_col, not last), out)
        rows = rows if last else staged(rows, "found")
    return rows.select("row", "found.*")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, min_longest: int = 10, max_coverage: float = 0.5,
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns of ``docs`` with the text freed of every stretch whose longest match has ``min_longest`` words or
    more (from its first to its last character), and (n_words, n_hit, spans, items, rejected): rejected documents
    have more than ``max_coverage`` of their words hit. Columns of docs with these names are replaced.

    Defined cases as in ``find_items``; a document without words has no coverage and is not rejected.
    """
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    out = find_items(docs, items, window, None, text_col, item_col, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    long = F.filter("spans", lambda s: s["longest"] >= min_longest)
    text = F.col("row").getField(text_col)
    free = F.pandas_udf(_free, "string")
    freed = F.when(F.size(long) > 0, free(text, F.transform(long, lambda s: s["first"]), F.transform(long, lambda s: s["words"]))).otherwise(text)
    own = {"n_words", "n_hit", "spans", "items", "rejected", text_col}
    cols = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in own]
    return out.select(*cols, freed.alias(text_col), "n_words", n_hit.alias("n_hit"), "spans", "items",
                      (n_hit > max_coverage * F.col("n_words")).alias("rejected"))
