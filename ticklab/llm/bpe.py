"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

Encoding:

1. Every partition splits its documents into pre-tokens and numbers the distinct ones of a block (up to
   BLOCK_TOKENS pre-tokens); a document becomes the sequence of its words' numbers, by position.
2. Each block's distinct words go to word shards, one packed row per (block, shard). A shard encodes
   each distinct word once, whatever number of blocks ask for it, and answers with packed ids (a shard of
   more than KNOWN_WORDS words starts its table afresh, so its memory is bounded). A very common word costs
   one entry a block, never one row an occurrence.
3. Answers meet the block's sequences by block key; ids are reassembled by position.

Step 1 runs once for the words and once for the sequences (cheaper than keeping the sequences on disk);
checksums over each block's words tie the two together, so a block that was read differently fails
loudly instead of mixing up words.

Decoding joins ids with the token-byte table: the table is the vocabulary, bounded and read once a worker, and
dense in the id, so that the join is an array lookup beside each document.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import bounded_batches
from ticklab.llm.pretokens import split_batches

BLOCK_TOKENS = 1 << 21
GATHERED = 1 << 18  # pre-tokens whose ids are gathered at a time
KNOWN_WORDS = 1_000_000  # a shard worker's words start afresh beyond this
SHARD_BYTES = 8 << 20
MAX_SHARDS = 8192


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
    """flat[begin[i]:begin[i] + size[i]] for every i of ``index``, one after the other."""
    n = size[index]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(begin[index] - (ends - n), n)]


def pack_lists(sizes: np.ndarray, flat: bytes) -> bytes:
    return np.array([len(sizes)], "<u4").tobytes() + sizes.astype("<u4").tobytes() + flat


def unpack_lists(data: bytes) -> tuple[np.ndarray, bytes]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    return np.frombuffer(data, "<u4", n, 4).astype(np.int64), data[4 + 4 * n:]


class _Block:
    """Distinct words of consecutive documents, and the documents as word numbers."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.docs, self.sizes, self.parts, self.tokens = [], [], [], 0

    def add(self, ids: list, texts: list[str]) -> None:
        index = self.index
        for i, j, words, which, counts in split_batches(texts):
            for w in words:
                if w not in index:
                    index[w] = len(index)
            self.parts.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words))[which])
            self.sizes.append(counts)
            self.tokens += len(which)
            self.docs += ids[i:j]

    def shards(self, n: int) -> tuple[list[tuple[bytes, int]], np.ndarray]:
        """Packed words and checksum of every shard; rank of each word in shard order."""
        words = [w.encode() for w in self.index]
        shard = np.fromiter((zlib.crc32(w) % n for w in words), np.int64, len(words))
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(n + 1))
        out = []
        for s in range(n):
            mine = [words[i] for i in order[bounds[s]:bounds[s + 1]]]
            blob = pack_lists(np.array([len(w) for w in mine], np.int64), b"".join(mine))
            out.append((blob, zlib.crc32(blob)))
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        return out, rank


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
    key, block = TaskContext.get().partitionId() << 32, _Block()
    for b in batches:
        # small steps keep a block near its bound
        for k in range(0, b.num_rows, 512):
            part = b.slice(k, 512)
            block.add(part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()])
            if block.tokens >= BLOCK_TOKENS:
                yield key, block
                key, block = key + 1, _Block()
    if block.docs:
        yield key, block


def _words(shards: int):
    def run(batches):
        for key, block in _blocks(batches):
            packed = [(s, blob, crc) for s, (blob, crc) in enumerate(block.shards(shards)[0]) if len(blob) > 4]
            yield pa.RecordBatch.from_pydict({"block": pa.array([key] * len(packed), pa.int64()), "shard": pa.array([p[0] for p in packed], pa.int32()),
                                              "words": pa.array([p[1] for p in packed], pa.binary()), "crc": pa.array([p[2] for p in packed], pa.int64())})
    return run


def _sequences(shards: int):
    def run(batches):
        for key, block in _blocks(batches):
            packed, rank = block.shards(shards)
            seq = np.concatenate(block.parts) if block.parts else np.zeros(0, np.int32)
            # numbers by falling frequency, high and low bytes apart: compresses best
            by_use = np.argsort(-np.bincount(seq, minlength=len(rank)), kind="stable")
            use = np.empty(len(rank), np.int32)
            use[by_use] = np.arange(len(rank), dtype=np.int32)
            planes = np.ascontiguousarray(use[seq].astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()
            zip_ = zstandard.ZstdCompressor(level=3).compress
            crcs = np.array([crc if len(blob) > 4 else -1 for blob, crc in packed], "<i8")
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([key], pa.int64()), "docs": pa.array([block.docs], pa.list_(pa.int64())),
                "sizes": pa.array([np.concatenate(block.sizes).astype("<i8").tobytes() if block.sizes else b""], pa.binary()),
                "seq": pa.array([zip_(planes)], pa.binary()), "order": pa.array([zip_(rank[by_use].astype("<i4").tobytes())], pa.binary()),
                "crcs": pa.array([crcs.tobytes()], pa.binary())})
    return run


def _encode_words(path: str, pattern: str):
    def run(batches):
        enc, known, wide = encoding(path, pattern), {}, "<u4" if len(ranks(path)) > 1 << 16 else "<u2"
        for b in batches:
            out = []
            for blob in b.column("words"):
                sizes, flat = unpack_lists(blob.as_py())
                ends = np.cumsum(sizes).tolist()
                words = [flat[i:j] for i, j in zip([0, *ends[:-1]], ends)]
                if len(known) > KNOWN_WORDS:
                    known.clear()
                new = list({w for w in words if w not in known})
                for w, ids in zip(new, enc.encode_ordinary_batch([w.decode() for w in new], num_threads=1)):
                    known[w] = np.array(ids, wide).tobytes()
                ids = [known[w] for w in words]
                out.append(pack_lists(np.array([len(x) // np.dtype(wide).itemsize for x in ids], np.int64), b"".join(ids)))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("shard"), pa.array(out, pa.binary()), b.column("crc")],
                                             names=["block", "shard", "ids", "crc"])
    return run


def _reassemble(path: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wide = "<u4" if len(ranks(path)) > 1 << 16 else "<u2"
        a, right = {n: left.column(n)[0] for n in left.column_names}, right.sort_by("shard")
        crcs = np.frombuffer(a["crcs"].as_py(), "<i8")
        if crcs[crcs >= 0].tolist() != right.column("crc").to_pylist():
            raise ValueError("a block was read differently the second time; stage the documents first")
        packed = [unpack_lists(x.as_py()) for x in right.column("ids")]
        size = np.concatenate([p[0] for p in packed]) if packed else np.zeros(0, np.int64)
        flat = np.frombuffer(b"".join(p[1] for p in packed), wide)
        begin = np.cumsum(size) - size
        del packed
        unzip = zstandard.ZstdDecompressor().decompress
        seq = np.ascontiguousarray(np.frombuffer(unzip(a["seq"].as_py()), np.uint8).reshape(4, -1).T).view("<i4").ravel()
        order = np.frombuffer(unzip(a["order"].as_py()), "<i4")
        size, begin = size[order], begin[order]
        ids, at = np.empty(int(size[seq].sum()), "<u4"), 0
        for k in range(0, len(seq), GATHERED):
            part = gather(flat, begin, size, seq[k:k + GATHERED])
            ids[at:at + len(part)] = part
            at += len(part)
        # ids before each document's end, in bytes
        words = np.concatenate([[0], np.cumsum(size[seq])])
        ends = 4 * words[np.cumsum(np.frombuffer(a["sizes"].as_py(), "<i8"))]
        offsets = np.concatenate([[0], ends]).astype("<i4" if len(ids) < 1 << 29 else "<i8")
        kind = pa.binary() if len(ids) < 1 << 29 else pa.large_binary()
        data = pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        return pa.table({"doc_id": pa.array(a["docs"].as_py(), pa.int64()), "ids": data.cast(pa.binary())})
    return run


def word_shards(texts: DataFrame) -> int:
    """Word shards from the optimizer's size estimate: SHARD_BYTES of input each, so that a task's share stays the same;
    at most MAX_SHARDS, since every block sends a row to every shard."""
    plan = getattr(texts, "_jdf", None)
    size = int(plan.queryExecution().optimizedPlan().stats().sizeInBytes()) if plan else 1 << 62
    if size >= 1 << 60:  # no estimate
        return int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_SHARDS, max(1, -(-size // SHARD_BYTES)))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers, one row per input row.

    ``path``: a rank file (base64 token, rank a line). Defined cases: null or empty text has no ids; ids
    and texts may repeat; a null id stays null; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = word_shards(texts)
    words = texts.mapInArrow(_words(shards), "block long, shard int, words binary, crc long")
    answers = (words.repartition(shards, "shard").mapInArrow(_encode_words(path, pattern), "block long, shard int, ids binary, crc long"))
    seqs = texts.mapInArrow(_sequences(shards), "block long, docs array<long>, sizes binary, seq binary, order binary, crcs binary")
    return (seqs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_reassemble(path), "doc_id long, ids binary"))


@functools.cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and begin and length by id."""
    by_id = {rank: token for token, rank in ranks(path).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def _decode(path: str):
    def run(batches):
        flat, begin, size = token_bytes(path)
        for b in batches:
            out = [gather(flat, begin, size, np.frombuffer(x.as_py(), "<u4")).tobytes() for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])
    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, bytes) of an encoded table (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids binary, bytes binary")
