"""Merkle manifest of a dataset with incremental witnesses.

Leaves of a group (one language, say) are ordered by id and form a tree of runs of ``ARITY``; the groups'
subroots form a tree above them. A leaf's witness lists, from below, its place in its run and the run's other
nodes, and so leads from the leaf to the root.

1. Leaves get their position by a range partition (no task per group), and are dealt into aligned blocks of
   ARITY^``LEVELS`` positions.
2. A block's task appends its leaves one after the other. Every open subtree keeps the partial witnesses of its
   leaves; when a run's last sibling is appended, the run becomes a node of the next level and all witnesses
   under it grow by their siblings.
3. Block roots are appends of their own: they are positions of the next round, in blocks again, until each group
   has one block. The witness of a block's root, found in the last step from the top down, extends those of all
   its leaves.

A round is 4 levels: ten thousand million leaves take three. No task holds more than one block, and only the
root passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklab.llm.common import staged
from ticklab.operators.layout import with_positions

ARITY = 8
LEVELS = 4


def digest(parts: list[bytes]) -> bytes:
    """sha256 of the digests' hex texts, one after the other."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf_text(*cols: str):
    """The bytes a leaf's sha256 is taken of: each column as ``-`` if null, else UTF-8 byte count, ``:``, value."""
    def field(c):
        value = F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.concat(*[field(c) for c in cols])


def step(place: int, run: list[bytes]) -> bytes:
    """One level of a witness: place in the run, its size, the other nodes' digests."""
    return bytes([place, len(run)]) + b"".join(run[:place] + run[place + 1:])


def siblings(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place, the run's other digests) of every level, from below."""
    at = 0
    while at < len(witness):
        place, size = witness[at], witness[at + 1]
        yield place, [witness[k:k + 32] for k in range(at + 2, at + 2 + 32 * (size - 1), 32)]
        at += 2 + 32 * (size - 1)


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, others in siblings(witness):
        leaf = digest([*others[:place], leaf, *others[place:]])
    return leaf


def proof(witness: bytes) -> bytes:
    """Digest of all siblings, level by level, left to right."""
    return digest([d for _, others in siblings(witness) for d in others])


class OpenTree:
    """Aligned appends: ``levels[k]`` is the open run of level k, its nodes as (digest, leaf numbers below)."""

    def __init__(self) -> None:
        self.levels: list[list[tuple[bytes, range]]] = [[]]
        self.witness: list[list[bytes]] = []

    def append(self, leaf: bytes) -> None:
        n = len(self.witness)
        self.witness.append([])
        self._put(0, leaf, range(n, n + 1))

    def _put(self, level: int, node: bytes, below: range) -> None:
        if level == len(self.levels):
            self.levels.append([])
        run = self.levels[level]
        run.append((node, below))
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The run becomes a node of the next level; the witnesses under it grow by its siblings."""
        run = self.levels[level]
        self.levels[level] = []
        nodes = [d for d, _ in run]
        for place, (_, below) in enumerate(run):
            part = step(place, nodes)
            for leaf in below:
                self.witness[leaf].append(part)
        self._put(level + 1, digest(nodes), range(run[0][1].start, run[-1][1].stop))

    def close(self, levels: int | None) -> bytes:
        """The root after ``levels`` levels, or (None) as soon as one node is left."""
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            run, above = self.levels[level], any(self.levels[level + 1:])
            if level == levels or levels is None and len(run) == 1 and not above:
                return run[0][0]
            if run:
                self._complete(level)
            level += 1


def _tree(pdf: pd.DataFrame, n: int, levels: int) -> tuple[pd.DataFrame, OpenTree, bytes]:
    """A block of a group of ``n`` nodes: its rows in order, its tree and its root."""
    pdf = pdf.sort_values("pos")
    tree = OpenTree()
    for d in pdf["node"]:
        tree.append(bytes(d))
    return pdf, tree, tree.close(None if n <= ARITY**levels else levels)


def _roots(levels: int):
    def run(pdf: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        """A block (grp, block, pos, node) to its root, a node of the next round."""
        _, _, root = _tree(pdf, int(sizes["n"].iloc[0]), levels)
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "pos": [int(pdf["block"].iloc[0])], "node": [root]})
    return run


def _witnesses(carry: list[str], roots: list[str], levels: int):
    def run(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        """A block and its root's witness to the witness of every member."""
        pdf, tree, _ = _tree(pdf, int(above["n"].iloc[0]), levels)
        rest = bytes(above["witness"].iloc[0])
        out = pdf[["grp", "pos", *carry, "node"]].assign(witness=[b"".join(w) + rest for w in tree.witness])
        return out.assign(**{c: [above[c].iloc[0]] * len(out) for c in roots})
    return run


def _sized(nodes: DataFrame) -> DataFrame:
    """(grp, block, n): the blocks of every group and the group's nodes. The window holds a group's blocks, not its
    nodes; a node learns n through its block, so no join has a group as key."""
    blocks = nodes.groupBy("grp", "block").agg(F.count(F.lit(1)).alias("size"))
    return blocks.select("grp", "block", F.sum("size").over(Window.partitionBy("grp")).alias("n"))


def _forest(nodes: DataFrame, carry: list[str], levels: int, extend=None) -> tuple[DataFrame, DataFrame]:
    """(roots, witnesses): ``nodes`` (grp, pos, node, ...) has positions without gaps from 0 in each grp. Roots are
    (grp, node). ``extend(roots)`` gives (grp, witness, subroot, root): what lies above the roots."""
    rounds = []
    while True:
        nodes = nodes.withColumn("block", F.floor(F.col("pos") / ARITY**levels))
        sizes = staged(_sized(nodes), "merkle-sizes")
        rounds.append((nodes, sizes))
        found = nodes.select("grp", "block", "pos", "node").groupBy("grp", "block").cogroup(sizes.groupBy("grp", "block"))
        nodes = staged(found.applyInPandas(_roots(levels), "grp string, pos long, node binary"), "merkle-roots")
        if not sizes.where(F.col("block") > 0).limit(1).count():  # every group is one block
            break
    roots = nodes.select("grp", "node")
    above = extend(roots) if extend else roots.select("grp", F.lit(b"").alias("witness"))
    ends = [c for c in above.columns if c in ("subroot", "root")]
    above = above.select("grp", F.lit(0).cast("long").alias("block"), "witness", *ends)
    for k in range(len(rounds) - 1, -1, -1):
        below, sizes = rounds[k]
        own = carry if k == 0 else []
        kinds = dict(below.dtypes)
        schema = ", ".join(["grp string", "pos long", *(f"`{c}` {kinds[c]}" for c in own), "node binary", "witness binary", *(f"{c} binary" for c in ends)])
        found = (below.select("grp", "block", "pos", "node", *own).groupBy("grp", "block")
                 .cogroup(above.join(sizes, ["grp", "block"]).groupBy("grp", "block")).applyInPandas(_witnesses(own, ends, levels), schema))
        above = found if k == 0 else staged(found.select("grp", F.col("pos").alias("block"), "witness", *ends), "merkle-witnesses")
    return roots, above


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their position in ``grp``."""
    return staged(with_positions(rows, ("grp",), tuple(order), "pos"), "merkle-leaves")


def manifest(leaves: DataFrame, group_col: str = "lang", id_col: str = "doc_id", leaf_col: str = "leaf", carry: list[str] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """(grp, pos, id, leaf, carry..., subroot, root, witness), one row per row of ``leaves``: leaf is a sha256 digest
    (32 bytes); witness leads from it to the root (``fold``), ``pos`` is its place in its group.

    Groups are ordered null first, then bytewise; leaves by id, null first, then by digest (rows that repeat an id
    or a whole row are leaves of their own). A tree of one leaf is that leaf itself, also if it is the only group:
    its witness is empty. A task holds a block of 8^``levels`` leaves. Columns ``carry`` travel beside the leaf; others are ignored. An empty table gives no
    rows. ``grp`` is the group as a string with a leading ``1``, and ``0`` for null.
    """
    carry = carry or []
    grp = F.when(F.col(group_col).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string"))).alias("grp")
    rows = leaves.select(grp, F.col(id_col).alias("id"), F.col(leaf_col).alias("node"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    rows = staged(rows, "merkle-digests")  # the range partition reads its input twice: digests, not texts
    named = ["id", *[f"carry_{c}" for c in carry]]

    def over_groups(roots: DataFrame) -> DataFrame:
        one = _numbered(roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"), ["name"])
        root, found = _forest(one, ["name"], levels)
        whole = root.first()  # one row
        return staged(found.select(F.col("name").alias("grp"), "witness", F.col("node").alias("subroot"),
                                   F.lit(bytes(whole["node"]) if whole else None).cast("binary").alias("root")), "merkle-groups")

    _, out = _forest(_numbered(rows, ["id", "node"]), named, levels, over_groups)
    return out.select("grp", "pos", "id", F.col("node").alias("leaf"), *[F.col(f"carry_{c}").alias(c) for c in carry], "subroot", "root", "witness")


def _folder(leaf_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(proof=[proof(w) for w in b["witness"]], folded_root=[fold(x, w) for x, w in zip(b[leaf_col], b["witness"])]).drop(columns="witness")
    return run


def verify(rows: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """A manifest's rows without the witness, and (proof, folded_root, verified): the digest of all siblings, the
    root that ``leaf_col`` and the witness lead to, and whether that is the root."""
    cols = [f for f in rows.schema if f.name != "witness"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in cols), "proof binary", "folded_root binary"])
    return rows.mapInPandas(_folder(leaf_col), schema).withColumn("verified", F.col("folded_root") == F.col("root"))
