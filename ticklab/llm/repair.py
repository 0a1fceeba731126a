"""Conversation structure repair through a suffix-shared automaton of role/fault signatures.

1. Rows get their place in their conversation by a range partition, and every ``SEGMENT`` places are one segment
   (almost every conversation has one). A segment's signature has one letter a row: its role's initial, whether
   the row is truncated, or that it has to go.
2. The distinct signatures are sorted by their reversed text, so that those with common endings are neighbours,
   and merged from the end: a node stands for one ending, whatever signatures share it. Each node holds, for
   every pair of grammar states before and after it, the cheapest cost and the least audit among the cheapest
   (``Node``); it is computed once, from the node of the ending that is one letter shorter.
3. A conversation's segments are put together by cost from the end, then each chooses its audit from the start.

Grammar of the kept roles' initials: ``(s?(ua)+)?``. States: 0 nothing yet, 1 after s, 2 after u, 3 after a;
0 and 3 may end. Inserts belong to the row after them, those of the end to the conversation, so every audit of a
segment ends with a row's letter: two different audits between the same rows never begin with each other, and the
choice of the earlier segment never waits for a later one's letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import BLANKS, staged
from ticklab.operators.layout import with_positions

SEGMENT = 512
HEAVY = 0.001  # share of all segments above which a signature's solution is broadcast: at most 1000 of them
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # fixed costs
STATES = range(4)
#: After a state, the role that user/assistant alternation asks for next, and the state it leads to.
NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
ENDS = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}  # cheapest way to an end
INF = 1 << 40

Best = tuple[int, str]  # cost, audit: smaller is better
Node = list[list[Best]]  # [state before][state after]


def grow(letter: str, rest: Node | None) -> Node:
    """The node of ``letter`` followed by the ending ``rest``.

    Letters: d must go; s, u, a, x (any other role) may stay; upper case: truncated."""
    def go(state: int, after: int, cost: int, mark: str) -> Best:
        if rest is None:
            return (cost, mark) if state == after else (INF, "")
        c, text = rest[state][after]
        return (cost + c, mark + text) if c < INF else (INF, "")

    extra = TRUNCATED if letter.isupper() else 0
    low = letter.lower()
    row: Node = []
    for q in STATES:
        role, to = NEXT[q]
        ways = [[go(q, z, DELETE, "D")] for z in STATES]
        if low != "d":
            for z in STATES:
                ways[z].append(go(to, z, REROLE + extra, "R"))
                if low == role:
                    ways[z].append(go(to, z, KEEP + extra, "K"))
                if q == 0 and low == "s":
                    ways[z].append(go(1, z, KEEP + extra, "K"))
        row.append([min(w) for w in ways])

    def inserted(q: int, base: Node) -> list[Best]:
        to = NEXT[q][1]
        return [min(row[q][z], (INSERT + base[to][z][0], "I" + base[to][z][1]) if base[to][z][0] < INF else (INF, "")) for z in STATES]
    once = [inserted(q, row) for q in STATES]
    return [inserted(q, once) for q in STATES]  # two inserts: s, then user and assistant


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reversed signatures in order; the path of the last one is kept, nodes of a common ending are there already."""
    path, nodes = "", []
    for b in batches:
        out = []
        for sig in b.column(0).to_pylist():
            same = 0
            while same < min(len(sig), len(path)) and sig[same] == path[same]:
                same += 1
            del nodes[same:]
            for c in sig[same:]:
                nodes.append(grow(c, nodes[-1] if nodes else None))
            path = sig
            best = nodes[-1]
            ranks = []
            for q in STATES:
                audits = sorted({text for c, text in best[q] if c < INF})
                ranks += [audits.index(text) if c < INF else -1 for c, text in best[q]]
            out.append((sig[::-1], [c if c < INF else -1 for q in best for c, _ in q], ranks, [text if c < INF else None for q in best for c, text in q]))
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, kinds)], names=["sig", "costs", "ranks", "audits"])


def choose(segments: list[dict]) -> tuple[int, list[tuple[int, int]]]:
    """(cost, state before and after every segment) of the least of a conversation's cheapest repairs."""
    ahead = [[ENDS[q][0] for q in STATES]]  # cost from each state to the end
    for s in reversed(segments):
        c = s["costs"]
        ahead.append([min((c[4 * q + z] + ahead[-1][z] for z in STATES if c[4 * q + z] >= 0), default=INF) for q in STATES])
    ahead.reverse()
    at, out = 0, []
    for k, s in enumerate(segments):
        ways = [(s["ranks"][4 * at + z], z) for z in STATES if s["costs"][4 * at + z] >= 0 and s["costs"][4 * at + z] + ahead[k + 1][z] == ahead[k][at]]
        z = min(ways)[1]
        out.append((at, z))
        at = z
    return ahead[0][0], out


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for name, segments in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            cost, states = choose(segments)
            rows += [(name, s["chunk"], cost, q, z, k + 1 == len(states)) for k, (s, (q, z)) in enumerate(zip(segments, states))]
        kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=["name", "chunk", "cost", "before", "after", "last"])


def rebuild(rows: list[dict], audit: str, before: int, after: int, last: bool) -> list[tuple[str, str]]:
    """A segment's repaired (role, text) rows."""
    state, out = before, []

    def put(row):
        nonlocal state
        role, to = NEXT[state]
        out.append(row if row[0] is not None else ({"u": "user", "a": "assistant"}[role], row[1]))
        state = 1 if state == 0 and row[0] is not None and row[0][:1] == "s" else to
    for edits, row in zip(re.findall("I*[KRD]", audit), rows):
        for _ in edits[:-1]:
            put((None, ""))
        if edits[-1] != "D":
            put((row["role"] if edits[-1] == "K" else None, row["text"]))
    if last:
        for _ in ENDS[after][1]:
            put((None, ""))
    return out


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = pa.struct([("role", pa.string()), ("text", pa.string())])
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("rows", "audit", "before", "after", "last")]
        found = [[{"role": r, "text": t} for r, t in rebuild(*x)] for x in zip(*cols)]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("chunk"), pa.array(found, pa.list_(row))], names=["conv", "chunk", "repaired"])


def numbered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(name, conv, pos, turn, role, text, h, g, own), staged: every row with its place in its conversation and what its
    own text shows (blank, truncated or null)."""
    null = F.lit(" ")
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), null).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), null).alias("text"))
    name = F.when(F.col("conv").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("conv").cast("string")))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    rows = rows.withColumns({"name": name, "h": F.xxhash64("text"), "g": F.xxhash64("text", F.lit(1)), "rid": F.monotonically_increasing_id(),
                             "own": F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated")})
    return staged(with_positions(rows, ("name",), ("turn", "role", "h", "g", "rid"), "pos").drop("rid"), "repair-rows")


def faults(placed: DataFrame) -> DataFrame:
    """(name, conv, pos, turn, role, fault), staged: the first fault of every row of ``numbered``."""
    # the first of equal rows: combined before the shuffle, then one row a place
    first = placed.groupBy("name", "role", "h", "g").agg(F.min("pos").alias("pos")).select("name", "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("own") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("own"))
    return staged(placed.join(first, ["name", "pos"], "left").select("name", "conv", "pos", "turn", "role", fault.alias("fault")), "repair-faults")


def solve(signatures: DataFrame) -> DataFrame:
    """(sig, costs, ranks, audits) of every distinct signature ``sig``; the arrays run over 4 states before times 4
    after, -1 or null where no audit leads from one to the other; ranks order the audits of one state before."""
    back = signatures.select(F.reverse("sig").alias("back")).distinct()
    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return back.repartitionByRange(n, "back").sortWithinPartitions("back").mapInArrow(_solve, "sig string, costs array<long>, ranks array<int>, audits array<string>")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, segments) of a log after whatever damage it took.

    Conversations: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit). Segments: (conv, chunk, repaired),
    the repaired (role, text) rows of every SEGMENT rows in order. Edits as the module says; the cheapest are taken,
    of equal ones those with the ASCII-least audit.

    Defined cases: null roles and texts are one space (a blank row, to be deleted); a null turn comes first and counts
    in no gap; a null conversation is a conversation; repeated rows are duplicates; rows of one turn go by role, then
    by the text's hash; extra columns are ignored; an empty table gives no rows. A conversation may be of any length
    up to the 2 GB of its audit: one task holds its segments' costs, 200 bytes for every 512 rows.
    """
    placed = numbered(rows, conv_col, turn_col, role_col, text_col)
    marked = faults(placed)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    chunk = F.floor(F.col("pos") / SEGMENT).alias("chunk")
    marks = marked.groupBy("name", chunk).agg(F.array_sort(F.collect_list(F.struct("pos", letter.alias("letter"), kind.alias("kind")))).alias("marks"))
    kinds = F.transform("marks", lambda m: m["kind"])
    segs = staged(marks.select("name", "chunk", F.array_join(F.transform("marks", lambda m: m["letter"]), "").alias("sig"), _illegal(kinds, kinds).alias("wrong"),
                               F.get(kinds, F.lit(0)).alias("first"), F.element_at(kinds, -1).alias("final")), "repair-segments")
    solved = staged(solve(segs), "repair-solved")
    often = segs.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.greatest(F.lit(1.0), F.lit(HEAVY) * segs.count()))
    often = F.broadcast(staged(often.select("sig"), "repair-heavy"))  # at most 1 / HEAVY signatures
    known = staged(segs.join(F.broadcast(solved.join(often, "sig")), "sig").unionByName(segs.join(often, "sig", "left_anti").join(solved, "sig")), "repair-known")

    whole = known.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("chunk", "costs", "ranks"))).alias("segments"))
    states = whole.mapInArrow(_chosen, "name string, chunk long, cost long, before int, after int, last boolean")
    states = staged(known.select("name", "chunk", "wrong", "first", "final", "audits").join(states, ["name", "chunk"])
                    .withColumn("audit", F.get("audits", F.col("before") * 4 + F.col("after"))).drop("audits"), "repair-states")

    tail = F.coalesce(*[F.when(F.col("last") & (F.col("after") == q), text) for q, (_, text) in ENDS.items()], F.lit(""))
    ends = states.groupBy("name").agg(F.first("cost").alias("cost"), F.sum("wrong").alias("wrong"), F.array_sort(F.collect_list(
        F.struct("chunk", F.concat("audit", tail).alias("audit"), "first", "final"))).alias("parts"))
    between = _illegal(F.transform("parts", lambda p: p["final"]), F.transform("parts", lambda p: p["first"]))
    ends = ends.select("name", "cost", (F.col("wrong") + between).alias("illegal"), F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    found = ("blank", "duplicate", "truncated")
    turns = marked.groupBy("name", "conv", "turn").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in found])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    counts = turns.groupBy("name", "conv").agg(gaps, *[F.sum(f).alias(f) for f in found])
    conversations = counts.join(ends, "name").select("conv", "gaps", *found, "illegal", "cost", "audit")

    texts = placed.groupBy("name", "conv", chunk).agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    segments = (texts.join(states.select("name", "chunk", "audit", "before", "after", "last"), ["name", "chunk"])
                .select("conv", "chunk", "rows", "audit", "before", "after", "last")
                .mapInArrow(_rebuilt, f"conv {dict(placed.dtypes)['conv']}, chunk long, repaired array<struct<role:string,text:string>>"))
    return conversations, segments


def _illegal(before, after):
    """Adjacent pairs that no legal conversation has: each of ``before`` but the last, with the next of ``after``."""
    n = F.size(before)
    pairs = F.zip_with(F.slice(before, 1, F.greatest(n - 1, F.lit(0))), F.slice(after, 2, n), lambda a, b: F.concat(a, b))
    return F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long")
