"""Decontamination, structure repair and Merkle manifest against brute force, with the defined edge cases."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F


def sha(t):
    return hashlib.sha256(t if isinstance(t, bytes) else t.encode()).hexdigest()


# ------------------------------------------------------------------ decontamination
def norm(t):
    low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits_reference(docs, items, window):
    out = []
    for _, t in docs:
        w, hit, names = norm(t), set(), set()
        for name, item in items:
            x = norm(item)
            m = min(window, len(x))
            for k in range(len(x) - m + 1 if m else 0):
                for i in range(len(w) - m + 1):
                    if w[i:i + m] == x[k:k + m]:
                        hit |= set(range(i, i + m))
                        names |= {str(name)} if name is not None else set()
        out.append((len(w), len(hit), sorted(names)))
    return out


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, words long, block string")


def doc_frame(spark, docs):
    return spark.createDataFrame([(i, t, [1], "x", True, "r") for i, t in docs], "doc_id long, text string, spans array<int>, found string, rejected boolean, row string")


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_matches_brute_force(spark, monkeypatch, seed):
    from ticklab.llm import decontaminate as d

    if seed:  # several blocks, several stages, items in overlapping parts
        monkeypatch.setattr(d, "BLOCK_WORDS", 40)
        monkeypatch.setattr(d, "PART_WORDS", 9)
        monkeypatch.setattr(d, "PASSES_A_STAGE", 2)
    r = random.Random(seed)
    vocab = ["a", "B", "ab", "Ä", "ä", "c1", "日本", "x", "y", "z"][:6 + 2 * seed]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "--", "\x00", " \x7f"]) for _ in range(n))
    items = [(k, text(r.choice([0, 1, 2, 3, 5, 12, 30]) + 0)) for k in range(14)] + [(None, text(6)), (3, text(8)), (100, "!!"), (101, None)]
    items += [items[4], (200, items[5][1])]  # a repeated row; one text under two ids
    docs = [(k, text(r.choice([0, 3, 40, 90]))) for k in range(25)] + [(None, text(30)), (1, None), (2, ""), (2, items[5][1] + " end"), (2, items[5][1] + " end")]
    got = d.find_items(doc_frame(spark, docs), item_frame(spark, items), window=4)
    rows = got.select("row.doc_id", "row.text", "n_words", "spans", "items").collect()
    want = hits_reference(docs, items, 4)
    key = lambda x: str(x)
    mine = [(x.doc_id, x.text, x.n_words, sum(s.words for s in x.spans), list(x["items"])) for x in rows]
    assert sorted(mine, key=key) == sorted([(i, t, *w) for (i, t), w in zip(docs, want)], key=key)
    for x in rows:  # stretches are maximal and in order
        assert all(a.first + a.words < b.first for a, b in itertools.pairwise(x.spans))


def test_decontamination_removes_spans_and_rejects(spark):
    from ticklab.llm.decontaminate import decontaminate

    item = " ".join(f"w{k}" for k in range(30))
    docs = [(1, "Before, W0 " + " ".join(f"w{k}" for k in range(1, 30)) + "! After it all " + "clean " * 80), (2, item), (3, "nothing here"), (4, None),
            (5, "x " * 50_000 + item + " y" * 50_000), (6, " ".join(f"w{k}" for k in range(9)))]
    out = {x.doc_id: x for x in decontaminate(doc_frame(spark, docs), item_frame(spark, [(1, item), (2, "gone gone")])).collect()}
    assert out[1].text.startswith("Before, ! After it all clean") and out[1].n_hit == 30 and not out[1].rejected and out[1].spans[0].longest == 30
    assert out[2].text == "" and out[2].rejected and out[2]["items"] == ["1"]
    assert out[3].text == "nothing here" and not out[3].rejected and out[3].row == "r" and out[3].found == "x"
    assert out[4].text is None and not out[4].rejected and out[4].n_words == 0
    assert out[5].text == "x " * 50_000 + " y" * 50_000 and out[5].n_hit == 30 and not out[5].rejected
    assert out[6].n_hit == 0
    longer = {x.doc_id: x for x in decontaminate(doc_frame(spark, docs), item_frame(spark, [(1, item)]), min_longest=31).collect()}
    assert longer[2].text == item and longer[2].n_hit == 30
    empty = decontaminate(doc_frame(spark, docs), item_frame(spark, [(1, item)]).limit(0))
    assert empty.where("size(spans) > 0").count() == 0 and empty.count() == 6
    assert decontaminate(doc_frame(spark, docs).limit(0), item_frame(spark, [(1, item)])).count() == 0


# ------------------------------------------------------------------ structure repair
BLANK = " \t\n\x0b\f\r"


def repair_reference(rows):
    """Cheapest repair of ordered (turn, role, text) rows by a plain table from the end over whole audits."""
    seen, marked = set(), []
    for _, role, text in rows:
        t = text.strip(BLANK)
        fault = "blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    nxt = {"": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
    # forward over all states with costs and audits, inserts anywhere: states (audit, output) kept by the least
    best = {("", ""): (0, "", ())}

    def insert(table):
        for _ in range(4):
            for (state, _), (c, a, out) in list(table.items()):
                for ch in "ua":
                    to = nxt[state].get(ch)
                    if to:
                        put(table, to, (c + 3, a + "I", (*out, ({"u": "user", "a": "assistant"}[ch], ""))))
        return table

    def put(table, state, value):
        k = (state, "")
        if k not in table or value[:2] < table[k][:2]:
            table[k] = value
    # a prefix may be the least of its state and lose later, so every audit of least cost or near it is kept
    beams = {(s, a): (c, a, out) for (s, _), (c, a, out) in best.items()}
    for role, text, fault in marked:
        for _ in range(3):
            for (s, a), (c, _, out) in list(beams.items()):
                for ch in "ua":
                    if nxt[s].get(ch) and a[-2:] != "II":
                        beams.setdefault((nxt[s][ch], a + "I"), (c + 3, a + "I", (*out, ({"u": "user", "a": "assistant"}[ch], ""))))
        new = {}
        for (s, a), (c, _, out) in beams.items():
            new.setdefault((s, a + "D"), (c + 4, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if nxt[s].get(role[:1]):
                new.setdefault((nxt[s][role[:1]], a + "K"), (c + more, a + "K", (*out, (role, text))))
            for ch in "ua":
                if nxt[s].get(ch):
                    new.setdefault((nxt[s][ch], a + "R"), (c + more + 3, a + "R", (*out, ({"u": "user", "a": "assistant"}[ch], text))))
        low = min(c for c, _, _ in new.values())
        beams = {k: v for k, v in new.items() if v[0] <= low + 9}
    ends = []
    for (s, a), (c, _, out) in beams.items():
        tail = {"": "", "A": "", "U": "a", "S": "ua"}[s]
        ends.append((c + 3 * len(tail), a + "I" * len(tail), (*out, *(({"u": "user", "a": "assistant"}[x], "") for x in tail))))
    cost, audit, out = min(ends)
    roles = [r[:1] for r, _, _ in marked]
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles)), cost, audit, "\n".join(f"{r}:{t}" for r, t in out))


def repaired(spark, rows):
    from ticklab.llm.repair import repair

    df = spark.createDataFrame([(*r, "x", 5, "y") for r in rows], "conv_id long, turn long, role string, text string, name string, pos int, sig string")
    out, segments = repair(df)
    texts = defaultdict(list)
    for s in sorted(segments.collect(), key=lambda s: s.chunk):
        texts[s.conv] += [f"{r.role}:{r.text}" for r in s.repaired]
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, "\n".join(texts[r.conv])) for r in out.collect()}


@pytest.mark.parametrize("segment", [512, 2])
def test_repair_matches_brute_force(spark, monkeypatch, segment):
    from ticklab.llm import repair as module

    monkeypatch.setattr(module, "SEGMENT", segment)
    r = random.Random(segment)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Sys"]
    texts = ["Yes.", "No!", "What?  ", "cut", "", " \n", "ü.", "end. "]
    rows = [(c, 2 * k + (k > 3), r.choice(roles), f"{r.choice(['', str(k)])}{r.choice(texts)}") for c in range(120) for k in range(r.randrange(0, 9))]
    rows += [(200, None, "user", "one."), (200, None, "user", "one."), (200, 4, None, None), (None, 0, "system", "alone."), (201, None, "system", "x.")]
    rows += [(202, 0, "user", "same.")] * 40  # one row, many times
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t, " " if role is None else role, " " if text is None else text))
    got = repaired(spark, rows)
    assert set(got) == set(groups)
    for c, mine in groups.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert got[c] == repair_reference(mine), (c, mine)


def test_repair_long_conversation_and_empty(spark):
    n = 3000  # six segments in one conversation
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}.") for k in range(n) if k % 1000 != 7]
    got = repaired(spark, rows)
    assert got[1][0] == 3 and got[1][5] == 9 and got[1][6].count("I") == 3 and got[1][6].count("K") == n - 3
    assert got[1][7].count("\n") == n - 1
    from ticklab.llm.repair import repair

    out, segments = repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").limit(0))
    assert out.count() == 0 and segments.count() == 0


def test_endings_are_solved_once(spark, monkeypatch):
    """Signatures with common endings share their nodes; the results are those of each on its own."""
    from ticklab.llm import repair as module
    import pyarrow as pa

    calls = []
    monkeypatch.setattr(module, "grow", lambda c, rest, f=module.grow: calls.append(c) or f(c, rest))
    sigs = sorted({"".join(p)[::-1] + "uaua"[::-1] for n in range(4) for p in itertools.product("suaAxd", repeat=n)} | {"auau"})
    batch = pa.RecordBatch.from_arrays([pa.array(sorted(s[::-1] for s in {x[::-1] for x in sigs}))], names=["back"])
    out = next(module._solve(iter([batch]))).to_pylist()
    nodes = {s[:k] for s in batch.column(0).to_pylist() for k in range(1, len(s) + 1)}
    assert len(calls) == len(nodes) < sum(len(s) for s in sigs)
    alone = {}
    for row in out:
        node = None
        for c in reversed(row["sig"]):
            node = module.grow(c, node)
        alone[row["sig"]] = node
        assert [c for q in node for c, _ in q] == [module.INF if c < 0 else c for c in row["costs"]]
        assert [t for q in node for c, t in q if c < module.INF] == [t for t in row["audits"] if t is not None]


# ------------------------------------------------------------------ Merkle manifest
def tree_reference(leaves):
    """(root, proofs): siblings of every leaf, level by level, as hex texts."""
    nodes, members, proofs = list(leaves), [[k] for k in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        up, groups = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k:k + 8]
            for j, who in enumerate(members[k:k + 8]):
                for leaf in who:
                    proofs[leaf].append((run[:j], run[j + 1:]))
            up.append(sha("".join(run)))
            groups.append([x for who in members[k:k + 8] for x in who])
        nodes, members = up, groups
    return nodes[0], proofs


@pytest.mark.parametrize("block_levels", [4, 1])
def test_manifest_matches_brute_force(spark, block_levels):
    from ticklab.llm import merkle

    sizes = {None: 3, "a": 1, "b": 8, "ä": 9, "c": 64, "d": 65, "e": 200, "": 2}
    rows = [(i if i % 50 else None, g, f"leaf {g} {i if i % 7 else 0}") for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([(*r, 0, "n", "w", "b") for r in rows], "doc_id long, lang string, t string, pos int, node string, witness string, block string")
    df = df.withColumn("leaf", F.unhex(F.sha2("t", 256))).withColumn("other", F.unhex(F.sha2(F.lit("x"), 256)))
    out = merkle.verify(merkle.manifest(df, carry=["other"], levels=block_levels)).collect()
    groups = {g: sorted([r for r in rows if r[1] == g], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(sha(r[2])))) for g in sizes}
    trees = {g: tree_reference([sha(r[2]) for r in m]) for g, m in groups.items()}
    order = sorted(sizes, key=lambda g: (g is not None, (g or "").encode()))
    root, tops = tree_reference([trees[g][0] for g in order])
    want = []
    for g, top in zip(order, tops):
        for r, p in zip(groups[g], trees[g][1]):
            siblings = "".join("".join(a + b) for a, b in [*p, *top])
            want.append(("0" if g is None else "1" + g, r[0], sha(r[2]), trees[g][0], root, sha(siblings)))
    got = [(x.grp, x.id, x.leaf.hex(), x.subroot.hex(), x.root.hex(), x.proof.hex()) for x in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(x.verified and x.folded_root == x.root for x in out)
    bad = merkle.verify(merkle.manifest(df, carry=["other"], levels=block_levels), "other")
    assert bad.where("verified").count() == 0


def test_manifest_of_one_leaf_and_none(spark):
    from ticklab.llm import merkle

    df = spark.createDataFrame([(1, None, "t")], "doc_id long, lang string, t string").withColumn("leaf", F.unhex(F.sha2("t", 256)))
    one = merkle.verify(merkle.manifest(df)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof.hex() == sha("") and one.verified
    assert merkle.verify(merkle.manifest(df.limit(0))).count() == 0


def test_leaf_text_lengths_and_nulls(spark):
    from ticklab.llm.merkle import leaf_text

    df = spark.createDataFrame([(1, "ä", None, "", "x" * 300_000)], "doc_id long, source string, lang string, n string, text string")
    assert df.select(leaf_text(*df.columns)).first()[0] == "1:12:ä-0:300000:" + "x" * 300_000
