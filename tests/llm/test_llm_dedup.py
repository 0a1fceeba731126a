"""Exact dedup, line dedup, SimHash and components against brute force, with the defined edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, digest string, kept boolean, component_id long, row string, line int"


def frame(spark, rows):
    """(doc_id, text) rows with extra columns whose names clash with columns the operators use."""
    return spark.createDataFrame([(i, t, "x", True, -1, "y", 0) for i, t in rows], SCHEMA)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


EDGE = [(1, "a  b"), (2, "a\tb"), (3, None), (4, ""), (5, " "), (None, "a b"), (7, "x" * 200_000), (8, "x" * 200_000), (9, "ä\u00a0b"),
        (2, "a\tb"), (10, "a b ")]


def test_exact_groups_edge_cases(spark):
    from ticklab.llm.exact_dedup import exact_groups

    got = sorted((tuple(r) for r in exact_groups(frame(spark, EDGE)).collect()), key=str)
    groups = defaultdict(list)
    for i, t in EDGE:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert len(got) == len(EDGE)
    for text, ids in groups.items():
        mine = [g for g in got if g[4] == sha(text)]
        assert sorted(str(g[0]) for g in mine) == sorted(map(str, ids))
        least = min((i for i in ids if i is not None), default=None)
        assert {g[1] for g in mine} == {least} and {g[2] for g in mine} == {len(ids)}
        assert sum(g[3] for g in mine) == 1 and next(g for g in mine if g[3])[0] == least


def test_exact_groups_heavy_hitter_and_empty(spark):
    from ticklab.llm.exact_dedup import exact_groups

    rows = [(i, "hot" if i % 3 else f"t{i // 2}") for i in range(3000, 0, -1)]
    out = {r.doc_id: r for r in exact_groups(frame(spark, rows), support=0.01).collect()}
    assert len(out) == 3000 and out[5].keep_id == 1 and out[5].group_size == 2000 and out[1].kept and not out[2].kept
    assert exact_groups(frame(spark, rows).limit(0)).count() == 0


def test_exact_groups_hold_no_group_in_a_window(spark):
    from ticklab.llm.exact_dedup import exact_groups

    out = exact_groups(frame(spark, [(i, f"t{i // 2}") for i in range(50)]), support=0.5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()} == {(i, i // 2 * 2, 2, i % 2 == 0) for i in range(50)}


def line_reference(rows, min_chars=40, min_docs=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(low)
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        top = lambda s: max((x for x in s if x is not None), default=None)
        keep = [x for x in ls if len(held.get(key(x), ())) < min_docs or top(held[key(x)]) == i]
        out.append((i, "\n".join(keep), len(ls), len(ls) - len(keep)))
    return sorted(out, key=str)


def test_line_dedup_matches_reference(spark, monkeypatch):
    from ticklab.llm import line_dedup

    # many shards and probe parts: hot shards are split, results stay
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 8)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 16)
    r = random.Random(4)
    lines = [f"{'Line with ÄÖ text number':<30} {k:012d}" for k in range(30)] + ["short", "", "  " + "B" * 39, "c" * 40, "d" * 39 + " "]
    rows = [(i, "\n".join(r.choice(lines) + r.choice(["", " ", "\r", "\t"]) for _ in range(r.randrange(0, 9)))) for i in range(60)]
    rows += [(100 + i, lines[0] + "\n" + f"own line {i}") for i in range(80)]  # one line in most documents
    rows += [(None, lines[1]), (None, lines[2] + "\nmore"), (3, rows[3][1]), (200, None), (201, ""), (202, ("z" * 50 + "\n") * 3000)]
    rows += [(None, "only rows without an id hold this line, five of them\n" + str(k)) for k in range(5)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows))
    got = sorted((tuple(x) for x in out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == line_reference(rows)
    assert out.select("row.component_id").distinct().collect()[0][0] == -1
    assert line_dedup.drop_repeated_lines(frame(spark, rows).limit(0)).count() == 0


def test_perfect_hash_is_minimal_and_packs():
    from ticklab.llm.line_dedup import PerfectHash

    keys = np.random.default_rng(0).integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    keys[0, :100] = 7  # equal first halves
    mph = PerfectHash.unpack(PerfectHash.build(*keys).pack())
    assert sorted(mph.index(*keys)) == list(range(5000))
    assert len(PerfectHash.unpack(PerfectHash.build(*keys[:, :0]).pack()).index(*keys[:, :0])) == 0


def simhash_reference(rows, words=3, radius=3):
    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        hs = [xxhash.xxh64_intdigest(" ".join(w[k:k + words]).encode(), 42) for k in range(max(1, len(w) - words + 1))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    fps = [fp(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((i for (i, _), h in zip(rows, group) if h == g and i is not None), default=None) for g in set(group)}
    return sorted(((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, group)), key=str)


def test_simhash_matches_reference(spark, monkeypatch):
    from ticklab.llm import simhash

    monkeypatch.setattr(simhash, "TILE", 8)
    monkeypatch.setattr(simhash, "SHORT", 4)
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(40):
        text = [r.choice(vocab) for _ in range(r.randrange(1, 300))]
        rows.append((i, " ".join(text)))
        for k in range(r.randrange(0, 6)):  # near copies
            copy = list(text)
            copy[r.randrange(len(copy))] = "changed"
            rows.append((100 + 10 * i + k, "  ".join(copy).upper()))
    base = [r.choice(vocab) for _ in range(2000)]
    for k in range(30):  # a large group of near copies
        rows.append((1000 + k, " ".join(base[:k] + ["new"] + base[k + 1:])))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "one two"), (5, rows[5][1]), (None, rows[0][1]), (None, "alone here yes"), (905, "q " * 150_000)]
    got = sorted((tuple(x) for x in simhash.simhash_groups(frame(spark, rows)).collect()), key=str)
    assert got == simhash_reference(rows)
    assert simhash.simhash_groups(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_comparison(radius):
    from ticklab.llm import simhash as S

    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    f = np.unique(np.array([int(base[i % 4]) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for i in range(300)], np.uint64))

    def parts(links):
        up = {int(x): int(x) for x in f}
        for a, b in links:
            a, b = up[a], up[b]
            up = {k: min(a, b) if v in (a, b) else v for k, v in up.items()}
        return up
    near = [(int(a), int(b)) for i, a in enumerate(f) for b in f[i + 1:] if (int(a) ^ int(b)).bit_count() <= radius]
    h = len(f) // 2
    assert parts(near) == parts(S.links_tiles(f, None, radius))
    assert parts(near) == parts(S.links_tiles(f[:h], None, radius) + S.links_tiles(f[h:], None, radius) + S.links_tiles(f[:h], f[h:], radius))
    runs = np.repeat(np.arange(len(f) // 20 + 1), 20)[:len(f)]
    near = [(a, b) for a, b in near if runs[np.searchsorted(f, np.uint64(a))] == runs[np.searchsorted(f, np.uint64(b))]]
    assert parts(near) == parts(S.links_sorted(runs, f, radius))


def test_components_chain_star_and_empty(spark):
    from ticklab.llm.components import connected_components

    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 201), (201, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(50), 0), 200: 200, 201: 200}
    assert connected_components(df.limit(0)).count() == 0
    names = connected_components(df.select(F.concat(F.lit("u"), "a").alias("a"), F.concat(F.lit("u"), "b").alias("b")))
    assert {r.node: r.component for r in names.collect()}["u49"] == "u0"


def test_line_dedup_of_a_very_long_text(spark):
    """A text of 100,000 lines that loses one, and one that loses half of its lines, are linear work."""
    import time

    from ticklab.llm.line_dedup import drop_repeated_lines

    shared = "a line that five documents share, long enough"
    own = [f"line {k} of the long document" for k in range(100_000)]
    many = [f"a repeated line that six documents share: {k}" for k in range(20_000)]
    half = "\n".join(x for pair in zip(many, own) for x in pair)
    rows = [(1, "\n".join([*own[:500], shared, *own[500:]])), (2, half)] + [(k, shared) for k in range(3, 8)] + [(k, "\n".join(many)) for k in range(10, 15)]
    began = time.time()
    out = {r.doc_id: r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    took = time.time() - began
    assert out[1].text == "\n".join(own) and out[1].n_dropped == 1 and out[1].n_lines == 100_001
    assert out[2].text == "\n".join(own[:20_000]) and out[2].n_dropped == 20_000
    assert out[7].text == shared and out[14].text == "\n".join(many) and out[10].text == ""
    assert took < 60, took
