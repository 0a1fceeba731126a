"""URL filter, chat formatting, BPE and packing: references, round trips and defined edge cases."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_url_verdicts(spark):
    from ticklab.llm.url_filter import url_verdicts

    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("com", "/de/", "block")], "host string, path string, verdict string")
    pages = [
        (1, "http://a.net/x", '<link rel="canonical" href="http://b.EXAMPLE.org/es/1">'),  # alias of a blocked url
        (2, "http://b.EXAMPLE.org/es/1?q", None),  # the longer rule wins
        (3, "http://c.net/", "<META http-equiv=refresh content='0;url=/y'>"),
        (4, "http://c.net/y", '<link href="//z.COM/de/q" rel=canonical>'),  # reaches a blocked url that was never fetched
        (5, None, None), (6, "nourl", ""), (6, "nourl", ""),
        (7, "http://z.net", '<link rel=canonical href="http://q.com/fr/1"><link rel=canonical href="http://q.com/de/1">'),  # allow has precedence
        (8, "http://notcom/de/", ""), (9, "https://com/de/x#f", ""), (10, "http://x.com", ""),
        (11, "http://y.com/fr/", '<link rel=canonical href="http://q2.com/de/1">'),  # its own rule decides
        (12, "http://long.com/de/" + "p" * 100_000, "h" * 100_000), (13, "x://U:1@Com:80/De/", None)]
    df = spark.createDataFrame([(*p, "r", "v", "c") for p in pages], "page_id long, url string, html string, rule string, verdict string, component string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(df, rules).collect()}
    assert url_verdicts(df, rules).count() == len(pages)
    assert got[1] == ("a.net", "/x", None, "block") and got[2] == ("b.example.org", "/es/1", "example.org/es/", "block")
    assert got[3][3] == got[4][3] == "block"
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("z.net", "", None, "allow") and got[8][2:] == (None, "allow") and got[9] == ("com", "/de/x", "com/de/", "block")
    assert got[10][2:] == (None, "allow") and got[11][2:] == ("com/fr/", "allow") and got[12][3] == "block"
    assert got[13] == ("u:1@com:80", "/De/", None, "allow")
    assert url_verdicts(df.limit(0), rules).count() == 0 and url_verdicts(df, rules.limit(0)).where("verdict = 'block'").count() == 0
    more = spark.createDataFrame([("http://x.com", "http://w.com/de/")], "a string, b string")
    assert {r.page_id: r.verdict for r in url_verdicts(df, rules, more).collect()}[10] == "block"


def test_fold_events(spark):
    from ticklab.llm.chat_format import fold_events

    log = [(1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", None), (1, 3, "delta", 2, None, "he"), (1, 4, "delta", 2, None, "llo"),
           (1, 5, "edit", 1, None, "hi!"), (1, 6, "message", 6, "user", "gone"), (1, 7, "regenerate", 2, None, ""), (1, 8, "delta", 2, None, "again"),
           (1, 9, "message", 9, "user", "bye"), (1, 10, "delta", None, None, "lost"), (2, 3, "delta", 2, "assistant", "orphan"), (None, 1, "message", 1, None, None)]
    df = spark.createDataFrame(log[::-1], "conv_id long, seq long, kind string, target long, role string, text string")
    got = sorted((tuple(r) for r in fold_events(df).collect()), key=str)
    assert got == sorted([(1, 1, "user", "hi!"), (1, 2, "assistant", "again"), (1, 9, "user", "bye"), (2, 2, "assistant", "orphan"), (None, 1, "", "")], key=str)
    assert fold_events(df.limit(0)).count() == 0


def test_chat_round_trip(spark):
    from pyspark.sql import functions as F

    from ticklab.llm.chat_format import events_of_rows, fold_events, parse, render, unescape

    r = random.Random(3)
    bits = ["\\", "#", "##", "###", "####", "</turn>", "</turn>\n", "<", "/turn>", "\n", ": ", ":", "é", "😀", " ", "a", "### Assistant: ", "<\\/turn>", "\\\\"]
    rows = [(c, t, r.choice(["user", "assistant", "tool: x", "a:\\", None, "### #"]), "".join(r.choice(bits) for _ in range(r.randrange(0, 12))))
            for c in range(60) for t in range(r.randrange(1, 6))]
    rows += [(70, 0, "assistant", None), (71, None, "user", "x"), (71, 0, "assistant", "y" * 100_000), (71, 0, "assistant", "y" * 100_000), (None, 0, "user", "z")]
    df = spark.createDataFrame([(*x, 1, "f") for x in rows], "conv_id long, turn long, role string, text string, seq long, formatted string")
    out = render(fold_events(events_of_rows(df, chunk=3)))
    spans = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    got = {x.conv_id: ([tuple(t) for t in x.turns], list(x.loss)) for x in out.select("conv_id", parse(F.col("formatted")).alias("turns"), spans.alias("loss")).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] or "")):
        want[c].append((role or "", text or ""))
    assert {c: t for c, (t, _) in got.items()} == want
    assert {c: x for c, (_, x) in got.items()} == {c: [t for role, t in turns if role == "assistant"] for c, turns in want.items()}
    assert render(fold_events(events_of_rows(df.limit(0)))).count() == 0


ALPHABET = "ab'  \n\t1é.!sreltvmd \u00a0\u3000中'\u0085\x1c😀"
TEXTS = [(1, None), (2, ""), (3, " "), (4, "it's a test, we'll see"), (5, "<|endoftext|> x"), (6, "a" * 50_000), (7, "\n" * 3000), (8, "word " * 30_000),
         (4, "it's a test, we'll see"), (None, "no id")]


def texts():
    r = random.Random(1)
    return TEXTS + [(100 + i, "".join(r.choice(ALPHABET) for _ in range(r.randrange(0, 40)))) for i in range(300)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, b"x", 3, "y") for i, t in rows], "doc_id long, text string, ids binary, block long, tail string")


def test_pretokens_match_the_pattern():
    regex = pytest.importorskip("regex")
    from ticklab.llm.pretokens import split_batches

    pattern = regex.compile(public_tokenizers.PATTERN)
    r = random.Random(2)
    sample = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(0, 12))) for _ in range(20_000)] + ["", "'s", " 's", "'s't"]
    got = []
    for _, _, words, which, counts in split_batches(sample):
        assert len(set(words)) == len(words)
        tokens, k = [words[i] for i in which], 0
        for n in counts:
            got.append(tokens[k:k + n])
            k += n
    assert got == [pattern.findall(t) for t in sample]


def test_bpe_matches_tiktoken_and_decodes(spark, monkeypatch):
    import tiktoken

    from ticklab.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = texts()
    out = bpe.decode(bpe.encode(frame(spark, rows), path, public_tokenizers.PATTERN), path)
    got = sorted(((r.doc_id, bytes(r.ids), bytes(r.bytes)) for r in out.collect()), key=str)
    assert got == sorted(((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows), key=str)
    assert bpe.encode(frame(spark, rows).limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    from ticklab.llm.packing import pack

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rows = [(i, t) for i, t in texts() if (i, t) != (4, "it's a test, we'll see")] + [(4, "it's a test, we'll see")] * 2
    ids = [(i, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t in rows]
    out = pack(frame(spark, rows), path).collect()
    want = {i: x for i, x in ids}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        x = want[r.doc_id]
        assert r.doc_tokens == len(x) and r.length > 0 and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, x in want.items():
        covered = np.zeros(len(x), int)
        for a, n in pieces[i]:
            covered[a:a + n] += 1
        assert set(covered) == {sum(1 for j, _ in ids if j == i)}
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert padding < 0.01 * sum(len(x) for _, x in ids)
    assert pack(frame(spark, rows).limit(0), path).count() == 0


def test_packing_tails_beside_heads_of_the_same_class(spark):
    from ticklab.llm.packing import pack

    # 63-token tails and 64-token heads: floor(2048 / length) is 32 for both
    rows = [(i, "a" + " a" * (61 + i % 2)) for i in range(90)]
    out = pack(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert {r.doc_tokens for r in out} == {63, 64} and sum(r.length for r in out) == 45 * 63 + 45 * 64
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 32 * 63 or at & (at - 1) == 0  # a bin of tails, or a power of two


def test_packing_query_gives_the_library_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    from ticklab.llm.queries import QUERIES

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "a <|endoftext|> x"), (2, "<|endoftext|><|endoftext|>"), (3, "plain words"), (4, "<|endoftext|"), (5, None), (6, "word <|endoftext|>\n" * 9)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    out = QUERIES["op10_harmonic_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(want) and sum(r.length for r in out) == sum(len(x) for x in want.values())
    for r in out:
        x = want[r.doc_id]
        assert r.doc_tokens == len(x) and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32


def test_packing_spreads_repeated_rows_over_workers(spark, monkeypatch):
    from ticklab.llm import packing

    monkeypatch.setattr(packing, "WORKER_PIECES", 100)
    rows = [(None, "a" + " a" * 62)] * 400
    out = packing.pack(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).collect()
    workers = [r.sequence_id >> 38 for r in out]
    assert len(out) == 400 and set(workers) == {0, 1, 2, 3} and max(workers.count(w) for w in range(4)) < 200


def test_cuts_cover_every_length():
    from ticklab.llm.packing import cuts

    for n in range(1, 6000):
        assert sum(cuts(n, 2048, 64)) == n and all(c > 0 for c in cuts(n, 2048, 64))


def test_digest_of_ids_is_little_endian(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(np.array([1, 258], "<u4").tobytes(),)], "ids binary")
    assert df.select(F.sha2("ids", 256)).first()[0] == hashlib.sha256(b"\x01\0\0\0\x02\x01\0\0").hexdigest()


def test_tokens_of_equal_first_hash_stay_apart(monkeypatch):
    """Where two texts share the first hash but not the second, every pre-token is its own."""
    from ticklab.llm import pretokens

    real = pretokens.token_hashes
    monkeypatch.setattr(pretokens, "token_hashes", lambda cp, begins: (np.zeros(len(begins), np.uint64), real(cp, begins)[1]))
    (_, _, words, which, counts), = pretokens.split_batches(["one two one", "two three"])
    assert [words[i] for i in which] == ["one", " two", " one", "two", " three"] and counts.tolist() == [3, 2]


def test_bpe_of_a_text_longer_than_a_block(spark):
    from ticklab.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    long = " ".join(f"w{k % 5000}" for k in range(bpe.BLOCK_TOKENS // 2 + 10_000))  # a letter and a number each
    out = bpe.decode(bpe.encode(frame(spark, [(1, long), (2, "short")]), path, public_tokenizers.PATTERN), path)
    got = {r.doc_id: bytes(r.bytes) for r in out.collect()}
    assert got == {1: long.encode(), 2: b"short"}


def test_chat_of_many_turns(spark):
    """50,000 turns in one conversation, some regenerated, are linear work."""
    import time

    from ticklab.llm.chat_format import events_of_rows, fold_events, read_back, render

    n = 50_000
    rows = spark.range(n).selectExpr("cast(null as bigint) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('text: ## ', id) as text")
    log = events_of_rows(rows)
    again = spark.createDataFrame([(None, (n + 1) << 31, "regenerate", (n - 10 + 1) << 31, None, "anew: </turn>")], log.schema)
    began = time.time()
    got = read_back(render(fold_events(log.unionByName(again)))).first()
    took = time.time() - began
    assert len(got.turns) == n - 9 and got.turns[-1].text == "anew: </turn>" and got.turns[-1].loss is None
    assert all((t.loss == t.text) == (t.role == "assistant") for t in got.turns[:-1])
    assert took < 60, took
