"""op3, op7 and the pipeline against plain loops over small tables: features, training, calibration, predictions, decisions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from test_llm_dedup import line_reference, simhash_reference


def text_hash(t):
    h = xxhash.xxh64_intdigest(t.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def softmax(z):
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


# ------------------------------------------------------------------ language ID
def ngrams(text):
    """Counts by bucket of the runs of 1 to 3 characters of a lower-cased text, non-letters as one blank."""
    from ticklab.llm.langid import BUCKETS

    if not regex.search(r"\p{L}", text):
        return None
    s = regex.sub(r"[^\p{L}]+", " ", text.lower())
    out = Counter()
    for i in range(len(s)):
        h = 0
        for n in (1, 2, 3):
            if i + n <= len(s):
                h = (h + ord(s[i + n - 1]) + n) * 0x9E3779B97F4A7C15 % (1 << 64)
                h ^= h >> 29
                out[h >> 20 & BUCKETS - 1] += 1
    return out


def unit(counts, idf):
    v = {b: (1 + math.log(n)) * idf(b) for b, n in counts.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {b: x / size for b, x in v.items()}


def contract_fold(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def language_reference(rows, fold=contract_fold):
    """{doc_id: (held_out, language, score)} for (doc_id, text, lang) rows."""
    held_out = {i: fold(i) for i, *_ in rows}
    taught = [(t, lang) for i, t, lang in rows if not held_out[i] and t is not None and lang is not None]
    grams = [g for t, _ in taught if (g := ngrams(t)) is not None]
    df = Counter(b for g in grams for b in g)

    def idf(b):
        return math.log((1 + len(grams)) / (1 + df[b])) + 1
    sample = sorted({(text_hash(t), lang, t) for t, lang in taught if ngrams(t) is not None})
    langs = sorted({lang for _, lang, _ in sample})
    x = [unit(ngrams(t), idf) for *_, t in sample]
    y = [langs.index(lang) for _, lang, _ in sample]
    held = [k for k in range(len(x)) if k % 6 == 5] if len(x) >= 60 else []
    fit = [k for k in range(len(x)) if k not in held]
    z, n, w = (defaultdict(lambda: [0.0] * len(langs)) for _ in range(3))
    shuffle = np.random.default_rng(7)
    for _ in range(4):
        order = shuffle.permutation(len(fit))
        for at in range(0, len(order), 16):
            grad = defaultdict(lambda: [0.0] * len(langs))
            for k in (fit[j] for j in order[at:at + 16]):
                p = softmax([sum(v * w[b][c] for b, v in x[k].items()) for c in range(len(langs))])
                for b, v in x[k].items():
                    for c in range(len(langs)):
                        grad[b][c] += v * (p[c] - (y[k] == c))
            for b, g in grad.items():
                for c in range(len(langs)):
                    sigma = (math.sqrt(n[b][c] + g[c] ** 2) - math.sqrt(n[b][c])) / 0.5
                    z[b][c] += g[c] - sigma * w[b][c]
                    n[b][c] += g[c] ** 2
                    over = max(abs(z[b][c]) - 0.02, 0)
                    w[b][c] = -math.copysign(over, z[b][c]) / ((1 + math.sqrt(n[b][c])) / 0.5 + 0.1)

    def logits(v):
        return [sum(a * w[b][c] for b, a in v.items() if b in w) for c in range(len(langs))]
    grid = [math.exp(-3 + 6 * i / 120) for i in range(121)]
    cold = {t: sum(-math.log(max(softmax([v / t for v in logits(x[k])])[y[k]], 1e-12)) for k in held) for t in grid}
    temperature = min(grid, key=cold.get) if held else 1.0
    out = {}
    for i, t, _ in rows:
        g = ngrams(t or "")
        p = softmax([v / temperature for v in logits(unit(g, idf))]) if g else []
        best = max(range(len(p)), key=lambda c: p[c]) if p else None
        out[i] = (held_out[i], langs[best], p[best]) if p else (held_out[i], "und", 0.0)
    return out


def test_language_query_matches_brute_force(spark, tmp_path):
    from ticklab.llm.queries import QUERIES

    r = random.Random(5)
    stock = {"en": "the cat and dog with this that from have word 7", "de": "der hund und die katze nicht mit über straße wort",
             "fr": "le chat et la chienne avec été pour dans être mot"}
    rows = [(i, " ".join(r.choice(stock[lang].split()) + r.choice(["", ",", " -- "]) for _ in range(r.randint(2, 12))), lang)
            for i, lang in enumerate(r.choice(sorted(stock)) for _ in range(130))]
    rows += [(200, rows[3][1], rows[3][2]), (201, None, "en"), (202, "", "de"), (203, "12 -- !", "fr"), (204, "the word", None), (205, "chat", "de"),
             (206, " word", "en"), (207, "hund\n", None)]
    spark.createDataFrame([(*row, "row", 1) for row in rows], "doc_id long, text string, lang string, source string, score int").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in QUERIES["op3_language_id"](spark, str(tmp_path)).collect()}
    want = language_reference(rows)
    assert got.keys() == want.keys()
    for i, (held_out, lang, score) in want.items():
        assert got[i] == (held_out, lang, pytest.approx(score, abs=1e-4)), i
    assert {w[1] for w in want.values()} == {"en", "de", "fr", "und"}


# ------------------------------------------------------------------ toxicity
def signs(text):
    """Words (runs of letters, lower-cased) and their beginnings of 4 to 7 letters."""
    found = regex.findall(r"\p{L}+", (text or "").lower())
    return {(w, 0) for w in found} | {(w[:n], n) for w in found for n in (4, 5, 6, 7) if len(w) > n}


def order_of(sign):
    """The operator's hash of a sign: it orders the vocabulary, and with it ties and the random start."""
    from ticklab.llm.toxicity import PREFIXES, words

    name, n = sign
    return int(words(name)[0]) if n == 0 else int(words(name + "x")[1 + PREFIXES.index(n)])


def sigmoid(z):
    return 1 / (1 + math.exp(-min(max(z, -40), 40)))


def link_reference(docs, extra, y):
    """{sign: weight}, weights of the earlier probabilities and the bias, last, by the same penalised loss."""
    n, share = len(y), sum(y) / len(y)
    held = Counter(s for d in docs for s in d)
    hits = Counter(s for d, t in zip(docs, y) if t for s in d)
    z = {s: abs(hits[s] - m * share) / math.sqrt(max(m * share * (1 - share), 1e-9)) if m >= 3 else 0 for s, m in held.items()}
    vocab = sorted((s for s in z if z[s] > 0), key=order_of)
    x = np.array([[s in d for s in vocab] + list(e) + [1.0] for d, e in zip(docs, extra)], float).reshape(n, -1)
    words, penalised = len(vocab), x.shape[1] - 1
    start = np.concatenate([np.random.default_rng(3).normal(size=words), np.ones(x.shape[1] - words)])
    for _ in range(12):
        start = start / math.sqrt(sum(v * v for v in start))
        start = x.T @ (x @ start) / n
    step = 1 / (0.25 * math.sqrt(sum(v * v for v in start)) * 1.05 + 1e-5)
    w = look = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(300):
        r = np.array([sigmoid(v) for v in x @ look]) - y
        grad = x.T @ r / n
        new = np.zeros(len(w))
        for j in range(len(w)):
            v = look[j] - step * (grad[j] + (1e-5 * look[j] if j < penalised else 0))
            new[j] = math.copysign(max(abs(v) - step * 1e-5, 0), v) if j < words else v
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return dict(zip(vocab, w)), list(w[words:])


def link_score(link, doc, earlier):
    weights, dense = link
    return sigmoid(sum(weights.get(s, 0.0) for s in doc) + sum(a * p for a, p in zip(dense, earlier)) + dense[-1])


def cut_reference(p, y):
    """Half way below the cut of best F1 on out-of-fold probabilities, within 0.4 and 0.95."""
    if not any(y):
        return 0.5
    best = None
    for cut in sorted(set(p), reverse=True):
        hit = sum(t for v, t in zip(p, y) if v >= cut)
        f1 = 2 * hit / (sum(v >= cut for v in p) + sum(y))
        if best is None or f1 > best[0]:
            best = f1, cut, max((v for v in p if v < cut), default=0.0)
    return min(max((best[1] + best[2]) / 2, 0.4), 0.95)


def toxicity_reference(rows, labels):
    """{doc_id: (probabilities, rejected)} for (doc_id, text) rows and (doc_id, toxic, quality) labels."""
    kinds = {}
    for i, toxic, quality in labels:
        if i is not None and toxic is not None:
            mine = (toxic == 1, toxic == 1 and quality != 1, toxic == 1 and quality == 1)
            kinds[i] = tuple(max(a, b) for a, b in zip(mine, kinds.get(i, mine)))
    taught = sorted((text_hash(t or "") % 5, i, t) for i, t in rows if i in kinds)
    fold, docs = [f for f, *_ in taught], [signs(t) for *_, t in taught]
    extra, links, cuts = [[] for _ in docs], [], []
    for c in range(3):
        y = [float(kinds[i][c]) for _, i, _ in taught]
        oof = [0.0] * len(docs)
        for k in range(5):
            rest = [j for j in range(len(docs)) if fold[j] != k]
            if 0 < len(rest) < len(docs):
                link = link_reference([docs[j] for j in rest], [extra[j] for j in rest], [y[j] for j in rest])
                for j in set(range(len(docs))) - set(rest):
                    oof[j] = link_score(link, docs[j], extra[j])
        links.append(link_reference(docs, extra, y))
        cuts.append(cut_reference(oof, y))
        extra = [[*e, p] for e, p in zip(extra, oof)]
    out = {}
    for i, t in rows:
        p = []
        for link in links:
            p.append(link_score(link, signs(t), p))
        out[i] = (p, any(v >= cut for v, cut in zip(p, cuts)))
    return out


def test_toxicity_query_matches_brute_force(spark, tmp_path):
    from ticklab.llm.queries import QUERIES, TOXICITY

    r = random.Random(8)
    calm, rude = "plain words about weather gardens rivers and bread".split(), "scoundrel villainous wretch scoundrels".split()
    rows, labels = [], []
    for i in range(140):
        toxic = int(i % 4 == 0)
        junk = i % 8 == 0
        text = [r.choice(calm) for _ in range(r.randint(2, 9))] + (["zzz"] if junk else [])
        if toxic and i % 20 or i % 37 == 5:
            text.insert(r.randrange(len(text)), r.choice(rude).upper() if i % 3 else r.choice(rude))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic, None if i == 8 else int(not junk)))
    rows += [(200, None), (201, ""), (202, "Scoundrel, scoundrel!"), (203, "unknown text"), (204, "Straße zzz wretch")]
    labels += [(3, 1, 1), (None, 1, 1), (201, 0, 1), (999, 1, 0), (5, None, 1)]
    spark.createDataFrame([(*row, "w") for row in rows], "doc_id long, text string, words string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: ([r[f"p_{c}"] for c in TOXICITY], r.toxic) for r in QUERIES["op7_toxicity"](spark, str(tmp_path)).collect()}
    want = toxicity_reference(rows, labels)
    assert got.keys() == want.keys()
    for i, (p, rejected) in want.items():
        assert got[i] == (pytest.approx(p, abs=1e-6), rejected), i
    assert 10 < sum(w[1] for w in want.values()) < 70


def test_plain_words_are_the_operators_words():
    from ticklab.llm.toxicity import words

    for text in ("Plain, plain words", "scoundrels über Straße x", "", "12 -- !", "a" * 9 + " b"):
        assert {int(h) for h in words(text)} == {order_of(s) for s in signs(text)}
        assert len(re.findall(r"\w+", text)) >= len({s for s in signs(text) if s[1] == 0})


# ------------------------------------------------------------------ pipeline
def test_pipeline_matches_the_plain_stages(spark, tmp_path):
    """The stages' plain versions one after the other give the same documents, and their tokenizer ids the same pieces."""
    from tokenizers import Tokenizer

    import corpus_pipeline as cp

    r = random.Random(3)
    stock = {"en": "the cat and dog with this that from have word".split(), "de": "der hund und die katze nicht mit über straße wort".split()}
    shared = "This passage stands in many documents and is far longer than forty characters"
    rows, labels = [], []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        text = " ".join(r.choice(stock[lang]) for _ in range(r.randint(15, 60)))
        if i % 5 == 0:
            text = f"scoundrel {text} villainous wretch"
        if i % 4 == 1:
            text = f"{text}\n  {shared} \n{text[::-1]}"
        rows.append((i, text, lang))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(i % 5 == 0), int(i % 10 == 0)))
    rows += [(200 + k, rows[i][1], rows[i][2]) for k, i in enumerate([1, 1, 2, 5, 7])]  # exact copies
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 -- !", "en"), (303, f"{shared}\n{shared.upper()}", "en"), (304, " ".join(stock["de"]) + " word", None)]
    spark.createDataFrame([(*row, "s", None if row[1] is None else len(row[1])) for row in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    toxic = toxicity_reference([row[:2] for row in rows], labels)
    left = [row for row in rows if not toxic[row[0]][1]]
    known = language_reference(left, lambda i: False)
    spoken = [row for row in left if known[row[0]][1] != "und" and known[row[0]][2] >= 0.5]
    trimmed = [(i, t) for i, t, *_ in line_reference([row[:2] for row in spoken])]
    group = {i: least for i, _, least in simhash_reference(trimmed)}
    kept = {i: t for i, t in trimmed if group[i] == i}
    assert len(rows) > len(left) > len(spoken) > len(kept) > 60 and {t for i, t in trimmed} != {row[1] for row in spoken}

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in kept.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in cp.run(spark, str(tmp_path)).collect():
        x = ids[p.doc_id]
        assert p.doc_tokens == len(x) and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert pieces.keys() == ids.keys()
    for parts, end in [(pieces[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        assert at == end if end else at <= 2048
