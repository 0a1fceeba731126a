"""Registered queries of the subpackage and their DuckDB SQL. Each query applies its operator to the
whole table; digests that stand for texts, spans or ids are derived here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.llm.common import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


# ------------------------------------------------------------------ 1 nearest neighbours
@query("op1_ann_forest")
def ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.ann_forest import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# ------------------------------------------------------------------ 2 URL filter
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]

OP2_SQL = """
WITH p AS (SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (SELECT url, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
         FROM (SELECT DISTINCT url, host, path FROM h) u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY url),
links AS (SELECT url AS a, replace(regexp_extract(html, '(?i)<link\\b[^>]*rel="?canonical"?[^>]*href="([^"]*)"', 1), '&amp;', '&') AS b FROM h WHERE url IS NOT NULL
          UNION SELECT url, regexp_extract(html, '(?i)<meta\\b[^>]*http-equiv="?refresh"?[^>]*content="[^"]*url=([^"]*)"', 1) FROM h WHERE url IS NOT NULL),
e AS (SELECT a, b FROM links WHERE b LIKE '%://%' UNION SELECT b, a FROM links WHERE b LIKE '%://%'),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a, b FROM r),
votes AS (SELECT a, min(v) AS v FROM reach JOIN best ON best.url = reach.b GROUP BY a)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, votes.v, 'allow') AS verdict,
       (SELECT least(min(b), min(a)) FROM reach WHERE reach.a = h.url) AS component
FROM h LEFT JOIN best ON best.url = h.url LEFT JOIN votes ON votes.a = h.url
"""


@query("op2_url_filter", OP2_SQL)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.url_filter import url_verdicts

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


# ------------------------------------------------------------------ 3 language ID
def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.langid import predict, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out() & F.col("lang").isNotNull()).select("text", F.col("lang").alias("label")))
    out = predict(docs, model, ["doc_id"])
    return out.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 4 exact dedup
OP4_SQL = """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256 FROM t
"""


@query("op4_exact_dedup", OP4_SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 5 line dedup
OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
hot AS (SELECT k, max(doc_id) AS top FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT doc_id, line, i, hot.k IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN hot USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.line_dedup import drop_repeated_lines

    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 6 SimHash near-dedup
@query("op6_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"), words=3, radius=3)


# ------------------------------------------------------------------ 7 toxicity
#: Chain order. The labels table has one toxicity and one quality flag; the two kinds of toxic text follow
#: from both.
TOXICITY = ["toxic", "toxic_junk", "toxic_fluent"]


def toxicity_labels(labels: DataFrame) -> DataFrame:
    """0/1 columns TOXICITY; a toxic row of unknown quality counts as toxic_junk."""
    toxic, good = F.col("toxic") == 1, F.coalesce(F.col("quality") == 1, F.lit(False))
    return labels.select("doc_id", toxic.cast("int").alias("toxic"), (toxic & ~good).cast("int").alias("toxic_junk"),
                         (toxic & good).cast("int").alias("toxic_fluent"))


@query("op7_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.toxicity import any_rejected, predict, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, toxicity_labels(table(spark, sf_dir, "labels")), TOXICITY)
    out = predict(docs, model, ["doc_id"])
    return out.select("row.doc_id", *[F.get("p", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(TOXICITY)],
                      any_rejected().alias("toxic"))


# ------------------------------------------------------------------ 8 chat formatting
CONTROL_TEXT = "\\### Assistant: </turn> ok"

OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
x AS (SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS body,
             replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ':', ':\') AS head FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + length(head) + length(body))::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""


@query("op8_chat_format", OP8_SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.chat_format import events_of_rows, fold_events, read_back, render

    cols = ["conv_id", "turn", "role", "text"]
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*cols).unionByName(extra)
    out = read_back(render(fold_events(events_of_rows(rows))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.array_join(F.transform("turns", lambda t: t["loss"]), "")  # turns without a mask have none
    return (out.select("conv_id", "turns", "formatted_chars", F.array_join(turns, "").alias("whole"), masked.alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("whole", 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))


# ------------------------------------------------------------------ 9 byte-level BPE
@query("op9_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ticklab.llm.bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = decode(encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


# ------------------------------------------------------------------ 10 packing
@query("op10_harmonic_packing")
def harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ticklab.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


# ------------------------------------------------------------------ 11 benchmark decontamination
OP11_SQL = r"""
WITH low(kind, id, name, w) AS (
  SELECT 'd', row_number() OVER (), CAST(doc_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), CAST(item_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS m FROM low WHERE kind = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT name, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g FROM sized, unnest(range(1, len(w) - m + 2)) t(i)),
seen AS (SELECT id, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
         FROM low, (SELECT DISTINCT m FROM sized) s, unnest(range(1, len(w) - m + 2)) t(i) WHERE kind = 'd'),
hits AS (SELECT id, i, seen.m, name FROM seen JOIN windows USING (m, g)),
words AS (SELECT id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(m)) t(k) GROUP BY id),
named AS (SELECT id, count(DISTINCT name) AS n_items, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM hits GROUP BY id)
SELECT CAST(low.name AS BIGINT) AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN words USING (id) LEFT JOIN named USING (id) WHERE kind = 'd'
"""


@query("op11_decontamination", OP11_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.decontaminate import find_items

    out = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return out.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


# ------------------------------------------------------------------ 13 Merkle manifest
#: CRC-32 of a VARCHAR column in DuckDB, which has no such function: the reflected polynomial, bit by bit.
def crc32_sql(col: str) -> str:
    byte = "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(c, b) & 255)"
    return f"xor(list_reduce(list_transform(string_split({col}, ''), lambda x: unicode(x)::BIGINT), lambda c, b: xor(c >> 8, {byte}), 4294967295), 4294967295)"


def _op13_sql(levels: int = 7) -> str:
    """Trees of up to 8^levels leaves a language, level by level."""
    def leaf(text: str) -> str:
        field = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
        return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    run = "string_agg(h, '') OVER (PARTITION BY g, p // 8 ORDER BY p ROWS BETWEEN {0} AND {1})"
    before, after = run.format("UNBOUNDED PRECEDING", "1 PRECEDING"), run.format("1 FOLLOWING", "UNBOUNDED FOLLOWING")

    def tree(name: str, at: str) -> str:
        """name_k: nodes of level k with their left and right siblings; a finished tree's only node goes on unchanged."""
        out = []
        for k in range(levels + 1):
            source = at if k == 0 else (f"SELECT g, p // 8 AS p, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h "
                                        f"FROM {name}_{k - 1} GROUP BY g, p // 8")
            out.append(f"{name}_{k} AS (SELECT *, CASE WHEN n > 1 THEN coalesce({before}, '') END AS l, CASE WHEN n > 1 THEN coalesce({after}, '') END AS r "
                       f"FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM ({source})))")
        return ",\n".join(out)

    def folded(name: str, src: str, into: str) -> str:
        """Each row's fold and proof through the levels: columns f (folded) and s (siblings so far)."""
        sql = src
        for k in range(levels):
            sql = (f"SELECT x.* EXCLUDE (f, s), CASE WHEN t.n > 1 THEN sha256(t.l || x.f || t.r) ELSE x.f END AS f, CASE WHEN t.n > 1 THEN x.s || t.l || t.r ELSE x.s END AS s "
                   f"FROM ({sql}) x JOIN {name}_{k} t ON t.g = x.{into} AND t.p = x.{into}p // {8 ** k}")
        return sql

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('text')} AS leaf,
             CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS t FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS gp FROM d),
{tree('a', 'SELECT g, gp AS p, leaf AS h FROM p')},
roots AS (SELECT g AS lang, 0 AS g, row_number() OVER (ORDER BY g) - 1 AS p, h FROM a_{levels}),
{tree('b', 'SELECT g, p, h FROM roots')},
inside AS ({folded('a', "SELECT doc_id, leaf, g, gp, t AS f, '' AS s FROM p", 'g')}),
whole AS ({folded('b', "SELECT doc_id, leaf, i.f, i.s, h AS subroot, 0 AS g, p AS gp FROM inside i JOIN roots ON lang = i.g", 'g')})
SELECT doc_id, leaf, subroot, (SELECT h FROM b_{levels}) AS root, sha256(s) AS proof_sha256, f AS folded_root, f = (SELECT h FROM b_{levels}) AS verified FROM whole
"""


@query("op13_merkle_manifest", _op13_sql())
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.common import lower_ascii
    from ticklab.llm.merkle import leaf_text, manifest, verify

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    cols = ["doc_id", "source", "lang", "n_chars"]
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    found = F.when(touched, lower_ascii("text")).otherwise(F.col("text"))  # what a later reader finds

    def leaf(col):
        return F.unhex(F.sha2(leaf_text(*cols, col), 256))
    leaves = docs.withColumn("found", found).select("doc_id", "lang", leaf("text").alias("leaf"), leaf("found").alias("found"))
    out = verify(manifest(leaves, carry=["found"]), "found")

    def text(c):
        return F.lower(F.hex(c))
    return out.select(F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                      text("proof").alias("proof_sha256"), text("folded_root").alias("folded_root"), "verified")


# ------------------------------------------------------------------ 12 conversation structure repair
def damage(rows: DataFrame) -> DataFrame:
    """The log with about a fifth of its rows damaged, by conversation and turn; nulls of role and text are one space,
    so are those of conversation and turn in the hash."""
    def name(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(F.col("text"), ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"))
    return (rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy"))


def _op12_sql() -> str:
    """Cost and audit to the end in one text for every state (0 to 3), row by row from the last."""
    def add(v: str, cost: str, mark: str) -> str:
        return f"(printf('%08d', {v}[1:8]::BIGINT + {cost}) || '{mark}' || {v}[9:])"

    nxt = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    base = []
    for q, (role, to) in nxt.items():
        ways = [add(f"r.v{to}", "3 + m.extra", "R"), f"CASE WHEN m.c = '{role}' THEN {add(f'r.v{to}', 'm.extra', 'K')} ELSE '~' END"]
        if q == 0:
            ways.append(f"CASE WHEN m.c = 's' THEN {add('r.v1', 'm.extra', 'K')} ELSE '~' END")
        base.append(f"least({add(f'r.v{q}', '4', 'D')}, CASE WHEN m.fault IN ('blank', 'duplicate') THEN '~' ELSE least({', '.join(ways)}) END) AS b{q}")
    one = ", ".join(f"least(b{q}, {add(f'b{to}', '3', 'I')}) AS w{q}" for q, (_, to) in nxt.items())
    two = ", ".join(f"least(b{q}, {add(f'w{to}', '3', 'I')}) AS v{q}" for q, (_, to) in nxt.items())
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d FROM conversations),
r0 AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
          unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE d <> 0),
r1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i FROM r0),
r2 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, role[1] AS c0, trim(text, {blanks}) AS t FROM r1),
marked AS (SELECT conv_id, turn, role, text, i, c0, CASE WHEN c0 IN ('s', 'u', 'a') THEN c0 ELSE 'x' END AS c,
             CASE WHEN t = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN t[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM r2),
m AS (SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM marked),
stats AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
            count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id),
r(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n, '00000000', '00000006II', '00000003I', '00000000' FROM stats
  UNION ALL
  SELECT conv_id, i, {', '.join(f'v{q}' for q in nxt)} FROM (SELECT conv_id, i, {two} FROM (SELECT *, {one} FROM (SELECT m.conv_id, m.i, {', '.join(base)} FROM r JOIN m ON m.conv_id = r.conv_id AND m.i = r.i - 1)))),
best AS (SELECT conv_id, v0[1:8]::BIGINT AS cost, v0[9:] AS audit FROM r WHERE i = 0),
marks AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(length(audit))) AS j FROM best WHERE audit <> ''),
edits AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY j) - 1 AS at, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id ORDER BY j) - 1 AS o FROM marks),
kept AS (SELECT e.*, m.role, m.text, m.c FROM edits e LEFT JOIN m ON e <> 'I' AND m.conv_id = e.conv_id AND m.i = e.at WHERE e <> 'D'),
heads AS (SELECT conv_id, max(CASE WHEN o = 0 AND e = 'K' AND c = 's' THEN 1 ELSE 0 END) AS s FROM kept GROUP BY conv_id),
lines AS (SELECT kept.conv_id, j, CASE WHEN e = 'K' THEN role WHEN (o - s) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line FROM kept JOIN heads USING (conv_id)),
fixed AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS h FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN fixed USING (conv_id)
"""


@query("op12_structure_repair", _op12_sql())
def structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklab.llm.repair import repair

    rows = table(spark, sf_dir, "conversations")
    out, segments = repair(damage(rows))
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    texts = (segments.where(F.size("repaired") > 0).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("chunk", F.array_join(lines, "\n").alias("lines")))).alias("p"))
             .select(F.col("conv").alias("text_conv"), F.sha2(F.array_join(F.transform("p", lambda p: p["lines"]), "\n"), 256).alias("h")))
    out = out.join(texts, F.col("conv").eqNullSafe(F.col("text_conv")), "left")
    every = rows.select("conv_id").distinct()
    found = out.join(every, F.col("conv").eqNullSafe(F.col("conv_id")), "right")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("h", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
