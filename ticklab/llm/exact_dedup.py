"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

Texts are equal when identical after every run of blanks [\\x20\\x09-\\x0D] became one space. A text's
SHA-256 stands for it. Frequent digests would send all their rows to one reducer, so:

1. ``freqItems`` (the Karp-Schenker-Papadimitriou form of Misra-Gries, 1/support counters a task)
   names every digest that holds more than ``support`` of the rows, with possible false alarms;
2. an exact, map-side combined count verifies them; at most 1/support digests can pass;
3. these winners (a proven bound) are broadcast, and their rows are settled where they are;
4. all other digests are aggregated with a map-side combine and meet their rows in a join: a group streams
   through its task and is never held there, however close to ``support`` it is.

The text itself is read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklab.llm.common import staged


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Defined cases: a null text counts as empty; a null id sorts after every other id (keep_id is null
    when a group has no other); of rows that repeat one id and one text exactly one is kept, and each
    counts in group_size. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("digest"),
                              F.monotonically_increasing_id().alias("rid")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid"))
    n = rows.count()
    if not n:
        return _columns(rows.withColumns({"first": F.struct(F.lit(False).alias("n"), "doc_id", "rid"), "size": F.lit(1).cast("long")}))
    suspects = rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    winners = (rows.join(F.broadcast(suspects), "digest").groupBy("digest")
               .agg(F.count(F.lit(1)).alias("size"), first.alias("first")).where(F.col("size") > max(1, support * n)))
    marked = rows.join(F.broadcast(staged(winners, "winners")), "digest", "left")
    heavy = marked.where("size is not null")
    rest = marked.where("size is null").select(*rows.columns)
    groups = rest.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), first.alias("first"))
    # a merge join at every size: the groups grow with the documents
    rest = rest.join(groups.hint("merge"), "digest").select(*rows.columns, "size", "first")
    return _columns(heavy.select(*rest.columns).unionByName(rest))


def _columns(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                     (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("digest").alias("text_sha256"))
