"""The corpus pipeline: documents -> toxicity -> language ID -> line dedup -> SimHash near-dedup -> packing.

Each stage is (name, function(spark, docs, sf_dir) -> DataFrame). Its result is written as Parquet to the
shared checkpoint folder and read again as the next stage's documents. All stages but the last return the
columns of documents; rows with a null doc_id are ordinary documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.llm import langid, toxicity
from ticklab.llm.common import staged, table
from ticklab.llm.line_dedup import drop_repeated_lines
from ticklab.llm.packing import pack
from ticklab.llm.queries import TOXICITY, toxicity_labels
from ticklab.llm.simhash import simhash_groups

#: A document whose language is less certain than this is rejected, like one without a letter.
MIN_LANGUAGE_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which every category's probability stays below the cut that out-of-fold predictions gave."""
    model = toxicity.train(docs, toxicity_labels(table(spark, sf_dir, "labels")), TOXICITY)
    out = toxicity.predict(docs, model, docs.columns)
    return out.where(~toxicity.any_rejected()).select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is recognised; learns from the labelled ones. If none of them
    teaches a language, every document with a letter stays."""
    model = langid.train(docs.select("text", F.col("lang").alias("label")))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    out = langid.predict(docs, model, docs.columns)
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more share (the largest doc_id keeps them); n_chars follows."""
    out = drop_repeated_lines(docs)
    cols = [F.col(f"row.{c}") for c in docs.columns if c not in ("text", "n_chars")]
    return out.select(*cols, "text", F.length("text").cast("long").alias("n_chars")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every SimHash group (3-word shingles, 3 bits): that of the smallest doc_id, then of the lowest
    hash of id and text. Rows without an id go by their text and yield to any row with one; rows that repeat id
    and text are one document, rows that share only the id are documents of their own."""
    key = F.coalesce("doc_id", F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)).alias("key")
    mark = F.xxhash64(key, "text").alias("mark")
    groups = simhash_groups(docs.select(mark, "text"), "mark", words=3, radius=3)
    members = groups.groupBy(F.col("doc_id").alias("mark"), "component_id").count()
    # merge joins at every size: marks and kept rows grow with the documents
    named = members.join(docs.select(key, mark).distinct().hint("merge"), "mark")
    first = named.groupBy("component_id").agg(F.min(F.struct("key", "mark", "count")).alias("first"))
    stays = staged(first.select("first.*"), "near-copies")
    row = docs.select(key, mark, F.struct("*").alias("row"))

    def kept(rows: DataFrame) -> DataFrame:
        return row.join(rows.hint("merge"), ["key", "mark"], "left_semi")
    once = kept(stays.where("count = 1"))
    return once.unionByName(kept(stays.where("count > 1")).dropDuplicates(["key", "mark"])).select("row.*")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [("toxicity", drop_toxic), ("language_id", keep_known_languages), ("line_dedup", drop_lines),
          ("simhash_near_dedup", drop_near_copies), ("packing", pack_documents)]
ORACLE_SQL = None  # trained models decide two stages: not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
