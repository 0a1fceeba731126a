"""SQL-dump ingest (S6): ``INSERT INTO ... VALUES (...),(...);`` text to the 23 tick columns.

Distributed: the text source splits at the tuple separator ``),`` (Hadoop line reader with a custom
separator, so files split across tasks), whatever follows it: a new line, a carriage return or the next
tuple. Quote-aware patterns then take the tuples out of each piece. Quoted text may hold commas,
parentheses, separators and newlines; ``''`` and ``\\'`` both mean a quote and ``\\\\`` a backslash.
A quoted ``),`` cuts its record: such pieces have an odd number of quotes, and are put together again in
file order. Unquoted NULL is NULL while the quoted text 'NULL' stays text. Records of the wrong width,
and text that is no record, are rejects (``dump_rejects``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklab.operators.layout import running_sum, with_positions
from ticklab.operators.quality import coerce_ticks
from ticklab.schema import TICK_COLUMNS, TICKS_RAW
from ticklab.session import materialize

# possessive and unrolled: no recursion per character, however long the text
QUOTED = r"'[^'\\]*+(?:(?:''|\\.)[^'\\]*+)*+'"
TUPLE = rf"(?s)\(([^'()]*+(?:{QUOTED}[^'()]*+)*+)(?:\)|$)"
HEADER = rf"(?is)({QUOTED})|\bINSERT\s+INTO\b[^']*?\bVALUES\s*"
COMMENT = rf"(?ms)({QUOTED})|^--[^\n]*$|/\*.*?\*/"
WIDTH = len(TICK_COLUMNS)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between separators that are not inside quotes."""
    text = spark.read.option("lineSep", "),").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit("'"), F.lit(""))).cast("long")) % 2
    text = text.withColumn("odd", odd.cast("long"))
    if text.where("odd = 1").isEmpty():
        return text.select("value")
    # an odd piece opens a cut record, the next odd one closes it: pieces between share one group
    placed = with_positions(text, ("file",), ("block", "row"), "pos")
    placed = materialize(running_sum(placed, "odd", "before", ("file",), "pos", inclusive=False), "dump-pieces")
    inside = F.coalesce("before", F.lit(0)) % 2 == 1
    cut = placed.withColumn("cut", inside | (F.col("odd") == 1))
    record = F.floor((F.coalesce("before", F.lit(0)) + F.col("odd") + 1) / 2)  # both ends and all between: the same number
    joined = (cut.where("cut").groupBy("file", record.alias("record")).agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("v"))
              .select(F.array_join(F.transform("v", lambda x: x["value"]), "),").alias("value")))
    return cut.where("not cut").select("value").unionByName(joined)


def dump_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per tuple text (without its parentheses) with its field count, and one with width 0 for text
    that is no tuple."""
    value = F.regexp_replace(F.regexp_replace("value", COMMENT, "$1"), HEADER, "$1")
    value = _pieces(spark, path).select(value.alias("value"))
    rest = F.trim(F.regexp_replace(F.regexp_replace("value", TUPLE, ""), r"(?i)[\s;,]+|\b(COMMIT|BEGIN)\b", " "))
    tuples = value.select(F.explode(F.regexp_extract_all("value", F.lit(TUPLE), F.lit(1))).alias("body"))
    unquoted = F.regexp_replace("body", rf"(?s){QUOTED}", "")
    width = F.length(unquoted) - F.length(F.regexp_replace(unquoted, ",", "")) + F.lit(1)
    other = value.select(rest.alias("body")).where("body <> ''").select("body", F.lit(0).alias("width"))
    return tuples.select("body", width.alias("width")).unionByName(other)


def _fields(body):
    """A tuple as one CSV record: escapes resolved, unquoted NULL an empty field."""
    body = F.regexp_replace(body, rf"(?is)({QUOTED})|(?:(?<=^|,)\s*NULL\s*(?=,|$))", "$1")
    held = F.replace(body, F.lit("\\\\"), F.lit("\x01"))  # two backslashes are one, and escape nothing
    for code, char in (("\\'", "''"), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        held = F.replace(held, F.lit(code), F.lit(char))
    return F.replace(held, F.lit("\x01"), F.lit("\\"))


def read_sql_dump(spark: SparkSession, path: str, with_rejects: bool = False):
    """Parse a dump into ticks (P1/P2 applied). With ``with_rejects`` also return the count of
    records of the wrong width (a DataFrame with one row); ``dump_rejects`` returns them and all other
    text, such as other statements."""
    recs = dump_records(spark, path)
    good = recs.where(F.col("width") == WIDTH)
    opts = {"quote": "'", "escape": "'", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
            "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    parsed = good.select(F.from_csv(_fields(F.col("body")), TICKS_RAW.simpleString(), opts).alias("r")).select("r.*")
    ticks = coerce_ticks(parsed)
    if with_rejects:
        rejects = recs.agg(F.count_if((F.col("width") != WIDTH) & (F.col("width") > 0)).alias("rejected"), F.count_if(F.col("width") > 0).alias("records"))
        return ticks, rejects
    return ticks


def dump_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Text and field count (0: no tuple) of everything that ``read_sql_dump`` leaves out."""
    return dump_records(spark, path).where(F.col("width") != WIDTH)


def _sql_literal(c, kind: str):
    if kind == "string":
        return F.when(c.isNull(), F.lit("NULL")).otherwise(
            F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
        )
    if kind == "timestamp":
        return F.when(c.isNull(), F.lit("NULL")).otherwise(
            F.concat(F.lit("'"), F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("'"))
        )
    return F.when(c.isNull(), F.lit("NULL")).otherwise(c.cast("string"))


def write_sql_dump(ticks: DataFrame, path: str, rows_per_insert: int = 500, table: str = "assets_history", between: str = ",\n") -> None:
    """Write ticks as an INSERT dump: a statement holds the ticks of ``rows_per_insert`` consecutive ids,
    with ``between`` between two tuples (",\n", ",\r\n" or "," in use)."""
    kinds = {n: ("string" if t.simpleString() == "string" else "timestamp" if "timestamp" in t.simpleString() else "num")
             for n, t in TICK_COLUMNS}
    tup = F.concat(F.lit("("), F.concat_ws(",", *[_sql_literal(F.col(n), kinds[n]) for n, _ in TICK_COLUMNS]), F.lit(")"))
    statement = F.floor(F.col("tick_id") / rows_per_insert).alias("statement")
    rows = ticks.select(statement, F.struct("tick_id", tup.alias("text")).alias("t")).groupBy("statement").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    text = F.concat(F.lit(f"INSERT INTO `{table}` VALUES\n"), F.array_join(F.transform("ts", lambda t: t["text"]), between), F.lit(";"))
    (rows.repartitionByRange("statement").sortWithinPartitions("statement").select(text.alias("value"))
     .write.mode("overwrite").text(path))
