"""Small helpers shared by the operators: staged tables, bounded samples, fixed character sets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklab.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\f\r"  # [\x20\x09-\x0D]


def staged_path(spark: SparkSession, tag: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back (lineage ends there)."""
    path = staged_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if "/llm/" in folder:
            path.getFileSystem(conf).delete(path, True)


def lower_ascii(col):
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowest_hashes(rows: DataFrame, kinds: list[str], hash_col: str, tie_col: str, per_kind: int) -> tuple[DataFrame, DataFrame]:
    """(sample, sizes): of every combination of ``kinds`` the ``per_kind`` rows of lowest ``hash_col``, and the
    rows it has (column size). ``hash_col`` is a long over its whole range. A row whose hash lies far above
    its share is left out before the shuffle, so a frequent kind sends about 2 x per_kind rows to its task
    however many it has."""
    sizes = staged(rows.groupBy(*kinds).agg(F.count(F.lit(1)).alias("size")), "kind-sizes")
    share = F.least(F.lit(1.0), 2.0 * per_kind / F.col("size"))
    place = (F.col(hash_col).cast("double") / 2.0**63 + 1) / 2  # 0 to 1
    near = rows.join(sizes, kinds).where(place <= share)
    first = Window.partitionBy(*kinds).orderBy(hash_col, tie_col)
    return near.withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_kind).drop("r", "size"), sizes


def row_and_text(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """Columns ``keep`` as a struct ``row``; a column ``text`` only where the row does not hold the text as a
    string already (texts travel once)."""
    row = F.struct(*keep).alias("row")
    if text_col in keep and dict(docs.dtypes)[text_col] == "string":
        return docs.select(row)
    return docs.select(row, F.col(text_col).cast("string").alias("text"))


def texts_of(batch, text_col: str):
    """The Arrow texts of a batch of ``row_and_text``."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text_col)


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Texts go to Python in Arrow batches of at most about ``size``, unless the session sets a size of its
    own: Spark's 64 MB a batch are held several times over, by every running task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # fixed value: Spark's default
        spark.conf.set(key, size)
