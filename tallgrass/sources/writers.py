"""Writers: idempotent reloads, clustered layout, exports, catalog objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# cells come back as they were: Spark's writer trims blanks and escapes quotes with backslashes unless told otherwise
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CLUSTER_KEYS = ("secondary_source_concept_id", "question_concept_id", "connect_id")


def create_fact(spark: SparkSession, path: str, schema: T.StructType, recreate: bool = False) -> None:
    """An empty fact with the fixed schema; kept as it is when present, unless ``recreate``."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite" if recreate else "ignore").parquet(path)


def reload_source(fact: DataFrame, path: str, source: str | None = None) -> None:
    """Replace the rows of the source tables present in ``fact``; other sources stay.

    Name the ``source`` of a load that may be empty: an emptied source then loses its old rows.

    Each source table is one directory. A load comes from one wide table, so every task writes into
    its own source directory and nothing is shuffled.
    """
    (
        fact.write.partitionBy("source_table")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    if source is not None and fact.isEmpty():
        spark = fact.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"source_table={source}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_clustered(
    fact: DataFrame, path: str, keys: Sequence[str] = CLUSTER_KEYS, files: int | None = None
) -> None:
    """Range-partition and sort by survey, question, participant, with a bloom filter on participant.

    A survey or question filter then prunes files and row groups by min/max; a participant lookup,
    the last key, is helped by the bloom filter. A hot question spreads over ranges because the
    participant is part of the key. Ranges are found by sampling, which runs the input a second time,
    so pass a stored table rather than the plan of a load.
    """
    ranged = (
        fact.repartitionByRange(*keys) if files is None else fact.repartitionByRange(files, *keys)
    )
    (
        ranged.sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#connect_id", "true")
        .parquet(path)
    )


def write_shadow(fact: DataFrame, path: str) -> None:
    """The same rows in arrival order, for comparison with the clustered layout."""
    fact.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a parquet table."""
    df.write.mode("overwrite").parquet(path)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back.

    Cuts the lineage of a result that several plans read, survives the loss of executors, and gives
    the planner real sizes. ``path`` must be in a folder all executors share. Nothing reads the shuffle
    files of the write again, so Spark deletes them at its end instead of at some later collection.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A CSV ordered by its key.

    The sort is distributed and part files are in key order, so their concatenation is ordered; a
    dictionary table is small enough that adaptive execution leaves one part. Blanks, quotes and line
    breaks inside cells are kept.
    """
    ordered = df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    ordered.write.mode("overwrite").options(**CSV).csv(path, header=True)


def export_records(df: DataFrame, path: str) -> None:
    """One JSON object per row, missing values included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL users of this session."""
    df.createOrReplaceTempView(name)
    return df
