"""Readers for survey tables, dictionary files, crosswalks and questionnaire markup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.plans.session import scratch_path
from tallgrass.schema import DICTIONARY_POSITIONS, DICTIONARY_WIDTH
from tallgrass.sources.writers import store


def read_survey(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, id_column: str = "connect_id"
) -> DataFrame:
    """A wide survey table; with ``columns`` only the id and those columns are read."""
    wide = spark.read.parquet(path)
    return wide if columns is None else wide.select(id_column, *columns)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The long answer table."""
    return spark.read.parquet(path)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header, read with the given schema and no inference."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text, blank cells kept as empty text."""
    return spark.read.csv(
        path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True,
        nullValue="\u0000", emptyValue="",
    )


def number_in_file_order(scan: DataFrame, group: Column | None = None) -> DataFrame:
    """Rows of a file scan with ``line_id``, their place over all files, and ``line_no``, their place in their group.

    Files follow each other by name; ``group`` tells which files belong together (each file by itself if not given)
    and is returned as ``source``. A task reads blocks of several files in an order that depends on their size, so a
    running number of the scan says nothing. Each row's place inside its block is added to the rows in all blocks
    before: counts per file and block, one row a block, are the only thing that is ordered as a whole. The scan is
    stored once, since a second scan may be cut into other blocks.
    """
    spark = scan.sparkSession
    own = F.col("_metadata.file_path") if group is None else group
    held = store(
        scan.select(
            *scan.columns, own.alias("source"), F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"),
        ),
        scratch_path(spark, "lines"),
    )
    blocks = held.groupBy("source", "__file", "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    order = [F.col("__file"), F.col("__block")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "source", "__file", "__block", "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.coalesce(F.sum("__n").over(within), F.lit(0)).alias("__within"),
    )
    place = F.col("__at") - F.col("__first") + 1
    return held.join(starts, ["source", "__file", "__block"]).select(
        "source", (F.col("__within") + place).alias("line_no"), (F.col("__before") + place).alias("line_id"), *scan.columns
    )


def read_flat_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The positional dictionary: headers dropped, short rows padded, rows numbered in file order.

    A file is a spreadsheet with quoted line breaks, so one task reads it; several files follow each other by name
    and each has its own header. Blank cells are kept as they are; use
    :func:`tallgrass.operators.dictionary.blanks_to_null`.
    """
    schema = T.StructType(
        [T.StructField(f"column{i:02d}", T.StringType()) for i in range(DICTIONARY_WIDTH)]
    )
    raw = spark.read.csv(
        path, schema=schema, header=False, mode="PERMISSIVE", quote='"', escape='"', multiLine=True
    )
    named = [F.col(f"column{i:02d}").alias(name) for i, name in DICTIONARY_POSITIONS.items()]
    return number_in_file_order(raw).where("line_no > 1").select((F.col("line_id") - 1).alias("rn"), *named)


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """The table-to-survey crosswalk with its line number, over one file or several."""
    numbered = number_in_file_order(read_text_csv(spark, path))
    return numbered.withColumn("line", F.col("line_id") - 1).drop("source", "line_no", "line_id")


def crosswalk_first(crosswalk: DataFrame) -> DataFrame:
    """One survey per table: the first listed row with both values wins."""
    listed = crosswalk.select(
        F.trim("bq_table").alias("table_name"),
        F.trim("secondary_source_concept_id").alias("secondary_source_concept_id"),
        "line",
    ).where("table_name <> '' AND secondary_source_concept_id <> ''")
    return listed.groupBy("table_name").agg(
        F.min_by("secondary_source_concept_id", "line").alias("secondary_source_concept_id")
    )


def read_markup(spark: SparkSession, path: str) -> DataFrame:
    """Questionnaire markup: ``questionnaire, line_no, line_id, line``, numbered in file order.

    A questionnaire is a file, by its name, or all files of a ``questionnaire=...`` folder in order of their names. ``line_no`` starts at 1 in each; ``line_id`` runs on over all of them.
    """
    scan = spark.read.text(path)
    folder = "questionnaire" in scan.columns
    numbered = number_in_file_order(scan, F.col("questionnaire").cast("string") if folder else F.col("_metadata.file_name"))
    return numbered.select(F.col("source").alias("questionnaire"), "line_no", "line_id", F.col("value").alias("line"))
