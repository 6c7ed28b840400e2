"""A cleaning pipeline over ``documents``: each stage applies one text operator to what the one before kept.

All stages take rows as they come: a null or empty text is a text without words (the quality rules reject it), a null
``doc_id`` is a row like others, repeated rows are judged alike and near copies among them but one go, other columns
stay as they are whatever their names, very long texts are read whole, and no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import bpe_codec, decontaminate, jaccard_join, quality_rules, substring_arrays
from tallgrass.llm.graph import keep
from tallgrass.llm.queries import table, tokenizer

ROW = "row name"  # of tables made here; names a row by id and text, so that rows that share an id are judged one by one


def _row(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows whose name is not in ``rejected(doc_id)``."""
    gone = rejected.select(F.col("doc_id").alias(ROW)).distinct()
    return docs.join(gone, _row(docs) == gone[ROW], "left_anti")


def _named(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(_row(docs).alias("doc_id"), *columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go, those without text among them; without ``lang`` no language is known."""
    columns = ["text", *(c for c in docs.columns if c == "lang")]
    return _without(docs, quality_rules.quality_rules(spark, _named(docs, *columns)).where("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the smallest id; rows without an id come last.

    Rows without words are copies of nothing and all stay.
    """
    rows = docs.groupBy(_row(docs).alias(ROW)).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    linked = jaccard_join.jaccard_join(spark, _named(docs, "text")).where("n_shingles > 0")  # blank texts are no copies
    linked = linked.select(F.col("doc_id").alias(ROW), "component_id").distinct().join(rows, ROW)
    linked = keep(spark, linked, "linked")
    head = F.struct(F.col("id").isNull(), "id", ROW)
    heads = linked.groupBy("component_id").agg(F.min(head)[ROW].alias("head")).join(linked, "component_id")
    gone = heads.where(F.col("head") != F.col(ROW)).select(F.col(ROW).alias("doc_id"))
    left = _without(docs, gone)
    again = heads.where((F.col("head") == F.col(ROW)) & (F.col("copies") > 1)).select(F.col(ROW).alias("doc_id"))
    if again.isEmpty():
        return left
    again_rows = again.select(F.col("doc_id").alias(ROW))
    once = left.join(again_rows, _row(left) == again_rows[ROW], "left_semi").dropDuplicates(["doc_id", "text"])
    return _without(left, again).union(once)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or 400 bytes that stand elsewhere too are cut out; the document stays with the rest.

    A passage is a run of strings of 200 bytes that stand elsewhere. Shorter texts, empty and null ones stay as they
    are; ``n_chars`` follows the text where it is given.
    """
    found = substring_arrays.remove_repeats(spark, docs.select("doc_id", "text"), least=200, texts=True, words=50)
    cut = found.where("n_removed > 0").select(F.col("text_id").alias(ROW), "kept").dropDuplicates([ROW])
    cut = keep(spark, cut, "cut")
    joined = docs.join(cut, F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == cut[ROW], "left")
    changed = {"text": F.coalesce(cut["kept"], docs["text"])}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut["kept"].isNotNull(), F.char_length(cut["kept"]).cast(kind)).otherwise(docs["n_chars"])
    return joined.select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows without text hold none."""
    return _without(docs, decontaminate.find_items(spark, _named(docs, "text"), table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, a row for each document; a null text has no tokens."""
    return bpe_codec.encode(docs, tokenizer("word_bpe_49k.json"), digest=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("BPE encoding and decoding", tokens),
]

# BPE, and components of a similarity graph, are beyond SQL: tested against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
