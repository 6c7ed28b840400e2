"""Participant events: rounds, event tables, one unified view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT_COLUMNS = (
    "connect_id", "round_id", "category", "item_concept_id", "status_concept_id", "event_date",
)


def rounds_to_rows(participants: DataFrame, rounds: str, id_column: str = "connect_id") -> DataFrame:
    """An array of per-round structs as rows keyed by participant and round."""
    return participants.select(F.col(id_column).alias("connect_id"), F.inline(rounds))


def round_columns_to_rows(
    participants: DataFrame, columns: Mapping[str, Sequence[str]], names: Sequence[str]
) -> DataFrame:
    """Columns that carry the round in their name as rows; a round with no value gives no row.

    ``columns`` maps a round to its columns, in the order of ``names``.
    """
    rows = [
        F.struct(
            F.lit(round_id).alias("round_id"),
            *[F.col(c).alias(name) for c, name in zip(members, names, strict=True)],
        )
        for round_id, members in columns.items()
    ]
    any_value = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in names])
    return participants.select("connect_id", F.inline(F.array(*rows))).where(any_value)


def participant_events(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """All event tables in one shape.

    ``tables`` maps a category to its table, item column and date column; each table also has
    ``connect_id``, ``round_id`` and ``status_concept_id``.
    """
    parts = [
        table.select(
            "connect_id",
            "round_id",
            F.lit(category).alias("category"),
            F.col(item).alias("item_concept_id"),
            "status_concept_id",
            F.col(date).cast("date").alias("event_date"),
        )
        for category, (table, item, date) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def any_by_round(collections: DataFrame, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per participant and round, whether any collection has one of the listed specimens."""
    return collections.groupBy("connect_id", "round_id").agg(
        *[
            F.bool_or(F.col("specimen_concept_id").isin(*codes)).alias(name)
            for name, codes in flags.items()
        ]
    )


def label_to_concept(events: DataFrame, label: str, vocabulary: DataFrame) -> DataFrame:
    """Concept id of a free label, spelling and blanks ignored; NULL where the vocabulary has none.

    ``vocabulary`` is ``label, concept_id`` with one row per folded label.
    """
    known = vocabulary.select(
        F.lower(F.trim("label")).alias("__label"), F.col("concept_id").alias(f"{label}_concept_id")
    )
    return (
        events.withColumn("__label", F.lower(F.trim(label)))
        .join(known, "__label", "left")
        .drop("__label")
    )


def unmatched_labels(mapped: DataFrame, label: str) -> DataFrame:
    """Labels the vocabulary does not know, with their counts."""
    return (
        mapped.where(F.col(f"{label}_concept_id").isNull() & F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
    )
