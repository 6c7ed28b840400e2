"""Checks over the answer table, the dictionary and the marts; the bad number should be zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.text import date_value, strict_number
from tallgrass.operators.dictionary import Star


def _rows() -> Column:
    return F.count(F.lit(1))


def _as_rows(counted: DataFrame, name: str, value: str) -> DataFrame:
    return counted.unpivot([], list(counted.columns), name, value)


def fact_volume(fact: DataFrame) -> DataFrame:
    """Rows, participants, columns and surveys.

    Several distinct counts in one aggregate would multiply every row. Columns and surveys are few,
    so they are counted from the rows per column and survey; participants get their own aggregate.
    """
    per_column = fact.groupBy("source_column", "secondary_source_concept_id").agg(_rows().alias("n"))
    small = per_column.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.countDistinct("source_column").alias("distinct_source_columns"),
        F.countDistinct("secondary_source_concept_id").alias("distinct_surveys"),
    )
    people = fact.agg(F.countDistinct("connect_id").alias("distinct_participants"))
    return _as_rows(small, "metric", "value").unionByName(_as_rows(people, "metric", "value"))


def fact_by_table(fact: DataFrame) -> DataFrame:
    """Rows and participants per source table, in two aggregation steps."""
    per_person = fact.groupBy("source_table", "connect_id").agg(_rows().alias("n"))
    return per_person.groupBy("source_table").agg(
        F.sum("n").alias("n_rows"), F.count("connect_id").alias("participants")
    )


def grain_duplicates(fact: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    grain = ["connect_id", "source_table", "source_column", "loop_instance"]
    return fact.groupBy(*grain).agg(_rows().alias("n")).where("n > 1")


def fact_nulls(fact: DataFrame) -> DataFrame:
    """Missing and blank values."""
    value = F.col("response_value_as_string")
    return fact.agg(
        F.count_if(value.isNull()).alias("null_value_rows"),
        F.count_if(value == "").alias("empty_string_rows"),
        F.count_if(F.col("question_concept_id").isNull()).alias("null_question_rows"),
        F.count_if(F.col("secondary_source_concept_id").isNull()).alias("null_survey_rows"),
    )


def loop_bounds(fact: DataFrame) -> DataFrame:
    """Range of loop passes; the default is 1."""
    loop = F.col("loop_instance")
    return fact.agg(
        F.min(loop).alias("min_loop"),
        F.max(loop).alias("max_loop"),
        F.count_if(loop.isNull()).alias("null_loops"),
        F.count_if(loop < 1).alias("sub1_loops"),
    )


def _orphans(name: str, counted: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set and has no dimension row; keys are counted before the anti join."""
    missing = counted.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.lit(name).alias("check"), "n"
    )


def fact_orphans(fact: DataFrame, star: Star) -> DataFrame:
    """Answers whose question or survey the dictionary does not have."""
    by_question = fact.groupBy("question_concept_id").agg(_rows().alias("n"))
    by_survey = fact.groupBy("secondary_source_concept_id").agg(_rows().alias("n"))
    return _orphans("question orphans", by_question, star.question, "question_concept_id").unionByName(
        _orphans(
            "survey orphans", by_survey, star.secondary_source, "secondary_source_concept_id"
        )
    )


def star_orphans(star: Star) -> DataFrame:
    """Broken references between dictionary tables."""
    checks = (
        ("secondary->primary orphans", "secondary_source", "primary_source", "primary_source_concept_id"),
        ("question->secondary orphans", "question", "secondary_source", "secondary_source_concept_id"),
        ("question->source_question orphans", "question", "source_question", "source_question_concept_id"),
        ("question_response->question orphans", "question_response", "question", "question_concept_id"),
        ("question_response->response orphans", "question_response", "response", "response_concept_id"),
    )
    return reduce(
        DataFrame.unionByName,
        [
            _orphans(
                name,
                getattr(star, child).groupBy(key).agg(_rows().alias("n")),
                getattr(star, parent),
                key,
            )
            for name, child, parent, key in checks
        ],
    )


def coverage(fact: DataFrame, colmap: DataFrame, layer: str = "clean") -> DataFrame:
    """Mapped columns against columns that produced rows, per source table."""
    produced = (
        fact.groupBy("source_table", "source_column")
        .agg(_rows().alias("n"))
        .groupBy("source_table")
        .agg(_rows().alias("cols_with_rows"))
    )
    mapped = colmap.groupBy(F.concat(F.lit(f"{layer}."), "table_name").alias("source_table")).agg(
        _rows().alias("cols_mapped")
    )
    seen = F.coalesce("cols_with_rows", F.lit(0))
    return mapped.join(produced, "source_table", "left").select(
        "source_table",
        "cols_mapped",
        seen.alias("cols_with_rows"),
        (F.col("cols_mapped") - seen).alias("cols_all_null"),
    )


def spot_check(fact: DataFrame, parent: str) -> DataFrame:
    """Selections and participants of one select-all, per option and revision."""
    return (
        fact.where(F.col("source_question_concept_id") == parent)
        .groupBy("question_concept_id", "question_version")
        .agg(_rows().alias("selections"), F.countDistinct("connect_id").alias("participants"))
    )


def parent_crosscheck(placed: DataFrame, question: DataFrame) -> DataFrame:
    """Agreement of the source question read from columns with the one in the dictionary."""
    pairs = (
        placed.where("question_concept_id <> '' AND source_question_concept_id <> ''")
        .select("question_concept_id", F.col("source_question_concept_id").alias("col_sq"))
        .distinct()
    )
    parents = pairs.groupBy("question_concept_id").agg(_rows().alias("n_parents"))
    agrees = F.coalesce(F.col("col_sq") == F.col("source_question_concept_id"), F.lit(False))
    single = F.col("n_parents") == 1
    return (
        pairs.join(parents, "question_concept_id")
        .join(question.select("question_concept_id", "source_question_concept_id"), "question_concept_id")
        .agg(
            _rows().alias("pairs_compared"),
            F.count_if(agrees).alias("agree_all"),
            F.count_if(single).alias("single_parent_pairs"),
            F.count_if(single & agrees).alias("single_parent_agree"),
            F.countDistinct(
                F.when(F.col("n_parents") > 1, F.col("question_concept_id"))
            ).alias("reused_concepts"),
        )
    )


def source_code_checks(codes: DataFrame) -> DataFrame:
    """Rows against distinct ids, and the range of the ids."""
    code = F.col("response_unique_id")
    return codes.agg(
        _rows().alias("n_rows"),
        F.countDistinct(code).alias("distinct_ids"),
        F.count_if(code <= 2_000_000_000).alias("ids_too_small"),
        F.min(code).alias("min_id"),
        F.max(code).alias("max_id"),
    )


def rule_violations(
    fact: DataFrame, rules: DataFrame, star: Star, sessions: DataFrame
) -> DataFrame:
    """Violations per participant of metadata-driven rules.

    Described in prose only. ``rules`` is ``rule_id, rule_class, question_concept_id, argument,
    gate_question, gate_answer`` with classes ``is_numeric``, ``is_date``, ``max_length``,
    ``in_option_set`` (an answer outside the allowed responses), ``required`` (submitted the survey in
    ``argument`` without answering) and ``required_if`` (gave ``gate_answer`` to ``gate_question``
    without answering). Blank answers count as given; a value rule is not applied to them.
    """
    value = F.col("response_value_as_string")
    kind = F.col("rule_class")
    out = ["rule_id", "rule_class", "connect_id", "question_concept_id"]
    checked = fact.where(value != "").join(
        rules.where(kind.isin("is_numeric", "is_date", "max_length", "in_option_set")),
        "question_concept_id",
    )
    broken = (
        F.when(kind == "is_numeric", strict_number(value).isNull())
        .when(kind == "is_date", date_value(value).isNull())
        .when(kind == "max_length", F.char_length(value) > F.col("argument").try_cast("bigint"))
        .otherwise(F.col("allowed").isNull())
    )
    allowed = star.question_response.select(
        "question_concept_id", F.col("response_concept_id").alias("response_value_as_string"), F.lit(True).alias("allowed")
    ).distinct()
    by_value = checked.join(allowed, ["question_concept_id", "response_value_as_string"], "left").where(broken).select(*out)
    expected = rules.where(kind.isin("required", "required_if")).select("question_concept_id").distinct()
    given = (
        fact.join(expected, "question_concept_id", "left_semi")
        .select("connect_id", "question_concept_id")
        .distinct()
    )
    must = rules.where(kind == "required").withColumnRenamed(
        "argument", "secondary_source_concept_id"
    )
    required = (
        sessions.where("is_complete")
        .join(must, "secondary_source_concept_id")
        .join(given, ["connect_id", "question_concept_id"], "left_anti")
        .select(*out)
    )
    gated = rules.where(kind == "required_if").select(
        "rule_id",
        "rule_class",
        F.col("question_concept_id").alias("needed"),
        F.col("gate_question").alias("question_concept_id"),
        F.col("gate_answer").alias("response_value_as_string"),
    )
    opened = (
        fact.join(gated, ["question_concept_id", "response_value_as_string"])
        .select("rule_id", "rule_class", "connect_id", F.col("needed").alias("question_concept_id"))
        .distinct()
    )
    unmet = opened.join(given, ["connect_id", "question_concept_id"], "left_anti").select(*out)
    return by_value.unionByName(required).unionByName(unmet)


def violation_counts(violations: DataFrame) -> DataFrame:
    """Violations per rule."""
    return violations.groupBy("rule_id", "rule_class").agg(_rows().alias("violations"))


def mart_contracts(
    mart: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Violations of each contract of a mart, all counted in one pass."""
    checks = [F.count_if(F.col(c).isNull()).alias(f"not_null({c})") for c in not_null]
    for c, values in (accepted or {}).items():
        checks.append(F.count_if(~F.col(c).isin(*values)).alias(f"accepted_values({c})"))
    for c, (low, high) in (ranges or {}).items():
        checks.append(F.count_if(~F.col(c).between(low, high)).alias(f"range({c})"))
    return _as_rows(mart.agg(*checks), "contract", "violations")
