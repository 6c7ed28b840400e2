"""Self-describing views over the answer table, and the source-code table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import text
from tallgrass.operators.dictionary import Star

ENRICHED = (
    "connect_id",
    "secondary_source_concept_id",
    "survey",
    "domain",
    "source_question_concept_id",
    "source_question",
    "question_concept_id",
    "question_text",
    "question_type",
    "question_version",
    "loop_instance",
    "response_value_as_string",
    "response_value_as_concept_id",
    "response_label",
    "response_value_as_number",
    "response_value_as_date",
    "response_option_set",
    "source_table",
    "source_column",
)
VARIABLE_COLUMNS = ("pii", "variable_type", "variable_label")


def option_set(star: Star) -> DataFrame:
    """The offered answers of each question as one text, in id order."""
    return (
        star.question_response.join(star.response, "response_concept_id", "left")
        .groupBy("question_concept_id")
        .agg(
            F.expr(
                "listagg(format_value, '; ') WITHIN GROUP (ORDER BY response_concept_id)"
            ).alias("response_option_set")
        )
    )


def responses_enriched(
    fact: DataFrame, star: Star, columns: Sequence[str] = ENRICHED
) -> DataFrame:
    """Answers with all dictionary context; only the joins that ``columns`` needs are made.

    Every join is a left join on a unique key, so the row count is that of the answer table. Survey
    and domain come from the survey stamped on the answer, never from the question's home survey.
    ``pii``, ``variable_type`` and ``variable_label`` need ``star.variable_metadata``.
    """
    wanted = set(columns)
    out = fact
    if wanted & {"survey", "domain"}:
        surveys = star.secondary_source.select(
            "secondary_source_concept_id",
            F.col("secondary_source").alias("survey"),
            "primary_source_concept_id",
        )
        out = out.join(surveys, "secondary_source_concept_id", "left")
        if "domain" in wanted:
            domains = star.primary_source.select(
                "primary_source_concept_id", F.col("primary_source").alias("domain")
            )
            out = out.join(domains, "primary_source_concept_id", "left")
    if wanted & {"question_text", "question_type"}:
        questions = star.question.select("question_concept_id", "question_text", "question_type")
        out = out.join(questions, "question_concept_id", "left")
    if "source_question" in wanted:
        parents = star.source_question.select(
            "source_question_concept_id", F.col("source_question_text").alias("source_question")
        )
        out = out.join(parents, "source_question_concept_id", "left")
    if "response_label" in wanted:
        labels = star.response.select(
            F.col("response_concept_id").alias("response_value_as_concept_id"),
            F.col("format_value").alias("response_label"),
        )
        out = out.join(labels, "response_value_as_concept_id", "left")
    if "response_option_set" in wanted:
        out = out.join(option_set(star), "question_concept_id", "left")
    if wanted & set(VARIABLE_COLUMNS):
        key = ["question_concept_id", "secondary_source_concept_id", "response_value_as_concept_id"]
        variables = (
            star.variable_metadata.withColumnRenamed(
                "response_concept_id", "response_value_as_concept_id"
            )
            .groupBy(*key)
            .agg(*[F.min(c).alias(c) for c in VARIABLE_COLUMNS])
        )
        out = out.join(variables, key, "left")
    return out.select(*columns)


def v_long(fact: DataFrame, star: Star) -> DataFrame:
    """Codes and labels side by side; ``answer`` is the label, or the text where there is none."""
    labels = star.response.select(
        F.col("response_concept_id").alias("response_value_as_concept_id"),
        F.col("format_value").alias("response_label"),
    )
    questions = star.question.select("question_concept_id", "question_text", "question_type")
    return (
        fact.join(questions, "question_concept_id")
        .join(labels, "response_value_as_concept_id", "left")
        .select(
            "connect_id",
            "question_concept_id",
            "question_text",
            "response_value_as_concept_id",
            "response_label",
            "response_value_as_string",
            "question_type",
            F.coalesce("response_label", "response_value_as_string").alias("answer"),
        )
    )


def source_codes(fact: DataFrame, star: Star) -> DataFrame:
    """One row per distinct survey, source question, question and non-blank answer, with its id.

    ``response_kind`` and the two text columns are decoration and never affect the id. The date test
    looks at the first ten characters only, so a timestamp also counts as a date. The costly text
    work runs after the distinct.
    """
    distinct = (
        fact.where("response_value_as_string <> ''")
        .select(
            "secondary_source_concept_id",
            "source_question_concept_id",
            "question_concept_id",
            "response_value_as_string",
            "response_unique_id",
        )
        .distinct()
    )
    value = F.col("response_value_as_string")
    allowed = star.question_response.select(
        "question_concept_id",
        F.col("response_concept_id").alias("response_value_as_string"),
        F.lit(True).alias("is_allowed"),
    )
    labels = star.response.select(
        F.col("response_concept_id").alias("response_value_as_string"), "format_value"
    )
    questions = star.question.select("question_concept_id", "question_text")
    kind = (
        F.when(F.col("is_allowed"), "coded")
        .when(
            text.strict_number(value).isNotNull() | value.rlike(text.DATE_PREFIX), "numeric_or_date"
        )
        .otherwise("free_text")
    )
    described = F.concat(
        F.coalesce("question_text", F.lit("")), F.lit(" | "), F.coalesce("format_value", value)
    )
    return (
        distinct.join(questions, "question_concept_id", "left")
        .join(allowed, ["question_concept_id", "response_value_as_string"], "left")
        .join(labels, "response_value_as_string", "left")
        .select(
            "response_unique_id",
            "secondary_source_concept_id",
            "source_question_concept_id",
            "question_concept_id",
            value.alias("response_value_verbatim"),
            kind.alias("response_kind"),
            text.normalize_text(value).alias("response_value_norm"),
            described.alias("source_code_description"),
        )
    )
