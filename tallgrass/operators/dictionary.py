"""Dimensions from the flat dictionary, and equivalence edges between concepts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions.text import blank_to_null


def blanks_to_null(rows: DataFrame, order: str = "rn") -> DataFrame:
    """NULL for every blank text cell; the order column is left alone."""
    return rows.select(
        *[F.col(c) if c == order else blank_to_null(F.col(c)).alias(c) for c in rows.columns]
    )


def forward_fill(
    df: DataFrame, order: str, columns: Sequence[str], block: int = 1_000_000
) -> DataFrame:
    """Add ``<column>_f``: the last non-null value at or before the row, in ``order``.

    ``order`` is a unique integer. A single ordered window would run in one task, so the order axis
    is cut into blocks of ``block`` numbers: each block is filled on its own, a summary with one row
    per block is filled in order, and the value carried into a block fills its leading gap. A block
    holds at most ``block`` rows, and only the summary (rows / block) is ordered as a whole.
    """
    cut = F.floor(F.col(order) / F.lit(block)).cast("bigint")
    blocked = df.withColumn("__block", cut)
    upto = Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = blocked.select(
        "*", *[F.last(c, ignorenulls=True).over(upto).alias(f"__in_{c}") for c in columns]
    )
    summary = blocked.groupBy("__block").agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__last_{c}")
            for c in columns
        ]
    )
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        "__block",
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns],
    )
    filled = [F.coalesce(f"__in_{c}", f"__carry_{c}").alias(f"{c}_f") for c in columns]
    return inside.join(carry, "__block", "left").select(*df.columns, *filled)


@dataclass(frozen=True)
class Star:
    """The dictionary tables; each is unique on its key."""

    primary_source: DataFrame
    secondary_source: DataFrame
    source_question: DataFrame
    question: DataFrame
    response: DataFrame
    question_response: DataFrame
    variable_metadata: DataFrame | None = None


def _first(value: str, order: str = "rn") -> Column:
    """First non-null value in file order, so rebuilds agree."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def _dimension(rows: DataFrame, key: str, key_name: str, **values: str) -> DataFrame:
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(key_name))
        .agg(*[_first(source).alias(name) for name, source in values.items()])
    )


def filled_rows(rows: DataFrame) -> DataFrame:
    """Dictionary rows, blanks as NULL, with the section and question carried down."""
    return forward_fill(
        blanks_to_null(rows), "rn", ["prim_cid", "prim", "sec_cid", "sec", "q_cid"]
    )


def build_star(filled: DataFrame) -> Star:
    """All dictionary tables from the filled rows.

    Where a concept appears several times its first non-null attribute is kept. A question takes its
    survey from the carried section and its source question from its own rows only.
    """
    return Star(
        primary_source=_dimension(
            filled, "prim_cid", "primary_source_concept_id", primary_source="prim"
        ),
        secondary_source=_dimension(
            filled,
            "sec_cid",
            "secondary_source_concept_id",
            secondary_source="sec_f",
            primary_source_concept_id="prim_cid_f",
        ),
        source_question=_dimension(
            filled,
            "sq_cid",
            "source_question_concept_id",
            source_question_text="sq_text",
            grid_name="grid_name",
        ),
        question=_dimension(
            filled,
            "q_cid",
            "question_concept_id",
            question_text="q_text",
            question_type="q_type",
            secondary_source_concept_id="sec_cid_f",
            source_question_concept_id="sq_cid",
        ),
        response=_dimension(filled, "resp_cid", "response_concept_id", format_value="resp_fmt"),
        question_response=question_response(filled),
    )


def question_response(filled: DataFrame) -> DataFrame:
    """The responses each question allows."""
    return (
        filled.where(F.col("resp_cid").isNotNull() & F.col("q_cid_f").isNotNull())
        .select(
            F.col("q_cid_f").alias("question_concept_id"),
            F.col("resp_cid").alias("response_concept_id"),
        )
        .distinct()
    )


VARIABLE_KEY = (
    "primary_source_concept_id", "secondary_source_concept_id", "source_question_concept_id", "question_concept_id", "response_concept_id",
)


def variable_metadata(rows: DataFrame) -> DataFrame:
    """One row per variable: five concept ids, and the first label, type, length, privacy flag and status in file order.

    ``rows`` are dictionary rows with ``variable_label, variable_type, variable_length, pii, status`` beside the
    concept columns. Section and question are carried down. The source question is that of the question's own row;
    a question that opens without one has none, so both are carried together. Blank and unknown flags are NULL.
    """
    filled = forward_fill(
        blanks_to_null(rows).withColumn("__parent", F.when(F.col("q_cid") != "", F.struct("sq_cid"))),
        "rn", ["prim_cid", "sec_cid", "q_cid", "__parent"],
    )
    flag = F.lower("pii")
    named = filled.where("q_cid_f IS NOT NULL").select(
        "rn", F.col("prim_cid_f").alias(VARIABLE_KEY[0]), F.col("sec_cid_f").alias(VARIABLE_KEY[1]), F.col("__parent_f.sq_cid").alias(VARIABLE_KEY[2]),
        F.col("q_cid_f").alias(VARIABLE_KEY[3]), F.col("resp_cid").alias(VARIABLE_KEY[4]), "variable_label", "variable_type",
        F.col("variable_length").try_cast("bigint").alias("variable_length"), F.when(flag == "yes", True).when(flag == "no", False).alias("pii"),
        F.col("status").alias("deprecated_new_or_revised"),
    )
    values = ("variable_label", "variable_type", "variable_length", "pii", "deprecated_new_or_revised")
    return named.groupBy(*VARIABLE_KEY).agg(*[_first(v).alias(v) for v in values])


def v_data_dictionary(star: Star, ordered: bool = True) -> DataFrame:
    """Back to the flat grain: one row per question and allowed response."""
    flat = (
        star.question.join(star.secondary_source, "secondary_source_concept_id", "left")
        .join(star.primary_source, "primary_source_concept_id", "left")
        .join(star.source_question, "source_question_concept_id", "left")
        .join(star.question_response, "question_concept_id", "left")
        .join(star.response, "response_concept_id", "left")
        .select(
            "primary_source_concept_id",
            "primary_source",
            "secondary_source_concept_id",
            "secondary_source",
            "source_question_concept_id",
            "source_question_text",
            "grid_name",
            "question_concept_id",
            "question_text",
            "question_type",
            "response_concept_id",
            "format_value",
        )
    )
    if not ordered:
        return flat
    return flat.orderBy(
        "primary_source_concept_id",
        "secondary_source_concept_id",
        F.asc_nulls_first("source_question_concept_id"),
        "question_concept_id",
        F.asc_nulls_first("response_concept_id"),
    )


def dim_counts(star: Star) -> DataFrame:
    """Rows per dictionary table."""
    tables = (
        "primary_source", "secondary_source", "source_question", "question", "response",
        "question_response",
    )
    counts = None
    for name in tables:
        one = getattr(star, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# Address pieces and classes, tested in this order on the lower-case text.
ADDRESS_COMPONENTS = {
    "street_name": r"street.*name|full street",
    "street_number": r"street.*number|number.*street",
    "apartment": r"apartment|apt|unit|suite",
    "city": r"\bcity\b|town",
    "state": r"\bstate\b|province",
    "zip": r"zip|postal",
    "country": r"country",
}
ADDRESS_CLASSES = {"work": r"employer|work", "school": r"school"}


def _first_match(text: Column, patterns: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), F.lit(name)) for name, p in patterns.items()])


def address_fields(question: DataFrame) -> DataFrame:
    """Questions that ask for a piece of an address, with the piece and the kind of address."""
    text = F.lower("question_text")
    return (
        question.where("question_text IS NOT NULL")
        .select(
            "question_concept_id",
            "question_text",
            _first_match(text, ADDRESS_COMPONENTS).alias("component"),
            F.coalesce(_first_match(text, ADDRESS_CLASSES), F.lit("residence")).alias("address_class"),
        )
        .where("component IS NOT NULL")
    )


def concept_relationship(question: DataFrame) -> DataFrame:
    """Synonym edges from every address question to the lowest id of its piece and class."""
    fields = address_fields(question)
    canonical = fields.groupBy("component", "address_class").agg(
        F.min("question_concept_id").alias("concept_id_2")
    )
    return fields.join(canonical, ["component", "address_class"]).select(
        F.col("question_concept_id").alias("concept_id_1"),
        "concept_id_2",
        F.lit("synonym").alias("relationship"),
        F.format_string(
            "demo: address %s %s (matched on question text)", "address_class", "component"
        ).alias("relationship_source"),
    )


def group_sizes(edges: DataFrame) -> DataFrame:
    """Concepts per synonym group, largest first."""
    return (
        edges.groupBy("relationship_source")
        .agg(F.count(F.lit(1)).alias("n_concepts"))
        .orderBy(F.desc("n_concepts"), "relationship_source")
    )


def group_members(edges: DataFrame, question: DataFrame, source: str) -> DataFrame:
    """Questions of the group that ``source`` names, found through the group's canonical concept."""
    canonical = (
        edges.where(F.col("relationship_source") == source)
        .agg(F.min("concept_id_2").alias("concept_id_2"))
    )
    return (
        edges.where("relationship = 'synonym'")
        .join(canonical, "concept_id_2", "left_semi")
        .join(question, F.col("concept_id_1") == F.col("question_concept_id"))
        .select("question_concept_id", "question_text")
    )
