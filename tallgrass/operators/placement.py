"""Column names to dictionary positions: parse, place, review, map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import names
from tallgrass.operators.dictionary import forward_fill
from tallgrass.schema import NON_SURVEY_TABLES


def parse_columns(
    columns: DataFrame,
    layer: str = "flat",
    loop_style: str = "auto",
    keep_all: bool = False,
    non_survey: Sequence[str] = NON_SURVEY_TABLES,
) -> DataFrame:
    """Parse ``table, column`` rows into concept path, loop pass, revision tag and odd tokens.

    ``loop_style`` is ``flat`` (doubled number), ``clean`` (single number) or ``auto``, which takes
    ``clean`` for the layer of that name. Columns without a concept are dropped unless ``keep_all``.
    """
    style = loop_style
    if style == "auto":
        style = "clean" if layer.lower().startswith("clean") else "flat"
    loop = names.loop_clean if style == "clean" else names.loop_flat
    name = F.col("column")
    parsed = (
        columns.where(~F.col("table").isin(*non_survey))
        .withColumn("ids", names.concept_ids(name))
        .select(
            F.lit(layer).alias("layer"),
            "table",
            "column",
            F.size("ids").cast("bigint").alias("n_concepts"),
            F.array_join("ids", ";").alias("concept_ids"),
            loop(name).alias("loop_number"),
            names.version_tag(name).alias("version_tag"),
            F.array_join(names.odd_tokens(name), ";").alias("nonconforming_tokens"),
        )
    )
    return parsed if keep_all else parsed.where("n_concepts > 0")


def parse_counts(columns: DataFrame, non_survey: Sequence[str] = NON_SURVEY_TABLES) -> DataFrame:
    """How many columns were seen, parsed and skipped for having no concept."""
    has_id = F.size(names.concept_ids(F.col("column"))) > 0
    return columns.where(~F.col("table").isin(*non_survey)).agg(
        F.count(F.lit(1)).alias("columns_seen"),
        F.count_if(has_id).alias("parsed"),
        F.count_if(~has_id).alias("skipped"),
    )


def _present(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) != ""


def concept_roles(rows: DataFrame) -> DataFrame:
    """Roles a concept plays anywhere in the dictionary: question, source question, any role."""
    roles = F.array(
        *[
            F.struct(F.trim(name).alias("concept_id"), F.lit(role).alias("role"))
            for name, role in (
                ("prim_cid", "domain"),
                ("sec_cid", "survey"),
                ("sq_cid", "source_question"),
                ("q_cid", "question"),
                ("resp_cid", "response"),
            )
        ]
    )
    return (
        rows.select(F.explode(roles).alias("r"))
        .select("r.concept_id", "r.role")
        .where("concept_id <> ''")
        .groupBy("concept_id")
        .agg(
            F.bool_or(F.col("role") == "question").alias("is_question"),
            F.bool_or(F.col("role") == "source_question").alias("is_source_question"),
        )
        .withColumn("has_role", F.col("concept_id").rlike(r"^[0-9]{9}\z"))
    )


def carried_rows(rows: DataFrame) -> DataFrame:
    """Dictionary rows with ``*_f`` columns carried down from the last row that had a value.

    Several of the functions below read the result; store it when the dictionary is large.
    """
    clean = rows.select(
        "rn",
        *[
            F.when(_present(name), F.trim(name)).alias(name)
            for name in ("prim_cid", "sec_cid", "sec", "q_cid")
        ],
    )
    return forward_fill(clean, "rn", ["prim_cid", "sec_cid", "q_cid"])


def survey_domain(carried: DataFrame) -> DataFrame:
    """Survey to domain; the first row that names the survey decides."""
    return (
        carried.where(F.col("sec_cid").isNotNull())
        .groupBy(F.col("sec_cid").alias("secondary_source_concept_id"))
        .agg(
            F.coalesce(F.min_by(F.coalesce("prim_cid_f", F.lit("")), "rn"), F.lit("")).alias(
                "primary_source_concept_id"
            )
        )
    )


def survey_names(rows: DataFrame) -> DataFrame:
    """Survey to its name; the last row that names both decides."""
    return (
        rows.where(_present("sec_cid") & _present("sec"))
        .groupBy(F.trim("sec_cid").alias("secondary_source_concept_id"))
        .agg(F.max_by(F.trim("sec"), "rn").alias("secondary_source"))
    )


def question_surveys(carried: DataFrame, carry_survey: bool = True) -> DataFrame:
    """Distinct (question, survey) pairs, the question carried down to its response rows.

    With ``carry_survey`` the survey is carried down too (used for the match flag). Without it only
    rows that state a survey count (used for the review list); the two give different sets.
    """
    survey = "sec_cid_f" if carry_survey else "sec_cid"
    return (
        carried.where(F.col("q_cid_f").isNotNull() & F.col(survey).isNotNull())
        .select(
            F.col("q_cid_f").alias("question_concept_id"),
            F.col(survey).alias("secondary_source_concept_id"),
        )
        .distinct()
    )


def place_columns(
    parsed: DataFrame,
    roles: DataFrame,
    pairs: DataFrame,
    crosswalk: DataFrame,
    domains: DataFrame,
) -> DataFrame:
    """Give every parsed column its domain, survey, source question and question.

    The last concept of the path is the question, unless the dictionary knows it only as a source
    question; then it is the source question and the question stays blank. ``crosswalk`` is one row
    per table (see :func:`tallgrass.sources.readers.crosswalk_first`).
    """
    ids = F.split("concept_ids", ";")
    leaf = F.when(F.col("n_concepts") > 0, F.element_at(ids, -1)).otherwise("")
    known = roles.select(F.col("concept_id").alias("leaf"), "is_question", "is_source_question")
    surveys = crosswalk.select(
        F.col("table_name").alias("base"), F.col("secondary_source_concept_id").alias("survey")
    )
    role = (
        F.when(F.col("is_question"), "question")
        .when(F.col("is_source_question"), "source_question")
        .when(F.col("leaf") != "", "other")
        .otherwise("")
    )
    at_parent = F.col("leaf_role") == "source_question"
    first_of_many = F.when(F.col("n_concepts") >= 2, F.element_at(ids, 1)).otherwise("")
    placed = (
        parsed.withColumn("leaf", leaf)
        .withColumn("base", names.base_table(F.col("table")))
        .join(known, "leaf", "left")
        .join(surveys, "base", "left")
        .withColumn("leaf_role", role)
        .withColumn("secondary_source_concept_id", F.coalesce("survey", F.lit("")))
        .withColumn(
            "source_question_concept_id", F.when(at_parent, F.col("leaf")).otherwise(first_of_many)
        )
        .withColumn("question_concept_id", F.when(at_parent, "").otherwise(F.col("leaf")))
    )
    matched = pairs.withColumn("matched", F.lit(True))
    return (
        placed.join(domains, "secondary_source_concept_id", "left")
        .join(matched, ["question_concept_id", "secondary_source_concept_id"], "left")
        .select(
            *parsed.columns,
            F.coalesce("primary_source_concept_id", F.lit("")).alias("primary_source_concept_id"),
            "secondary_source_concept_id",
            "source_question_concept_id",
            "question_concept_id",
            F.lit("").alias("response_concept_id"),
            "leaf_role",
            F.when(F.col("leaf_role") == "question", "Y").otherwise("N").alias("question_in_dict"),
            F.when(F.col("matched"), "Y").otherwise("N").alias("secondary_source_match"),
        )
    )


def placement_totals(placed: DataFrame) -> DataFrame:
    """Totals of the placement flags."""
    return placed.agg(
        F.count(F.lit(1)).alias("columns_mapped"),
        F.count_if(F.col("question_in_dict") == "Y").alias("leaf_is_question"),
        F.count_if(F.col("secondary_source_match") == "Y").alias("survey_match"),
        F.count_if(F.col("secondary_source_concept_id") == "").alias("tables_without_survey"),
    )


def review_worklist(
    placed: DataFrame,
    roles: DataFrame,
    stated_pairs: DataFrame,
    names_of_surveys: DataFrame,
    unconfirmed_tables: Sequence[str] = (),
) -> DataFrame:
    """Columns that did not map cleanly, each with the first issue that applies.

    ``stated_pairs`` are the pairs without carried surveys. ``unconfirmed_tables`` are tables whose
    survey mapping is known to be unconfirmed. A question lists at most one name per survey.
    """
    known = roles.select(F.col("concept_id").alias("question_concept_id"), "has_role")
    labelled = (
        stated_pairs.join(names_of_surveys, "secondary_source_concept_id", "left")
        .groupBy("question_concept_id")
        .agg(
            F.array_join(
                F.array_sort(
                    F.collect_list(F.coalesce("secondary_source", "secondary_source_concept_id"))
                ),
                ";",
            ).alias("dict_secondary_sources")
        )
    )
    is_other = F.col("leaf_role") == "other"
    unmatched = F.col("secondary_source_match") == "N"
    issue = (
        F.when(F.col("nonconforming_tokens") != "", "impure_token_present")
        .when(F.col("leaf_role") == "source_question", "source_question_level_column")
        .when(is_other & F.coalesce("has_role", F.lit(False)), "concept_present_but_not_as_question")
        .when(is_other, "concept_absent_from_dictionary")
        .when(
            unmatched & F.col("table").isin(*unconfirmed_tables), "bio_survey_mapping_unconfirmed"
        )
        .when(unmatched, "reused_concept_survey_not_in_dict")
    )
    return (
        placed.join(known, "question_concept_id", "left")
        .withColumn("issue", issue)
        .where("issue IS NOT NULL")
        .join(labelled, "question_concept_id", "left")
        .select(
            "issue",
            "table",
            "column",
            "leaf_role",
            "question_concept_id",
            "source_question_concept_id",
            "secondary_source_concept_id",
            F.coalesce("dict_secondary_sources", F.lit("")).alias("dict_secondary_sources"),
            "version_tag",
            "loop_number",
            "nonconforming_tokens",
        )
    )


def issue_counts(worklist: DataFrame) -> DataFrame:
    """Columns per issue, most frequent first."""
    return (
        worklist.groupBy("issue")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "issue")
    )


def colmap(placed: DataFrame) -> DataFrame:
    """The mapping the reshape joins: loop defaults to 1, blank parent and tag become NULL.

    The question id is passed on as it is, so columns that sit at a source question keep ``''``.
    """
    return placed.select(
        F.col("table").alias("table_name"),
        F.col("column").alias("source_column"),
        "secondary_source_concept_id",
        F.nullif("source_question_concept_id", F.lit("")).alias("source_question_concept_id"),
        "question_concept_id",
        F.coalesce(F.col("loop_number").try_cast("bigint"), F.lit(1).cast("bigint")).alias(
            "loop_instance"
        ),
        F.nullif("version_tag", F.lit("")).alias("question_version"),
    )


def build_colmap(columns: DataFrame, sheet: DataFrame, crosswalk: DataFrame, layer: str = "clean") -> DataFrame:
    """From column names, the dictionary sheet and the crosswalk lines to the mapping that the load takes.

    ``columns`` is ``table, column``; ``crosswalk`` has one survey per table.
    """
    carried = carried_rows(sheet)
    placed = place_columns(
        parse_columns(columns, layer=layer), concept_roles(sheet), question_surveys(carried), crosswalk, survey_domain(carried)
    )
    return colmap(placed)
