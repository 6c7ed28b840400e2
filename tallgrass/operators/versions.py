"""Revisions of questions: axes, overlay, routing to successors, question types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.operators.dictionary import Star, forward_fill
from tallgrass.plans.session import scratch_path
from tallgrass.sources.writers import store

# Fixed value: how a variable name states its version and revision.
AXES = r"_v([0-9]+)r([0-9]+)$"


def version_of(label: Column) -> Column:
    """Major version in a variable name, NULL when it states none."""
    return F.regexp_extract(label, AXES, 1).try_cast("bigint")


def revision_of(label: Column) -> Column:
    """Minor revision in a variable name, NULL when it states none."""
    return F.regexp_extract(label, AXES, 2).try_cast("bigint")


def version_axes(variables: DataFrame) -> DataFrame:
    """Highest version and revision per concept, from its variable names."""
    label = F.col("variable_label")
    return variables.groupBy("question_concept_id").agg(
        F.max(version_of(label)).alias("max_version"), F.max(revision_of(label)).alias("max_revision")
    )


def version_census(variables: DataFrame) -> DataFrame:
    """Variables per version and revision."""
    label = F.col("variable_label")
    return variables.groupBy(
        version_of(label).alias("version"), revision_of(label).alias("revision")
    ).agg(F.count(F.lit(1)).alias("n"))


def question_lifecycle(rows: DataFrame) -> DataFrame:
    """Status of each question and the day it was added or deprecated.

    ``rows`` is ``rn, q_cid, status, status_date`` with blanks as NULL; the question is carried down
    to its rows and its first stated status and date count.
    """
    carried = forward_fill(rows, "rn", ["q_cid"]).where("q_cid_f IS NOT NULL")

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("rn"))).alias(name)

    stated = carried.groupBy(F.col("q_cid_f").alias("question_concept_id")).agg(
        first("status"), first("status_date")
    )

    def on(status: str) -> Column:
        return F.when(F.col("status") == status, F.col("status_date"))

    return stated.select(
        "question_concept_id",
        "status",
        on("New").alias("added_at"),
        on("Deprecated").alias("deprecated_at"),
    )


def v_question(question: DataFrame) -> DataFrame:
    """Questions with ``is_versioned`` derived from their status and highest version."""
    changed = F.coalesce(F.col("status").isin("Deprecated", "Revised"), F.lit(False))
    later = F.coalesce(F.col("max_version") > 1, F.lit(False))
    return question.withColumn("is_versioned", later | changed)


def question_version(question: DataFrame) -> DataFrame:
    """One row per wording of a question, from its current, V1 and V2 text columns.

    The current wording takes the highest version; an old column with that same number only repeats
    it and is left out. Blank columns give no row.
    """
    top = F.coalesce("max_version", F.lit(1).cast("bigint"))

    def wording(version: Column, which: str, status: Column, used: Column) -> Column:
        text = F.nullif(f"{which}_text", F.lit(""))
        return F.struct(
            version.alias("version"),
            F.when(used, text).alias("question_text"),
            F.col(f"{which}_source_question").alias("source_question_concept_id"),
            status.alias("status"),
        )

    current_status = F.coalesce(F.nullif("status", F.lit("")), F.lit("Current"))
    wordings = [wording(top, "current", current_status, F.lit(True))]
    for n in (1, 2):
        number = F.lit(n).cast("bigint")
        wordings.append(wording(number, f"v{n}", F.lit("Deprecated"), number != top))
    return question.select("question_concept_id", F.inline(F.array(*wordings))).where(
        "question_text IS NOT NULL"
    )


def response_options(fact: DataFrame, overrides: DataFrame) -> DataFrame:
    """Options offered per question and version: seen in the data, corrected by the dictionary.

    ``overrides`` is ``question_concept_id, version, response_concept_id, offered`` and wins over the
    data in both directions. An answer without a revision tag belongs to version 1.
    """
    key = ["question_concept_id", "version", "response_concept_id"]
    seen = (
        fact.where("response_value_as_concept_id IS NOT NULL")
        .select(
            "question_concept_id",
            answer_version().alias("version"),
            F.col("response_value_as_concept_id").alias("response_concept_id"),
        )
        .distinct()
    )
    stated = overrides.select(*key, "offered")
    return (
        seen.join(stated, key, "left_anti")
        .unionByName(stated.where("offered").select(*key).distinct())
    )


def answer_version() -> Column:
    """Version number of an answer from its revision tag; 1 without a tag."""
    tag = F.regexp_extract(F.coalesce("question_version", F.lit("")), r"^_v([0-9]+)$", 1)
    return F.coalesce(tag.try_cast("bigint"), F.lit(1).cast("bigint"))


def successor_chains(question: DataFrame) -> DataFrame:
    """``question_concept_id, current_question_cid, hops, in_cycle`` for every question.

    A deprecated question leads to its successor where that exists; the successor may be deprecated too. Chains
    are followed by pointer doubling: in every round a question takes over where its pointer points, so a chain
    of any length needs as many rounds as its length has binary digits. Before a question that is far from its end
    come others at every smaller distance, so a round in which none finds an end leaves only questions that are in
    a circle or lead into one; they are reported and stay under themselves.
    """
    spark = question.sparkSession
    listed = question.groupBy("question_concept_id").agg(
        F.min(F.when(F.col("status") == "Deprecated", F.col("successor_concept_id"))).alias("successor")
    )
    existing = listed.select(F.col("question_concept_id").alias("successor"))
    edges = store(
        listed.where("successor IS NOT NULL").join(existing, "successor", "left_semi").select("question_concept_id", "successor"),
        scratch_path(spark, "edges"),
    )
    inner = edges.select(F.col("question_concept_id").alias("to"), F.lit(False).alias("ends"))
    first = edges.select("question_concept_id", F.col("successor").alias("to"), F.lit(1).cast("bigint").alias("hops"))
    first = first.join(inner, "to", "left").select("question_concept_id", "to", "hops", F.coalesce("ends", F.lit(True)).alias("ends"))
    found, before = store(first, scratch_path(spark, "chains")), edges.count()
    while 0 < (left := found.where("NOT ends").count()) < before:
        before = left
        further = found.select(F.col("question_concept_id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("ends").alias("ended"))
        moved = found.where("NOT ends").join(further, "to").select(
            "question_concept_id", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"), F.col("ended").alias("ends")
        )
        found = store(found.where("ends").unionByName(moved), scratch_path(spark, "chains"))
    return listed.join(found, "question_concept_id", "left").select(
        "question_concept_id",
        F.when(F.col("ends"), F.col("to")).otherwise(F.col("question_concept_id")).alias("current_question_cid"),
        F.when(F.col("ends"), F.col("hops")).when(F.col("ends").isNull(), F.lit(0)).alias("hops"),
        F.coalesce(~F.col("ends"), F.lit(False)).alias("in_cycle"),
    )


def responses_current(fact: DataFrame, question: DataFrame) -> DataFrame:
    """Answers with the question they count under today, at the end of its chain of successors."""
    routes = successor_chains(question).where("hops > 0").select("question_concept_id", "current_question_cid")
    return fact.join(routes, "question_concept_id", "left").select(
        *fact.columns,
        F.coalesce("current_question_cid", "question_concept_id").alias("current_question_cid"),
    )


def pooled_successor(fact: DataFrame, question: DataFrame, star: Star) -> DataFrame:
    """Answer counts of listed questions, each counted where :func:`successor_chains` leads."""
    counted = fact.groupBy("question_concept_id", "response_value_as_concept_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    routed = counted.join(
        successor_chains(question).select("question_concept_id", F.col("current_question_cid").alias("q_cid")), "question_concept_id"
    )
    labels = star.response.select(
        F.col("response_concept_id").alias("response_value_as_concept_id"),
        F.col("format_value").alias("answer"),
    )
    return (
        routed.join(labels, "response_value_as_concept_id", "left")
        .groupBy("q_cid", "answer")
        .agg(F.sum("n").alias("n"))
    )


def pooled_versions(fact: DataFrame, options: DataFrame, star: Star, question: str) -> DataFrame:
    """Answers of one question per revision, with the number of versions that offered each answer."""
    offered = (
        options.where(F.col("question_concept_id") == question)
        .groupBy(F.col("response_concept_id").alias("response_value_as_concept_id"))
        .agg(F.countDistinct("version").alias("versions_offered"))
    )
    labels = star.response.select(
        F.col("response_concept_id").alias("response_value_as_concept_id"),
        F.col("format_value").alias("answer"),
    )
    counted = (
        fact.where(F.col("question_concept_id") == question)
        .groupBy("response_value_as_concept_id", "question_version")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.join(labels, "response_value_as_concept_id", "left")
        .join(offered, "response_value_as_concept_id", "left")
        .groupBy("answer", "question_version", "versions_offered")
        .agg(F.sum("n").alias("n"))
    )


def version_hazard(fact: DataFrame) -> DataFrame:
    """Questions answered under more than one revision tag, where pooling needs care.

    ``is_hazard`` counts tags as written, so answers without a tag do not count as a version;
    ``versions_seen`` counts them as version 1. Rows are reduced to one per question and tag first.
    """
    pairs = fact.groupBy("question_concept_id", "question_version").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("question_concept_id").agg(
        F.sum("n").alias("n"),
        F.countDistinct(answer_version()).alias("versions_seen"),
        (F.count("question_version") > 1).alias("is_hazard"),
    )


def dancing_pairs(columns: DataFrame) -> DataFrame:
    """Columns that exist with and without a revision tag, and those only with one.

    ``columns`` is ``table, column``; one row per table and tag-free name.
    """
    tag = F.regexp_extract("column", r"_[vV]([0-9]+)(?=_|$)", 1)
    bare = F.regexp_replace("column", r"_[vV][0-9]+(?=_|$)", "")
    seen = columns.groupBy("table", bare.alias("base_column")).agg(
        F.bool_or(tag == "").alias("has_untagged"), F.bool_or(tag != "").alias("has_tagged")
    )
    return seen.where("has_tagged").select(
        "table",
        "base_column",
        F.when(F.col("has_untagged"), "pair").otherwise("tagged_only").alias("kind"),
    )


def successor_links(variables: DataFrame) -> DataFrame:
    """Replacement of each deprecated variable, by its name without the version ending.

    ``variables`` is ``question_concept_id, variable_label, status``. A deprecated variable links to
    the live concept with the same base name and a higher version. Several such concepts are
    ambiguous and reported without a link; the same concept is a new wording, not a successor.
    Per base the rows are reduced to one per version before versions are compared.
    """
    named = variables.select(
        "question_concept_id",
        "variable_label",
        "status",
        F.regexp_replace("variable_label", AXES, "").alias("base"),
        version_of(F.col("variable_label")).alias("version"),
    ).where("version IS NOT NULL")
    live = F.when(
        ~F.coalesce(F.col("status") == "Deprecated", F.lit(False)), F.col("question_concept_id")
    )
    by_version = named.groupBy("base", "version").agg(
        F.min(live).alias("low"), F.max(live).alias("high")
    )
    above = (
        Window.partitionBy("base")
        .orderBy(F.desc("version"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    candidates = by_version.select(
        "base",
        "version",
        F.min("low").over(above).alias("low_above"),
        F.max("high").over(above).alias("high_above"),
    )
    low, high = F.col("low_above"), F.col("high_above")
    outcome = (
        F.when(low.isNull(), "none")
        .when(low != high, "ambiguous")
        .when(low == F.col("question_concept_id"), "same_concept")
        .otherwise("linked")
    )
    return (
        named.where("status = 'Deprecated'")
        .join(candidates, ["base", "version"])
        .withColumn("outcome", outcome)
        .select(
            "question_concept_id",
            "variable_label",
            F.when(F.col("outcome") == "linked", low).alias("successor_concept_id"),
            "outcome",
        )
    )


# Base types, tested in this order on the cleaned text.
BASE_TYPES = {
    "XOR_AGE_OR_YEAR": r"xor=",
    "GRID": r"^grid",
    "SELECT_ALL_THAT_APPLY": r"select all that apply",
    "MC_WITH_TEXT_BOX": r"multiple choice with text box|text box plus check box",
    "MULTIPLE_CHOICE": r"multiple choice|^nested|dropdown menu",
    "MULTIPLE_TEXT_BOXES": r"multiple text boxes",
    "SPECIAL_FUNCTION": r"special function|self populates",
    "TEXT_FREE": r"text only response|^text box$",
}


def clean_type(raw: Column) -> Column:
    """Lower case, single spaces, the known misspelling repaired."""
    squeezed = F.regexp_replace(F.lower(F.trim(raw)), r"\s+", " ")
    return F.replace(squeezed, F.lit("mulitple"), F.lit("multiple"))


def question_type_norm(question: DataFrame) -> DataFrame:
    """Base type and flags of each question's free-form type text.

    Nested items and drop-downs are stored as single answers; a text box with a check box is kept
    with the choice-and-text type; system-filled questions join the special functions. A blank or
    unknown text has no base type.
    """
    raw = clean_type(F.col("question_type"))
    base = F.coalesce(*[F.when(raw.rlike(p), F.lit(name)) for name, p in BASE_TYPES.items()])

    def flag(pattern: str) -> Column:
        return F.coalesce(raw.rlike(pattern), F.lit(False))

    return question.select(
        "question_concept_id",
        "question_type",
        base.alias("base_type"),
        flag(r"^required").alias("is_required"),
        flag(r"^optional").alias("is_optional"),
        flag(r"loops").alias("has_loop"),
        flag(r"display ?if").alias("has_displayif"),
        flag(r"piped text").alias("has_piped_text"),
        flag(r"with text box").alias("has_inline_text_box"),
    )


def type_census(typed: DataFrame) -> DataFrame:
    """Questions per raw type text and base type."""
    return typed.groupBy("question_type", "base_type").agg(F.count(F.lit(1)).alias("n"))


def type_quality(question: DataFrame) -> DataFrame:
    """Blank, misspelt and unknown type texts, and texts that differ from another only by case."""
    raw = F.col("question_type")
    counted = question.groupBy("question_type").agg(F.count(F.lit(1)).alias("n"))
    spelt = counted.groupBy(F.lower("question_type").alias("folded")).agg(
        F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n")
    )
    basic = counted.agg(
        F.sum(F.when(raw.isNull() | (F.trim(raw) == ""), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.lower(raw).contains("mulitple"), F.col("n")).otherwise(0)).alias("misspelt"),
    )
    variants = spelt.agg(
        F.sum(F.when(F.col("spellings") > 1, F.col("n")).otherwise(0)).alias("case_variants")
    )
    rows = [
        frame.select(F.lit(name).alias("issue"), F.col(name).alias("n"))
        for frame, name in ((basic, "blank"), (basic, "misspelt"), (variants, "case_variants"))
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
