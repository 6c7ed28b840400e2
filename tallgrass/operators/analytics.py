"""Analyst query shapes over the answer table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.operators.dictionary import Star
from tallgrass.schema import YES


def _rows() -> Column:
    return F.count(F.lit(1))


def _labels(star: Star, label: str = "answer") -> DataFrame:
    return star.response.select(
        F.col("response_concept_id").alias("response_value_as_concept_id"),
        F.col("format_value").alias(label),
    )


def distribution(fact: DataFrame, star: Star, question: str) -> DataFrame:
    """Labelled answer counts of one coded question.

    Codes are counted before the label join, so only one row per code meets the dictionary.
    """
    coded = (
        fact.where(F.col("question_concept_id") == question)
        .where("response_value_as_concept_id IS NOT NULL")
        .groupBy("response_value_as_concept_id")
        .agg(_rows().alias("n"))
    )
    return coded.join(_labels(star), "response_value_as_concept_id").groupBy("answer").agg(
        F.sum("n").alias("n")
    )


def distribution_by_survey(fact: DataFrame, star: Star, question: str) -> DataFrame:
    """The same question counted per survey it was answered in."""
    coded = (
        fact.where(F.col("question_concept_id") == question)
        .where("response_value_as_concept_id IS NOT NULL")
        .groupBy("secondary_source_concept_id", "response_value_as_concept_id")
        .agg(_rows().alias("n"))
    )
    surveys = star.secondary_source.select(
        "secondary_source_concept_id", F.col("secondary_source").alias("survey")
    )
    return (
        coded.join(_labels(star), "response_value_as_concept_id")
        .join(surveys, "secondary_source_concept_id")
        .groupBy("survey", "answer")
        .agg(F.sum("n").alias("n"))
    )


def distribution_by_type(fact: DataFrame, star: Star, types: DataFrame, base_type: str) -> DataFrame:
    """Answer counts of every question of one base type."""
    coded = (
        fact.where("response_value_as_concept_id IS NOT NULL")
        .groupBy("question_concept_id", "response_value_as_concept_id")
        .agg(_rows().alias("n"))
    )
    typed = types.where(F.col("base_type") == base_type).select("question_concept_id", "base_type")
    return (
        coded.join(typed, "question_concept_id")
        .join(_labels(star), "response_value_as_concept_id")
        .groupBy("base_type", "question_concept_id", "answer")
        .agg(F.sum("n").alias("n"))
    )


def agg_question_distribution(fact: DataFrame, star: Star) -> DataFrame:
    """Every question's coded distribution, ready to be written once and read many times.

    Described in prose only: coded answers, pooled over surveys and loops, with participants.
    """
    counted = (
        fact.where("response_value_as_concept_id IS NOT NULL")
        .groupBy("question_concept_id", "response_value_as_concept_id")
        .agg(_rows().alias("n"), F.countDistinct("connect_id").alias("participants"))
    )
    return counted.join(_labels(star, "answer_label"), "response_value_as_concept_id", "left").select(
        "question_concept_id", "response_value_as_concept_id", "answer_label", "n", "participants"
    )


def distribution_pct(fact: DataFrame) -> DataFrame:
    """Answer counts of every question with their share of the question's answers.

    Totals are summed from the counts and joined back, so no window has to hold a whole question.
    """
    counts = fact.groupBy("question_concept_id", "response_value_as_string").agg(_rows().alias("n"))
    totals = counts.groupBy("question_concept_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "question_concept_id").select(
        "question_concept_id",
        "response_value_as_string",
        "n",
        (F.col("n") * F.lit(100.0) / F.col("total")).alias("pct"),
    )


def gated_distribution(
    fact: DataFrame, star: Star, question: str, gate_question: str, gate_answer: str
) -> DataFrame:
    """Distribution of a question among participants who gave one answer to a gate question."""
    passed = fact.where(
        (F.col("question_concept_id") == gate_question)
        & (F.col("response_value_as_concept_id") == gate_answer)
    ).select("connect_id")
    asked = fact.where(F.col("question_concept_id") == question)
    return distribution(asked.join(passed, "connect_id", "left_semi"), star, question)


def harmonised(fact: DataFrame, star: Star, edges: DataFrame, canonical: str) -> DataFrame:
    """Answers of all concepts linked to one canonical concept, every loop pass included."""
    members = edges.where(
        (F.col("relationship") == "synonym") & (F.col("concept_id_2") == canonical)
    ).select(F.col("concept_id_1").alias("question_concept_id"))
    fields = members.join(
        star.question.select("question_concept_id", F.col("question_text").alias("field")),
        "question_concept_id",
    )
    return fact.join(fields, "question_concept_id").select(
        "field", "response_value_as_string", "connect_id", "loop_instance"
    )


def select_all_counts(fact: DataFrame, star: Star, parent: str, yes: str = YES) -> DataFrame:
    """How often each option of a select-all was chosen; revisions pool by themselves."""
    chosen = (
        fact.where(
            (F.col("source_question_concept_id") == parent)
            & (F.col("response_value_as_concept_id") == yes)
        )
        .groupBy("question_concept_id")
        .agg(_rows().alias("n"))
    )
    options = star.question.select("question_concept_id", F.col("question_text").alias("reason"))
    return chosen.join(options, "question_concept_id").groupBy("reason").agg(F.sum("n").alias("n"))


def select_all_wide(wide: DataFrame, options: dict[str, Sequence[str]], yes: str = YES) -> DataFrame:
    """The same from the wide table: per option the first non-null of its columns, newest first.

    All options are counted in one pass and turned into rows at the end.
    """
    names = list(options)
    counted = wide.agg(
        *[F.count_if(F.coalesce(*options[name]) == yes).alias(name) for name in names]
    )
    return counted.unpivot([], names, "reason", "n")


def decode_column(wide: DataFrame, column: str, labels: dict[str, str]) -> DataFrame:
    """Counts of one wide column with labels given by hand; other values count as NULL."""
    pairs = [F.when(F.col(column) == code, F.lit(label)) for code, label in labels.items()]
    return wide.groupBy(F.coalesce(*pairs).alias("answer")).agg(_rows().alias("n"))


def hierarchy(fact: DataFrame, star: Star) -> DataFrame:
    """Domain, survey, source question, question and answer of each row of ``fact``."""
    surveys = star.secondary_source.select(
        "secondary_source_concept_id",
        F.col("secondary_source").alias("survey"),
        "primary_source_concept_id",
    )
    domains = star.primary_source.select(
        "primary_source_concept_id", F.col("primary_source").alias("domain")
    )
    parents = star.source_question.select(
        "source_question_concept_id", F.col("source_question_text").alias("source_question")
    )
    questions = star.question.select("question_concept_id", F.col("question_text").alias("question"))
    return (
        fact.join(surveys, "secondary_source_concept_id")
        .join(domains, "primary_source_concept_id")
        .join(questions, "question_concept_id")
        .join(parents, "source_question_concept_id", "left")
        .join(_labels(star, "label"), "response_value_as_concept_id", "left")
        .select(
            "connect_id",
            "domain",
            "survey",
            "source_question",
            "question",
            F.coalesce("label", "response_value_as_string").alias("answer"),
            "source_column",
        )
    )


def slice_fact(
    fact: DataFrame,
    survey: str | None = None,
    source_question: str | None = None,
    question: str | None = None,
    answer: str | None = None,
    loop: int | None = None,
) -> DataFrame:
    """Rows at the given coordinates; a coordinate left out does not filter."""
    coordinates = {
        "secondary_source_concept_id": survey,
        "source_question_concept_id": source_question,
        "question_concept_id": question,
        "response_value_as_concept_id": answer,
        "loop_instance": loop,
    }
    given = [F.col(name) == value for name, value in coordinates.items() if value is not None]
    return fact.where(reduce(lambda a, b: a & b, given)) if given else fact


def slice_domain(fact: DataFrame, star: Star, domain: str) -> DataFrame:
    """Rows of every survey of one domain."""
    surveys = star.secondary_source.where(F.col("primary_source_concept_id") == domain)
    return fact.join(surveys, "secondary_source_concept_id", "left_semi").select(*fact.columns)


def top_answers(fact: DataFrame, question: str, k: int) -> DataFrame:
    """The most frequent answers of a question."""
    return (
        fact.where(F.col("question_concept_id") == question)
        .groupBy("response_value_as_string")
        .agg(_rows().alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first("response_value_as_string"))
        .limit(k)
    )


def pivot_wide(long: DataFrame, key: str, name: str, value: str, values: Sequence[str]) -> DataFrame:
    """Long rows to one column per entry of ``values``; repeats keep the smallest value.

    Pass the values from the dictionary; finding them in the answers would cost a second scan.
    """
    return long.groupBy(key).pivot(name, list(values)).agg(F.min(value))


def pivot_all(
    long: DataFrame, codes: Sequence[str], key: str = "connect_id", name: str = "question_concept_id",
    value: str = "answer", prefix: str = "q_", block: int = 64,
) -> DataFrame:
    """Long rows to one column per entry of ``codes``, however many; repeats keep the smallest value.

    An aggregate per column makes plans of thousands of expressions. Here the rows are brought together by
    ``key`` once; in that one exchange answers are reduced to one per question and then to a map per block of
    columns, and a column is a look-up in the map of its block. Rows of other names give no column, their
    participants stay. Pass the codes from the dictionary.
    """
    if not codes:
        return long.select(key).distinct()
    listed = ", ".join(f"('{code}', {i})" for i, code in enumerate(codes))
    places = long.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(__code, place)")
    placed = long.join(places, F.col(name) == F.col("__code"), "left").select(key, F.col(value).alias("v"), "place")
    least = placed.repartition(F.col(key)).groupBy(key, "place").agg(F.min("v").alias("v"))
    blocks = range(0, len(codes), block)
    in_block = F.floor(F.col("place") / block)
    maps = [
        F.map_from_entries(F.collect_list(F.when((in_block == n) & F.col("v").isNotNull(), F.struct("place", "v")))).alias(f"__{n}")
        for n in range(len(blocks))
    ]
    columns = [f"`__{i // block}`[{i}] AS `{prefix}{code}`" for i, code in enumerate(codes)]
    return least.groupBy(key).agg(*maps).selectExpr(f"`{key}`", *columns)


def loop_rows(fact: DataFrame, parent: str, questions: dict[str, str]) -> DataFrame:
    """One row per participant and loop pass of a repeated block, one column per question.

    Described in prose only: a repeated answer within one pass keeps its largest text.
    """
    code = F.col("question_concept_id")
    block = fact.where(
        (F.col("source_question_concept_id") == parent) & code.isin(*questions.values())
    )
    return block.groupBy("connect_id", "source_question_concept_id", "loop_instance").agg(
        *[
            F.max(F.when(code == question, F.col("response_value_as_string"))).alias(name)
            for name, question in questions.items()
        ]
    )


def address_rows(fact: DataFrame, fields: DataFrame, components: Sequence[str]) -> DataFrame:
    """One row per participant, address class and loop pass, one column per address piece.

    ``fields`` maps questions to their piece and class. Described in prose only: where several
    questions fill the same piece, the largest text is kept.
    """
    places = fields.select("question_concept_id", "component", "address_class")
    placed = fact.join(places, "question_concept_id")
    return placed.groupBy("connect_id", "address_class", "loop_instance").agg(
        *[
            F.max(F.when(F.col("component") == c, F.col("response_value_as_string"))).alias(c)
            for c in components
        ]
    )


def shape_a(fact: DataFrame, survey: str) -> DataFrame:
    """Rows and mean number of one survey."""
    return fact.where(F.col("secondary_source_concept_id") == survey).agg(
        _rows().alias("n"), F.avg("response_value_as_number").alias("mean_number")
    )


def shape_b(fact: DataFrame, survey: str, question: str) -> DataFrame:
    """Coded answers of one question in one survey."""
    return (
        slice_fact(fact, survey=survey, question=question)
        .groupBy("response_value_as_concept_id")
        .agg(_rows().alias("n"))
        .orderBy(F.desc("n"), "response_value_as_concept_id")
    )


def shape_c(fact: DataFrame, question: str) -> DataFrame:
    """Rows of one question per survey."""
    return (
        slice_fact(fact, question=question)
        .groupBy("secondary_source_concept_id")
        .agg(_rows().alias("n"))
        .orderBy(F.desc("n"), "secondary_source_concept_id")
    )


def shape_d(fact: DataFrame, participant: str) -> DataFrame:
    """All answers of one participant."""
    return fact.where(F.col("connect_id") == participant).select(
        "question_concept_id", "response_value_as_string"
    )


def shape_e(fact: DataFrame) -> DataFrame:
    """Rows per survey over the whole table."""
    return (
        fact.groupBy("secondary_source_concept_id")
        .agg(_rows().alias("n"))
        .orderBy(F.desc("n"), "secondary_source_concept_id")
    )
