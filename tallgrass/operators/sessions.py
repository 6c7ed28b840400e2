"""Survey sessions, completion and the reason an answer is missing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.schema import STATUS_CODES, STATUS_SUBMITTED


@dataclass(frozen=True)
class Triad:
    """The participant-table columns that describe one survey's session."""

    survey: str
    status: str
    started: str
    submitted: str


def status_code(status: Column) -> Column:
    """0 not started, 1 started, 2 submitted; NULL for anything else."""
    return F.coalesce(*[F.when(status == cid, F.lit(code)) for cid, code in STATUS_CODES.items()])


def _moment(column: str, schema: T.StructType) -> Column:
    is_text = isinstance(schema[column].dataType, T.StringType)
    return F.col(column).try_cast("timestamp") if is_text else F.col(column).cast("timestamp")


def response_sessions(
    participants: DataFrame, triads: Sequence[Triad], id_column: str = "connect_id"
) -> DataFrame:
    """One row per participant and survey from the wide participant row; empty triads give no row."""
    sessions = F.array(
        *[
            F.struct(
                F.lit(t.survey).alias("secondary_source_concept_id"),
                F.col(t.status).cast("string").alias("status_concept_id"),
                _moment(t.started, participants.schema).alias("started_at"),
                _moment(t.submitted, participants.schema).alias("completed_at"),
            )
            for t in triads
        ]
    )
    rows = participants.select(F.col(id_column).alias("connect_id"), F.inline(sessions)).where(
        "status_concept_id IS NOT NULL OR started_at IS NOT NULL OR completed_at IS NOT NULL"
    )
    return with_session_facts(rows)


def with_session_facts(sessions: DataFrame) -> DataFrame:
    """Status number, completion flag, minutes taken and hour of the start."""
    return sessions.select(
        "connect_id",
        "secondary_source_concept_id",
        "status_concept_id",
        status_code(F.col("status_concept_id")).alias("status"),
        "started_at",
        "completed_at",
        F.coalesce(F.col("status_concept_id") == STATUS_SUBMITTED, F.lit(False)).alias("is_complete"),
        F.timestamp_diff("MINUTE", "started_at", "completed_at").alias("duration_minutes"),
        F.hour("started_at").alias("start_hour"),
    )


def timestamp_kind(question_text: Column, label: Column) -> Column:
    """``start`` or ``complete`` for automatic time stamps, else NULL.

    Completion stamps are often labelled ``Sub`` for submitted, so that ending counts too.
    """
    both = F.lower(F.concat_ws(" ", question_text, label))
    automatic = F.lower(question_text).contains("autogenerated")
    done = both.rlike("complete|submitted") | label.rlike(r"\bSub\b|Sub$")
    return F.when(automatic & both.contains("start"), "start").when(automatic & done, "complete")


def triad_completeness(variables: DataFrame) -> DataFrame:
    """Which parts of the session triad each survey has.

    ``variables`` is ``secondary_source_concept_id, question_text, variable_label,
    response_concept_id``; a status question is one that allows a status answer.
    """
    kind = timestamp_kind(F.col("question_text"), F.col("variable_label"))

    def any_of(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition), F.lit(False))

    parts = variables.groupBy("secondary_source_concept_id").agg(
        any_of(F.col("response_concept_id").isin(*STATUS_CODES)).alias("has_status"),
        any_of(kind == "start").alias("has_start"),
        any_of(kind == "complete").alias("has_submit"),
    )
    return parts.withColumn("full_triad", F.expr("has_status AND has_start AND has_submit"))


def completion(sessions: DataFrame, fact: DataFrame, survey: str, question: str) -> DataFrame:
    """Participants and answerers of one question by session status."""
    answered = (
        fact.where(
            (F.col("secondary_source_concept_id") == survey)
            & (F.col("question_concept_id") == question)
        )
        .select("connect_id")
        .distinct()
        .withColumn("answered", F.lit(True))
    )
    taken = sessions.where(F.col("secondary_source_concept_id") == survey)
    return (
        taken.join(answered, "connect_id", "left")
        .groupBy("status")
        .agg(
            F.countDistinct("connect_id").alias("participants"),
            F.countDistinct(F.when(F.col("answered"), F.col("connect_id"))).alias("answered_x"),
        )
    )


def offered_denominator(sessions: DataFrame, questions: DataFrame, fact: DataFrame) -> DataFrame:
    """Per question: submitted sessions, those it was offered to, and those that answered it.

    ``questions`` is ``secondary_source_concept_id, question_concept_id, added_at``. A session that
    ended before the day a question was added never offered it. Sessions are counted per survey and
    day before they meet the questions, so no row per participant and question is made.
    """
    submitted = sessions.where("is_complete").withColumn("day", F.to_date("completed_at"))
    per_day = submitted.groupBy("secondary_source_concept_id", "day").agg(
        F.count(F.lit(1)).alias("sessions")
    )
    in_time = F.col("added_at").isNull() | (F.col("day") >= F.col("added_at"))
    offered = (
        questions.join(per_day, "secondary_source_concept_id", "left")
        .groupBy("secondary_source_concept_id", "question_concept_id")
        .agg(
            F.coalesce(F.sum("sessions"), F.lit(0)).alias("submitted"),
            F.coalesce(F.sum(F.when(in_time, F.col("sessions"))), F.lit(0)).alias("offered"),
        )
    )
    key = ["connect_id", "secondary_source_concept_id"]
    answers = (
        fact.join(questions, ["secondary_source_concept_id", "question_concept_id"])
        .select(*key, "question_concept_id", "added_at")
        .distinct()
    )
    answered = (
        answers.join(submitted.select(*key, "day"), key)
        .where(in_time)
        .groupBy("secondary_source_concept_id", "question_concept_id")
        .agg(F.countDistinct("connect_id").alias("answered"))
    )
    return offered.join(
        answered, ["secondary_source_concept_id", "question_concept_id"], "left"
    ).withColumn("answered", F.coalesce("answered", F.lit(0)))


def missingness(
    sessions: DataFrame, questions: DataFrame, fact: DataFrame, hidden: DataFrame
) -> DataFrame:
    """Why each participant has or lacks an answer to each question of a survey.

    Described in prose only; the first rule that holds decides: ``not_taken`` (no submitted session),
    ``not_offered`` (submitted before the question was added), ``not_shown`` (in ``hidden``, the
    ``connect_id, secondary_source_concept_id, question_concept_id`` that skip rules closed), ``answered``,
    ``not_answered``. A question that several surveys use is closed in the survey named only.
    ``sessions`` has one row per participant and survey, also for those who never started. Answers
    and closed questions are reduced to one row per participant and question, so one join finds both.
    """
    key = ["connect_id", "secondary_source_concept_id", "question_concept_id"]
    answered = (
        fact.join(
            questions.select("secondary_source_concept_id", "question_concept_id"),
            ["secondary_source_concept_id", "question_concept_id"],
            "left_semi",
        )
        .select(*key, F.lit(True).alias("has_answer"), F.lit(False).alias("is_hidden"))
    )
    asked = questions.select("secondary_source_concept_id", "question_concept_id")
    closed = hidden.join(asked, ["secondary_source_concept_id", "question_concept_id"], "left_semi").select(
        *key, F.lit(False).alias("has_answer"), F.lit(True).alias("is_hidden")
    )
    known = answered.unionByName(closed).groupBy(*key).agg(
        F.bool_or("has_answer").alias("has_answer"), F.bool_or("is_hidden").alias("is_hidden")
    )
    early = F.col("added_at").isNotNull() & (F.to_date("completed_at") < F.col("added_at"))
    reason = (
        F.when(~F.col("is_complete"), "not_taken")
        .when(early, "not_offered")
        .when(F.col("is_hidden"), "not_shown")
        .when(F.col("has_answer"), "answered")
        .otherwise("not_answered")
    )
    return (
        sessions.join(questions, "secondary_source_concept_id")
        .join(known, key, "left")
        .select(*key, reason.alias("missingness"))
    )
