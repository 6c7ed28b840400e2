"""Participant-grain derived variables from the answer table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions.text import strict_number
from tallgrass.schema import NO, YES


@dataclass(frozen=True)
class Pick:
    """A column to make from one question, optionally only under one source question."""

    name: str
    question: str
    source_question: str | None = None
    kind: str = "text"


# The questions behind the marts.
DEMOGRAPHICS = (
    Pick("education_concept_id", "367803647", "367803647"),
    Pick("marital_status_concept_id", "783167257"),
    Pick("income_concept_id", "759004335"),
)
ANTHROPOMETRY = (
    Pick("height_ft", "340854069", "114314839", "number"),
    Pick("height_in", "600462977", "114314839", "number"),
    Pick("weight", "746012894", None, "number"),
)
SMOKING = (
    Pick("smoker_status_concept_id", "712653855", "947205597"),
    Pick("cigs_lifetime_concept_id", "763164658"),
    Pick("smoke_cigs_now_concept_id", "639684251"),
    Pick("cigs_lasttime_concept_id", "798549704"),
)
# The answers the smoking rules test.
LIFETIME_UP_TO_10 = "151488193"
LIFETIME_11_TO_49 = "805449318"
LIFETIME_50_TO_99 = "486319890"
LIFETIME_100_OR_MORE = "132232896"
NOW_NOT_AT_ALL = "419415087"
NOW_SMOKING = ("299561721", "716761013", "804785430")
LAST_WITHIN_YEAR = ("317567178", "484055234")
LAST_OVER_YEAR = "802197176"


def pivot_questions(fact: DataFrame, picks: Sequence[Pick]) -> DataFrame:
    """One row per participant, one column per pick; several marts can share one call.

    A repeated question keeps its largest answer (largest text, or largest number). One pass over the answers
    gives the picked ones and the participants, who stay whole; rows are reduced to one per participant before
    the shuffle.
    """
    answer = F.col("response_value_as_string")

    def pick(p: Pick) -> Column:
        hit = F.col("question_concept_id") == p.question
        if p.source_question is not None:
            hit = hit & (F.col("source_question_concept_id") == p.source_question)
        return F.max(F.when(hit, strict_number(answer) if p.kind == "number" else answer)).alias(p.name)

    return fact.groupBy("connect_id").agg(*[pick(p) for p in picks])


def _with_labels(base: DataFrame, response: DataFrame, labels: dict[str, str], default: str) -> DataFrame:
    """Add the dictionary label of each coded column, or the default."""
    out = base
    for coded, label in labels.items():
        dim = response.select(
            F.col("response_concept_id").alias(coded), F.col("format_value").alias(label)
        )
        out = out.join(dim, coded, "left").withColumn(label, F.coalesce(label, F.lit(default)))
    return out


def mart_demographics(fact: DataFrame, response: DataFrame) -> DataFrame:
    """Education, marital status and income, coded and labelled."""
    base = pivot_questions(fact, DEMOGRAPHICS)
    labels = {
        "education_concept_id": "education_cat",
        "marital_status_concept_id": "marital_status_cat",
        "income_concept_id": "income_cat",
    }
    return _with_labels(base, response, labels, "Missing").select(
        "connect_id", *[name for pair in labels.items() for name in pair]
    )


def mart_anthropometry(fact: DataFrame) -> DataFrame:
    """Height, weight and body mass index in imperial units; sizes that are not positive are NULL."""
    inches = F.col("height_ft") * 12 + F.col("height_in")
    bmi = F.col("bmi_derived")
    category = (
        F.when(bmi.isNull(), "Missing")
        .when(bmi < 18.5, "Underweight (<18.5)")
        .when(bmi < 25, "Normal weight (18.5 - <25)")
        .when(bmi < 30, "Overweight (25 - <30)")
        .when(bmi < 35, "Obesity class I (30 - <35)")
        .when(bmi < 40, "Obesity class II (35 - <40)")
        .when(bmi >= 40, "Obesity class III (>=40)")
        .otherwise("Missing")
    )
    return (
        pivot_questions(fact, ANTHROPOMETRY)
        .withColumn("height_combined_nozeroes", F.when(inches > 0, inches))
        .withColumn("weight_nozeroes", F.when(F.col("weight") > 0, F.col("weight")))
        .withColumn(
            "bmi_derived",
            F.try_divide("weight_nozeroes", F.pow("height_combined_nozeroes", F.lit(2.0))) * 703,
        )
        .withColumn("bmi_category", category)
        .select(
            "connect_id",
            "height_ft",
            "height_in",
            "weight",
            "height_combined_nozeroes",
            "weight_nozeroes",
            "bmi_derived",
            "bmi_category",
        )
    )


def ever_smoker_override(lifetime: Column) -> Column:
    """1 for a hundred cigarettes or more, 0 for fewer, NULL when unknown."""
    fewer = lifetime.isin(LIFETIME_UP_TO_10, LIFETIME_11_TO_49, LIFETIME_50_TO_99)
    return F.when(lifetime == LIFETIME_100_OR_MORE, 1).when(fewer, 0)


def cigarette_category(status: Column, lifetime: Column, now: Column, last: Column) -> Column:
    """Never, current or former smoker from the four coded answers."""
    smoked = status == YES
    regular = smoked & lifetime.isin(LIFETIME_50_TO_99, LIFETIME_100_OR_MORE)
    no_last = last.isNull()
    never = (status == NO) | (smoked & lifetime.isin(LIFETIME_UP_TO_10, LIFETIME_11_TO_49))
    current = (regular & last.isin(*LAST_WITHIN_YEAR)) | (regular & no_last & now.isin(*NOW_SMOKING))
    former = (
        (regular & (last == LAST_OVER_YEAR))
        | (regular & no_last & (now == NOW_NOT_AT_ALL))
        | (smoked & lifetime.isNull() & (now == NOW_NOT_AT_ALL) & (last == LAST_OVER_YEAR))
    )
    return (
        F.when(never, "Never Smoker")
        .when(current, "Current Smoker")
        .when(former, "Former Smoker")
        .otherwise("Missing / Skipped")
    )


def mart_smoking(fact: DataFrame, response: DataFrame) -> DataFrame:
    """Smoking answers, their labels and the two derived variables."""
    labels = {
        "smoker_status_concept_id": "smoker_status",
        "cigs_lifetime_concept_id": "cigs_lifetime",
        "smoke_cigs_now_concept_id": "smoke_cigs_now",
        "cigs_lasttime_concept_id": "cigs_lasttime",
    }
    base = _with_labels(pivot_questions(fact, SMOKING), response, labels, "Missing / Skipped")
    return base.select(
        "connect_id",
        *[name for pair in labels.items() for name in pair],
        ever_smoker_override(F.col("cigs_lifetime_concept_id")).alias("ever_smoker_override"),
        cigarette_category(
            F.col("smoker_status_concept_id"),
            F.col("cigs_lifetime_concept_id"),
            F.col("smoke_cigs_now_concept_id"),
            F.col("cigs_lasttime_concept_id"),
        ).alias("cigarette_cats"),
    )


def select_all_rows(fact: DataFrame, parents: Sequence[str], yes: str = YES) -> DataFrame:
    """Select-all answers as one row per chosen option of the parent question.

    The binary sub-question becomes the answer and its parent becomes the question. The rule is
    described in prose only; the old source question is dropped, everything else is kept.
    """
    chosen = fact.where(
        F.col("source_question_concept_id").isin(*parents)
        & (F.col("response_value_as_string") == yes)
    )
    return chosen.select(
        "connect_id",
        "secondary_source_concept_id",
        F.col("source_question_concept_id").alias("question_concept_id"),
        F.col("question_concept_id").alias("response_value_as_concept_id"),
        "loop_instance",
        "question_version",
        "source_table",
        "source_column",
    )


def multiselect_flags(selected: DataFrame, question: str, options: dict[str, str]) -> DataFrame:
    """Per participant: any option chosen, each named option chosen, number of distinct options."""
    answer = F.col("response_value_as_concept_id")
    rows = selected.where(F.col("question_concept_id") == question)
    return rows.groupBy("connect_id").agg(
        F.bool_or(answer.isNotNull()).alias("any_selected"),
        *[F.bool_or(answer == code).alias(name) for name, code in options.items()],
        F.countDistinct(answer).alias("n_options"),
    )


def quantified_rate(fact: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per participant, the sum of numbers that stand for coded frequencies.

    ``lookup`` is ``question_concept_id, response_concept_id, rate`` and is the analyst's decision,
    not dictionary data; answers outside it do not count.
    """
    rates = lookup.withColumnRenamed("response_concept_id", "response_value_as_string")
    return (
        fact.join(rates, ["question_concept_id", "response_value_as_string"])
        .groupBy("connect_id")
        .agg(F.sum("rate").alias("weekly_total"), F.count(F.lit(1)).alias("n_answers"))
    )


def reconcile_rows(mart: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that one side has more often: all columns, ``side`` and ``n``, the surplus; empty when the two agree.

    Rows of the mart count as plus one, expected ones as minus one, in a single aggregate that adds them up
    before anything is shuffled. NULL equals NULL.
    """
    columns = mart.columns
    signed = mart.select("*", F.lit(1).alias("__sign")).union(expected.select(*columns, F.lit(-1).alias("__sign")))
    surplus = signed.groupBy(*columns).agg(F.sum("__sign").alias("__n")).where("__n <> 0")
    side = F.when(F.col("__n") > 0, "mart_only").otherwise("expected_only")
    return surplus.select(*columns, side.alias("side"), F.abs("__n").alias("n"))


def reconcile(mart: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows found on one side only, one for each surplus copy; empty when the two agree."""
    surplus = reconcile_rows(mart, expected)
    return surplus.select(*mart.columns, "side", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).drop("col")


def reconcile_columns(mart: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """``column, matched, differing, mart_only, expected_only`` for every column that is no key.

    Rows meet by their key in a full outer join; rows that share a key are paired in the order of their
    values. ``matched`` counts pairs, ``differing`` those whose values differ (NULL equals NULL); the last two
    count rows without a partner, and are the same for every column.
    """
    columns = [c for c in mart.columns if c not in key]

    def side(rows: DataFrame, name: str) -> DataFrame:
        turn = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in columns]))
        return rows.select(*key, *columns, turn.alias("__turn")).withColumn(name, F.lit(True)).alias(name)

    own, other = side(mart, "mart"), side(expected, "expected")
    same = [F.col(f"mart.{k}").eqNullSafe(F.col(f"expected.{k}")) for k in (*key, "__turn")]
    both = own.join(other, same, "full")
    paired = F.col("mart.mart").isNotNull() & F.col("expected.expected").isNotNull()
    counts = both.agg(
        F.count_if(paired).alias("matched"),
        F.count_if(F.col("expected.expected").isNull()).alias("mart_only"), F.count_if(F.col("mart.mart").isNull()).alias("expected_only"),
        *[F.count_if(paired & ~F.col(f"mart.{c}").eqNullSafe(F.col(f"expected.{c}"))).alias(f"__{i}") for i, c in enumerate(columns)],
    )
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("differing")) for i, c in enumerate(columns)])
    return counts.select("matched", "mart_only", "expected_only", F.inline(each)).select("column", "matched", "differing", "mart_only", "expected_only")
