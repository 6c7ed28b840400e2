import datetime

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import governance, quality
from tallgrass.operators.dictionary import Star
from tallgrass.plans import inputs
from tests.conftest import SF_DIR


@pytest.mark.parametrize(
    "text, classes",
    [
        ("What is your street address?", {"address"}),
        ("Write to me@example.org", {"email"}),
        ("First name of your mother", {"names"}),
        ("Your Social Security number", {"ssn"}),
        ("How many teeth lost?", set()),
        ("Date of birth and telephone", {"dates", "phone"}),
    ],
)
def test_identifier_classes(spark, text, classes):
    df = spark.createDataFrame([(1, text)], "id bigint, t string")
    row = governance.sensitivity_scan(df, "id", "t").first().asDict()
    assert {c for c in governance.IDENTIFIERS if row[c]} == classes
    assert row["is_identifier"] == bool(classes)


def test_effective_tier_is_the_stricter_one(spark):
    fact = spark.createDataFrame(
        [("q1", "r1"), ("q1", "r2"), ("q2", "r2"), ("q3", None)],
        "question_concept_id string, response_value_as_concept_id string",
    )
    questions = spark.createDataFrame([("q1", "quasi_identifier"), ("q2", "genetic")], "question_concept_id string, tier string")
    responses = spark.createDataFrame([("r2", "geolocation")], "response_concept_id string, tier string")
    tiered = governance.effective_tier(fact, questions, responses)
    got = {(r.question_concept_id, r.response_value_as_concept_id): r.sensitivity_tier for r in tiered.collect()}
    assert got == {
        ("q1", "r1"): "quasi_identifier", ("q1", "r2"): "geolocation", ("q2", "r2"): "genetic",
        ("q3", None): "unclassified",
    }
    assert governance.release(tiered, "quasi_identifier").count() == 1  # the unclassified question stays in


def test_date_shift_keeps_intervals_and_hides_the_text(spark):
    rows = [
        (p, str(d), d) for p in ("1", "2", "3") for d in (datetime.date(2024, 1, 1), datetime.date(2024, 2, 29))
    ] + [("1", "free", None)]
    fact = spark.createDataFrame(rows, "connect_id string, response_value_as_string string, response_value_as_date date")
    shifted = governance.shift_dates(fact, "pepper", 60).collect()
    offsets = set()
    for p in ("1", "2", "3"):
        days = sorted(r.response_value_as_date for r in shifted if r.connect_id == p and r.response_value_as_date)
        assert (days[1] - days[0]).days == 59
        offset = (days[0] - datetime.date(2024, 1, 1)).days
        assert -60 <= offset <= 60
        offsets.add(offset)
    assert len(offsets) > 1
    assert all(str(r.response_value_as_date) == r.response_value_as_string for r in shifted if r.response_value_as_date)
    assert "free" in {r.response_value_as_string for r in shifted}
    other = governance.shift_dates(fact, "salt", 60).collect()
    assert [r.response_value_as_date for r in other] != [r.response_value_as_date for r in shifted]


def test_ages_over_the_limit_are_top_coded(spark):
    fact = spark.createDataFrame(
        [("age", "89", 89.0, 1), ("age", "90", 90.0, 2), ("weight", "200", 200.0, 3), ("age", "old", None, 4)],
        "question_concept_id string, response_value_as_string string, response_value_as_number double, response_unique_id bigint",
    )
    got = [tuple(r) for r in governance.top_code_age(fact, ["age"]).collect()]
    assert got == [("age", "89", 89.0, 1), ("age", "90+", None, None), ("weight", "200", 200.0, 3), ("age", "old", None, 4)]


def test_suppression_hides_a_companion_cell(spark):
    cells = {"q1": {"a": 2, "b": 5, "c": 5, "d": 9}, "q2": {"a": 2, "b": 3, "c": 9}, "q3": {"a": 9}, "q4": {"a": 1}}
    rows = [
        (f"{q}{a}{i}", q, a) for q, answers in cells.items() for a, n in answers.items() for i in range(n)
    ] + [("q1a0", "q1", "a")]
    fact = spark.createDataFrame(rows, "connect_id string, question_concept_id string, response_value_as_concept_id string")
    got: dict[str, dict] = {}
    for r in governance.suppressed_counts(fact, least=4).collect():
        got.setdefault(r.question_concept_id, {})[r.response_value_as_concept_id] = r.participants
        assert r.is_suppressed == (r.participants is None)
    assert got == {
        "q1": {"a": None, "b": None, "c": 5, "d": 9}, "q2": {"a": None, "b": None, "c": 9}, "q3": {"a": 9},
        "q4": {"a": None},
    }


def test_masking_keeps_typed_answers_only(spark):
    fact = inputs.fact(spark, SF_DIR, "module_a")
    masked = governance.mask_free_text(fact)
    assert masked.where("response_value_as_string IS NULL AND response_unique_id IS NOT NULL").count() == 0
    assert masked.count() == fact.count()
    left = masked.where("response_value_as_string IS NOT NULL")
    assert left.where(
        "coalesce(response_value_as_concept_id, CAST(response_value_as_date AS STRING), "
        "CAST(response_value_as_number AS STRING)) IS NULL"
    ).count() == 0


def test_typed_columns_exclude_each_other(spark):
    typed = ["response_value_as_concept_id", "response_value_as_date", "response_value_as_number"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in typed), F.lit(0))
    assert inputs.fact(spark, SF_DIR).where(filled > 1).count() == 0


def test_orphans_count_the_blank_question(spark):
    fact = spark.createDataFrame(
        [("", "s1"), ("q1", "s1"), ("q1", "s9"), (None, None), ("q9", "s9")],
        "question_concept_id string, secondary_source_concept_id string",
    )
    star = Star(
        None,
        spark.createDataFrame([("s1",)], "secondary_source_concept_id string"),
        None,
        spark.createDataFrame([("q1",)], "question_concept_id string"),
        None, None,
    )
    assert {tuple(r) for r in quality.fact_orphans(fact, star).collect()} == {
        ("question orphans", 2), ("survey orphans", 2),
    }


def test_contracts(spark):
    mart = spark.createDataFrame([("1", "a", 5.0), (None, "z", 50.0), ("3", None, None)], "id string, cat string, x double")
    got = {
        r.contract: r.violations
        for r in quality.mart_contracts(mart, ["id"], {"cat": ["a", "b"]}, {"x": (0, 10)}).collect()
    }
    assert got == {"not_null(id)": 1, "accepted_values(cat)": 1, "range(x)": 1}


def test_checks_on_an_empty_fact(spark):
    from tallgrass.schema import FACT

    empty = spark.createDataFrame([], FACT)
    assert {tuple(r) for r in quality.fact_volume(empty).collect()} == {
        ("total_rows", 0), ("distinct_participants", 0), ("distinct_source_columns", 0), ("distinct_surveys", 0),
    }
    assert tuple(quality.fact_nulls(empty).first()) == (0, 0, 0, 0)


def test_hot_question_gives_the_same_counts(spark):
    """A third of all rows on one question, split joins forced on."""
    fact = inputs.fact(spark, SF_DIR)
    hot = fact.select(*[F.lit("200000001").alias(c) if c == "response_value_as_concept_id" else
                        F.lit(inputs.SEGMENT).alias(c) if c == "question_concept_id" else F.col(c) for c in fact.columns])
    both = fact.unionByName(hot)
    star = inputs.star(spark, SF_DIR)
    from tallgrass.operators import views

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = views.responses_enriched(both, star).groupBy("question_text", "response_label").count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    usual = views.responses_enriched(both, star).groupBy("question_text", "response_label").count().collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in usual}
