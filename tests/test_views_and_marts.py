import itertools

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import analytics, marts, views
from tallgrass.operators.dictionary import Star
from tallgrass.plans import inputs
from tallgrass.schema import NO, YES
from tallgrass.sources import readers, writers
from tests.conftest import SF_DIR

# the small demonstration: five participants, five questions
QUESTIONS = [
    ("100001", "Sex", "single_select"), ("100002", "Age", "number"),
    ("100003", "Smoking Status", "single_select"), ("100004", "Education", "single_select"),
    ("899251483", "Have you lost any permanent teeth?", "multi_select"),
]
LABELS = [
    ("536341288", "Female"), ("654207589", "Male"), ("700000001", "Never"), ("700000002", "Former"),
    ("700000003", "Current"), ("404564707", "High School"), ("875342283", "Bachelor"),
    ("598242454", "Advanced"), ("812107266", "Accident"), ("452438775", "Decay"), ("886864375", "Other"),
    ("551489317", "None lost"),
]
ANSWERS = {
    "1001": ["536341288", "47", "700000002", "875342283", "812107266", "452438775"],
    "1002": ["654207589", "62", "700000003", "404564707", "551489317"],
    "1003": ["536341288", "55", "700000001", "598242454", "812107266"],
    "1004": ["654207589", "39", "700000001", "875342283"],
    "1005": ["536341288", "71", "700000002", "404564707", "452438775", "886864375"],
}


@pytest.fixture(scope="module")
def demo(spark):
    rows = []
    for person, answers in ANSWERS.items():
        for i, answer in enumerate(answers):
            question = QUESTIONS[min(i, 4)][0]
            coded = answer if len(answer) == 9 else None
            rows.append((person, question, coded, answer))
    fact = spark.createDataFrame(
        rows,
        "connect_id string, question_concept_id string, response_value_as_concept_id string, "
        "response_value_as_string string",
    )
    question = spark.createDataFrame(
        QUESTIONS, "question_concept_id string, question_text string, question_type string"
    )
    response = spark.createDataFrame(LABELS, "response_concept_id string, format_value string")
    return fact, Star(None, None, None, question, response, None)


def test_demo_long_pivot_and_counts(demo):
    fact, star = demo
    long = views.v_long(fact, star)
    assert long.count() == 26
    single = long.where("question_type <> 'multi_select'")
    wide = analytics.pivot_wide(
        single, "connect_id", "question_text", "answer", ["Sex", "Age", "Smoking Status", "Education"]
    )
    rows = {r.connect_id: tuple(r)[1:] for r in wide.collect()}
    assert rows["1001"] == ("Female", "47", "Former", "Bachelor")
    assert rows["1004"] == ("Male", "39", "Never", "Bachelor")
    smoking = {r.answer: r.n for r in analytics.distribution(fact, star, "100003").collect()}
    assert smoking == {"Never": 2, "Former": 2, "Current": 1}
    teeth = {r.answer: r.n for r in analytics.distribution(fact, star, "899251483").collect()}
    assert teeth == {"Accident": 2, "Decay": 2, "Other": 1, "None lost": 1}


def test_pivot_then_melt_is_the_identity(spark, demo):
    from tallgrass.operators.reshape import melt

    fact, _ = demo
    single = fact.where("question_concept_id <> '899251483'")
    codes = [q for q, *_ in QUESTIONS[:4]]
    wide = analytics.pivot_wide(
        single, "connect_id", "question_concept_id", "response_value_as_string", codes
    )
    back = {tuple(r) for r in melt(wide, codes).collect()}
    assert back == {
        (r.connect_id, r.question_concept_id, r.response_value_as_string) for r in single.collect()
    }


def test_enriched_keeps_every_answer_and_takes_the_stamped_survey(spark):
    fact, star = inputs.fact(spark, SF_DIR), inputs.star(spark, SF_DIR)
    rows = views.responses_enriched(fact, star)
    assert rows.columns == list(views.ENRICHED)
    assert rows.count() == fact.count()
    surveys = {
        r.survey for r in rows.where("question_concept_id = '784119588'").select("survey").distinct().collect()
    }
    assert surveys == {"NATION_0", "NATION_1"}


def test_enriched_makes_only_the_needed_joins(spark, plan_of):
    fact, star = inputs.fact(spark, SF_DIR, "module_b"), inputs.star(spark, SF_DIR)
    assert "Join" not in plan_of(views.responses_enriched(fact, star, ["connect_id", "question_version"]))
    one = plan_of(views.responses_enriched(fact, star, ["connect_id", "response_label"]))
    assert one.count("BroadcastHashJoin LeftOuter") == 1
    full = plan_of(views.responses_enriched(fact, star))
    assert "SortMergeJoin" not in full.split("BroadcastExchange")[0]


def test_results_are_the_same_without_broadcasts(spark, as_set):
    fact, star = inputs.fact(spark, SF_DIR), inputs.star(spark, SF_DIR)
    usual = as_set(views.responses_enriched(fact, star))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert as_set(views.responses_enriched(fact, star)) == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_source_codes_collapse_repeats(spark):
    from tallgrass.functions.text import response_unique_id

    schema = (
        "secondary_source_concept_id string, source_question_concept_id string, question_concept_id string, "
        "response_value_as_string string"
    )
    rows = [
        ("1", None, "q1", "353358909"), ("1", None, "q1", "353358909"), ("1", "p", "q1", "353358909"),
        ("1", None, "q2", "Aspirin  100"), ("1", None, "q2", "aspirin 100"), ("1", None, "q3", "2024-01-01T10:00"),
        ("1", None, "q3", "7.5"), ("1", None, "q3", ""), ("1", None, "q3", None), ("2", None, "q1", "353358909"),
    ]
    fact = spark.createDataFrame(rows, schema)
    fact = fact.withColumn("response_unique_id", response_unique_id(*[F.col(c) for c in fact.columns]))
    star = Star(
        None, None, None,
        spark.createDataFrame([("q1", "One?")], "question_concept_id string, question_text string"),
        spark.createDataFrame([("353358909", "1 = Yes")], "response_concept_id string, format_value string"),
        spark.createDataFrame([("q1", "353358909")], "question_concept_id string, response_concept_id string"),
    )
    codes = views.source_codes(fact, star).collect()
    assert len(codes) == 7 == len({c.response_unique_id for c in codes})
    by_text = {(c.question_concept_id, c.response_value_verbatim): c for c in codes}
    assert by_text["q1", "353358909"].response_kind == "coded"
    assert by_text["q1", "353358909"].source_code_description == "One? | 1 = Yes"
    assert by_text["q3", "2024-01-01T10:00"].response_kind == "numeric_or_date"
    assert by_text["q3", "7.5"].response_kind == "numeric_or_date"
    assert by_text["q2", "Aspirin  100"].response_kind == "free_text"
    assert by_text["q2", "Aspirin  100"].response_value_norm == by_text["q2", "aspirin 100"].response_value_norm


def expected_category(status, lifetime, now, last):
    """The published rule table, as plain Python."""
    many, few = ("486319890", "132232896"), ("151488193", "805449318")
    if status == NO:
        return "Never Smoker"
    if status == YES and lifetime in few:
        return "Never Smoker"
    if status == YES and lifetime in many:
        if last in ("317567178", "484055234"):
            return "Current Smoker"
        if last == "802197176":
            return "Former Smoker"
        if last is None and now in ("299561721", "716761013", "804785430"):
            return "Current Smoker"
        if last is None and now == "419415087":
            return "Former Smoker"
    if status == YES and lifetime is None and now == "419415087" and last == "802197176":
        return "Former Smoker"
    return "Missing / Skipped"


def test_smoking_rules_over_every_combination(spark):
    combos = list(
        itertools.product(
            [None, YES, NO],
            [None, "151488193", "805449318", "486319890", "132232896", "999999999"],
            [None, "419415087", "299561721", "716761013", "804785430"],
            [None, "317567178", "484055234", "802197176", "999999999"],
        )
    )
    df = spark.createDataFrame(combos, "s string, l string, n string, t string")
    got = df.select("*", marts.cigarette_category(*[F.col(c) for c in "slnt"]).alias("c")).collect()
    assert all(r.c == expected_category(r.s, r.l, r.n, r.t) for r in got)


def test_participants_without_answers_stay_in_the_mart(spark):
    fact = inputs.fact(spark, SF_DIR)
    people = fact.select("connect_id").distinct().count()
    response = inputs.star(spark, SF_DIR).response
    for mart in (marts.mart_smoking(fact, response), marts.mart_anthropometry(fact), marts.mart_demographics(fact, response)):
        assert mart.count() == people


def test_one_pivot_equals_three(spark):
    fact = inputs.fact(spark, SF_DIR)
    shared = marts.pivot_questions(fact, [*marts.DEMOGRAPHICS, *marts.ANTHROPOMETRY, *marts.SMOKING])
    alone = marts.pivot_questions(fact, marts.ANTHROPOMETRY)
    assert marts.reconcile(shared.select(*alone.columns), alone).count() == 0


def test_reconcile_counts_duplicates(spark):
    mart = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b")], "connect_id string, v string")
    oracle = spark.createDataFrame([("a", "1"), ("c", "2")], "v string, connect_id string")
    rows = sorted(tuple(r) for r in marts.reconcile(mart, oracle).collect())
    assert rows == [("1", "a", "mart_only"), ("2", "b", "mart_only"), ("2", "c", "expected_only")]


def test_wide_and_long_select_all_agree_where_revisions_do_not_overlap(spark):
    from tallgrass.plans import catalog

    wide = {r.reason: r.n for r in catalog.QUERIES["select_all_wide"](spark, SF_DIR).collect()}
    long = {r.reason: r.n for r in catalog.QUERIES["select_all_counts"](spark, SF_DIR).collect()}
    assert wide == {
        "accident": long["Yes, from accident"], "decay": long["Yes, from decay"], "other": long["Yes, other reason"],
    }


def test_clustered_layout_prunes_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    fact = inputs.fact(spark, SF_DIR)
    writers.write_clustered(fact, path, files=8)
    stored = readers.read_fact(spark, path)
    assert stored.count() == fact.count()
    ranges = stored.groupBy(F.col("_metadata.file_path")).agg(
        F.min("secondary_source_concept_id").alias("low"), F.max("secondary_source_concept_id").alias("high")
    )
    inside = ranges.where(F.lit(inputs.SURVEY_B).between(F.col("low"), F.col("high"))).count()
    assert inside < ranges.count()


def test_slice_without_coordinates_is_everything(spark):
    fact = inputs.fact(spark, SF_DIR, "module_b")
    assert analytics.slice_fact(fact).count() == fact.count()
    assert analytics.slice_fact(fact, question="784119588", loop=2).count() == 0
