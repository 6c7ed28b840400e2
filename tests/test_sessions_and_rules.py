import datetime

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import events, rules, sessions, versions
from tallgrass.plans import inputs
from tallgrass.schema import STATUS_NOT_STARTED, STATUS_STARTED, STATUS_SUBMITTED, YES
from tests.conftest import SF_DIR

# raw type text and the base type it belongs to
TYPES = {
    "Optional Select All that Apply": "SELECT_ALL_THAT_APPLY",
    "Or (xor=) Question (either/or text boxes without radio button), Loops": "XOR_AGE_OR_YEAR",
    "Grid with Multiple Choice Sub-Questions": "GRID",
    "Optional Multiple Choice": "MULTIPLE_CHOICE",
    "Multiple choice": "MULTIPLE_CHOICE",
    "Nested": "MULTIPLE_CHOICE",
    "Select All That Apply": "SELECT_ALL_THAT_APPLY",
    "Optional Select All That Apply, DisplayIf in One or More Responses": "SELECT_ALL_THAT_APPLY",
    "Text Box Plus Check Box": "MC_WITH_TEXT_BOX",
    "Optional Multiple Choice with Text Box (text in text box)": "MC_WITH_TEXT_BOX",
    "Text only Response": "TEXT_FREE",
    "Text box": "TEXT_FREE",
    "Mulitple Text Boxes": "MULTIPLE_TEXT_BOXES",
    "Mulitple Choice": "MULTIPLE_CHOICE",
    "Special Function": "SPECIAL_FUNCTION",
    "Dropdown Menu (single choice)": "MULTIPLE_CHOICE",
    "Optional Multiple Choice, Figures (with radio button to select one)": "MULTIPLE_CHOICE",
    "Question text also for something else": None,
    "": None,
}


def test_base_types_and_flags(spark):
    df = spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(TYPES)], "question_concept_id string, question_type string"
    )
    rows = {r.question_type: r for r in versions.question_type_norm(df).collect()}
    assert {t: r.base_type for t, r in rows.items()} == TYPES
    looped = rows["Or (xor=) Question (either/or text boxes without radio button), Loops"]
    assert looped.has_loop and not looped.is_optional
    gated = rows["Optional Select All That Apply, DisplayIf in One or More Responses"]
    assert gated.has_displayif and gated.is_optional
    assert rows["Optional Multiple Choice with Text Box (text in text box)"].has_inline_text_box


def test_sessions_from_the_wide_participant_row(spark):
    wide = spark.createDataFrame(
        [
            ("1", STATUS_SUBMITTED, "2024-01-01T10:00:00Z", "2024-01-01 10:45:30"),
            ("2", STATUS_STARTED, "2024-01-02 23:00:00", None),
            ("3", None, None, None),
            ("4", STATUS_NOT_STARTED, "not a time", None),
        ],
        "connect_id string, d_1 string, d_2 string, d_3 string",
    )
    rows = {
        r.connect_id: r
        for r in sessions.response_sessions(wide, [sessions.Triad("300000001", "d_1", "d_2", "d_3")]).collect()
    }
    assert set(rows) == {"1", "2", "4"}
    assert (rows["1"].status, rows["1"].is_complete, rows["1"].duration_minutes, rows["1"].start_hour) == (2, True, 45, 10)
    assert (rows["2"].status, rows["2"].is_complete, rows["2"].completed_at) == (1, False, None)
    assert rows["4"].started_at is None


@pytest.mark.parametrize(
    "text, label, kind",
    [
        ("Autogenerated date/time stamp for Start of survey", "D/T Surv Start", "start"),
        ("Autogenerated date/time stamp when survey completed", "x", "complete"),
        ("Autogenerated date/time stamp", "D/T BOH Sub", "complete"),
        ("Autogenerated date/time stamp", "D/T BOH", None),
        ("Start of your job", "Start", None),
    ],
)
def test_time_stamp_kinds(spark, text, label, kind):
    df = spark.createDataFrame([(text, label)], "t string, l string")
    assert df.select(sessions.timestamp_kind(F.col("t"), F.col("l"))).first()[0] == kind


def test_missingness_takes_the_first_rule_that_holds(spark):
    day = datetime.datetime
    taken = spark.createDataFrame(
        [
            ("none", "s", False, None), ("early", "s", True, day(2020, 1, 1)), ("hid", "s", True, day(2022, 1, 1)),
            ("ans", "s", True, day(2021, 1, 1)), ("skip", "s", True, day(2022, 1, 1)),
        ],
        "connect_id string, secondary_source_concept_id string, is_complete boolean, completed_at timestamp",
    )
    asked = spark.createDataFrame(
        [("s", "q", datetime.date(2021, 1, 1))],
        "secondary_source_concept_id string, question_concept_id string, added_at date",
    )
    fact = spark.createDataFrame(
        [("none", "s", "q"), ("early", "s", "q"), ("hid", "s", "q"), ("ans", "s", "q"), ("skip", "other", "q")],
        "connect_id string, secondary_source_concept_id string, question_concept_id string",
    )
    hidden = spark.createDataFrame(
        [("hid", "s", "q"), ("none", "s", "q"), ("skip", "other", "q")],  # closed in another survey only
        "connect_id string, secondary_source_concept_id string, question_concept_id string",
    )
    got = {r.connect_id: r.missingness for r in sessions.missingness(taken, asked, fact, hidden).collect()}
    assert got == {
        "none": "not_taken", "early": "not_offered", "hid": "not_shown", "ans": "answered", "skip": "not_answered",
    }
    offered = sessions.offered_denominator(taken, asked, fact).first()
    assert (offered.submitted, offered.offered, offered.answered) == (4, 3, 2)


MARKUP = """[SEX?] What is your sex?
(1) Male
(2) Female -> PREG
[SEX2,displayif=equals(SEX,3)!] Later questions in this survey
[1] Penis
[WTLOSS?,displayif=greaterThanOrEqual(percentDiff(W1,W2),.05)] Did you lose weight?
[BLD?,displayif=greaterThanOrEqual(NUMBLD,1)] How old were you?
[MH?] Conditions? |displayif=equals(SIB2,1)|he| or |displayif=or(equals(SIB2,3),equals(SIB2,77))|they|
[1,displayif=or(equals(SEX,2),and(equals(SEX,3),equals(SEX2,6)))] Fibroids -> UF
[3] PCOS -> PCOS
< -> NEXT >
[HYS?] Hysterectomy?
< #NR -> HYS >
<loop max=25>
[AGE?,displayif=isNotDefined(AGE,age)] Age?
|__|__|xor=CANC3 id=CANC3_AGE min=0| Age |__|__|__|__|xor= CANC3 id=CANC3_YEAR| Year
[BOTH?,displayif=and(equals(A,1),equals(B,2))] Both?
|__|__|__|min=0 max=999 softedit=true modalif=value<70 modalvalue='Is this right?'| #Pounds"""


@pytest.fixture(scope="module")
def rule_rows(spark):
    lines = spark.createDataFrame(list(enumerate(MARKUP.split("\n"))), "line_id bigint, line string")
    return rules.skip_rules(lines)


def test_every_mechanism_is_found(rule_rows):
    counts: dict[str, set] = {}
    for r in rule_rows.collect():
        counts.setdefault(r.mechanism, set()).add((r.line_id, r.option, r.target, r.raw_expression))
    assert {m: len(v) for m, v in counts.items()} == {
        "question_gate": 5, "option_gate": 1, "answer_jump": 3, "unconditional_jump": 1, "no_response_jump": 1,
        "loop": 1, "soft_edit": 1, "xor_group": 1, "inline_text": 2,
    }


def test_conditions_are_taken_apart(rule_rows):
    rows = [r for r in rule_rows.collect() if r.mechanism in ("question_gate", "option_gate")]
    arms = {}
    for r in rows:
        arms.setdefault((r.question, r.expression_class), []).append(
            (r.group_no, r.operator, r.trigger, r.trigger_value)
        )
    assert arms["SEX2", "equals"] == [(1, "equals", "SEX", "3")]
    assert arms["WTLOSS", "percent_change"] == [(1, "percentDiff", "W1;W2", ".05")]
    assert arms["BLD", "comparison"] == [(1, "greaterThanOrEqual", "NUMBLD", "1")]
    assert arms["AGE", "defined_check"] == [(1, "isNotDefined", "AGE", "age")]
    assert sorted(arms["BOTH", "and_of_equals"]) == [(1, "equals", "A", "1"), (2, "equals", "B", "2")]
    assert arms["MH", "nested"] == [(None, None, None, None)]


def test_lines_belong_to_the_question_above(rule_rows):
    jumps = {(r.question, r.option, r.target) for r in rule_rows.collect() if "jump" in r.mechanism}
    assert jumps == {
        ("SEX", "2", "PREG"), ("MH", "1", "UF"), ("MH", "3", "PCOS"), ("MH", None, "NEXT"), ("HYS", None, "HYS"),
    }


def test_trigger_census_counts_arms(rule_rows):
    census = {r.trigger: r.n for r in rules.trigger_census(rule_rows).collect()}
    assert census["SIB2"] == 3 and census["SEX"] == 1


def test_exclusive_pair_is_judged_per_parent_and_loop(spark):
    rows = [
        ("1", "s", "p", 1, "age", "40"), ("1", "s", "p", 1, "year", "1990"),
        ("2", "s", "p", 1, "age", "40"), ("2", "s", "p", 2, "year", "1990"),
        ("3", "s", "p", 1, "age", "40"), ("3", "s", "r", 1, "year", "1990"),
        ("4", "s", None, 1, "age", "40"), ("4", "s", None, 1, "year", ""),
    ]
    fact = spark.createDataFrame(
        rows,
        "connect_id string, secondary_source_concept_id string, source_question_concept_id string, "
        "loop_instance bigint, question_concept_id string, response_value_as_string string",
    )
    assert [r.connect_id for r in rules.xor_violations(fact, ["age", "year"]).collect()] == ["1"]


def test_successors(spark):
    rows = [
        ("1", "Srv_A_v1r0", "Deprecated"), ("2", "Srv_A_v2r0", "New"),
        ("3", "Srv_B_v1r0", "Deprecated"), ("4", "Srv_B_v2r0", None), ("5", "Srv_B_v3r0", ""),
        ("6", "Srv_C_v1r0", "Deprecated"), ("6", "Srv_C_v2r0", "Revised"),
        ("7", "Srv_D_v2r0", "Deprecated"), ("8", "Srv_D_v1r0", None),
        ("9", "Srv_E_v1r0", "Deprecated"), ("10", "Srv_E_v1r1", "Revised"),
    ]
    df = spark.createDataFrame(rows, "question_concept_id string, variable_label string, status string")
    got = {r.question_concept_id: (r.successor_concept_id, r.outcome) for r in versions.successor_links(df).collect()}
    assert got == {
        "1": ("2", "linked"), "3": (None, "ambiguous"), "6": (None, "same_concept"), "7": (None, "none"),
        "9": (None, "none"),
    }


def test_deprecated_answers_route_only_to_existing_successors(spark):
    question = spark.createDataFrame(
        [("1", "Deprecated", "2"), ("2", None, None), ("3", "Deprecated", "99"), ("4", "Revised", "2")],
        "question_concept_id string, status string, successor_concept_id string",
    )
    fact = spark.createDataFrame([(q,) for q in "12345"], "question_concept_id string")
    got = {r.question_concept_id: r.current_question_cid for r in versions.responses_current(fact, question).collect()}
    assert got == {"1": "2", "2": "2", "3": "3", "4": "4", "5": "5"}


def test_event_rounds_and_labels(spark):
    wide = spark.createDataFrame(
        [("1", [("BL", "x"), ("F1", "y")]), ("2", [])], "connect_id string, rounds array<struct<round_id: string, v: string>>"
    )
    assert {tuple(r) for r in events.rounds_to_rows(wide, "rounds").collect()} == {("1", "BL", "x"), ("1", "F1", "y")}
    vocabulary = spark.createDataFrame([(" Mouthwash", "9"), ("Home mouthwash", "9")], "label string, concept_id string")
    raw = spark.createDataFrame([("MOUTHWASH ",), ("home Mouthwash",), ("Spit",), (None,)], "s string")
    mapped = events.label_to_concept(raw, "s", vocabulary)
    assert [r.s_concept_id for r in mapped.where("s IS NOT NULL").orderBy("s").collect()] == ["9", None, "9"]
    assert [tuple(r) for r in events.unmatched_labels(mapped, "s").collect()] == [("Spit", 1)]


def test_every_order_counts_in_a_loop_column(spark):
    loops = [c for c in inputs.module_a(spark, SF_DIR).columns if c.startswith(f"d_{inputs.LOOP_PARENT}_d_{inputs.LOOP_QUESTION}_")]
    total = inputs.module_a(spark, SF_DIR).selectExpr(" + ".join(f"sum(coalesce(CAST({c} AS BIGINT), 0))" for c in loops) + " AS s").first().s
    orders = inputs.table(spark, SF_DIR, "orders").join(inputs.table(spark, SF_DIR, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    assert total == orders.selectExpr("sum(CAST(floor(o_totalprice) AS BIGINT)) AS s").first().s
