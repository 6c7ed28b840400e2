"""Descriptions in the catalogue, free-text questions and variable rows."""

from tallgrass.operators import dictionary, governance
from tallgrass.sources import schemas


def test_table_and_column_descriptions(spark, tmp_path):
    spark.sql(f"CREATE TABLE described (a string, b bigint) USING parquet LOCATION '{tmp_path}/t'")
    try:
        schemas.describe_table(spark, "described", "It's one row\\per answer", {"b": "How 'many'"})
        got = {(r.table, r.column, r.description) for r in schemas.descriptions(spark, ["described"]).collect()}
        assert got == {("described", None, "It's one row\\per answer"), ("described", "a", ""), ("described", "b", "How 'many'")}
    finally:
        spark.sql("DROP TABLE described")


def test_free_text_questions_go_with_their_typed_answers(spark):
    fact = spark.createDataFrame([("p", "t", "12"), ("p", "c", "x"), ("q", "t", "words"), ("q", "n", "y")], "connect_id string, question_concept_id string, v string")
    kinds = spark.createDataFrame([("t", "TEXT_FREE"), ("c", "MULTIPLE_CHOICE"), ("n", None)], "question_concept_id string, base_type string")
    assert {tuple(r) for r in governance.drop_free_text(fact, kinds).collect()} == {("p", "c", "x"), ("q", "n", "y")}


def test_variables_take_the_first_values_and_their_own_parent(spark):
    schema = "rn bigint, prim_cid string, sec_cid string, sq_cid string, q_cid string, resp_cid string, variable_label string, variable_type string, variable_length string, pii string, status string"
    rows = [
        (1, "d", "s", "g", "q1", "r1", "", "Num", "x", "Yes", ""), (2, "", "", "", "", "r2", "L2", "", "4", "maybe", "New"),
        (3, "", "", "", "q2", "r1", "M", "", "", "NO", ""), (4, "", "s2", "", "", "r1", "N", "Char", "2", "", ""), (5, "", "", "g", "q1", "r1", "later", "", "7", "no", ""),
    ]
    got = {tuple(r) for r in dictionary.variable_metadata(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        ("d", "s", "g", "q1", "r1", None, "Num", None, True, None), ("d", "s", "g", "q1", "r2", "L2", None, 4, None, "New"),
        ("d", "s", None, "q2", "r1", "M", None, None, False, None), ("d", "s2", None, "q2", "r1", "N", "Char", 2, None, None),
        ("d", "s2", "g", "q1", "r1", "later", None, 7, False, None),
    }
