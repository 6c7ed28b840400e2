import pytest
from pyspark.sql import functions as F

from tallgrass.functions import names
from tallgrass.operators import placement

# name: concept ids, revision tag, clean loop, flat loop, odd tokens
GRAMMAR = {
    "d_715581797_1_v2": (["715581797"], "_v2", 1, None, []),
    "d_110872086_d_110872086": (["110872086", "110872086"], "", None, None, []),
    "d_220055064_d_220055064_10": (["220055064", "220055064"], "", 10, None, []),
    "d_236590500_d_236590500_d_958239616_10": (
        ["236590500", "236590500", "958239616"], "", 10, None, [],
    ),
    "D_123456789_D_987654321_3_3": (["123456789", "987654321"], "", 3, 3, []),
    "D_123456789_V2_4_4": (["123456789"], "_v2", 4, 4, []),
    "D_123456789_12_12_v3": (["123456789"], "_v3", 12, 12, []),
    "D_123456789_1_12": (["123456789"], "", 12, 12, []),
    "d_123456789_AGE": (["123456789"], "", None, None, ["AGE"]),
    "d_123456789_123": (["123456789"], "", None, None, ["123"]),
    "Person_ID": ([], "", None, None, ["Person", "ID"]),
    "token": ([], "", None, None, ["token"]),
    "d_123456789_v2x": (["123456789"], "", None, None, ["v2x"]),
}


def test_grammar(spark):
    df = spark.createDataFrame([(n,) for n in GRAMMAR], "name string")
    name = F.col("name")
    rows = df.select(
        name,
        names.concept_ids(name).alias("ids"),
        names.version_tag(name).alias("tag"),
        names.loop_clean(name).alias("clean"),
        names.loop_flat(name).alias("flat"),
        names.odd_tokens(name).alias("odd"),
    ).collect()
    for r in rows:
        assert (r.ids, r.tag, r.clean, r.flat, r.odd) == GRAMMAR[r.name], r.name


@pytest.mark.parametrize(
    "table, base",
    [("module1_v1", "module1"), ("module3_V2", "module3"), ("survey2024", "survey2024"), ("a_v1_b", "a_v1_b")],
)
def test_base_table(spark, table, base):
    df = spark.createDataFrame([(table,)], "t string")
    assert df.select(names.base_table(F.col("t"))).first()[0] == base


def test_loop_style_follows_the_layer(spark):
    columns = spark.createDataFrame([("m", "d_123456789_3"), ("participants", "d_123456789")], "table string, column string")
    clean = placement.parse_columns(columns, layer="clean").collect()
    flat = placement.parse_columns(columns, layer="flat").collect()
    assert [r.loop_number for r in clean] == [3]
    assert [r.loop_number for r in flat] == [None]
    assert placement.parse_columns(columns, layer="flat", loop_style="clean").first().loop_number == 3


def test_columns_without_concepts_only_on_request(spark):
    columns = spark.createDataFrame([("m", "token"), ("m", "d_123456789")], "table string, column string")
    assert placement.parse_columns(columns).count() == 1
    assert placement.parse_columns(columns, keep_all=True).count() == 2


def sheet(spark, data):
    return spark.createDataFrame(
        data, "rn bigint, prim_cid string, sec_cid string, sec string, sq_cid string, q_cid string, resp_cid string"
    )


def test_the_two_survey_sets_differ(spark, as_set):
    rows = sheet(
        spark,
        [
            (1, "900000001", "910000001", "First", "", "920000001", ""),
            (2, "", "", "", "", "920000002", "930000001"),
            (3, "", "910000002", "Second", "", "", "930000002"),
        ],
    )
    carried = as_set(placement.question_surveys(placement.carried_rows(rows)))
    stated = as_set(placement.question_surveys(placement.carried_rows(rows), carry_survey=False))
    assert carried == {
        ("920000001", "910000001"), ("920000002", "910000001"), ("920000002", "910000002"),
    }
    assert stated == {("920000001", "910000001"), ("920000002", "910000002")}


def test_source_question_leaf_moves_to_the_parent(spark):
    rows = sheet(spark, [(1, "900000001", "910000001", "S", "940000001", "920000001", "")])
    columns = spark.createDataFrame(
        [("t_v1", "d_940000001_2"), ("t_v1", "d_940000001_d_920000001"), ("x", "d_999999999")],
        "table string, column string",
    )
    crosswalk = spark.createDataFrame([("t", "910000001")], "table_name string, secondary_source_concept_id string")
    placed = placement.place_columns(
        placement.parse_columns(columns, layer="clean"),
        placement.concept_roles(rows),
        placement.question_surveys(placement.carried_rows(rows)),
        crosswalk,
        placement.survey_domain(placement.carried_rows(rows)),
    )
    by_column = {r["column"]: r for r in placed.collect()}
    grid = by_column["d_940000001_2"]
    assert (grid.leaf_role, grid.question_concept_id, grid.source_question_concept_id) == (
        "source_question", "", "940000001",
    )
    leaf = by_column["d_940000001_d_920000001"]
    assert (leaf.question_in_dict, leaf.secondary_source_match, leaf.primary_source_concept_id) == (
        "Y", "Y", "900000001",
    )
    unknown = by_column["d_999999999"]
    assert (unknown.leaf_role, unknown.secondary_source_concept_id) == ("other", "")
    mapping = {r.source_column: r for r in placement.colmap(placed).collect()}
    assert mapping["d_940000001_2"].loop_instance == 2
    assert mapping["d_940000001_2"].question_concept_id == ""
    assert mapping["d_999999999"].source_question_concept_id is None
