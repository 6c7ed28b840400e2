import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallgrass.operators import quality, reshape
from tallgrass.plans import inputs
from tallgrass.schema import FACT, NO, YES
from tallgrass.sources import readers, writers
from tests.conftest import SF_DIR


def placed(column, question, survey="300000001", parent=None, loop=1, version=None):
    return Row(
        source_column=column, secondary_source_concept_id=survey, source_question_concept_id=parent,
        question_concept_id=question, loop_instance=loop, question_version=version,
    )


# names in the style of a real cleaned survey: standalone, nested, revised
COLUMNS = [
    "d_899251483_d_452438775", "d_899251483_d_452438775_v2", "d_899251483_d_812107266",
    "d_899251483_d_812107266_v2", "d_724589244", "d_784119588", "d_191057574_v2",
]


@pytest.mark.parametrize("strategy", ["stack", "array"])
def test_null_cells_vanish_and_every_row_is_stamped(spark, strategy):
    seeded = 4
    p1 = {c: (YES if i < seeded else None) for i, c in enumerate(COLUMNS)}
    p2 = {c: (YES if i < 1 else None) for i, c in enumerate(COLUMNS)}
    schema = "connect_id string, " + ", ".join(f"{c} string" for c in COLUMNS)
    wide = spark.createDataFrame([("P1", *p1.values()), ("P2", *p2.values())], schema)
    mapping = [placed(c, c.split("_")[-1] if not c.endswith("_v2") else "452438775") for c in COLUMNS]
    fact = reshape.load_survey(wide, mapping, "mouth", strategy=strategy)
    assert fact.count() == seeded + 1
    assert fact.where("secondary_source_concept_id IS NULL").count() == 0
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT]


cells = st.one_of(st.none(), st.just(""), st.text(alphabet="ab1|'\\", max_size=4))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(cells, cells, cells), min_size=1, max_size=12))
def test_melt_gives_one_row_per_non_null_cell(spark, data):
    rows = [(str(i), *cells) for i, cells in enumerate(data)]
    wide = spark.createDataFrame(rows, "connect_id string, a string, b string, c string")
    expected = sorted(
        (r[0], name, value) for r in rows for name, value in zip("abc", r[1:], strict=True) if value is not None
    )
    for strategy in ("stack", "array"):
        found = sorted(tuple(r) for r in reshape.melt(wide, ["a", "b", "c"], strategy=strategy).collect())
        assert found == expected


def test_other_types_become_text(spark):
    wide = spark.createDataFrame([("1", 5, True)], "connect_id string, a bigint, b boolean")
    assert {tuple(r) for r in reshape.melt(wide, ["a", "b"]).collect()} == {("1", "a", "5"), ("1", "b", "true")}


def test_very_wide_table(spark, tmp_path):
    path = str(tmp_path / "wide")
    names = [f"d_{100000000 + i}" for i in range(2400)]
    spark.range(20).selectExpr(
        "CAST(id AS STRING) AS connect_id",
        *[f"CASE WHEN id % 7 = {i % 7} THEN '1' END AS {c}" for i, c in enumerate(names)],
    ).write.parquet(path)
    wide = readers.read_survey(spark, path)
    fact = reshape.load_survey(wide, [placed(c, c[2:]) for c in names], "wide")
    seen = fact.agg(F.count(F.lit(1)), F.countDistinct("question_concept_id")).first()
    assert seen[0] == sum(1 for i in range(2400) for p in range(20) if p % 7 == i % 7)
    assert seen[1] == 2400


def test_column_mapped_twice_gives_two_rows(spark):
    wide = spark.createDataFrame([("1", "x")], "connect_id string, a string")
    mapping = [placed("a", "100000001"), placed("a", "100000002")]
    for strategy in ("stack", "array"):
        fact = reshape.load_survey(wide, mapping, "t", strategy=strategy)
        assert {r.question_concept_id for r in fact.collect()} == {"100000001", "100000002"}


def test_constant_placement_equals_the_join(spark, as_set):
    wide = inputs.module_a(spark, SF_DIR)
    mapping = inputs.colmap(spark)
    names = [c for c in wide.columns if c != "connect_id"]
    joined = reshape.place_cells(reshape.melt(wide, names), mapping, "module_a")
    keys = ["connect_id", "source_column", "question_concept_id", "loop_instance", "question_version"]
    fact = inputs.fact(spark, SF_DIR, "module_a")
    assert as_set(joined, *keys, "value") == as_set(fact, *keys, "response_value_as_string")


def test_load_has_no_shuffle_and_reads_only_wanted_columns(spark, plan_of):
    fact = inputs.fact(spark, SF_DIR, "module_c")
    assert "Exchange" not in plan_of(fact)
    one = plan_of(inputs.fact(spark, SF_DIR, questions=[inputs.SEGMENT]).select("response_value_as_string"))
    assert one.count("ReadSchema") == 1
    assert "ReadSchema: struct<c_mktsegment:string>" in one


def test_batches_give_the_same_rows(spark):
    wide = inputs.module_c(spark, SF_DIR)
    mapping = reshape.placements(inputs.colmap(spark), {"module_c": wide})["module_c"]
    whole = reshape.load_survey(wide, mapping, "module_c")
    parts = reshape.load_survey(wide, mapping, "module_c", batch=3)
    assert whole.exceptAll(parts).count() == 0 and whole.count() == parts.count()


def test_mapped_columns_absent_from_the_table_are_counted(spark):
    wide = spark.createDataFrame([("1", "x")], "connect_id string, a string")
    assert reshape.mapped_columns(wide, [placed("a", "1"), placed("gone", "2")]) == (["a"], 1)


def test_reload_replaces_one_source_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    writers.reload_source(inputs.fact(spark, SF_DIR), path)
    first = {r.source_table: r["count"] for r in spark.read.parquet(path).groupBy("source_table").count().collect()}
    for _ in range(2):
        writers.reload_source(inputs.fact(spark, SF_DIR, "module_b"), path)
    again = {r.source_table: r["count"] for r in spark.read.parquet(path).groupBy("source_table").count().collect()}
    assert first == again
    short = inputs.fact(spark, SF_DIR, "module_b").where("question_concept_id = '784119588'")
    writers.reload_source(short, path)
    last = readers.read_fact(spark, path)
    assert last.where("source_table = 'clean.module_b'").count() == short.count()
    assert last.where("source_table = 'clean.module_a'").count() == first["clean.module_a"]
    assert quality.grain_duplicates(last).count() == 0


def test_flatten_nested_export(spark):
    schema = (
        "connect_id string, D_1 struct<D_2: string, D_3: struct<D_4: bigint, D_5: array<string>>>, d_6 string"
    )
    raw = spark.createDataFrame([("1", ("a", (7, ["x", "y"])), "z")], schema)
    flat = reshape.flatten_struct(raw)
    assert flat.columns == ["connect_id", "D_1_D_2", "D_1_D_3_D_4", "D_1_D_3_D_5", "d_6"]
    options = sorted(r.option for r in reshape.array_options(flat, "D_1_D_3_D_5").collect())
    marked = reshape.array_indicators(flat, "D_1_D_3_D_5", [*options, "w"])
    clean = reshape.indicators_to_concepts(marked, [c for c in marked.columns if c.startswith("D_1_D_3_D_5_")])
    row = clean.first()
    assert (row["D_1_D_3_D_5_D_x"], row["D_1_D_3_D_5_D_w"]) == (YES, NO)


def test_null_array_gives_null_indicators(spark):
    raw = spark.createDataFrame([("1", None), ("2", [])], "connect_id string, a array<string>")
    rows = {r.connect_id: r.a_D_x for r in reshape.array_indicators(raw, "a", ["x"]).collect()}
    assert rows == {"1": None, "2": "0"}


def test_merge_takes_the_newest_value_per_cell(spark):
    v1 = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d")], "connect_id string, x string, y string")
    v2 = spark.createDataFrame([("2", None, "e"), ("3", "f", "g")], "connect_id string, x string, z string")
    v3 = spark.createDataFrame([("2", "h")], "connect_id string, y string")
    merged = {r.connect_id: (r.x, r.y, r.z) for r in reshape.merge_versions([v1, v2, v3]).collect()}
    assert merged == {"1": ("a", "b", None), "2": ("c", "h", "e"), "3": ("f", None, "g")}


def test_audit_lists_the_most_frequent_untyped_texts(spark):
    values = ["x"] * 3 + ["y"] * 2 + ["5", "353358909", "2024-02-29"]
    fact = reshape.type_values(spark.createDataFrame([(v,) for v in values], "value string"))
    assert [tuple(r) for r in reshape.untyped_audit(fact, 1).collect()] == [("x", 3)]
