import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.operators import dictionary
from tallgrass.plans import catalog
from tallgrass.schema import DICTIONARY_POSITIONS, DICTIONARY_WIDTH, FACT, MAPPING
from tallgrass.sources import readers, schemas, writers
from tests.conftest import SF_DIR


def line(**cells):
    places = {name: i for i, name in DICTIONARY_POSITIONS.items()}
    row = [""] * DICTIONARY_WIDTH
    for name, value in cells.items():
        row[places[name]] = '"' + value.replace('"', '""') + '"' if any(c in value for c in ',"\n') else value
    return ",".join(row)


def write_dictionary(tmp_path):
    header = ",".join(["conceptId"] * DICTIONARY_WIDTH)
    lines = [
        header,
        line(prim_cid="900000001", prim="Survey", sec_cid="910000001", sec="Mouth, teeth", q_cid="920000001",
             q_text='Say "aah"\nplease', resp_cid="930000001", resp_fmt="0 = No", q_type="Multiple Choice"),
        line(resp_cid="930000002", resp_fmt="1 = Yes"),
        line(sec_cid="910000002", sec="Other", sq_cid="940000001", sq_text="Grid", q_cid="920000002", q_text="Two"),
        ",,900000002,Bio,910000003,Third",
        line(q_cid="920000001", q_text="Later wording", resp_cid="930000002", resp_fmt="late label"),
    ]
    path = tmp_path / "dictionary.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_flat_dictionary_file_to_tables(spark, tmp_path, as_set):
    rows = readers.read_flat_dictionary(spark, write_dictionary(tmp_path))
    assert rows.count() == 5
    star = dictionary.build_star(dictionary.filled_rows(rows))
    assert as_set(star.primary_source) == {("900000001", "Survey"), ("900000002", "Bio")}
    assert as_set(star.secondary_source) == {
        ("910000001", "Mouth, teeth", "900000001"),
        ("910000002", "Other", "900000001"),
        ("910000003", "Third", "900000002"),
    }
    questions = {r.question_concept_id: r for r in star.question.collect()}
    first = questions["920000001"]
    assert first.question_text == 'Say "aah"\nplease'
    assert first.secondary_source_concept_id == "910000001"
    assert questions["920000002"].source_question_concept_id == "940000001"
    assert as_set(star.question_response) == {
        ("920000001", "930000001"), ("920000001", "930000002"),
    }
    assert as_set(star.response) == {("930000001", "0 = No"), ("930000002", "1 = Yes")}
    flat = dictionary.v_data_dictionary(star).collect()
    assert [(r.question_concept_id, r.response_concept_id) for r in flat] == [
        ("920000001", "930000001"), ("920000001", "930000002"), ("920000002", None),
    ]
    counts = {r.tbl: r.n for r in dictionary.dim_counts(star).collect()}
    assert counts == {
        "primary_source": 2, "secondary_source": 3, "source_question": 1, "question": 2, "response": 2,
        "question_response": 2,
    }


def test_forward_fill_over_many_blocks(spark):
    rng = random.Random(3)
    data = [
        (i * 3 + (i // 50) * 1000, rng.choice(["a", "b", None, None, None]), rng.choice([1, None, None]))
        for i in range(400)
    ]
    expected, last_x, last_y = {}, None, None
    for order, x, y in data:
        last_x, last_y = x or last_x, y or last_y
        expected[order] = (last_x, last_y)
    rng.shuffle(data)
    df = spark.createDataFrame(data, "o bigint, x string, y bigint")
    for block in (1, 7, 100, 1_000_000):
        filled = dictionary.forward_fill(df, "o", ["x", "y"], block=block)
        assert {r.o: (r.x_f, r.y_f) for r in filled.collect()} == expected


def test_forward_fill_orders_only_the_block_summary_as_a_whole(spark, plan_of):
    df = spark.range(1000).select(F.col("id").alias("o"), F.lit("x").alias("x"))
    plan = plan_of(dictionary.forward_fill(df, "o", ["x"], block=10))
    single = [part for part in plan.split("\n\n") if "SinglePartition" in part]
    assert len(single) == 1 and "__last_x" in single[0]


def test_synonym_groups_and_members(spark):
    question = spark.createDataFrame(
        [
            ("3", "Street name of employer"), ("1", "Full Street, work"), ("2", "Street name"),
            ("5", "Your CITY of school"), ("4", "Electricity"), ("6", None),
        ],
        "question_concept_id string, question_text string",
    )
    edges = dictionary.concept_relationship(question)
    pairs = {(r.concept_id_1, r.concept_id_2) for r in edges.collect()}
    assert pairs == {("3", "1"), ("1", "1"), ("2", "2"), ("5", "5")}
    sizes = [tuple(r) for r in dictionary.group_sizes(edges).collect()]
    assert sizes[0] == ("demo: address work street_name (matched on question text)", 2)
    members = dictionary.group_members(edges, question, sizes[0][0])
    assert {r.question_concept_id for r in members.collect()} == {"1", "3"}


def test_crosswalk_file_first_row_wins(spark, tmp_path, as_set):
    path = tmp_path / "crosswalk.csv"
    path.write_text(
        "secondary_source,secondary_source_concept_id,bq_table,notes\n"
        '"Medicines, sleep",910000001,module2,"first, listed"\n'
        "Casing,,module2,\n"
        "Casing pair,910000002, module2 ,x\n"
        "No table,910000003,,\n"
    )
    crosswalk = readers.read_crosswalk(spark, str(path))
    assert as_set(readers.crosswalk_first(crosswalk)) == {("module2", "910000001")}


def test_flags_stay_text(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text(",".join(MAPPING.fieldNames()) + "\n" + ",".join(["x"] * 14 + ["Y", "N"]) + "\n")
    row = readers.read_typed_csv(spark, str(path), MAPPING).first()
    assert (row.question_in_dict, row.secondary_source_match) == ("Y", "N")


def test_schema_walks(spark):
    schema = T.StructType(
        [
            T.StructField("connect_id", T.StringType(), False, {"comment": "the\nparticipant"}),
            T.StructField(
                "D_1",
                T.StructType(
                    [T.StructField("D_2", T.ArrayType(T.StringType())), T.StructField("D_3", T.LongType())]
                ),
            ),
            T.StructField("r", T.ArrayType(T.StructType([T.StructField("k", T.DateType())]))),
        ]
    )
    assert schemas.column_paths(schema) == ["connect_id", "D_1_D_2", "D_1_D_3", "r_k"]
    rows = [tuple(r) for r in schemas.schema_rows(spark, schema).collect()]
    assert rows == [
        ("connect_id", "STRING", "REQUIRED", "the participant"),
        ("D_1", "RECORD", "NULLABLE", ""),
        ("D_1.D_2", "STRING", "REPEATED", ""),
        ("D_1.D_3", "BIGINT", "NULLABLE", ""),
        ("r", "RECORD", "REPEATED", ""),
        ("r.k", "DATE", "NULLABLE", ""),
    ]
    assert schemas.table_columns(spark, {"t": schema}).count() == 4


def test_repeated_headers(spark):
    header = ["conceptId", "x", "conceptId", "", "conceptId", ""]
    names = ["conceptId", "x", "conceptId_2", "column", "conceptId_3", "column_2"]
    assert schemas.unique_headers(header) == names
    df = spark.createDataFrame([tuple("abcdef")], "a string, b string, c string, d string, e string, f string")
    assert schemas.repair_headers(df, header).columns == names


def test_comments_and_empty_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    writers.create_fact(spark, path, FACT)
    described = schemas.with_comments(spark.read.parquet(path), {"connect_id": "participant"})
    assert described.schema["connect_id"].metadata["comment"] == "participant"
    row = spark.createDataFrame([("1",)], "connect_id string")
    row.write.mode("append").parquet(path)
    writers.create_fact(spark, path, FACT)
    assert spark.read.schema(FACT).parquet(path).count() == 1
    writers.create_fact(spark, path, FACT, recreate=True)
    assert spark.read.parquet(path).count() == 0


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", "x, y"), ("c", "")], "k string, v string")
    writers.export_csv(df, str(tmp_path / "csv"), ["k"])
    files = sorted((tmp_path / "csv").glob("part-*.csv"))
    body = [r for f in files for r in f.read_text().splitlines() if r != "k,v"]
    assert body[0] == 'a,"x, y"' and [r[0] for r in body] == ["a", "b", "c"]
    writers.export_records(df, str(tmp_path / "json"))
    text = "".join(f.read_text() for f in (tmp_path / "json").glob("part-*.json"))
    assert '{"k":"b","v":null}' in text
    writers.replace_table(df, str(tmp_path / "pq"))
    writers.replace_table(df.limit(1), str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1
    writers.publish_view(df, "export_view")
    assert spark.sql("SELECT count(*) FROM export_view").first()[0] == 3


def test_markup_file_keeps_line_order(spark, tmp_path):
    path = tmp_path / "module.txt"
    path.write_text("[A?] one\n(1) Yes -> B\n")
    rows = readers.read_markup(spark, str(path)).orderBy("line_id").collect()
    assert [r.line for r in rows] == ["[A?] one", "(1) Yes -> B"]
    assert rows[0].questionnaire == "module.txt"


def test_export_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    texts = ["  two  blanks ", ' "said" ', "back\\slash\\", '\\"', "a\nb", "a\r\nb", "\r", "\n", " ", "\t", None, ",", "#"]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "k int, text string")
    writers.export_csv(df, str(tmp_path / "csv"), ["k"])
    read = readers.read_typed_csv(spark, str(tmp_path / "csv"), df.schema)
    assert [r.text for r in read.orderBy("k").collect()] == texts


def test_dictionary_file_gives_back_every_cell(spark, monkeypatch):
    columns = catalog.inputs.SHEET_COLUMNS
    texts = ["  Multiple   choice ", ' "quoted" ', "ends in \\", "a\nb", "x, y"]
    data = [(i, *[texts[i % 5] if c in ("q_text", "q_type") else f"{c}{i}" for c in columns[1:]]) for i in range(10)]
    sheet = spark.createDataFrame(data, "rn bigint, " + ", ".join(f"{c} string" for c in columns[1:]))
    monkeypatch.setattr(catalog.inputs, "sheet_rows", lambda *_: sheet)
    read = catalog.QUERIES["dictionary_file"](spark, SF_DIR).orderBy("place").collect()
    assert [tuple(r)[1:] for r in read] == [row[1:] for row in data]


def test_type_census_has_the_types_that_populate_themselves(spark):
    census = {r.question_type: r for r in catalog.QUERIES["type_census"](spark, SF_DIR).collect()}
    found = census["Self Populates Outside of the Form"]
    assert found.n == 1 and found.base_type == "SPECIAL_FUNCTION"
    assert sorted(catalog.inputs.TYPE_TEXTS) == list(range(34))
