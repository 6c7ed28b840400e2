"""Survey-shaped inputs derived from the given tables.

Every row of a given table takes part; a remainder of a key only picks which kind of value the row
gets, so that all edge cases appear at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallgrass.functions.text import response_unique_id
from tallgrass.operators.dictionary import Star, build_star, filled_rows
from tallgrass.operators.flow import Flow, resolve, response_codes
from tallgrass.operators.reshape import load_surveys, type_values
from tallgrass.operators.rules import skip_rules
from tallgrass.operators.sessions import Triad, with_session_facts
from tallgrass.plans.session import scratch_path
from tallgrass.schema import (
    NO,
    STATUS_NOT_STARTED,
    STATUS_STARTED,
    STATUS_SUBMITTED,
    YES,
)
from tallgrass.sources.writers import store

SURVEY_A, SURVEY_B, SURVEY_C = "300000001", "300000002", "300000003"
SEGMENT, BALANCE, NOTE, EDGE = "100000001", "100000002", "100000003", "100000004"
OTHER_BALANCE, LANGUAGE = "100000011", "784119588"
SELECT_ALL = "110000000"
OPTIONS = {"accident": "110000001", "decay": "110000002", "other": "110000003"}
LOOP_PARENT, LOOP_QUESTION = "120000000", "120000001"
ENGLISH, SPANISH = "163149180", "773342525"


ROWS_PER_TASK = 25_000  # rows of a wide table that one task melts, each into up to a dozen cells

_schemas: dict[tuple[int, str, str], StructType] = {}
_counts: dict[tuple[int, str, str], int] = {}


def _state(spark: SparkSession, path: str) -> str | None:
    """When a file or folder was last written and how long it is; None if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    status = files.getFileStatus(place)
    return f"{path} {status.getModificationTime()} {status.getLen()}"


def _schema(spark: SparkSession, path: str) -> StructType:
    """A file's schema, looked up again when the file has been written anew."""
    key = id(spark), path, str(_state(spark, path))
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return _schemas[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a given table by its footers, looked up again when the file has been written anew."""
    path = f"{sf_dir}/{name}.parquet"
    key = id(spark), path, str(_state(spark, path))
    if key not in _counts:
        _counts[key] = table(spark, sf_dir, name).count()
    return _counts[key]


def rows(spark: SparkSession, schema: str, data: list[tuple]) -> DataFrame:
    """A small constant table as an in-plan relation, whose size the planner knows.

    All cells are SQL literals; NULL for None.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    kinds = [part.strip().split(" ")[1] for part in schema.split(",")]

    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, (int, float)):
            return str(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in data)
    casts = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds, strict=True))
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(names)})")


def _by_remainder(key: str, divisor: int, values: dict[int, str]) -> Column:
    rest = F.pmod(F.col(key), F.lit(divisor))
    return F.coalesce(*[F.when(rest == k, F.lit(v)) for k, v in values.items()])


def _whole(column: str) -> Column:
    return F.floor(F.col(column)).cast("bigint").cast("string")


def module_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide survey of every customer: codes, numbers, text, edge cases, select-all, loops.

    The loop columns hold the sum of all of a customer's orders of high, of medium and of low priority,
    so every order counts and the sums are combined before the shuffle.
    """
    key = F.col("c_custkey")
    loops = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", F.floor("o_totalprice").cast("bigint").alias("v"), F.left("o_orderpriority", F.lit(1)).alias("p"))
        .groupBy("o_custkey")
        .agg(*[F.sum(F.when(F.col("p").isin(*ps), F.col("v"))).alias(f"loop_{n}") for n, ps in ((1, "12"), (2, "3"), (3, "45"))])
    )
    segment = F.create_map(
        *[
            F.lit(x)
            for pair in zip(
                ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
                ("200000001", "200000002", "200000003", "200000004"),
                strict=True,
            )
            for x in pair
        ]
    )
    edges = {0: "2024-02-29", 1: "2024-02-30", 2: "2023-05", 3: "12d", 4: " 12 ", 5: "1e5", 6: "1_000"}
    option = f"d_{SELECT_ALL}_d_"
    return (
        table(spark, sf_dir, "customer")
        .join(loops, key == F.col("o_custkey"), "left")
        .select(
            key.cast("string").alias("connect_id"),
            F.coalesce(F.try_element_at(segment, F.col("c_mktsegment")), F.lit("200000005")).alias(
                f"d_{SEGMENT}"
            ),
            F.when(key % 10 != 0, _whole("c_acctbal")).alias(f"d_{BALANCE}"),
            F.when(key % 3 == 0, F.concat(F.lit("note | "), "c_name"))
            .when(key % 3 == 1, "")
            .alias(f"d_{NOTE}"),
            _by_remainder("c_custkey", 8, edges).alias(f"d_{EDGE}"),
            F.when(key % 2 == 0, YES).when(key % 4 == 1, NO).alias(option + "110000001"),
            F.when(key % 4 == 3, YES).alias(option + "110000001_v2"),
            F.when(key % 3 == 0, YES).alias(option + "110000002"),
            F.when(key % 5 == 0, YES).alias(option + "110000003_v2"),
            *[
                F.col(f"loop_{n}").cast("string").alias(f"d_{LOOP_PARENT}_d_{LOOP_QUESTION}_{n}") for n in (1, 2, 3)
            ],
            F.lit(ENGLISH).alias(f"d_{LANGUAGE}"),
        )
    )


def module_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second survey, of every supplier, that reuses the language question."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("connect_id"),
        F.when(F.col("s_suppkey") % 2 == 0, ENGLISH).otherwise(SPANISH).alias(f"d_{LANGUAGE}"),
        _whole("s_acctbal").alias(f"d_{OTHER_BALANCE}"),
    )


def module_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height, weight, demographics and smoking answers of every customer."""
    key = F.col("c_custkey")

    def number(value: Column) -> Column:
        return value.cast("string")

    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("connect_id"),
        F.when(key % 11 != 0, number(4 + key % 3)).alias("d_114314839_d_340854069"),
        number(key % 12).alias("d_114314839_d_600462977"),
        F.when(key % 17 == 0, "0").otherwise(number(100 + key % 250)).alias("d_746012894"),
        _by_remainder("c_custkey", 4, {0: "210000001", 1: "210000002", 2: "210000009"}).alias(
            "d_367803647_d_367803647"
        ),
        _by_remainder("c_custkey", 5, {0: "220000001", 1: "220000002", 2: "220000003", 3: "220000004"}).alias(
            "d_783167257"
        ),
        _by_remainder(
            "c_custkey", 6,
            {0: "230000001", 1: "230000002", 2: "230000003", 3: "230000004", 4: "230000005"},
        ).alias("d_759004335"),
        _by_remainder("c_custkey", 3, {0: YES, 1: NO}).alias("d_947205597_d_712653855"),
        _by_remainder(
            "c_custkey", 5, {0: "151488193", 1: "805449318", 2: "486319890", 3: "132232896"}
        ).alias("d_763164658"),
        _by_remainder(
            "c_custkey", 7,
            {0: "419415087", 1: "299561721", 2: "716761013", 3: "804785430", 4: "419415087"},
        ).alias("d_639684251"),
        _by_remainder("c_custkey", 4, {0: "317567178", 1: "484055234", 2: "802197176"}).alias(
            "d_798549704"
        ),
    )


# fixed placement of the columns below: table, column, survey, source question, question, loop, revision
COLMAP = [
    ("module_a", "d_100000001", SURVEY_A, None, "100000001", 1, None),
    ("module_a", "d_100000002", SURVEY_A, None, "100000002", 1, None),
    ("module_a", "d_100000003", SURVEY_A, None, "100000003", 1, None),
    ("module_a", "d_100000004", SURVEY_A, None, "100000004", 1, None),
    ("module_a", "d_110000000_d_110000001", SURVEY_A, "110000000", "110000001", 1, None),
    ("module_a", "d_110000000_d_110000001_v2", SURVEY_A, "110000000", "110000001", 1, "_v2"),
    ("module_a", "d_110000000_d_110000002", SURVEY_A, "110000000", "110000002", 1, None),
    ("module_a", "d_110000000_d_110000003_v2", SURVEY_A, "110000000", "110000003", 1, "_v2"),
    ("module_a", "d_120000000_d_120000001_1", SURVEY_A, "120000000", "120000001", 1, None),
    ("module_a", "d_120000000_d_120000001_2", SURVEY_A, "120000000", "120000001", 2, None),
    ("module_a", "d_120000000_d_120000001_3", SURVEY_A, "120000000", "120000001", 3, None),
    ("module_a", "d_784119588", SURVEY_A, None, "784119588", 1, None),
    ("module_a", "d_199999999", SURVEY_A, None, "199999999", 1, None),
    ("module_b", "d_784119588", SURVEY_B, None, "784119588", 1, None),
    ("module_b", "d_100000011", SURVEY_B, None, "100000011", 1, None),
    ("module_c", "d_114314839_d_340854069", SURVEY_C, "114314839", "340854069", 1, None),
    ("module_c", "d_114314839_d_600462977", SURVEY_C, "114314839", "600462977", 1, None),
    ("module_c", "d_746012894", SURVEY_C, None, "746012894", 1, None),
    ("module_c", "d_367803647_d_367803647", SURVEY_C, "367803647", "367803647", 1, None),
    ("module_c", "d_783167257", SURVEY_C, None, "783167257", 1, None),
    ("module_c", "d_759004335", SURVEY_C, None, "759004335", 1, None),
    ("module_c", "d_947205597_d_712653855", SURVEY_C, "947205597", "712653855", 1, None),
    ("module_c", "d_763164658", SURVEY_C, None, "763164658", 1, None),
    ("module_c", "d_639684251", SURVEY_C, None, "639684251", 1, None),
    ("module_c", "d_798549704", SURVEY_C, None, "798549704", 1, None),
]
COLMAP_SCHEMA = (
    "table_name string, source_column string, secondary_source_concept_id string, "
    "source_question_concept_id string, question_concept_id string, loop_instance bigint, "
    "question_version string"
)


def colmap(spark: SparkSession) -> DataFrame:
    """Placement of every column of the three modules."""
    return rows(spark, COLMAP_SCHEMA, COLMAP)


MODULES = {"module_a": module_a, "module_b": module_b, "module_c": module_c}
PEOPLE = {"module_a": "customer", "module_b": "supplier", "module_c": "customer"}  # the table each has its rows from


def fact(
    spark: SparkSession,
    sf_dir: str,
    *modules: str,
    questions: list[str] | None = None,
) -> DataFrame:
    """The long answer table of the named modules (all by default).

    With ``questions`` only the columns of those questions are read from the wide tables.

    A wide file packs a row into a few bytes, so a task that reads one whole would sort or group millions of
    cells. Participants are therefore spread over as many tasks as their number asks for before the melt.
    """
    wanted = modules or tuple(MODULES)
    wide = {name: MODULES[name](spark, sf_dir) for name in wanted}
    tasks = 1 + sum(_count(spark, sf_dir, PEOPLE[name]) for name in wanted) // ROWS_PER_TASK
    if tasks > 1:
        wide = {name: answers.repartition(tasks, "connect_id") for name, answers in wide.items()}
    return load_surveys(wide, colmap(spark), questions=questions)


# question, text, type, home survey, source question
QUESTIONS = [
    ("100000001", "Which segment?", "Multiple Choice", SURVEY_A, None),
    ("100000002", "What is the balance?", "Text Only Response", SURVEY_A, None),
    ("100000003", "Any notes?", "Text box", SURVEY_A, None),
    ("110000001", "Yes, from accident", "Optional Select All that Apply", SURVEY_A, "110000000"),
    ("110000002", "Yes, from decay", "Optional Select All that Apply", SURVEY_A, "110000000"),
    ("110000003", "Yes, other reason", "Select all that apply", SURVEY_A, "110000000"),
    ("120000001", "What was the price?", "Text Only Response, Loops", SURVEY_A, "120000000"),
    ("784119588", "Survey language", "Multiple Choice", SURVEY_A, None),
    ("100000011", "What is the other balance?", None, SURVEY_B, None),
    ("340854069", "Height, feet", "Multiple Text Boxes", SURVEY_C, "114314839"),
    ("600462977", "Height, inches", "Mulitple Text Boxes", SURVEY_C, "114314839"),
    ("746012894", "Weight, pounds", "Text Only Response", SURVEY_C, None),
    ("367803647", "Highest education", "Multiple Choice", SURVEY_C, "367803647"),
    ("783167257", "Marital status", "Optional Multiple Choice", SURVEY_C, None),
    ("759004335", "Household income", "Multiple Choice", SURVEY_C, None),
    ("712653855", "Ever smoked", "Grid with Multiple Choice Sub-Questions", SURVEY_C, "947205597"),
    ("763164658", "Cigarettes in lifetime", "Multiple Choice", SURVEY_C, None),
    ("639684251", "Smoking now", "Multiple Choice", SURVEY_C, None),
    ("798549704", "Last time smoked", "Multiple Choice", SURVEY_C, None),
]
SOURCE_QUESTIONS = [
    ("110000000", "Have you lost any? Select all that apply", "LOST"),
    ("120000000", "Your purchases", "BUY"),
    ("114314839", "How tall are you?", None),
    ("367803647", "Highest education", None),
]
# question, response, label
OPTION_LABELS = [
    ("100000001", "200000001", "1 = Automobile"),
    ("100000001", "200000002", "2 = Building"),
    ("100000001", "200000003", "3 = Furniture"),
    ("100000001", "200000004", "4 = Household"),
    ("100000001", "200000005", "5 = Machinery"),
    ("110000001", NO, "0 = No"),
    ("110000001", YES, "1 = Yes"),
    ("110000002", YES, "1 = Yes"),
    ("110000003", YES, "1 = Yes"),
    ("784119588", ENGLISH, "1 = English"),
    ("784119588", SPANISH, "2 = Spanish"),
    ("367803647", "210000001", "1 = School"),
    ("367803647", "210000002", "2 = College"),
    ("783167257", "220000001", "1 = Never Married"),
    ("783167257", "220000002", "2 = Partner"),
    ("783167257", "220000003", "3 = Married"),
    ("783167257", "220000004", "4 = Divorced"),
    ("759004335", "230000001", "1 = Low"),
    ("759004335", "230000002", "2 = Lower middle"),
    ("759004335", "230000003", "3 = Middle"),
    ("759004335", "230000004", "4 = Upper middle"),
    ("759004335", "230000005", "5 = High"),
    ("712653855", NO, "0 = No"),
    ("712653855", YES, "1 = Yes"),
    ("763164658", "151488193", "1 = 10 or fewer"),
    ("763164658", "805449318", "2 = 11 to 49"),
    ("763164658", "486319890", "3 = 50 to 99"),
    ("763164658", "132232896", "4 = 100 or more"),
    ("639684251", "419415087", "0 = Not at all"),
    ("639684251", "299561721", "1 = Rarely"),
    ("639684251", "716761013", "2 = Some days"),
    ("639684251", "804785430", "3 = Every day"),
    ("798549704", "317567178", "1 = Past month"),
    ("798549704", "484055234", "2 = Past year"),
    ("798549704", "802197176", "3 = More than a year ago"),
    ("199999998", "299999999", None),
]


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The dictionary behind the three modules: domains are regions, surveys are nations.

    One question, one source question and one response are left out on purpose, as orphans.
    """
    fixed = {0: SURVEY_A, 1: SURVEY_B, 2: SURVEY_C}
    key = F.col("n_nationkey").cast("bigint")
    survey = F.coalesce(
        *[F.when(key == k, F.lit(v)) for k, v in fixed.items()], (key + 410000000).cast("string")
    )
    labels: dict[str, str | None] = {}
    for _, code, label in OPTION_LABELS:
        if label is not None:
            labels[code] = label
    return Star(
        primary_source=table(spark, sf_dir, "region").select(
            (F.col("r_regionkey").cast("bigint") + 400000000).cast("string").alias(
                "primary_source_concept_id"
            ),
            F.col("r_name").alias("primary_source"),
        ),
        secondary_source=table(spark, sf_dir, "nation").select(
            survey.alias("secondary_source_concept_id"),
            F.col("n_name").alias("secondary_source"),
            (F.col("n_regionkey").cast("bigint") + 400000000).cast("string").alias(
                "primary_source_concept_id"
            ),
        ),
        source_question=rows(
            spark,
            "source_question_concept_id string, source_question_text string, grid_name string",
            SOURCE_QUESTIONS,
        ),
        question=rows(
            spark,
            "question_concept_id string, question_text string, question_type string, "
            "secondary_source_concept_id string, source_question_concept_id string",
            QUESTIONS,
        ),
        response=rows(
            spark, "response_concept_id string, format_value string", sorted(labels.items())
        ),
        question_response=rows(
            spark,
            "question_concept_id string, response_concept_id string",
            [(q, r) for q, r, _ in OPTION_LABELS],
        ),
    )


# ---- the flat dictionary, derived from part, nation and region -------------------------------

ADDRESS_TEXTS = {
    0: "Street name of your employer",
    1: "Street number",
    2: "Apartment or unit",
    3: "City or town",
    4: "State",
    5: "Zip code",
    6: "Country",
    7: "Full street, school",
    8: "What is your first name?",
    9: "What is your e-mail?",
    10: "Age at diagnosis",
    11: "Autogenerated date/time stamp for Start",
    12: "Autogenerated date/time stamp",
    13: "Is this survey complete?",
}
# fixed values: type texts as the dictionary writes them, and statuses
TYPE_TEXTS = {
    0: "Optional Select All that Apply",
    1: "Or (xor=) Question (either/or text boxes without radio button), Loops",
    2: "Grid with Multiple Choice Sub-Questions",
    3: "Optional Multiple Choice",
    4: "Or (xor=) Question (either/or text boxes without radio button)",
    5: "Optional Select All that Apply, Loops",
    6: "Multiple Choice",
    7: "Nested",
    8: "Select All That Apply",
    9: "Optional Multiple Choice, Loops",
    10: "Optional Select All that Apply, Displayif in One or More Responses",
    11: "Select all that apply",
    12: "Text Box Plus Check Box",
    13: "Optional Multiple Choice with Text Box (text in text box)",
    14: "Text only Response",
    15: "Text Only Response",
    16: "Multiple Text Boxes",
    17: "Text Only Response, loops",
    18: "Text Box Plus Check Box, Loops",
    19: "Special Functions",
    20: "Required Select All that Apply",
    21: "Mulitple Text Boxes",
    22: "Optional Multiple Choice, Displayif and Piped text",
    23: "Required Multiple Choice",
    24: "Optional Multiple Choice, Figures (with radio button to select one)",
    25: "Special Function",
    26: "Self Populates Outside of the Form",
    27: "Multiple Choice with displayif and/or Piped Text",
    28: "Mulitple Choice",
    29: "Text box",
    30: "Dropdown Menu (single choice)",
    31: "Multiple Text Boxes, Display if in One or More Responses",
    32: "  Multiple   choice ",
    33: "Updated Secondary Source",
}
STATUSES = {0: "Deprecated", 1: "Revised", 2: "New"}


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their nation, region and position: the rows of the dictionary sheet.

    ``j`` is the row's position in its nation's block; ``rn`` orders the whole sheet.
    """
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"),
        "p_name",
        "p_brand",
        (F.col("p_partkey") % 25).cast("bigint").alias("nk"),
        F.floor(F.col("p_partkey") / 25).cast("bigint").alias("j"),
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nk"),
        "n_name",
        F.col("n_regionkey").cast("bigint").alias("rk"),
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("rk"), "r_name"
    )
    return (
        part.join(nation, "nk")
        .join(region, "rk")
        .withColumn("rn", (F.col("rk") * 100 + F.col("nk")) * 1_000_000_000_000 + F.col("j"))
    )


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat dictionary with cells left blank below the first row of each block.

    A region is named on the first row of its first nation, a nation on its first row, a question on
    every third row; some questions are reused by several nations.
    """
    k, j = F.col("k"), F.col("j")
    opens_region = (F.col("nk") < 5) & (j == 0)
    opens_nation = j == 0
    opens_question = j % 3 == 0
    reused = F.when(k % 5 == 0, j).otherwise(k)
    has_parent = opens_question & (j % 2 == 0)

    def cell(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise("")

    version = F.concat(
        F.lit("_v"), (1 + k % 3).cast("string"), F.lit("r"), (k % 2).cast("string")
    )
    return _parts(spark, sf_dir).select(
        "rn",
        cell(opens_region, (F.col("rk") + 400000000).cast("string")).alias("prim_cid"),
        cell(opens_region, F.col("r_name")).alias("prim"),
        cell(opens_nation, (F.col("nk") + 410000000).cast("string")).alias("sec_cid"),
        cell(opens_nation, F.col("n_name")).alias("sec"),
        cell(has_parent, (j % 40 + 600000000).cast("string")).alias("sq_cid"),
        cell(has_parent, F.concat(F.lit("Group "), (j % 40).cast("string"))).alias("sq_text"),
        cell(has_parent & (k % 4 == 0), F.concat(F.lit("GRID"), (j % 40).cast("string"))).alias(
            "grid_name"
        ),
        cell(opens_question, (reused + 500000000).cast("string")).alias("q_cid"),
        cell(
            opens_question,
            F.concat("p_name", F.lit(": "), _by_remainder("k", 14, ADDRESS_TEXTS)),
        ).alias("q_text"),
        cell(opens_question, F.coalesce(_by_remainder("k", 37, TYPE_TEXTS), F.lit(""))).alias("q_type"),
        cell(k % 13 != 0, (k % 300 + 700000000).cast("string")).alias("resp_cid"),
        cell(k % 13 != 0, F.concat((k % 300).cast("string"), F.lit(" = "), "p_brand")).alias("resp_fmt"),
        cell(
            opens_question,
            F.concat(F.lit("Srv_"), F.floor(k / 4).cast("bigint").cast("string"), version),
        ).alias("variable_label"),
        cell(opens_question, F.coalesce(_by_remainder("k", 5, STATUSES), F.lit(""))).alias("status"),
        _by_remainder("k", 6, {0: "Yes", 1: "No", 2: "NO"}).alias("pii"),
    )


SHEET_COLUMNS = (
    "rn", "prim_cid", "prim", "sec_cid", "sec", "sq_cid", "sq_text", "grid_name", "q_cid", "q_text",
    "q_type", "resp_cid", "resp_fmt",
)


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the sheet that the dictionary build reads."""
    return sheet(spark, sf_dir).select(*SHEET_COLUMNS)


def variable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sheet with what it says about variables."""
    rows_ = sheet(spark, sf_dir).withColumn("variable_type", F.col("q_type"))
    length = _parts(spark, sf_dir).select("rn", (F.col("k") % 7).cast("string").alias("variable_length"))
    return rows_.join(length, "rn")


def sheet_star(spark: SparkSession, sf_dir: str) -> Star:
    """The dictionary tables built from the sheet."""
    return build_star(filled_rows(sheet_rows(spark, sf_dir)))


def lifecycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and its date on the rows of the sheet; a question's second row may state them too."""
    rest = F.col("k") % 5
    status = F.coalesce(*[F.when(rest == n, F.lit(s)) for n, s in STATUSES.items()])
    stated = F.col("j") % 3 < 2
    start = F.lit("2022-06-01").cast("date")
    return _parts(spark, sf_dir).select(
        "rn",
        F.when(
            F.col("j") % 3 == 0,
            (F.when(F.col("k") % 5 == 0, F.col("j")).otherwise(F.col("k")) + 500000000).cast("string"),
        ).alias("q_cid"),
        F.when(stated, status).alias("status"),
        F.when(stated & (rest < 3), F.date_add(start, (F.col("k") % 1400).cast("int"))).alias(
            "status_date"
        ),
    )


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The same with the filled rows written first, for queries that read several of the tables."""
    filled = filled_rows(sheet_rows(spark, sf_dir))
    return build_star(store(filled, scratch_path(spark, "filled")))


def variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variable rows of the sheet: ``question_concept_id, variable_label, status, pii, question_text``."""
    return (
        sheet(spark, sf_dir)
        .where("q_cid <> ''")
        .select(
            F.col("q_cid").alias("question_concept_id"),
            "variable_label",
            "status",
            "pii",
            F.col("q_text").alias("question_text"),
            F.col("resp_cid").alias("response_concept_id"),
            F.col("rn"),
        )
    )


def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table, column``: one survey column name per part, every shape of name included."""
    k = F.col("p_partkey")
    question = (k + 500000000).cast("string")
    parent = (F.floor(k / 25).cast("bigint") % 40 + 600000000).cast("string")
    loop = (k % 25 + 1).cast("string")

    def name(*pieces: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    shapes = [
        name("d_", question),
        name("d_", parent, "_d_", question),
        name("d_", parent, "_d_", question, "_v2"),
        name("d_", question, "_3"),
        name("d_", parent, "_d_", question, "_", loop),
        name("d_", question, "_1_v2"),
        name("d_", parent, "_d_", parent, "_d_", question, "_10"),
        name("D_", parent, "_D_", question, "_3_3"),
        name("D_", parent, "_D_", question, "_v2_", loop, "_", loop),
        name("d_", question, "_AGE"),
        name("token_", k.cast("string")),
        name("d_", parent),
    ]
    spelling = F.coalesce(*[F.when(k % 12 == i, shape) for i, shape in enumerate(shapes)])
    tables = {0: "module0", 1: "module1_v1", 2: "module2", 3: "module3_V2", 4: "participants", 5: "unlisted"}
    return table(spark, sf_dir, "part").select(
        _by_remainder("p_partkey", 6, tables).alias("table"), spelling.alias("column")
    )


def tagged_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table, column``: names of which some exist with and without a revision tag."""
    k = F.col("p_partkey")
    question = (F.floor(k / 3).cast("bigint") + 500000000).cast("string")
    tag = _by_remainder("p_partkey", 3, {0: "", 1: "_v2", 2: "_V3"})
    keep = F.when(F.floor(k / 3).cast("bigint") % 4 == 0, "").otherwise(tag)
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("module"), (F.floor(k / 3).cast("bigint") % 3).cast("string")).alias("table"),
        F.concat(
            F.lit("d_"), question,
            F.when(F.floor(k / 3).cast("bigint") % 4 == 1, F.lit("_v2")).otherwise(keep),
        ).alias("column"),
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-to-survey lines from nation; tables repeat and some lines are incomplete."""
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        key.alias("line"),
        F.when(key % 9 == 8, "").otherwise(
            F.concat(F.lit(" module"), (key % 4).cast("string"))
        ).alias("bq_table"),
        F.when(key % 7 == 0, "").otherwise((key + 410000000).cast("string")).alias(
            "secondary_source_concept_id"
        ),
    )


def question_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with status, successor and the wide Current/V1/V2 wording columns, from part."""
    k = F.col("p_partkey")
    deprecated = k % 10 == 0
    text = F.col("p_name")
    top = (1 + k % 3).cast("bigint")
    return table(spark, sf_dir, "part").select(
        (k + 500000000).cast("string").alias("question_concept_id"),
        F.when(deprecated, "Deprecated").when(k % 10 == 1, "Revised").when(k % 10 == 2, "New").alias("status"),
        top.alias("max_version"),
        F.when(deprecated, (k + 1 + 500000000).cast("string")).alias("successor_concept_id"),
        text.alias("current_text"),
        F.when(k % 4 == 1, F.concat(text, F.lit(" (first)"))).when(k % 4 == 2, "").alias("v1_text"),
        F.when(k % 4 == 3, F.concat(text, F.lit(" (second)"))).alias("v2_text"),
        (k % 40 + 600000000).cast("string").alias("current_source_question"),
        F.when(k % 2 == 0, (k % 40 + 600000000).cast("string")).alias("v1_source_question"),
        F.lit(None).cast("string").alias("v2_source_question"),
    )


def question_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from part in groups of twelve: a chain of five successors, and a circle of three that one leads into."""
    k = F.col("p_partkey")
    m = k % 12
    to = F.when(m.between(1, 5) | m.between(7, 9), k + 1).when(m == 10, k - 2)
    return table(spark, sf_dir, "part").select(
        (k + 500000000).cast("string").alias("question_concept_id"),
        F.when(to.isNotNull(), "Deprecated").alias("status"),
        (to + 500000000).cast("string").alias("successor_concept_id"),
    )


def release_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an age, a postal code like number and the day of their first order."""
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("day"))
    return table(spark, sf_dir, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("string").alias("connect_id"),
        (F.floor(F.col("c_acctbal") / 150) + 20).cast("bigint").alias("age"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"), (F.col("c_custkey") % 3).cast("string")).alias("postal"), "day",
    )


def part_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded answers to the questions made from part, one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("connect_id"),
        (F.col("l_partkey") + 500000000).cast("string").alias("question_concept_id"),
        F.when(F.col("l_linenumber") > 3, "_v2").alias("question_version"),
        F.when(F.col("l_returnflag") == "A", YES)
        .when(F.col("l_returnflag") == "N", NO)
        .alias("response_value_as_concept_id"),
    )


# ---- sessions and events -----------------------------------------------------------------------

WEEKS = tuple(range(5))
TRIADS = tuple(
    Triad(str(300000010 + w), f"status_{w}", f"start_{w}", f"submit_{w}") for w in WEEKS
)


def participant_triads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide participant row: per week a status, a first sign-up and a last purchase, as text."""
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("int")
    events = table(spark, sf_dir, "events").withColumn("week", week)

    def moment(kind: str, w: int) -> Column:
        return F.when((F.col("event_type") == kind) & (F.col("week") == w), F.col("ts"))

    firsts = events.groupBy(F.col("user_id").cast("string").alias("connect_id")).agg(
        *[F.min(moment("signup", w)).alias(f"s_{w}") for w in WEEKS],
        *[F.max(moment("purchase", w)).alias(f"c_{w}") for w in WEEKS],
    )
    columns: list[Column] = [F.col("connect_id")]
    for w in WEEKS:
        started, done = F.col(f"s_{w}"), F.col(f"c_{w}")
        columns.append(
            F.when(done.isNotNull(), STATUS_SUBMITTED)
            .when(started.isNotNull(), STATUS_STARTED)
            .otherwise(STATUS_NOT_STARTED)
            .alias(f"status_{w}")
        )
        columns.append(started.cast("string").alias(f"start_{w}"))
        columns.append(done.cast("string").alias(f"submit_{w}"))
    return firsts.select(*columns)


def survey_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session of module A per customer and one of module B per supplier.

    A session runs from the first order (shipment) to the last; enough filled orders (returned
    shipments) make it submitted.
    """

    def spans(rows: DataFrame, key: str, day: str, filled: Column) -> DataFrame:
        return rows.groupBy(F.col(key).alias("k")).agg(
            F.min(day).cast("timestamp").alias("started_at"),
            F.max(day).cast("timestamp").alias("ended_at"),
            F.count_if(filled).alias("filled"),
        )

    def of(people: DataFrame, key: str, span: DataFrame, survey: str, least: int) -> DataFrame:
        done = F.col("filled") >= least
        return people.join(span, F.col(key) == F.col("k"), "left").select(
            F.col(key).cast("string").alias("connect_id"),
            F.lit(survey).alias("secondary_source_concept_id"),
            F.when(done, STATUS_SUBMITTED)
            .when(F.col("started_at").isNotNull(), STATUS_STARTED)
            .otherwise(STATUS_NOT_STARTED)
            .alias("status_concept_id"),
            "started_at",
            F.when(done, F.col("ended_at")).alias("completed_at"),
        )

    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    by_customer = spans(orders, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F")
    by_supplier = spans(items, "l_suppkey", "l_shipdate", F.col("l_returnflag") == "R")
    customers = of(table(spark, sf_dir, "customer"), "c_custkey", by_customer, SURVEY_A, 3)
    suppliers = of(table(spark, sf_dir, "supplier"), "s_suppkey", by_supplier, SURVEY_B, 190)
    return with_session_facts(customers.unionByName(suppliers))


ASKED = [
    (SURVEY_A, "100000001", None),
    (SURVEY_A, "100000002", None),
    (SURVEY_A, "100000003", "2001-06-01"),
    (SURVEY_A, "110000002", None),
    (SURVEY_A, "120000001", "2000-01-01"),
    (SURVEY_B, "784119588", None),
    (SURVEY_B, "100000011", "2001-12-31"),
]


def asked_questions(spark: SparkSession) -> DataFrame:
    """Questions of modules A and B with the day they were added."""
    return rows(
        spark,
        "secondary_source_concept_id string, question_concept_id string, added_at date",
        ASKED,
    )


SPECIMEN_LABELS = {0: "Mouthwash", 1: "MW Collection", 2: "mouthwash collection ", 3: "Saliva kit"}
VOCABULARY = [
    ("Mouthwash", "900000001"),
    ("MW Collection", "900000001"),
    ("Mouthwash Collection", "900000001"),
    ("Home Mouthwash", "900000001"),
]
EVENT_KINDS = {
    "collection": ("view", "specimen_concept_id", "collected_at"),
    "kit": ("click", "kit_type_concept_id", "shipped_at"),
    "incentive": ("purchase", "payment_type_concept_id", "issued_at"),
    "refusal": ("error", "refusal_type_concept_id", "refused_at"),
}


def event_table(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    """One event table; rounds are weeks and the item is one of four concepts."""
    kind, item, date = EVENT_KINDS[category]
    rest = F.col("event_id") % 4
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == kind)
        .select(
            F.col("user_id").cast("string").alias("connect_id"),
            F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("round_id"),
            (rest + 900000001).cast("string").alias(item),
            F.when(F.col("value") > 50, STATUS_SUBMITTED)
            .otherwise(STATUS_NOT_STARTED)
            .alias("status_concept_id"),
            F.col("ts").cast("date").alias(date),
            _by_remainder("event_id", 4, SPECIMEN_LABELS).alias("specimen_label"),
        )
    )


# ---- free text -----------------------------------------------------------------------------------


def text_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as free-text answers: the language picks the question, the source the survey."""
    documents = table(spark, sf_dir, "documents")
    question = (
        F.when(F.col("lang") == "en", "130000001")
        .when(F.col("lang") == "de", "130000002")
        .otherwise("130000003")
    )
    cells = documents.select(
        F.col("doc_id").cast("string").alias("connect_id"),
        F.concat(F.lit("survey "), "source").alias("secondary_source_concept_id"),
        F.lit(None).cast("string").alias("source_question_concept_id"),
        question.alias("question_concept_id"),
        F.col("text").alias("value"),
    )
    return type_values(cells).withColumn(
        "response_unique_id",
        response_unique_id(
            F.col("secondary_source_concept_id"),
            F.col("source_question_concept_id"),
            F.col("question_concept_id"),
            F.col("response_value_as_string"),
        ),
    )


# ---- skip rules ----------------------------------------------------------------------------------


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up questionnaire markup: one block of lines per part, every mechanism included."""
    k = F.col("p_partkey").cast("string")

    def line(*pieces: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    heads = [
        line("[Q", k, "?] Plain question about ", F.col("p_name")),
        line("[Q", k, ",displayif=equals(SEX,3)!] Gated question"),
        line("[Q", k, "?,displayif=or(equals(SEX,2),equals(MOM1,1))] Gated question"),
        line("[Q", k, "?,displayif=and(equals(SEX,3),equals(SEX2,6))] Gated question"),
        line("[Q", k, "?,displayif=greaterThanOrEqual(NUMSIB,1)] Gated question"),
        line("[Q", k, "?,displayif=greaterThanOrEqual(percentDiff(W1,W2),.05)] Gated question"),
        line("[Q", k, "?,displayif=or(equals(SEX,2),and(equals(SEX,3),equals(SEX2,6)))] Gated"),
        line("[Q", k, "?,displayif=isNotDefined(AGE,age)] Gated question"),
        line("[Q", k, "?] Is |displayif=equals(SIB2,1)|he| |displayif=equals(SIB2,2)|she| well?"),
    ]
    bodies = [
        line("(1) Yes -> Q", k),
        line("[1,displayif=equals(SEX,2)] Fibroids -> UF"),
        line("|__|__|xor=G", k, " id=A min=0| Age or |__|__|xor=G", k, " id=B| Year"),
        line("|__|__|__|min=0 max=999 softedit=true modalif=value<70 modalvalue='Sure?'| Pounds"),
        line("<loop max=25>"),
    ]
    tails = [line("< -> END", k, " >"), line("< #NR -> Q", k, " >"), line("(0) No")]

    def pick(lines: list[Column]) -> Column:
        return F.coalesce(
            *[F.when(F.col("p_partkey") % len(lines) == i, text) for i, text in enumerate(lines)]
        )

    block = F.array(pick(heads), pick(bodies), pick(tails))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(block).alias("offset", "line")
    ).select((F.col("p_partkey") * 3 + F.col("offset")).alias("line_id"), "line")


def module_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of the three modules as rows of a sheet, cells blank below the first row of a question."""
    labels = star(spark, sf_dir)
    flat = (
        labels.question.join(labels.secondary_source, "secondary_source_concept_id")
        .join(labels.primary_source, "primary_source_concept_id")
        .join(labels.source_question, "source_question_concept_id", "left")
        .join(labels.question_response, "question_concept_id", "left")
        .join(labels.response, "response_concept_id", "left")
    )
    order = Window.orderBy("secondary_source_concept_id", "question_concept_id", F.asc_nulls_first("response_concept_id"))
    numbered = flat.withColumn("rn", F.row_number().over(order).cast("bigint"))
    first = F.col("rn") == F.min("rn").over(Window.partitionBy("question_concept_id"))
    opens = F.col("rn") == F.min("rn").over(Window.partitionBy("secondary_source_concept_id"))

    def cell(condition: Column, name: str) -> Column:
        return F.coalesce(F.when(condition, F.col(name)), F.lit(""))

    return numbered.select(
        "rn", cell(opens, "primary_source_concept_id").alias("prim_cid"), cell(opens, "primary_source").alias("prim"),
        cell(opens, "secondary_source_concept_id").alias("sec_cid"), cell(opens, "secondary_source").alias("sec"),
        cell(first, "source_question_concept_id").alias("sq_cid"), cell(first, "source_question_text").alias("sq_text"),
        cell(first, "grid_name").alias("grid_name"), cell(first, "question_concept_id").alias("q_cid"),
        cell(first, "question_text").alias("q_text"), cell(first, "question_type").alias("q_type"),
        cell(F.lit(True), "response_concept_id").alias("resp_cid"), cell(F.lit(True), "format_value").alias("resp_fmt"),
    )


def questionnaire_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of questionnaires of different size made from the parts; each begins with a line that has no question above it."""
    lines = markup(spark, sf_dir).withColumn("part", F.floor(F.col("line_id") / 3) % 6)
    named = lines.select(
        F.when(F.col("part") == 0, "first").when(F.col("part") < 3, "second").otherwise("third").alias("questionnaire"), "line_id", "line"
    )
    opening = named.select("questionnaire").distinct().select("questionnaire", F.lit(-1).alias("line_id"), F.lit("(1) Yes -> START").alias("line"))
    return write_questionnaires(spark, named.unionByName(opening))


def write_questionnaires(spark: SparkSession, lines: DataFrame) -> str:
    """Write ``questionnaire, line_id, line`` as text, one folder each, parts in the order of lines."""
    path = scratch_path(spark, "questionnaires")
    ordered = lines.repartitionByRange("questionnaire", "line_id").sortWithinPartitions("questionnaire", "line_id")
    ordered.select("questionnaire", "line").write.partitionBy("questionnaire").text(path)
    return path


# the questionnaires of the three modules, in markup
QUESTIONNAIRES = {
    "module_a": """[SEGMENT!] Which segment?
(1) Automobile
(2) Building -> NOTES
(3) Furniture
(4) Household -> PRICE
(5) Machinery -> _CONTINUE
[BALANCE?,displayif=isNotDefined(EDGE,edge)] What is the balance?
|__|__|__|min=0 max=9999|
< #NR -> DECAY >
[EDGE?] Which text?
[NOTES?,displayif=or(equals(SEGMENT,1),equals(SEGMENT,2))] Any notes?
< -> OTHER >
[ACCIDENT?] Lost any by accident?
(0) No -> SEGMENT
(1) Yes -> PRICE
[DECAY?,displayif=and(equals(ACCIDENT,1),equals(SEGMENT,2))] Lost any by decay?
(1) Yes -> LANG
[OTHER?,displayif=or(equals(SEGMENT,3),and(equals(ACCIDENT,1),equals(DECAY,1)))] Lost any otherwise?
[PRICE?,displayif=greaterThanOrEqual(percentDiff(WEIGHT,BALANCE),.05)] What was the price?
[LANG?] Survey language
[GHOST?,displayif=equals(NOBODY,1)] A question that no dictionary knows
< -> NOWHERE >""",
    "module_b": """[LANG?,displayif=greaterThan(OTHERBAL,0)] Survey language
(2) Spanish -> END
[OTHERBAL?] What is the other balance?""",
    "module_c": """[HEIGHTFT?] Height, feet
[HEIGHTIN?] Height, inches
[WEIGHT?] Weight, pounds
[EDU?] Highest education
(1) School -> INCOME
(2) College
[MARITAL?,displayif=equals(SEGMENT,1)] Marital status
(1) Never Married -> EVER
(3) Married -> _CONTINUE
[INCOME?] Household income
(5) High -> NOWSMOKE
< #NR -> LASTSMOKE >
[EVER?] Ever smoked
(0) No -> END
[LIFETIME?,displayif=equals(EVER,1)] Cigarettes in lifetime
(4) 100 or more -> LASTSMOKE
[NOWSMOKE?,displayif=and(equals(EVER,1),or(equals(LIFETIME,3),equals(LIFETIME,4)))] Smoking now
(1) Rarely -> END
[LASTSMOKE?,displayif=greaterThanOrEqual(isDefined(WEIGHT,400),200)] Last time smoked""",
}
# survey, name in the questionnaire, question
QUESTION_NAMES = [
    (SURVEY_A, "SEGMENT", SEGMENT), (SURVEY_A, "BALANCE", BALANCE), (SURVEY_A, "NOTES", NOTE), (SURVEY_A, "EDGE", EDGE),
    (SURVEY_A, "ACCIDENT", "110000001"), (SURVEY_A, "DECAY", "110000002"), (SURVEY_A, "OTHER", "110000003"),
    (SURVEY_A, "PRICE", LOOP_QUESTION), (SURVEY_A, "LANG", LANGUAGE), (SURVEY_B, "LANG", LANGUAGE), (SURVEY_B, "OTHERBAL", OTHER_BALANCE),
    (SURVEY_C, "HEIGHTFT", "340854069"), (SURVEY_C, "HEIGHTIN", "600462977"), (SURVEY_C, "WEIGHT", "746012894"), (SURVEY_C, "EDU", "367803647"),
    (SURVEY_C, "MARITAL", "783167257"), (SURVEY_C, "INCOME", "759004335"), (SURVEY_C, "EVER", "712653855"), (SURVEY_C, "LIFETIME", "763164658"),
    (SURVEY_C, "NOWSMOKE", "639684251"), (SURVEY_C, "LASTSMOKE", "798549704"),
]


_flows: dict[tuple, dict[str, str]] = {}


def flow(spark: SparkSession, sf_dir: str) -> Flow:
    """Rules and jumps of the three modules, resolved once for a state of the dictionary and stored."""
    key = id(spark), *(_state(spark, f"{sf_dir}/{name}.parquet") for name in ("nation", "region"))
    known = _flows.get(key)
    if known is None or any(_state(spark, path) is None for path in known.values()):
        resolved = _resolved(spark, sf_dir)
        known = {part: scratch_path(spark, part) for part in ("axis", "gates", "jumps", "unresolved")}
        for part, path in known.items():
            store(getattr(resolved, part), path)
        _flows[key] = known
    return Flow(**{part: spark.read.parquet(path) for part, path in known.items()})


def _resolved(spark: SparkSession, sf_dir: str) -> Flow:
    """The same from the lines of the questionnaires, numbered as ``read_markup`` does."""
    said = [(name, i, line) for name, text in sorted(QUESTIONNAIRES.items()) for i, line in enumerate(text.split("\n"), 1)]
    numbered = [(name, no, at, line) for at, (name, no, line) in enumerate(said, 1)]
    lines = rows(spark, "questionnaire string, line_no bigint, line_id bigint, line string", numbered)
    surveys = rows(
        spark, "questionnaire string, secondary_source_concept_id string",
        [("module_a", SURVEY_A), ("module_b", SURVEY_B), ("module_c", SURVEY_C)],
    )
    names = rows(spark, "secondary_source_concept_id string, name string, question_concept_id string", QUESTION_NAMES)
    labels = star(spark, sf_dir)
    return resolve(lines, skip_rules(lines), surveys, names, response_codes(labels.question_response, labels.response))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questionnaire prompts that repeat, decorate or change the dictionary's wording."""
    text = F.col("p_name")
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("prompt_id"),
        F.when(k % 5 == 0, text)
        .when(k % 5 == 1, F.concat(F.lit("<b>"), text, F.lit("</b>?")))
        .when(k % 5 == 2, F.concat(text, F.lit(" |__|__|min=40 max=70|")))
        .when(k % 5 == 3, F.concat(F.lit("You are {$u:age}. "), text))
        .otherwise(F.concat(text, F.lit(" |displayif=equals(SEX,1)|he|")))
        .alias("prompt"),
    )


def prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary's wording of the prompts."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("question_text"))
