"""Table contracts and the fixed concept ids the rules refer to."""

from __future__ import annotations

from pyspark.sql import types as T

FACT = T.StructType(
    [
        T.StructField("connect_id", T.StringType()),
        T.StructField("secondary_source_concept_id", T.StringType()),
        T.StructField("source_question_concept_id", T.StringType()),
        T.StructField("question_concept_id", T.StringType()),
        T.StructField("loop_instance", T.LongType()),
        T.StructField("question_version", T.StringType()),
        T.StructField("response_value_as_string", T.StringType()),
        T.StructField("response_value_as_concept_id", T.StringType()),
        T.StructField("response_value_as_date", T.DateType()),
        T.StructField("response_value_as_number", T.DoubleType()),
        T.StructField("response_unique_id", T.LongType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("source_column", T.StringType()),
    ]
)

# Columns of the column-to-dictionary mapping, all text as written by the mapping job.
MAPPING = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "layer",
            "table",
            "column",
            "n_concepts",
            "concept_ids",
            "loop_number",
            "version_tag",
            "nonconforming_tokens",
            "primary_source_concept_id",
            "secondary_source_concept_id",
            "source_question_concept_id",
            "question_concept_id",
            "response_concept_id",
            "leaf_role",
            "question_in_dict",
            "secondary_source_match",
        )
    ]
)

# Positions in the flat dictionary file (0-based) and the names we give them.
DICTIONARY_POSITIONS = {
    2: "prim_cid",
    3: "prim",
    4: "sec_cid",
    5: "sec",
    6: "sq_cid",
    7: "sq_text",
    10: "grid_name",
    13: "q_cid",
    14: "q_text",
    22: "resp_cid",
    23: "resp_fmt",
    35: "q_type",
}
DICTIONARY_WIDTH = 37

# Answer and status concept ids that rules test for.
YES = "353358909"
NO = "104430631"
STATUS_NOT_STARTED = "972455046"
STATUS_STARTED = "615768760"
STATUS_SUBMITTED = "231311385"
STATUS_CODES = {STATUS_NOT_STARTED: 0, STATUS_STARTED: 1, STATUS_SUBMITTED: 2}

# Tables that sit beside the surveys but are not surveys.
NON_SURVEY_TABLES = ("participants", "biospecimen")
