import datetime
import hashlib
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallgrass.functions import text
from tallgrass.operators.reshape import type_values

CASES = {
    "353358909": ("concept", "353358909"),
    "35335890": ("number", 35335890.0),
    "3533589090": ("number", 3533589090.0),
    "2024-02-29": ("date", datetime.date(2024, 2, 29)),
    "2024-02-30": (None, None),
    "2023-05": (None, None),
    "2024-02-29\n": (None, None),
    "353358909\n": (None, None),
    "12d": (None, None),
    "1_000": (None, None),
    "1,5": (None, None),
    "NaN": (None, None),
    "Infinity": (None, None),
    " 12 ": ("number", 12.0),
    "1e5": ("number", 100000.0),
    "-1": ("number", -1.0),
    "+.5": ("number", 0.5),
    "5.": ("number", 5.0),
    "1e": (None, None),
    "": (None, None),
    "some text | more": (None, None),
    "٣٥٣٣٥٨٩٠٩": (None, None),
}


def test_each_value_lands_in_at_most_one_typed_column(spark):
    df = type_values(spark.createDataFrame([(v,) for v in CASES], "value string"))
    for row in df.collect():
        got = {
            "concept": row.response_value_as_concept_id,
            "date": row.response_value_as_date,
            "number": row.response_value_as_number,
        }
        kind, value = CASES[row.response_value_as_string]
        expected = {k: (value if k == kind else None) for k in got}
        assert got == expected, row.response_value_as_string


def reference_id(*parts):
    joined = "|".join(p or "" for p in parts).encode("utf-8")
    return 2_000_000_001 + int(hashlib.sha256(joined).hexdigest()[:15], 16)


def test_id_equals_hashlib_and_treats_null_as_blank(spark):
    parts = [
        ("300000001", None, "100000001", "353358909"),
        ("300000001", "", "100000001", "353358909"),
        (None, None, None, None),
        ("1", "2", "3", "a | b"),
        ("1", "2", "3", "naïve ünïcode 漢字"),
    ]
    df = spark.createDataFrame(parts, "s string, p string, q string, v string")
    ids = [r[0] for r in df.select(text.response_unique_id(*[F.col(c) for c in "spqv"])).collect()]
    assert ids == [reference_id(*p) for p in parts]
    assert ids[0] == ids[1]
    assert all(2_000_000_000 < i < 2**63 for i in ids)


def test_normalised_text(spark):
    values = ["  Café  AU\tlait ", "PLAIN  text", "", None, "Ångström", "Ångström"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(text.normalize_text(F.col("v"))).collect()]
    assert got[0] == "café au lait"
    assert got[1:4] == ["plain text", "", None]
    assert got[4] == got[5] == "ångström"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=40))
def test_normalised_text_is_composed(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for row in df.select(text.normalize_text(F.col("v")).alias("n")).collect():
        assert unicodedata.normalize("NFC", row.n).lower() == row.n.lower()


@pytest.mark.parametrize(
    "raw, words",
    [("<b>What</b> is   your AGE?", "what is your age"), ("a-b<br/>c", "a b c"), ("", "")],
)
def test_plain_words(spark, raw, words):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(text.plain_words(F.col("v"))).first()[0] == words


def test_composing_a_batch_holds_few_strings():
    texts = pa.array(["é" * 2000, None, "plain"] * 1500)
    tracemalloc.start()
    composed = text._compose.func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert composed.to_pylist() == ["é" * 2000, None, "plain"] * 1500
    assert peak < 2**20
