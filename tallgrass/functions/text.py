"""Typing, identity and normalisation of raw answer text.

The patterns end in ``\\z``: a Java ``$`` would also match before a trailing newline.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The shapes that decide which typed column an answer lands in.
CONCEPT_SHAPE = r"^[0-9]{9}\z"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
NUMBER_SHAPE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\z"

# Fixed value: first id above the range reserved for published vocabularies.
ID_BASE = 2_000_000_001


def concept_value(value: Column) -> Column:
    """The value itself when it is exactly nine digits, else NULL."""
    return F.when(value.rlike(CONCEPT_SHAPE), value)


def date_value(value: Column) -> Column:
    """A DATE when the text has the ISO shape and names a real day.

    The shape test comes first because Spark also reads ``2023-05`` as a date.
    """
    return F.when(value.rlike(DATE_SHAPE), value.try_cast("date"))


def strict_number(value: Column) -> Column:
    """A DOUBLE when the text, without outer blanks, is a plain decimal number.

    A bare cast would also take ``12d`` and words such as ``NaN``; those stay text.
    """
    bare = F.trim(value)
    return F.when(bare.rlike(NUMBER_SHAPE), bare.try_cast("double"))


def number_value(value: Column) -> Column:
    """The number, unless the text has the concept shape.

    No date-shaped text is a plain number, so a date that names no real day is NULL in every typed
    column.
    """
    return F.when(~value.rlike(CONCEPT_SHAPE), strict_number(value))


def response_unique_id(
    survey: Column, source_question: Column, question: Column, value: Column
) -> Column:
    """Stable 64-bit id: the first 60 bits of SHA-256 over the four parts, lifted above the base.

    NULL counts as the empty string, so both spellings of "no parent" give the same id.
    """
    parts = [F.coalesce(part, F.lit("")) for part in (survey, source_question, question, value)]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") + F.lit(ID_BASE)


COMPOSED_AT_ONCE = 64  # texts of a batch that are Python strings at one time


@F.arrow_udf(T.StringType())
def _compose(text: pa.Array) -> pa.Array:
    """A whole batch of texts as Python strings would take many times the room of its bytes."""
    parts = [pa.array([], text.type)]
    for at in range(0, len(text), COMPOSED_AT_ONCE):
        some = text.slice(at, COMPOSED_AT_ONCE).to_pylist()
        parts.append(pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in some], text.type))
    return pa.concat_arrays(parts)


def normalize_text(value: Column) -> Column:
    """Trim, compose to NFC, collapse white space, lower case.

    Spark has no NFC function. Plain ASCII text is already composed, so it is sent to Python as
    NULL and only the rest pays for the transfer.
    """
    bare = F.trim(value)
    composed = _compose(F.when(bare.rlike(r"[^\x00-\x7F]"), bare))
    return F.lower(F.regexp_replace(F.coalesce(composed, bare), r"\s+", " "))


def plain_words(value: Column) -> Column:
    """Text reduced to lower-case words: no markup tags, no punctuation, single spaces."""
    no_tags = F.regexp_replace(F.lower(value), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(no_tags, r"[^a-z0-9]+", " "))


def blank_to_null(value: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(value, F.lit(""))
