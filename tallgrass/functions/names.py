"""Grammar of survey column names: concept path, loop pass, revision tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pieces of a column name.
CONCEPT_PIECE = r"[dD]_([0-9]{9})"
VERSION_PIECE = r"_[vV]([0-9]+)(?=_|$)"


def concept_ids(name: Column) -> Column:
    """All nine-digit ids that follow a ``d_``, in order of appearance."""
    return F.regexp_extract_all(name, F.lit(CONCEPT_PIECE), F.lit(1))


def version_tag(name: Column) -> Column:
    """First revision tag as ``_v<n>``; empty text when there is none."""
    number = F.regexp_extract(name, VERSION_PIECE, 1)
    return F.when(number == "", F.lit("")).otherwise(F.concat(F.lit("_v"), number))


def without_version(name: Column) -> Column:
    """The name with every revision tag removed."""
    return F.regexp_replace(name, VERSION_PIECE, "")


def _number(text: Column) -> Column:
    return text.try_cast("bigint")


def loop_clean(name: Column) -> Column:
    """Loop pass in the cleaned layer: one trailing ``_N`` of one or two digits."""
    return _number(F.regexp_extract(without_version(name), r"_([0-9]{1,2})$", 1))


def loop_flat(name: Column) -> Column:
    """Loop pass in the flat layer, where the number is written twice (``_N_N``).

    A doubled number right after the revision tag wins, then the first doubled number once the
    tag is gone, then the trailing number of a name that repeats a number with digits after it.
    """
    bare = without_version(name)
    after_tag = F.regexp_extract(name, r"(?i)_v[0-9]+_([0-9]+)_\1(?![0-9])", 1)
    doubled = F.regexp_extract(bare, r"_([0-9]+)_\1(?![0-9])", 1)
    trailing = F.when(bare.rlike(r"_([0-9]+)_\1"), F.regexp_extract(bare, r"_([0-9]+)$", 1))
    return F.coalesce(_number(after_tag), _number(doubled), _number(trailing))


def odd_tokens(name: Column) -> Column:
    """Pieces of the name that are no ``d``, loop number, concept id or revision tag."""

    def is_odd(piece: Column) -> Column:
        known = (
            (F.upper(piece) == "D")
            | piece.rlike(r"^([0-9]{1,2}|[0-9]{9})$")
            | piece.rlike(r"^[vV][0-9]+$")
        )
        return (piece != "") & ~known

    pieces = F.transform(F.split(name, "_"), lambda piece: F.trim(piece))
    return F.filter(pieces, is_odd)


def base_table(table: Column) -> Column:
    """Table name without a trailing revision."""
    return F.regexp_replace(table, r"_[vV][0-9]+$", "")
