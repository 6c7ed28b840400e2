"""Wide survey tables to the long answer table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.functions import text
from tallgrass.schema import FACT, NO, YES


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cells(
    wide: DataFrame, id_column: str, columns: Sequence[str], strategy: str, batch: int | None = None
) -> DataFrame:
    """``(id, position, value)`` for every non-null cell; row-local, nothing is shuffled.

    Built as one SQL expression: a column object per cell would make wide plans slow to build. With ``batch``
    no expression holds more than that many cells: a row becomes one row per batch, each with the array of its
    cells, and those become cells, all in the one scan.
    """
    kinds = {f.name: f.dataType for f in wide.schema}

    def cell(column: str) -> str:
        name = _quoted(column)
        return name if isinstance(kinds[column], T.StringType) else f"CAST({name} AS STRING)"

    if batch and batch < len(columns):
        parts = [
            f"named_struct('first', {i}, 'cells', array({', '.join(cell(c) for c in columns[i : i + batch])}))"
            for i in range(0, len(columns), batch)
        ]
        rows = wide.selectExpr(f"{_quoted(id_column)} AS connect_id", f"inline(array({', '.join(parts)}))")
        cells = rows.selectExpr("connect_id", "first", "posexplode(cells) AS (place, value)")
        return cells.where("value IS NOT NULL").selectExpr("connect_id", "first + place AS position", "value")
    if strategy == "stack":
        pairs = ", ".join(f"{i}, {cell(c)}" for i, c in enumerate(columns))
        return wide.selectExpr(
            f"{_quoted(id_column)} AS connect_id",
            f"stack({len(columns)}, {pairs}) AS (position, value)",
        ).where("value IS NOT NULL")
    if strategy == "array":
        answered = (
            f"filter(transform(array({', '.join(cell(c) for c in columns)}),"
            " (v, i) -> named_struct('position', i, 'value', v)), c -> c.value IS NOT NULL)"
        )
        return wide.selectExpr(f"{_quoted(id_column)} AS connect_id", f"inline({answered})")
    raise ValueError(f"unknown strategy {strategy!r}")


def _pick(values: Sequence[str | int | None], kind: str) -> Column:
    """The entry of a constant list at the cell's position."""

    def literal(value: str | int | None) -> str:
        if value is None:
            return "NULL"
        return str(value) if kind == "bigint" else "'" + str(value).replace("'", "\\'") + "'"

    constants = ", ".join(literal(v) for v in values)
    return F.expr(f"element_at(cast(array({constants}) AS array<{kind}>), position + 1)")


def melt(
    wide: DataFrame, columns: Sequence[str], id_column: str = "connect_id", strategy: str = "stack",
    batch: int | None = None,
) -> DataFrame:
    """``(connect_id, source_column, value)``, one row per non-null cell. Blank text is kept.

    Both strategies give the same rows; ``bench.py`` times them. ``DataFrame.unpivot`` is not used:
    it keeps NULL cells, so a sparse wide table would be expanded in full before the filter.
    """
    return _cells(wide, id_column, columns, strategy, batch).select(
        "connect_id", _pick(list(columns), "string").alias("source_column"), "value"
    )


def mapped_columns(wide: DataFrame, placed: Sequence[Row]) -> tuple[list[str], int]:
    """Mapped columns present in the wide table, sorted, and how many mapped columns are absent.

    Names are compared exactly: Spark resolves columns without regard to case, the mapping does not.
    """
    mapped = {p.source_column for p in placed}
    present = sorted(mapped & set(wide.columns))
    return present, len(mapped) - len(present)


def placements(colmap: DataFrame, tables: Mapping[str, DataFrame]) -> dict[str, list[Row]]:
    """The mapping rows of each wide table that name one of its columns.

    This is plan-time metadata: the result is bounded by the widths of the wide tables.
    """
    names = sorted({c for wide in tables.values() for c in wide.columns})
    rows = (
        colmap.where(F.col("table_name").isin(*tables) & F.col("source_column").isin(*names))
        .select(
            "table_name",
            "source_column",
            "secondary_source_concept_id",
            "source_question_concept_id",
            "question_concept_id",
            "loop_instance",
            "question_version",
        )
        .collect()
    )
    found: dict[str, list[Row]] = {name: [] for name in tables}
    for row in sorted(rows, key=lambda r: r.source_column):
        if row.source_column in tables[row.table_name].columns:
            found[row.table_name].append(row)
    return found


def place_cells(cells: DataFrame, colmap: DataFrame, table: str) -> DataFrame:
    """Inner join of melted cells with the mapping of their table; unmapped cells vanish."""
    mapping = colmap.where(F.col("table_name") == table).drop("table_name")
    return cells.join(mapping, "source_column")


def type_values(cells: DataFrame, value: str = "value") -> DataFrame:
    """Add the verbatim text and the three typed columns; at most one of the three is set."""
    cell = F.col(value)
    return cells.select(
        "*",
        cell.alias("response_value_as_string"),
        text.concept_value(cell).alias("response_value_as_concept_id"),
        text.date_value(cell).alias("response_value_as_date"),
        text.number_value(cell).alias("response_value_as_number"),
    ).drop(value)


def _as_fact(placed: DataFrame, source_table: str) -> DataFrame:
    """Typed values, the stable id and provenance, in the contract's column order."""
    full = type_values(placed).withColumn(
        "response_unique_id",
        text.response_unique_id(
            F.col("secondary_source_concept_id"),
            F.col("source_question_concept_id"),
            F.col("question_concept_id"),
            F.col("response_value_as_string"),
        ),
    )
    return full.withColumn("source_table", F.lit(source_table)).select(*FACT.fieldNames())


def load_survey(
    wide: DataFrame,
    placed: Sequence[Row],
    table: str,
    layer: str = "clean",
    id_column: str = "connect_id",
    questions: Sequence[str] | None = None,
    strategy: str = "stack",
    batch: int | None = None,
) -> DataFrame:
    """One wide survey as rows of the answer table.

    The placement of each column is known when the plan is built, so it enters as constant lists
    looked up by cell position: the load has no join and no shuffle. With ``questions`` only the
    columns that hold those questions are read at all. A column mapped twice gives two rows per
    cell, as a join would. ``batch`` limits the columns in one expression, should one plan be too wide; the
    table is still scanned once.
    """
    chosen = _chosen(wide, placed, questions)
    if not chosen:
        return wide.sparkSession.createDataFrame([], FACT)
    cells = _cells(wide, id_column, [p.source_column for p in chosen], strategy, batch)
    described = cells.select(
        "connect_id",
        *[
            _pick([getattr(p, name) for p in chosen], kind).alias(name)
            for name, kind in (
                ("source_column", "string"),
                ("secondary_source_concept_id", "string"),
                ("source_question_concept_id", "string"),
                ("question_concept_id", "string"),
                ("loop_instance", "bigint"),
                ("question_version", "string"),
            )
        ],
        "value",
    )
    return _as_fact(described, f"{layer}.{table}")


def _chosen(
    wide: DataFrame, placed: Sequence[Row], questions: Sequence[str] | None
) -> list[Row]:
    return [
        p
        for p in placed
        if p.source_column in wide.columns
        and (questions is None or p.question_concept_id in questions)
    ]


def load_surveys(
    tables: Mapping[str, DataFrame],
    colmap: DataFrame,
    layer: str = "clean",
    questions: Sequence[str] | None = None,
) -> DataFrame:
    """Several wide surveys in one answer table. Versions of a column pool on the same question.

    A survey without any of the wanted questions is not read.
    """
    placed = placements(colmap, tables)
    loads = [
        load_survey(wide, placed[name], name, layer, questions=questions)
        for name, wide in tables.items()
        if _chosen(wide, placed[name], questions)
    ]
    if not loads:
        return colmap.sparkSession.createDataFrame([], FACT)
    return reduce(DataFrame.unionByName, loads)


def untyped_audit(fact: DataFrame, k: int = 50) -> DataFrame:
    """The most frequent texts that no typed column took."""
    typed = ("response_value_as_number", "response_value_as_concept_id", "response_value_as_date")
    untyped = F.col("response_value_as_string").isNotNull()
    for name in typed:
        untyped = untyped & F.col(name).isNull()
    return (
        fact.where(untyped)
        .groupBy("response_value_as_string")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "response_value_as_string")
        .limit(k)
    )


def flatten_struct(df: DataFrame) -> DataFrame:
    """Struct leaves as columns named by their path; arrays and scalars stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out.extend(leaves(field.dataType, here))
            else:
                out.append(F.col(".".join(_quoted(p) for p in here)).alias("_".join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def array_indicators(df: DataFrame, column: str, options: Sequence[str], prefix: str = "D_") -> DataFrame:
    """One text indicator per option of a select-all array: ``1`` when chosen, ``0`` when not.

    The source only says that arrays become binary columns; a NULL array gives NULL indicators,
    because a question that was not answered is not a row of zeros.
    """
    marks = [
        F.when(F.array_contains(column, option), "1")
        .when(F.col(column).isNotNull(), "0")
        .alias(f"{column}_{prefix}{option}")
        for option in options
    ]
    return df.select(*[c for c in df.columns if c != column], *marks)


def array_options(df: DataFrame, column: str) -> DataFrame:
    """The members seen in a select-all array column."""
    return (
        df.select(F.explode(column).alias("option")).where("option IS NOT NULL").distinct()
    )


def indicators_to_concepts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0/1 indicators as No/Yes concept ids; any other value is kept."""
    return df.withColumns(
        {
            c: F.when(F.col(c) == "1", YES).when(F.col(c) == "0", NO).otherwise(F.col(c))
            for c in columns
        }
    )


def merge_versions(versions: Sequence[DataFrame], id_column: str = "connect_id") -> DataFrame:
    """Revisions of one survey table as one table; the newest revision that has a value wins per cell.

    ``versions`` are in revision order, each with one row per participant. The source only says the
    revisions are merged; taking the newest value per cell is our rule.
    """

    def merge(older: DataFrame, newer: DataFrame) -> DataFrame:
        old, new = older.alias("old"), newer.alias("new")
        joined = old.join(new, F.col(f"old.{id_column}") == F.col(f"new.{id_column}"), "full")
        names = [*older.columns, *[c for c in newer.columns if c not in older.columns]]

        def cell(name: str) -> Column:
            sources = [
                F.col(f"{side}.{_quoted(name)}")
                for side, frame in (("new", newer), ("old", older))
                if name in frame.columns
            ]
            return F.coalesce(*sources).alias(name)

        return joined.select(*[cell(name) for name in names])

    return reduce(merge, versions)
