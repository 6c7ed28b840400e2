"""Schemas as data: column paths, flat metadata rows, header repair, empty tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaf_struct(kind: T.DataType) -> T.StructType | None:
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind if isinstance(kind, T.StructType) else None


def column_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Leaf column names, nested names joined with an underscore."""
    names: list[str] = []
    for field in schema:
        inner = _leaf_struct(field.dataType)
        if inner is None:
            names.append(prefix + field.name)
        else:
            names.extend(column_paths(inner, f"{prefix}{field.name}_"))
    return names


def _describe(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, str, str, str]]:
    for field in schema:
        path = prefix + field.name
        repeated = isinstance(field.dataType, T.ArrayType)
        element = field.dataType.elementType if repeated else field.dataType
        inner = _leaf_struct(field.dataType)
        kind = "RECORD" if inner is not None else element.simpleString().upper()
        mode = "REPEATED" if repeated else ("NULLABLE" if field.nullable else "REQUIRED")
        comment = (field.metadata or {}).get("comment", "").replace("\n", " ").strip()
        yield path, kind, mode, comment
        if inner is not None:
            yield from _describe(inner, path + ".")


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per column and nested column: ``column, type, mode, description``."""
    return spark.createDataFrame(
        list(_describe(schema)), "column string, type string, mode string, description string"
    )


def _values(schema: T.StructType, reach: Column | None = None, prefix: str = "", repeated: bool = False) -> Iterator[tuple[str, Column]]:
    """How many values each column of a row holds, nested ones included; inside an array, over its entries."""

    def inside(name: str) -> Column:
        return F.transform(reach, lambda entry: entry[name]) if repeated else reach[name]

    for field in schema:
        here = F.col(f"`{field.name}`") if reach is None else inside(field.name)
        array = isinstance(field.dataType, T.ArrayType)
        held = F.size(F.array_compact(here)) if repeated else here.isNotNull().cast("int")
        yield prefix + field.name, F.greatest(F.coalesce(held, F.lit(0)), F.lit(0))
        inner = _leaf_struct(field.dataType)
        if inner is not None:
            below = F.flatten(here) if array and repeated else here
            yield from _values(inner, below, f"{prefix}{field.name}.", repeated or array)


def schema_profile(df: DataFrame) -> DataFrame:
    """:func:`schema_rows` with ``n_values``, how many non-null values each column holds; one pass, one aggregate."""
    counted = list(_values(df.schema))
    sums = df.agg(*[F.coalesce(F.sum(held), F.lit(0)).alias(f"__{i}") for i, (_, held) in enumerate(counted)])
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"__{i}").alias("n_values")) for i, (name, _) in enumerate(counted)])
    return schema_rows(df.sparkSession, df.schema).join(sums.select(F.inline(pairs)), "column")


def table_columns(spark: SparkSession, tables: dict[str, T.StructType]) -> DataFrame:
    """``table, column`` rows for several tables, ready for name parsing."""
    rows = [(table, name) for table, schema in sorted(tables.items()) for name in column_paths(schema)]
    return spark.createDataFrame(rows, "table string, column string")


def unique_headers(header: Iterable[str]) -> list[str]:
    """Repeated names get ``_2``, ``_3``…; blanks become ``column``."""
    counts: dict[str, int] = {}
    out = []
    for name in header:
        name = name or "column"
        counts[name] = counts.get(name, 0) + 1
        out.append(name if counts[name] == 1 else f"{name}_{counts[name]}")
    return out


def repair_headers(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Rename the columns by position with :func:`unique_headers`."""
    return df.toDF(*unique_headers(header))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The same table with column descriptions attached."""
    fields = []
    for field in df.schema:
        metadata = dict(field.metadata or {})
        if field.name in comments:
            metadata["comment"] = comments[field.name]
        fields.append(df[field.name].alias(field.name, metadata=metadata))
    return df.select(*fields)


def describe_table(spark: SparkSession, table: str, description: str, columns: dict[str, str] | None = None) -> None:
    """Write a description, and descriptions of columns, onto a table of the session's catalogue."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(description)}")
    for name, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}` COMMENT {quoted(text)}")


def descriptions(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """``table, column, description``: what the catalogue says about tables (``column`` is NULL) and their columns."""
    rows: list[tuple[str, str | None, str]] = []
    for table in tables:
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        rows.append((table, None, about.get("Comment", "")))
        rows += [(table, f.name, (f.metadata or {}).get("comment", "")) for f in spark.table(table).schema]
    return spark.createDataFrame(rows, "table string, column string, description string")
