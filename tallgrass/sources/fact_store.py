"""The answer table as a store that is clustered and whose sources are reloaded one by one.

Each load of a source is a folder of its own, range-partitioned and sorted by the cluster keys. A
catalogue names the load that counts for every source, with the key range of each of its files. A load
is staged first and takes effect when the next version of the catalogue is complete; until then, and if
the job dies in between, readers see the version before. One job at a time writes to a store.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.sources.writers import CLUSTER_KEYS

_CATALOGUE = "source_table string, load string, file string, n_rows bigint, low struct<{keys}>, high struct<{keys}>"


def _keys(names: Sequence[str]) -> str:
    return ", ".join(f"{k}: string" for k in names)


def _schema(keys: Sequence[str]) -> str:
    return _CATALOGUE.format(keys=_keys(keys))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the catalogue, rising."""
    folder, files = _folder(spark, f"{path}/catalogue")
    if not files.exists(folder):
        return []
    names = [s.getPath() for s in files.listStatus(folder)]
    done = [p.getName() for p in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.removeprefix("v")) for n in done if n.startswith("v"))


def catalogue(spark: SparkSession, path: str, keys: Sequence[str] = CLUSTER_KEYS) -> DataFrame:
    """``source_table, load, file, n_rows, low, high``: the files that count, with their key ranges."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], _schema(keys))
    return spark.read.schema(_schema(keys)).parquet(f"{path}/catalogue/v{versions[-1]}")


def stage(fact: DataFrame, path: str, source: str, keys: Sequence[str] = CLUSTER_KEYS, files: int | None = None) -> DataFrame:
    """Write one load of a source and return its catalogue rows; no reader sees it yet.

    Rows are ranged by the keys, so that no two files of the load overlap: equal keys are in one file,
    and a hot question spreads over files by participant. Ranges are found by sampling, which runs the
    input a second time, so pass a stored table rather than the plan of a load.
    """
    spark = fact.sparkSession
    load = uuid.uuid4().hex
    folder = f"{path}/data/source_table={source}/load={load}"
    ranged = fact.repartitionByRange(*keys) if files is None else fact.repartitionByRange(files, *keys)
    (
        ranged.sortWithinPartitions(*keys).drop("source_table")
        .write.option("parquet.bloom.filter.enabled#connect_id", "true").parquet(folder)
    )
    key = F.struct(*[F.col(k).cast("string").alias(k) for k in keys])
    written = spark.read.schema(fact.drop("source_table").schema).parquet(folder)
    return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high")
    ).select(F.lit(source).alias("source_table"), F.lit(load).alias("load"), "file", "n_rows", "low", "high")


def swap(spark: SparkSession, path: str, source: str, staged: DataFrame, keys: Sequence[str] = CLUSTER_KEYS) -> None:
    """Make a staged load the one that counts for its source; a load without rows empties the source."""
    versions = _versions(spark, path)
    others = catalogue(spark, path, keys).where(F.col("source_table") != source)
    after = others.unionByName(staged)
    after.coalesce(1).write.mode("overwrite").parquet(f"{path}/catalogue/v{versions[-1] + 1 if versions else 1}")


def replace_source(
    fact: DataFrame, path: str, source: str, keys: Sequence[str] = CLUSTER_KEYS, files: int | None = None
) -> None:
    """Replace all rows of one source table with ``fact``; the other sources stay as they are."""
    swap(fact.sparkSession, path, source, stage(fact, path, source, keys, files), keys)


def _within(low: Column, high: Column, wanted: dict[str, str], keys: Sequence[str]) -> Column:
    """Whether a file can hold rows of the wanted keys, by its range; later keys help while all earlier ones are given."""
    given = []
    for k in keys:
        if k not in wanted:
            break
        given.append(k)
    if not given:
        return F.lit(True)
    at = F.struct(*[F.lit(wanted[k]).alias(k) for k in given])

    def prefix(bound: Column) -> Column:
        return F.struct(*[bound[k].alias(k) for k in given])

    return (prefix(low) <= at) & (at <= prefix(high))


def read(
    spark: SparkSession, path: str, wanted: dict[str, str] | None = None, keys: Sequence[str] = CLUSTER_KEYS
) -> DataFrame:
    """The current rows of all sources.

    Without ``wanted`` the loads that count are read as folders. With ``wanted``, values of cluster keys, the
    catalogue tells which files can hold them, and only those are opened.
    """
    current = catalogue(spark, path, keys)
    if wanted:
        found = current.where(_within(F.col("low"), F.col("high"), wanted, keys)).select("file").collect()
        places = [r.file for r in found]
    else:
        loads = current.select("source_table", "load").distinct().collect()
        places = [f"{path}/data/source_table={r.source_table}/load={r.load}" for r in loads]
    if not places:
        some = current.select("source_table", "load").first()
        if some is None:
            raise FileNotFoundError(f"no rows in {path}")
        return read(spark, path, None, keys).limit(0)
    rows = spark.read.option("basePath", f"{path}/data").parquet(*places).drop("load")
    rows = rows.withColumn("source_table", F.col("source_table").cast("string"))
    for k, v in (wanted or {}).items():
        rows = rows.where(F.col(k) == v)
    return rows


def overlaps(files: DataFrame) -> DataFrame:
    """Per source: files, rows, and files that begin before another file of the source has ended."""
    order = Window.partitionBy("source_table").orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    seen = files.withColumn("before", F.max("high").over(order))
    return seen.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("n_rows"),
        F.count_if(F.col("low") <= F.col("before")).alias("overlapping"),
    )


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete loads that none of the last ``keep`` versions names, and older versions; returns the deleted folders.

    What is listed is one folder a load, which a store has few of.
    """
    versions = _versions(spark, path)[-keep:]
    if not versions:
        return []
    used = set()
    for v in versions:
        rows = spark.read.parquet(f"{path}/catalogue/v{v}").select("source_table", "load").distinct().collect()
        used |= {(r.source_table, r.load) for r in rows}
    gone = []
    root, files = _folder(spark, f"{path}/data")
    for source in files.listStatus(root) if files.exists(root) else []:
        for load in files.listStatus(source.getPath()):
            name = source.getPath().getName().removeprefix("source_table="), load.getPath().getName().removeprefix("load=")
            if name not in used:
                gone.append(load.getPath().toString())
                files.delete(load.getPath(), True)
    root, files = _folder(spark, f"{path}/catalogue")
    for version in files.listStatus(root):
        if version.getPath().getName() not in {f"v{v}" for v in versions}:
            files.delete(version.getPath(), True)
    return gone
