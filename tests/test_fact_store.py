"""The clustered store: reloads, an emptied source, a crash between stage and swap, and pruning by the catalogue."""

import pytest
from pyspark.sql import functions as F

from tallgrass.plans import inputs
from tallgrass.sources import fact_store, writers
from tests.conftest import SF_DIR

MODULES = ("module_a", "module_b", "module_c")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return writers.store(inputs.fact(spark, SF_DIR), str(tmp_path_factory.mktemp("fact") / "f"))


@pytest.fixture
def path(spark, stored, tmp_path):
    place = str(tmp_path / "store")
    for name in MODULES:
        fact_store.replace_source(stored.where(F.col("source_table") == f"clean.{name}"), place, f"clean.{name}", files=5)
    return place


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def counts(df):
    return {r.source_table: r.n for r in df.groupBy("source_table").agg(F.count("*").alias("n")).collect()}


def test_all_rows_come_back(spark, stored, path):
    got = fact_store.read(spark, path)
    assert sorted(got.columns) == sorted(stored.columns)
    assert rows(got) == rows(stored)


def test_a_reload_replaces_one_source(spark, stored, path):
    before = counts(fact_store.read(spark, path))
    short = stored.where("source_table = 'clean.module_a' AND connect_id < '3'")
    for _ in range(2):
        fact_store.replace_source(short, path, "clean.module_a", files=3)
    assert counts(fact_store.read(spark, path)) == {**before, "clean.module_a": short.count()}


def test_an_emptied_source_loses_its_rows(spark, stored, path):
    before = counts(fact_store.read(spark, path))
    fact_store.replace_source(stored.limit(0), path, "clean.module_c")
    assert counts(fact_store.read(spark, path)) == {k: n for k, n in before.items() if k != "clean.module_c"}
    for name in MODULES[:2]:
        fact_store.replace_source(stored.limit(0), path, f"clean.{name}")
    with pytest.raises(FileNotFoundError):
        fact_store.read(spark, path)


def test_a_crash_between_stage_and_swap_changes_nothing(spark, stored, path):
    before = rows(fact_store.read(spark, path))
    fact_store.stage(stored.where("source_table = 'clean.module_b'").limit(3), path, "clean.module_b")
    assert rows(fact_store.read(spark, path)) == before
    # the next load works, and what the dead one left is swept
    fact_store.replace_source(stored.where("source_table = 'clean.module_b'"), path, "clean.module_b")
    assert rows(fact_store.read(spark, path)) == before
    assert len(fact_store.vacuum(spark, path)) == 2
    assert rows(fact_store.read(spark, path)) == before and fact_store.vacuum(spark, path) == []


def test_an_incomplete_catalogue_does_not_count(spark, stored, path):
    before = rows(fact_store.read(spark, path))
    versions = fact_store._versions(spark, path)
    fact_store.catalogue(spark, path).limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{path}/catalogue/v{versions[-1] + 1}"
    )
    assert rows(fact_store.read(spark, path)) == before
    fact_store.replace_source(stored.where("source_table = 'clean.module_b'"), path, "clean.module_b")
    assert rows(fact_store.read(spark, path)) == before


def test_ranges_of_a_source_do_not_overlap(spark, path):
    found = {r.source_table: r for r in fact_store.overlaps(fact_store.catalogue(spark, path)).collect()}
    assert set(found) == {f"clean.{m}" for m in MODULES}
    assert all(r.overlapping == 0 for r in found.values()) and max(r.files for r in found.values()) == 5
    twice = fact_store.catalogue(spark, path)
    again = twice.where("source_table = 'clean.module_a'").withColumn("file", F.concat("file", F.lit("x")))
    assert {r.overlapping for r in fact_store.overlaps(twice.unionByName(again)).collect()} == {0, 5}


def test_only_files_that_can_hold_a_key_are_opened(spark, stored, path):
    survey, question = inputs.SURVEY_A, inputs.SEGMENT
    wanted = {"secondary_source_concept_id": survey, "question_concept_id": question}
    got = fact_store.read(spark, path, wanted)
    assert rows(got) == rows(stored.where((F.col("secondary_source_concept_id") == survey) & (F.col("question_concept_id") == question)))
    assert len(got.inputFiles()) < len(fact_store.read(spark, path).inputFiles()) / 3
    one = fact_store.read(spark, path, {**wanted, "connect_id": "77"})
    assert one.count() == 1 and len(one.inputFiles()) == 1
    assert fact_store.read(spark, path, {"secondary_source_concept_id": "no such"}).count() == 0
    assert fact_store.read(spark, path, {"connect_id": "77"}).count() == stored.where("connect_id = '77'").count()
