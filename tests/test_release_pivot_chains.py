"""Pivot over all questions, reconciliation, generalised release, successor chains and batches of columns."""

import collections
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import analytics, governance, marts, reshape, versions
from tallgrass.plans import inputs
from tests.conftest import SF_DIR

LONG = "connect_id string, question_concept_id string, answer string"


def test_pivot_keeps_smallest_answers_and_all_participants(spark):
    rnd = random.Random(3)
    codes = [str(c) for c in range(150)]
    rows = [(f"p{rnd.randint(0, 30)}", str(rnd.randint(0, 170)), rnd.choice(["b", "a", "c", None])) for _ in range(900)] + [("only", "999", "x"), (None, "5", "y")]
    got = {r.connect_id: r for r in analytics.pivot_all(spark.createDataFrame(rows, LONG), codes).collect()}
    want = collections.defaultdict(dict)
    for p, q, v in rows:
        mine = want[p]
        if q in codes and v is not None:
            mine[q] = min(v, mine.get(q, v))
    assert set(got) == set(want)
    assert all([got[p][f"q_{c}"] for c in codes] == [want[p].get(c) for c in codes] for p in want)
    assert analytics.pivot_all(spark.createDataFrame(rows, LONG), []).columns == ["connect_id"]


def test_two_thousand_columns_plan_fast_with_one_exchange_on_the_participant(spark, plan_of):
    rows = [("p1", str(c), "v") for c in range(0, 2000, 7)]
    start = time.perf_counter()
    wide = analytics.pivot_all(spark.createDataFrame(rows, LONG), [str(c) for c in range(2000)])
    plan = plan_of(wide)
    assert time.perf_counter() - start < 5
    assert len(wide.columns) == 2001 and plan.count("hashpartitioning(connect_id") <= 2  # the plan names it in tree and list
    assert wide.first()["q_7"] == "v" and wide.first()["q_8"] is None


MART = "connect_id string, a string, b double"


def test_surplus_rows_count_duplicates_and_nulls(spark):
    mart = [("1", "x", 1.0), ("1", "x", 1.0), ("1", "x", 1.0), ("2", None, None), ("3", "y", 2.0), (None, None, None)]
    other = [("1", "x", 1.0), ("2", None, None), ("3", "y", 2.5), ("4", "z", 1.0), ("4", "z", 1.0), (None, None, None)]
    own, expected = spark.createDataFrame(mart, MART), spark.createDataFrame([(b, c, a) for a, b, c in other], "a string, b double, connect_id string")
    got = {tuple(r) for r in marts.reconcile_rows(own, expected).collect()}
    assert got == {("1", "x", 1.0, "mart_only", 2), ("3", "y", 2.0, "mart_only", 1), ("3", "y", 2.5, "expected_only", 1), ("4", "z", 1.0, "expected_only", 2)}
    assert marts.reconcile_rows(own, own).count() == 0
    columns = {r.column: tuple(r)[1:] for r in marts.reconcile_columns(own, expected, ["connect_id"]).collect()}
    assert columns == {"a": (4, 0, 2, 2), "b": (4, 1, 2, 2)}


def test_reconciliation_reads_each_side_once_and_adds_up_before_the_exchange(spark, plan_of, tmp_path):
    spark.createDataFrame([("1", "x", 1.0)], MART).write.parquet(str(tmp_path / "m"))
    mart = spark.read.parquet(str(tmp_path / "m"))
    tree = plan_of(marts.reconcile_rows(mart, mart.withColumn("b", F.col("b") + 1))).split("(1) Scan")[0]
    assert tree.count("Scan parquet") == 2 and tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2


def hierarchies():
    return {
        "age": [F.col("age"), F.floor(F.col("age") / 10) * 10, F.lit("*")],
        "place": [F.col("place"), F.substring("place", 1, 1), F.lit("*")],
    }


def forms(age, place):
    told = "unknown"
    return [told if age is None else str(age), told if age is None else str(age // 10 * 10), "*"], [told if place is None else place, told if place is None else place[0], "*"]


@pytest.mark.parametrize("least", [1, 3, 8, 40, 500])
def test_the_finest_levels_that_hide_everyone(spark, least):
    rnd = random.Random(7)
    people = [(str(i), rnd.choice([None, *range(30, 60)]) if i % 9 else 31, rnd.choice(["a1", "a2", "b1", None])) for i in range(300)]
    df = spark.createDataFrame(people, "connect_id string, age bigint, place string")
    sizes = {}
    for choice in itertools.product(range(3), range(3)):
        sizes[choice] = collections.Counter(tuple(f[level] for f, level in zip(forms(a, p), choice, strict=True)) for _, a, p in people)
    got = {(r.age, r.place): (r.cells, r.smallest) for r in governance.level_sizes(df, hierarchies()).collect()}
    assert got == {c: (len(n), min(n.values())) for c, n in sizes.items()}
    fit = sorted((sum(c), c) for c, n in sizes.items() if min(n.values()) >= least)
    levels = governance.finest_levels(df, hierarchies(), least)
    released = {(r.age, r.place): r.participants for r in governance.generalised_release(df, hierarchies(), least).collect()}
    if not fit:
        assert levels is None and released == {}
    else:
        assert (levels["age"], levels["place"]) == fit[0][1]
        assert released == dict(sizes[fit[0][1]]) and min(released.values()) >= least


def test_chains_and_circles(spark):
    pairs = {f"c{i}": f"c{i + 1}" for i in range(40)} | {"x1": "x2", "x2": "x3", "x3": "x1", "into": "x2", "self": "self", "lost": "nowhere", "c7b": "c8"}
    names = sorted({*pairs, "c40", "free"})
    rows = [(n, "Deprecated" if n in pairs else None, pairs.get(n)) for n in names] + [("kept", "Revised", "c1")]
    question = spark.createDataFrame(rows, "question_concept_id string, status string, successor_concept_id string")
    got = {r.question_concept_id: (r.current_question_cid, r.hops, r.in_cycle) for r in versions.successor_chains(question).collect()}
    want = {n: (n, 0, False) for n in (*names, "kept")}
    want |= {f"c{i}": ("c40", 40 - i, False) for i in range(40)} | {"c7b": ("c40", 33, False)}
    want |= {n: (n, None, True) for n in ("x1", "x2", "x3", "into", "self")}
    assert got == want
    assert versions.successor_chains(question.limit(0)).count() == 0


@pytest.mark.parametrize("batch", [1, 3, 4, 50])
def test_batches_scan_once_and_give_the_same_cells(spark, plan_of, tmp_path, batch):
    rnd = random.Random(1)
    columns = [f"d_{i}" for i in range(13)]
    rows = [(str(i), *[rnd.choice([None, "", str(rnd.randint(0, 9))]) for _ in columns]) for i in range(50)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("connect_id", *columns))).write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w"))
    cells = reshape.melt(wide, columns, batch=batch)
    assert {tuple(r) for r in cells.collect()} == {(r[0], c, v) for r in rows for c, v in zip(columns, r[1:], strict=True) if v is not None}
    assert cells.count() == reshape.melt(wide, columns).count()
    assert plan_of(cells).split("(1) Scan")[0].count("Scan parquet") == 1


def test_no_task_melts_a_whole_wide_table(spark, monkeypatch, as_set):
    columns = ("connect_id", "source_table", "source_column", "response_value_as_string")
    whole = as_set(inputs.fact(spark, SF_DIR), *columns)
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 30)
    spread = inputs.fact(spark, SF_DIR)
    assert as_set(spread, *columns) == whole
    per_task = spread.groupBy(F.spark_partition_id().alias("task"), "source_table").agg(F.count_distinct("connect_id").alias("n"))
    assert max(r.n for r in per_task.collect()) <= 60


def test_circles_cost_no_rounds(spark, monkeypatch):
    stored = []
    store = versions.store
    monkeypatch.setattr(versions, "store", lambda df, path: stored.append(path) or store(df, path))
    edges = [(f"c{i}", f"c{i - i % 3 + (i + 1) % 3}") for i in range(180)] + [(f"l{i}", f"l{i + 1}") for i in range(5)]
    question = spark.createDataFrame([*[(a, "Deprecated", b) for a, b in edges], ("l5", None, None)], "question_concept_id string, status string, successor_concept_id string")
    got = {r.question_concept_id: (r.current_question_cid, r.hops, r.in_cycle) for r in versions.successor_chains(question).collect()}
    assert {q: got[q] for q in got if q[0] == "l"} == {f"l{i}": ("l5", 5 - i, False) for i in range(6)}
    assert all(got[f"c{i}"] == (f"c{i}", None, True) for i in range(180))
    assert len(stored) == 6  # edges, pointers and four rounds
