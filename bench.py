"""Headline queries on the given tables; prints one JSON line.

``BENCH_SF_DIR`` picks the data, ``BENCH_CPUS`` the cores, ``BENCH_REPEAT`` the timed runs after one
warm-up (the fastest counts). Every query is run to the last row into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.operators import analytics, marts, reshape, views
from tallgrass.plans import catalog, inputs
from tallgrass.plans.session import local_session, scratch_path
from tallgrass.sources import readers, writers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
HEADLINE = (
    "load_fact",
    "distribution",
    "distribution_by_survey",
    "responses_enriched",
    "source_codes",
    "source_codes_text",
    "mart_demographics",
    "mart_anthropometry",
    "mart_smoking",
    "agg_distribution",
    "v_data_dictionary",
    "review_worklist",
    "pooled_successor",
    "response_sessions",
    "missingness",
    "skip_rules",
    "release_core",
    "suppressed_counts",
    "quality_rules",
    "fact_volume",
)


def drain(df: DataFrame) -> None:
    """Compute every row and column, keep none."""
    df.write.format("noop").mode("overwrite").save()


def timed(build: Callable[[], DataFrame]) -> float:
    """Fastest seconds of plan building plus run, after one warm-up."""
    drain(build())
    runs = []
    for _ in range(REPEAT):
        start = time.perf_counter()
        drain(build())
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    queries: dict[str, float] = {}
    for name in HEADLINE:
        queries[name] = timed(lambda n=name: catalog.QUERIES[n](spark, SF_DIR))

    # the stored answer table, clustered and in arrival order
    clustered, shadow = scratch_path(spark, "clustered"), scratch_path(spark, "shadow")
    start = time.perf_counter()
    writers.write_shadow(inputs.fact(spark, SF_DIR), shadow)
    queries["write_shadow"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    writers.write_clustered(readers.read_fact(spark, shadow), clustered)
    queries["write_clustered"] = round(time.perf_counter() - start, 3)
    shapes: dict[str, Callable[[DataFrame], DataFrame]] = {
        "shape_a": lambda f: analytics.shape_a(f, inputs.SURVEY_A),
        "shape_b": lambda f: analytics.shape_b(f, inputs.SURVEY_A, inputs.SEGMENT),
        "shape_c": lambda f: analytics.shape_c(f, inputs.LANGUAGE),
        "shape_d": lambda f: analytics.shape_d(f, "77"),
        "shape_e": analytics.shape_e,
    }
    for variant, path in (("clustered", clustered), ("shadow", shadow)):
        for name, shape in shapes.items():
            queries[f"{name}_{variant}"] = timed(
                lambda p=path, s=shape: s(readers.read_fact(spark, p))
            )
    stored = readers.read_fact(spark, clustered)
    star = inputs.star(spark, SF_DIR)
    queries["stored_enriched_all_joins"] = timed(lambda: views.responses_enriched(stored, star))
    queries["stored_enriched_needed_joins"] = timed(
        lambda: views.responses_enriched(stored, star, ["connect_id", "survey", "response_label"])
    )
    queries["stored_three_marts"] = timed(
        lambda: marts.mart_demographics(stored, star.response)
        .join(marts.mart_anthropometry(stored), "connect_id")
        .join(marts.mart_smoking(stored, star.response), "connect_id")
    )
    queries["stored_one_pivot_for_three_marts"] = timed(
        lambda: marts.pivot_questions(
            stored, [*marts.DEMOGRAPHICS, *marts.ANTHROPOMETRY, *marts.SMOKING]
        )
    )

    # melt strategies on one wide numeric table
    items = inputs.table(spark, SF_DIR, "lineitem").withColumn(
        "connect_id", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    for strategy in ("stack", "array"):
        queries[f"melt_{strategy}"] = timed(
            lambda s=strategy: reshape.melt(items, measures, strategy=s)
        )
    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "survey queries, total",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()


if __name__ == "__main__":
    main()
