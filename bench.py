"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then $BENCH_RUNS times; the median counts. With BENCH_NESTED=1 the nested-loop form
of three questions is timed too.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, Window, functions as F

from epigrid.functions.geo import dist_deg
from epigrid.plans.catalogue import Inputs, queries
from epigrid.session import local_session, tune

HEADLINE = (
    "q02_cases_near_schools",
    "q04_nearest_hospital",
    "q05_hospital_case_load",
    "q15_risk_zones",
    "q19_cell_heatmap",
    "q24_cells_in_red_zones",
)


def nested_forms(t: Inputs) -> dict[str, DataFrame]:
    """The same questions with the join condition written down and left to a nested loop."""
    cases = t.cases.withColumnsRenamed({"lon": "x", "lat": "y"})
    away = dist_deg("lon", "lat", "x", "y")

    def load(facilities: DataFrame, metres: float) -> DataFrame:
        return facilities.join(cases, away <= F.lit(metres / 111000.0)).groupBy("name").agg(F.count(F.lit(1)))

    ranked = cases.crossJoin(F.broadcast(t.hospitals)).withColumn(
        "rn", F.row_number().over(Window.partitionBy("case_id").orderBy(away, "id"))
    )
    return {
        "q02_cases_near_schools": load(t.schools, 1000.0),
        "q04_nearest_hospital": ranked.filter("rn = 1"),
        "q05_hospital_case_load": load(t.hospitals, 5000.0),
    }


def timed(make, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.time() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shared = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-")
    spark = tune(local_session(cpus, shuffle_partitions=8, app="bench", settings={"spark.checkpoint.dir": shared}))
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {name: timed(lambda: known[name](spark, folder), runs) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_NESTED") == "1":
        inputs = Inputs(spark, folder)
        result["nested_loop"] = {
            name: timed(lambda: nested_forms(inputs)[name], 1) for name in nested_forms(inputs)
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
