"""Times the headline queries on $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from perron import build_session
from perron.plans.catalog import INPUTS, QUERIES, landed

HEADLINE = [
    "avg_daily_delay",
    "overall_avg_delay",
    "avg_daily_delay_all_stations",
    "peak_hours_report",
    "join_planned_changes",
    "latest_change",
    "left_latest_change",
    "xml_timetable_scan",
    "xml_change_scan",
    "archive_member_scan",
    "distinct_trains",
    "station_fuzzy_match",
    "station_resolution",
    "nearest_station_batch",
    "movement_messages",
    "files_per_period",
    "fact_build",
    "avg_delay_per_station",
    "cancelled_in_period",
    "stream_xml_ingest",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "perron-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # not measured: the XML drops and tables that the queries read
    for name in INPUTS:
        landed(spark, sf_dir, name)
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
