"""Benchmark the headline queries; prints ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  Each query is executed in full into Spark's ``noop`` sink (no
rows travel to the driver); the time of each is the median of ``BENCH_REPS``
runs after one warm-up run.

``queries`` are the registered queries, end to end from the driver's tables
(the fixture view joins four tables, and each test table is a single Parquet
row group, so its scan is one task); ``message_outbox`` includes the daily
job's readiness checkpoint.  On a
shared VM the totals vary by 20 % or more between runs; compare runs made
back to back.  ``stored_ledger`` times the headline
operators again on the fixture ledger stored once with ``write_ledger`` (by
month, rebalanced files): the layout a production ledger would have.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerday.functions.dates import ledger_span  # noqa: E402
from ledgerday.operators import availability, sales, sales_multi  # noqa: E402
from ledgerday.registry import ITEMS, QUERIES  # noqa: E402
from ledgerday.session import get_session, scratch_path  # noqa: E402
from ledgerday.sources.fixtures import REPORT_DATE, fixture_ledger  # noqa: E402
from ledgerday.sources.ledger import read_ledger, write_ledger  # noqa: E402

HEADLINE = (
    "sales_report",
    "sales_report_multi",
    "report_readiness",
    "sales_report_text",
    "availability_alerts",
    "send_decisions",
    "message_outbox",
    "send_log_append",
    "ledger_normalised",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(
        f"local[{cpus}]",
        app_name="ledgerday-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(build) -> float:
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        return round(statistics.median(runs), 3)

    timings = {name: timed(lambda name=name: QUERIES[name](spark, sf_dir)) for name in names}

    stored: dict[str, float] = {}
    path = scratch_path(spark, "bench-ledger")
    t0 = time.perf_counter()
    write_ledger(fixture_ledger(spark, sf_dir), path, partitions=cpus)
    stored["write_ledger"] = round(time.perf_counter() - t0, 3)
    led = read_ledger(spark, path)
    stored["sales_report"] = timed(lambda: sales.sales_report(led, REPORT_DATE, items=ITEMS))
    stored["sales_report_multi"] = timed(lambda: sales_multi.sales_report_multi(led, ledger_span(led), ITEMS))
    stored["report_readiness"] = timed(lambda: availability.report_readiness(led, items=ITEMS))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "stored_ledger": stored,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "reps": reps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
