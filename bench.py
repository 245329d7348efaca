"""Time the headline queries and a whole booking run, and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores. The source
tables are derived from it and written before, in several files each, as a real run finds them.
Each query runs once to warm up and then ``BENCH_RUNS`` times into a sink that reads every
column of every row; the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame

from checks import fixture
from checks.queries import QUERIES, Booking
from tallybook.plans.booking import run_booking
from tallybook.session import build_session

HEADLINE = (
    "sc_extract",
    "oms_extract",
    "sc_valid",
    "sc_invalid",
    "type_routing",
    "item_price_and_credit",
    "missing_beneficiary",
    "ipc_final",
    "ipt_final",
    "commission_final",
    "commission_revenue_ledger_amount",
    "total_ledger_amount",
    "posting_template",
    "posting_template_month",
    "posting_template_flat",
    "step_counts",
    "upload_ledger_map",
    "append_beneficiary",
    "shipped_ledger_keys",
)


class WrittenSources(fixture.Sources):
    """Derived tables that are written when they are first asked for, and read from then on."""

    folder = ""
    written: set[str] = set()

    def view(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if name not in self.written:
            df = super().view(name)
            df.repartition(8).write.mode("overwrite").parquet(path)
            self.written.add(name)
        return self.spark.read.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else 8,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    WrittenSources.folder = tempfile.mkdtemp(prefix="run-bench-")
    Booking.sources_of = WrittenSources

    def whole_run() -> None:
        tables = Booking(spark, sf_dir).tables
        run_booking(tables, f"{WrittenSources.folder}/booked", every_month=True)

    seconds = {}
    for name in (*names, "booking_run"):
        best = None
        for turn in range(runs + 1):
            start = time.perf_counter()
            if name == "booking_run":
                whole_run()
            else:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            if turn and (best is None or taken < best):
                best = taken
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
