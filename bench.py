"""Wall seconds per query: prints one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from moodline.session import CHECKPOINT_DIR, build_session, configure
from workload.queries import QUERIES, report


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
    }
    if not os.environ.get("BENCH_KEEP_STAGES"):
        conf[CHECKPOINT_DIR] = tempfile.mkdtemp(prefix="bench-stage-")
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the JVM's threads

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        report(QUERIES[name](spark, sf_dir)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
