"""Benchmark: derive the trial sources once, then build and publish every mart.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.  Per-mart time is build + full write of the mart
(Parquet), i.e. the nightly job's real work; dependants read the published
parents; marts are written one after the other, so that each has its own time.
The nightly run is repeated ``$BENCH_RUNS`` times
(3); per mart the median counts, so the first, cold run does not decide;
``parallel_wall`` is the wall time of one more run with independent marts at the
same time, as in production.
``derive_sources`` (writing the derived source tables) is reported separately
and not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trialmart import build_session  # noqa: E402
from trialmart.sinks import run_nightly  # noqa: E402
from trialmart.sources import from_parquet, from_testdata  # noqa: E402
from trialmart.sources.derived import DERIVED  # noqa: E402

RUN_TS = "2024-02-01 06:00:00"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="trialmart-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
                                 "spark.checkpoint.dir": f"{scratch}/ckpt"})

    t0 = time.perf_counter()
    derived = from_testdata(spark, sf_dir)
    src_dir = f"{scratch}/sources"
    for name, _ in DERIVED:
        derived[name].write.mode("overwrite").parquet(f"{src_dir}/{name}.parquet")
    derive_s = time.perf_counter() - t0

    src = from_parquet(spark, src_dir)
    runs: list[dict[str, float]] = []
    for k in range(int(os.environ.get("BENCH_RUNS", "3"))):
        times: dict[str, float] = {}

        def timer(name, fn, times=times):
            t = time.perf_counter()
            out = fn()
            times[name] = time.perf_counter() - t
            return out

        run_nightly(spark, src, f"{scratch}/marts-{k}", RUN_TS, timer=timer, parallel=1)
        runs.append(times)
    t0 = time.perf_counter()
    run_nightly(spark, src, f"{scratch}/marts-parallel", RUN_TS)
    parallel_s = time.perf_counter() - t0
    times = {name: round(statistics.median(r[name] for r in runs), 3) for name in runs[0]}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "nightly_marts_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "runs": [round(sum(r.values()), 3) for r in runs],
                      "parallel_wall": round(parallel_s, 3), "derive_sources_sec": round(derive_s, 3), "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
