"""Headline timings: each pipeline step alone, then the flagship query. Prints one JSON line.

The same steps run once on the smallest tables before the clock starts, so that the numbers show throughput and not
the start of the JVM and its compiler; ``warmup_sec`` tells how long that took (``BENCH_WARMUP=0`` skips it).
``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from edilake.operators import framing, lookup, loops, reports, writing  # noqa: E402
from edilake.plans import claims  # noqa: E402
from edilake.plans.lake import SPEC, lake  # noqa: E402
from edilake.session import build_session  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(spark, sf_dir: str, step) -> int:
    x, dirty = lake(spark, sf_dir), lake(spark, sf_dir, "dirty")
    # each store is computed once; the steps after it read the stored table
    step("encode", lambda: x.raw)
    step("frame", lambda: run(framing.split_elements(framing.split_segments(x.framed))))
    step("envelope", lambda: run(loops.number_envelopes(x.parts, x.has_long)))
    step("assign_loops", lambda: run(x.assign()))
    step("store_segments", lambda: (x.located, x.loops))
    step("lookup", lambda: run(lookup.get_elements(x.located, x.loops, [lookup.Address("claim", "2300", "CLM", 1, loop_no=1)])))
    step("subtree_size", lambda: run(lookup.subtree_size(x.located)))
    step("extract", lambda: run(lookup.flatten(x.located, [
        lookup.Field("market", "2000B", "SBR", 3), lookup.Field("claim", "2300", "CLM", 1, cast="bigint"),
        lookup.Field("charge", "2400", "SV1", 2, cast="decimal(18,2)"),
        lookup.Field("service_date", "2400", "DTP", 3, qualifier="472", cast="date")], SPEC)))
    step("store_dirty", lambda: (dirty.located, dirty.loops))
    step("validate", lambda: dirty.errors)
    step("error_ranking", lambda: run(reports.error_ranking(dirty.errors)))
    step("write_source_order", lambda: run(writing.write_source_order(x.located)))
    step("write_spec_order", lambda: run(writing.write_spec_order(x.located, SPEC)))
    step("write_json", lambda: run(writing.nested_json(x.located, x.loops)))
    step("billed_amounts", lambda: run(claims.billed_amounts(spark, sf_dir)))
    return x.located.agg(F.count("*")).first()[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    start = time.perf_counter()
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") != "0" and small != sf_dir and os.path.isdir(small):
        steps(spark, small, lambda name, action: action())
    warmup = round(time.perf_counter() - start, 3)
    segments = steps(spark, sf_dir, timed)
    rates = {k: round(segments / times[k]) for k in ("frame", "envelope", "assign_loops", "validate", "write_spec_order")}
    print(json.dumps({"metric": "EDI pipeline, total of all steps", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir), "segments": segments,
                      "segments_per_sec": rates, "warmup_sec": warmup}))


if __name__ == "__main__":
    main()
