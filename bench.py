"""Per-stage throughput of the corpus run on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from textmill.plans.corpus_run import run
    from textmill.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    t0 = time.time()
    # the tables are single-row-group files: spread them, as a reader of many files would be
    res = run(spark, sf_dir, input_partitions=int(cpus) * 2 if cpus.isdigit() else 16)
    t1 = time.time()
    for name in ("safety_metrics", "dedup_metrics", "token_metrics", "perplexity_stats", "shard_meta", "report_summary",
                 "report_token_histogram", "report_char_histogram", "report_token_boxplot"):
        res.tables[name].collect()
    total = time.time() - t0
    stages = {s: round(sec, 3) for s, _, _, sec, _ in res.throughput} | {"report": round(time.time() - t1, 3)}
    res.release(spark)
    rates = {s: round(r, 1) for s, _, _, _, r in res.throughput}
    rows = {s: [i, o] for s, i, o, _, _ in res.throughput}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "corpus_run_wall", "value": round(total, 3), "unit": "sec",
                      "queries": stages, "rows_per_sec": rates, "rows_in_out": rows, "sf": sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
