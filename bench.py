"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores). Every query is computed in full
and its rows are discarded; times are wall-clock seconds of one run in a warm session.
"""

from __future__ import annotations

import json
import os
import time

from logloom.plans.queries import QUERIES
from logloom.session import local_session

HEADLINE = (
    "scan_lines",
    "line_number",
    "source_fingerprint",
    "parse_block_logs",
    "parse_vm_logs",
    "mask_content",
    "signature_counts",
    "template_table_exact",
    "template_table",
    "template_leaf",
    "template_increment",
    "line_events",
    "entity_event_counts",
    "labelled_matrix",
    "vm_labelled_matrix",
    "anomaly_rate",
    "top_events_per_label",
    "event_variance",
    "event_correlation",
    "large_count_correlation",
    "select_correlation",
    "stratified_folds",
    "roc_auc",
    "roc_curve",
    "cv_summary",
    "stream_ingest",
    "stream_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("labelled_matrix")
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
