"""Benchmark: headline queries on the rendered log at ``$BENCH_SF_DIR``.

Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected).  One warm-up pass runs first so JIT and codegen caches
are warm, as in a long-running cluster session.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchlog.operators.events import build_events, classify_events, enrich  # noqa: E402
from matchlog.operators.framing import frame  # noqa: E402
from matchlog.plans.catalog import QUERIES, events, log_lines, table  # noqa: E402
from matchlog.session import ensure_checkpoint_dir, local_session  # noqa: E402
from matchlog.sources.fixture import PROTAGONIST  # noqa: E402
from matchlog.sources.logs import read_logs  # noqa: E402

# Cumulative prefixes of the ETL: each stage's time includes the ones before.
STAGES = {
    "render": lambda spark, d: log_lines(spark, d),
    "frame": lambda spark, d: frame(log_lines(spark, d)),
    "classify_enrich": lambda spark, d: enrich(classify_events(frame(log_lines(spark, d))), PROTAGONIST),
    "segment": lambda spark, d: events(spark, d),
}

BASELINE_LINES_PER_SEC = round(500 / 6.34, 1)

HEADLINE = (
    "build_event_table",
    "events_by_match_category",
    "pvp_log",
    "protagonist_summary",
    "top_killers",
    "kd_by_player",
    "match_spans",
    "xp_by_match",
    "resources_by_match",
    "events_by_category",
    "line_funnel",
    "segment_matches_global",
    "scan_lines",
    "decode_legacy_text",
)


def run(spark, name: str, sf_dir: str, registry=QUERIES) -> float:
    t = time.perf_counter()
    registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def write_raw_log(spark, sf_dir: str) -> str:
    """Untimed setup: the rendered log as ONE text file (a single hot log),
    written under the session's checkpoint folder (shared storage on a
    cluster; set only when unset)."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/matchlog-bench-{uuid.uuid4().hex}/latest"
    log_lines(spark, sf_dir).orderBy("line_no").select("value").coalesce(1).write.text(out)
    return out


def run_raw_log(spark, path: str) -> float:
    """Raw text log -> event table: line numbers and match ids in one shuffle."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))  # several splits, as on a cluster
    try:
        t = time.perf_counter()
        lines = read_logs(spark, path, charset="utf-8", with_match_ids=True)
        build_events(lines, PROTAGONIST).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="matchlog-bench")
    lines = table(spark, sf_dir, "events").count()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    for name in names:  # warm-up
        run(spark, name, sf_dir)
    for name in STAGES:
        run(spark, name, sf_dir, STAGES)
    raw_log = write_raw_log(spark, sf_dir)
    run_raw_log(spark, raw_log)
    timings = {name: round(run(spark, name, sf_dir), 3) for name in names}
    stages = {name: round(run(spark, name, sf_dir, STAGES), 3) for name in STAGES}
    raw = round(run_raw_log(spark, raw_log), 3)
    total = round(sum(timings.values()), 3)
    etl = timings.get("build_event_table")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "log_lines": lines,
                "etl_lines_per_sec": round(lines / etl, 1) if etl else None,
                "baseline_lines_per_sec": BASELINE_LINES_PER_SEC,
                "comparison_note": "ours is warm, without session start, from a Parquet table; the baseline is one cold run of 500 lines",
                "etl_speedup_vs_baseline": round(lines / etl / BASELINE_LINES_PER_SEC, 1) if etl else None,
                "stages_cumulative_sec": stages,
                "raw_text_log_event_table_sec": raw,
                "raw_text_log_lines_per_sec": round(lines / raw, 1),
                "stages_lines_per_sec": {k: round(lines / v, 1) for k, v in stages.items()},
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
