"""The end-to-end job: raw logs in, event table and marts out.

    python -m matchlog LOGS... --out DIR [--protagonist NAME] [--charset cp1252|utf-8] [--csv [--bom]]

The event table is written once (Parquet, partitioned by category) and read
back for the marts: a written table cuts the lineage, so a lost executor
recomputes from the table, not from the raw logs, and each mart scans only
the columns and category partitions it needs.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators import marts
from .operators.contract import original_contract
from .operators.events import build_events
from .sources.logs import read_logs
from .sources.sinks import write_csv, write_parquet


def mart_tables(ev: DataFrame, protagonist: str) -> dict[str, DataFrame]:
    return {
        "events_by_match_category": marts.events_by_match_category(ev, ordered=False),
        "pvp_log": marts.pvp_log(ev),
        "protagonist_summary": marts.protagonist_summary(ev, protagonist),
        "purchase_log": marts.purchase_log(ev),
        "bed_log": marts.bed_log(ev, ordered=False),
        "xp_log": marts.xp_log(ev),
        "chat_log": marts.chat_log(ev),
        "top_items": marts.top_items(ev),
        "event_volume_in_match": marts.event_volume_in_match(ev),
        "top_killers": marts.top_killers(ev),
        "pvp_share": marts.pvp_share(ev, protagonist),
        "beds_by_team": marts.beds_by_team(ev),
        "events_by_category": marts.events_by_category(ev),
        "match_spans": marts.match_spans(ev),
        "xp_by_match": marts.xp_by_match(ev),
        "resources_by_match": marts.resources_by_match(ev),
        "kd_by_player": marts.kd_by_player(ev),
    }


def run_job(
    spark: SparkSession,
    paths: Sequence[str],
    out_dir: str,
    *,
    protagonist: str,
    charset: str = "cp1252",
    csv: bool = False,
    bom: bool = False,
) -> dict[str, str]:
    """Run the whole ETL; returns the output folder of every table.  ``bom`` starts
    the CSV files with a byte-order mark, as the original export does."""
    out_dir = out_dir.rstrip("/")
    lines = read_logs(spark, list(paths), charset=charset, with_match_ids=True)
    write_parquet(build_events(lines, protagonist), f"{out_dir}/events")
    ev = spark.read.parquet(f"{out_dir}/events")
    outputs = {"events": f"{out_dir}/events"}
    if csv:
        write_csv(original_contract(ev), f"{out_dir}/events_csv", bom=bom)
        outputs["events_csv"] = f"{out_dir}/events_csv"
    # Lines and chat lines cannot be recovered from the event table.
    for name, df in {**mart_tables(ev, protagonist), "line_funnel": marts.line_funnel(lines)}.items():
        path = f"{out_dir}/marts/{name}"
        df.write.mode("overwrite").parquet(path)
        outputs[name] = path
    return outputs


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="matchlog", description=__doc__.split("\n\n")[0])
    ap.add_argument("logs", nargs="+", help="log files, directories or globs")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--protagonist", required=True, help="owner of the logs")
    ap.add_argument("--charset", default="cp1252", choices=("cp1252", "utf-8"))
    ap.add_argument("--csv", action="store_true", help="also write the event table as CSV (original columns)")
    ap.add_argument("--bom", action="store_true", help="start the CSV files with a byte-order mark")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("matchlog").getOrCreate()
    for name, path in run_job(spark, args.logs, args.out, protagonist=args.protagonist, charset=args.charset, csv=args.csv, bom=args.bom).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
