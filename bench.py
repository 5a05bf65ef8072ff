"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR   folder of the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or 'all'
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from capsieve import catalog  # noqa: E402
from capsieve.session import local_session  # noqa: E402

HEADLINE = (
    "adv20_latest", "exchange_price_cap_gate", "quote_spread_gate", "form_lookback_longest_prefix", "coverage_gate",
    "append_antijoin_purge", "hydrate", "shortlist_gate", "filings_evidence_parts", "or_key_join", "cascading_event_match",
    "classify_events", "governance_text_scan", "eightk_items_and_flags", "primary_event", "catalyst_pick",
    "evidence_parse_summary", "number_parser", "html_statement_runway", "page_statements", "xbrl_best_fact",
    "runway_first_complete", "candidate_shortlist", "deep_research", "validated_selections", "research_bundle",
    "populate_research", "watchlist", "progress_counts", "call_rate_60s",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES", "")
    spark = local_session(cores, "capsieve-bench", **{
        "spark.sql.shuffle.partitions": str(max(8, int(cores) if cores.isdigit() else 8)),
        # call sites of every Column are only needed for error messages
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    queries = catalog.queries()
    names = list(queries) if picked == "all" else [n for n in picked.split(",") if n] or list(HEADLINE)
    queries["exchange_price_cap_gate"](spark, folder).count()  # start executors before timing
    seconds: dict[str, float] = {}
    for name in names:
        started = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cores}))


if __name__ == "__main__":
    main()
