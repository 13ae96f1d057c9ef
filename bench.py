"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line.

Every query is run to its last row (``noop`` sink). A query's time covers building
the plan, jobs it needs on the way (a checked lookup, staged files) and the run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakekit.session import local_session  # noqa: E402
from lakekit.workload.queries import all_queries  # noqa: E402

HEADLINE = [
    "cleaned_text",
    "text_metrics",
    "silver_events",
    "dedup_events",
    "upsert",
    "upsert_partitions",
    "daily_activity",
    "channel_summary",
    "hourly_activity",
    "view_daily_trend",
    "view_leaderboard",
    "view_sentiment_breakdown",
    "view_engagement_summary",
    "view_topic_kpis",
    "view_topic_share",
    "tile_02",
    "tile_03",
    "tile_08",
    "dq_report",
    "dq_silver_gate",
    "profile_score_pcts",
    "profile_top",
    "engagement_label",
    "topic_argmax",
    "tokens_docfreq",
    "job_gold",
    "lda_topics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    # One small query first, so that starting the engine is not booked on the first name.
    registered["profile_rows"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
