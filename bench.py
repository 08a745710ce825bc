"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Once
``BENCH_BUDGET`` seconds have passed, the remaining queries are timed once after their warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from growthmill.session import build_session
from verification.registry import QUERIES, Models

HEADLINE = (
    "src_google_ads",
    "src_meta_actions_pivot",
    "src_ga4_report",
    "src_mixpanel_events",
    "stg_google_ads",
    "stg_mixpanel_events",
    "fct_campaign_performance",
    "fct_ad_spend_roi",
    "fct_mixpanel_events",
    "fct_mixpanel_campaign_attribution",
    "fct_mixpanel_campaign_attribution_bridged",
    "fct_funnel_conversion",
    "fct_mixpanel_funnel",
    "fct_revenue",
    "fct_attribution_bridged",
    "last_touch",
    "linear_attribution",
    "attribution_models",
    "channel_credit_report",
    "asof_utm_attribution",
    "funnel_conversion_rates",
    "event_funnel_steps",
    "campaign_transform",
    "latest_per_key",
    "merge_upsert",
    "dq_run_all",
    "mon_null_rates",
    "test_accepted_range",
    "kpi_paid_media",
    "biz_top_roas",
    "biz_channel_revenue",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    """Wall-clock of the query itself, without the rounding its comparison adds."""
    started = time.perf_counter()
    QUERIES[name].run(Models(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_BUDGET", "150"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    started = time.perf_counter()
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, sf_dir)
        repeats = runs if time.perf_counter() - started < budget else 1
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
