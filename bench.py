"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder of the tables     (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads            (default 8)
    BENCH_RUNS    timed runs, best counts  (default 2, after one warm-up)

Names given as arguments replace the headline list; `all` stands for every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans import QUERIES
from millrace.session import build_session, intermediates

HEADLINE = """
daily_sales_stats daily_stats_summary daily_revenue_variance daily_revenue_in_range
region_category_revenue department_summary department_salary_stats sales_by_day top_products
customer_distribution inventory_score business_analytics business_insights
business_insights_by_customer customer_order_analytics customer_order_patterns
stock_indicators tick_indicators market_signals completeness_gate column_profile column_drift
weather_transform pit_join historical_features latest_per_key counter_rate histogram_quantile
alert_for fact_sales fact_inventory sales_by_product_level sales_by_geography dim_date
""".split()


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    with intermediates(spark):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, folder) if runs > 1 else None
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(max(runs, 1))), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
