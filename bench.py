"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice and the better time counts: the first run also compiles
the generated code, which a long-lived session pays once.

`python bench.py all` times every registered query, slowest first, on stderr.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.queries import QUERIES  # noqa: E402
from quayside.session import build_session, scope  # noqa: E402

HEADLINE = (
    "w_mom_growth", "a_totals", "a_state_revenue", "a_segment_revenue", "a_product_summary", "a_quantiles",
    "j_star4", "j_total_mismatch", "j_self_pairs", "w_first_value", "w_ntile_segments", "w_rank_compare",
    "w_interp_linear", "w_lag_features", "u_dedup_exact", "d_validate_orders", "d_dq_suite", "m_fill_numeric",
    "m_outlier_cap", "e_clean_all", "e_feature_all", "t_fact_orders", "t_revenue_month_category",
    "t_cohort_retention", "t_rfm_clv", "t_product_performance", "t_affinity", "x_clean_text",
)


def run(spark, name: str, folder: str) -> float:
    with scope(spark):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if sys.argv[1:] == ["all"] else list(HEADLINE)
    run(spark, "w_mom_growth", folder)  # start the workers before timing
    times = {name: round(min(run(spark, name, folder) for _ in range(2)), 3) for name in names}
    if sys.argv[1:] == ["all"]:
        for name, sec in sorted(times.items(), key=lambda kv: -kv[1]):
            print(f"{sec:8.3f}  {name}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
