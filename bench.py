"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice against the no-op sink: `queries` holds the warm time,
`cold` the first. BENCH_QUERIES (comma separated, or `all`) picks others.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "h1_series_summary",
    "h1_many_series_summary",
    "b8_catalog_index",
    "b10_sparklines",
    "i1_changes",
    "i3_year_on_year",
    "l1_breaks",
    "l4_range_one_year",
    "f1_keep_first",
    "f1_anomalies",
    "f14_vintages",
    "e1_wide_to_long",
    "e2_keyed_to_long",
    "h4_auction_series",
    "l7_curve_slope",
    "g4_asof_backward",
    "g6_nearest",
    "g8_interval_join",
    "g11_siblings",
    "m11_recovered_decisions",
    "a3_table_records",
    "e13_grid_observations",
    "m1_release_figures",
    "m7_statement_diffs",
    "a8_page_text",
    "n1_postings",
    "n3_index_postings",
    "n4_full_text",
    "n7_ranked_search",
    "b16_published_pages",
]


def main() -> None:
    from seriesforge import session
    from seriesforge.plans.catalog import load_all

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark__sql__shuffle__partitions": cpus,
        "spark__ui__enabled": "false",
        "spark__driver__memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark__ui__showConsoleProgress": "false",
    }
    spark = session.build("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    asked = os.environ.get("BENCH_QUERIES")
    names = list(registry) if asked == "all" else (asked.split(",") if asked else HEADLINE)

    def run(name: str) -> float:
        start = time.perf_counter()
        registry[name].plan(spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name in names:
        cold[name] = run(name)
        warm[name] = run(name)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf.rstrip("/")),
                "conf": {"master": f"local[{cpus}]", **{k.replace("__", "."): v for k, v in conf.items()}},
            }
        )
    )


if __name__ == "__main__":
    main()
