"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Every query is run
to the end into a sink that keeps nothing. The first entries land the raw datasets and build the
warehouse; later queries read its tables, as the users of a warehouse do.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from skygalley.registry import queries  # noqa: E402
from skygalley.registry.base import lab  # noqa: E402
from skygalley.session import local_session  # noqa: E402

HEADLINE = (
    "stg_sales",
    "stg_payments",
    "stg_items_load",
    "stg_wastage",
    "int_flights",
    "fact_sales",
    "fact_payments",
    "fact_items_load",
    "fact_wastage",
    "mart_fresh_food_order_sale",
    "mart_pax_sales",
    "bi_sales_performance",
    "bi_product_sales",
    "bi_flight_sales",
    "mq_sales_by_category_top",
    "mq_filter",
    "mq_all_global_sales",
    "mq_wastage_wastage_rate",
    "dq_not_null",
    "dq_unique_combo",
    "dq_relationship",
    "feat_hist_avg",
    "cv_hist_avg",
    "eval_deep",
    "score_inputs",
    "eda_describe",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    setup = lab(spark, folder)
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("land_raw", lambda: [setup.wh.raw[name] for name in setup.wh.raw])
    timed("build_warehouse", setup.wh.build)
    timed("build_older_star", lambda: [setup.legacy.ref(n) for n in setup.legacy.names])
    known = queries()
    for name in HEADLINE:
        timed(name, lambda n=name: run(known[n](spark, folder)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
