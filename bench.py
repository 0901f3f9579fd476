"""Time the headline jobs and print one JSON line.

Tables are built layer by layer as in a scheduled run; reports and audits then read the
stored tables. A pass over the smallest test folder warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from checks.feed_source import landed_root  # noqa: E402
from checks.lake import lake  # noqa: E402
from galley.operators.together import together  # noqa: E402
from galley.session import build_session  # noqa: E402
from galley.sources.contracts import ENTITIES  # noqa: E402

# tables that can be built side by side, level by level
STAGING = [["int_customers", "int_stores", "int_products", "int_orders", "int_deliveries"], ["int_order_items"]]
MARTS = [
    ["dim_store", "dim_date", "dim_customer", "dim_product", "dim_channel", "dim_payment_method", "dim_promo"],
    ["fact_orders", "fact_order_items", "fact_deliveries"],
    ["order_sales"],
]

HEADLINES = [
    "vw1_rpt_order_summary",
    "vw2_sales_performance",
    "vw3_delivery_performance",
    "vw4_product_performance",
    "vw5_customer_summary",
    "dq1_41_results",
    "exc1_exceptions",
    "rec1_14_reconciliation",
    "prf1_source_profile",
    "prf2_relationship_profile",
    "win3_customer_order_rank",
    "jn3_as_of_version",
    "ups1_upsert",
    "inc11_provider_summary",
    "bq7_spend_quantiles",
    "mon2_missing_store_days",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def build(here, levels) -> None:
    for level in levels:
        together({name: lambda name=name: here.any(name) for name in level})


def run(spark, sf_dir: str) -> dict[str, float]:
    here, queries = lake(spark, sf_dir), registry.QUERIES
    for entity in ENTITIES:  # the mapping of the test tables is not part of the measurement
        here.typed(entity)
    landed_root(spark, sf_dir)
    seconds = {
        "build_staging": timed(lambda: build(here, STAGING)),
        "build_marts": timed(lambda: build(here, MARTS)),
    }
    for name in HEADLINES:
        df_of = queries[name]
        seconds[name] = timed(
            lambda: df_of(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    small = str(Path(sf_dir).parent / "sf0.001")
    if Path(small).is_dir() and small != sf_dir:
        run(spark, small)
    seconds = run(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
