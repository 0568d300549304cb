"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the driver tables, ``BENCH_CPUS`` the local threads.
Every result is consumed in full. ``load_warehouse`` builds nothing: it types, checks and
publishes a star that is already built, like the reload whose duration is published.
"""

from __future__ import annotations

import json
import os
import time

from tenderlake import contracts as C
from tenderlake.plans import gold, publish
from tenderlake.session import build_session, new_folder, side_by_side
from workload import QUERIES, adapters

HEADLINES = (
    "q1_top_products", "q2_top_suppliers", "q3_value_by_state", "q4_value_by_month", "q5a_mean_price",
    "q5b_price_stats", "q6_top_agencies", "q7_top_categories", "q8_overpriced_suppliers",
    "q9_bidders_by_state", "q10_price_anomalies", "v1_anomaly_view", "r1_kpis", "r2_value_by_day",
    "r5_price_lookup", "b1_clean_tenders", "b2_clean_items", "b3_clean_participants", "d1_dedup_exact",
    "e1_dense_key", "e3_get_or_create_key", "j1_inner_with_orphans", "k6_check_contract",
    "i4_merge_by_key", "i4_merge_into_periods", "s7_promote",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.monotonic()
        result = run()
        seconds[name] = round(time.monotonic() - start, 3)
        return result

    def consume(df):
        df.write.format("noop").mode("overwrite").save()

    consume(adapters.table(spark, folder, "lineitem").groupBy("l_returnflag").count())
    tables = adapters.silver(spark, folder)
    tenders, items, bids = tables[C.TENDERS], tables[C.ITEMS], tables[C.BIDS]
    dims = timed("build_dimensions", lambda: gold.build_dimensions(tenders, items, bids))

    def facts():
        won = lambda: gold.number_fact(gold.build_fact_item(items, tenders, dims)[0], C.FATO_ITEM)
        offered = lambda: gold.number_fact(gold.build_fact_bid(bids, dims), C.FATO_PARTICIPACAO)
        return side_by_side(spark, {C.FATO_ITEM.name: won, C.FATO_PARTICIPACAO.name: offered})

    built = dims | timed("build_facts", facts)
    root = new_folder(spark, "warehouse")
    counts = timed("load_warehouse", lambda: publish.publish_if_clean(spark, built, root))
    adapters.use_published(spark, folder, root, counts)
    for name in HEADLINES:
        timed(name, lambda: consume(QUERIES[name](spark, folder)))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "rows_loaded": sum(counts.values()),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
