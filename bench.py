"""Time the reports and jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Every query starts from the given parquet tables and is run to its last row (noop
sink). The session is warmed up with one small report first; reports and charts are the
median of three runs, jobs are run once.
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from fireledger.registry.queries import registered
from fireledger.session import local_session

HEADLINE = [
    "q01_top_month",
    "q02_literal",
    "q02_top2_cumulative",
    "q03_max_yoy_increase",
    "q04_rank_change",
    "q04_yoy_direction",
    "q05_rank_asia",
    "q06_top3_by_gas_year",
    "q07_above_global_avg",
    "q08_largest_record",
    "q09_moving_avg_records",
    "q09_moving_avg_months",
    "q10_continent_range",
    "q11_country_year_sum",
    "chart_total",
    "chart_share",
    "chart_stacked",
    "chart_top_pairs",
    "audit_primary_key",
    "job_clean_fires",
    "job_dim_country",
    "job_dim_year",
    "job_fact_emission",
    "job_full_refresh",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, memory="16g", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("q11_country_year_sum")
    times = {name: median(run(name) for _ in range(1 if name.startswith("job") else 3)) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of reports and jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
