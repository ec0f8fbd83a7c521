"""Time the headline queries: one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores, BENCH_QUERIES a
comma-separated choice. Each query runs once to warm up, then BENCH_RUNS times (default 2);
the median, building the plan included, is reported. Rows are worked out in full and
dropped.
"""

import json
import os
import statistics
import time
from pathlib import Path

from gleanfield.plans.catalog import QUERIES
from gleanfield.session import local_session

HEADLINE = """
q_pages_to_events q_clean_urls q_links q_entries q_fields q_strip_accents q_event_id
q_dates_us_range q_dates_day_month_range q_contacts q_country_in_text q_country_lookup
q_pairs q_adjacent q_chunks q_lot2dol q_flatten_json q_soft_update q_csv_rows q_json_rows
q_pagination q_calendar q_site_bio q_site_ausbiotech q_site_uk_biotech_database
q_site_solebury_trout
""".split()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, cores, driver_memory="16g")
    times = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": Path(folder).name.removeprefix("sf"), "cores": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
