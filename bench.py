"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of local threads. The corpus queries, if their
subpackage is there, are timed apart (``corpus``) and not counted in the headline total; ``BENCH_CORPUS=0`` skips them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from tallyport.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "codes_per_institution_month",
    "users_per_institution_month",
    "codes_per_institution_database_year",
    "subscribers_per_status",
    "usage_subscription",
    "user_monthly_codes",
    "codes_month_by_year_pivot",
    "users_per_institution",
    "bar_chart_frames",
    "institution_theta_join",
    "institution_report_blocks",
    "report_pages",
)
CORPUS = ("op2_jaccard_join", "op7_suffix_dedup", "op9_phrase_dedup", "op11_periodic_runs", "op13_vector_codes", "pipeline")


def corpus_queries() -> dict:
    """The corpus queries, or none where their subpackage was left out."""
    if os.environ.get("BENCH_CORPUS", "1") == "0":
        return {}
    try:
        from tallyport.llm.queries import QUERIES as CORPUS_QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("tallyport.llm", "corpus_pipeline"):
            raise
        return {}
    return {name: CORPUS_QUERIES[name] for name in CORPUS if name in CORPUS_QUERIES}


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g", spark__ui__enabled="false",
        # one host: reading shuffles "locally" only ties a join to the one task that scanned the file
        spark__sql__adaptive__localShuffleReader__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up and code loading are not part of any query
    QUERIES[HEADLINE[0]](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    corpus = {}
    if not sys.argv[1:]:
        for name, run in corpus_queries().items():
            start = time.perf_counter()
            run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            corpus[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "corpus": corpus,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
