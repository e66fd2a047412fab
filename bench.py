"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Every query is
run once to warm up; the reported time is the median of the runs after that.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.catalog import QUERIES
from tidemark.session import session

HEADLINE = """
hashtag_top30 hashtag_top10 keyword_window_counts item_brand_window
rating_profile rating_split rating_pred_join rmse_fixed_n baseline_rmse confusion_matrix class_report
topn_titles unrated_items top_item_brand mutual_friends running_sum asof_running_state
wordcount stopword_filter tfidf nb_theta nb_predict sentiment_select
visual_word_histogram knn_bruteforce pairwise_distance kmedians_step gaussian_nb
sig_zero_crossings sig_centroid sig_mfcc scan_ratings scan_header_typed stream_keyword_sink als_train_mse
""".split()


def timed(spark, name, folder) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        warm = timed(spark, name, folder)
        runs = [timed(spark, name, folder) for _ in range(3 if warm < 8 else 1)]
        times[name] = round(statistics.median(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
