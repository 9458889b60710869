"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES an optional list.
Every query is run to its last row, twice in a row: `queries` holds the second time, after code generation
and warm-up, and `cold` the first. `stored` has the live views over the tables that the stream job keeps, warm, and `stored_build` the time
the job takes for them (three runs, a compaction); neither counts in `value`. BENCH_STORED=0 leaves them out.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from moodstream.plans.catalogue import QUERIES  # noqa: E402
from moodstream.plans.streams import restarted  # noqa: E402

HEADLINES = [
    "decode_payload",
    "labelled_sample",
    "english_nonempty",
    "track_subjects",
    "placeholder_text",
    "placeholder_links",
    "tokenize",
    "word_count_total",
    "vocabulary_build",
    "vocab_hit_rate",
    "term_frequency",
    "linear_score",
    "linear_score_join",
    "score_polarity",
    "word_count_by_window",
    "word_count_topk",
    "word_count_latest",
    "word_count_long",
    "word_cloud_long",
    "sentiment_by_window",
    "sentiment_history_short",
    "sentiment_history_long",
    "sentiment_pie",
    "trailing_volume",
    "recent_per_window",
    "recent_tweets",
    "confusion_matrix",
    "train_and_confuse",
    "replay_sample",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("moodstream-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold, times = {}, {}
    for name in names:
        cold[name], times[name] = run(name), run(name)
        print(f"{name} {cold[name]} {times[name]}", file=sys.stderr, flush=True)
    stored, build = {}, None
    if os.environ.get("BENCH_STORED", "1") != "0" and names is HEADLINES:
        start = time.perf_counter()
        restarted(spark, folder)
        build = round(time.perf_counter() - start, 3)
        for name in [x for x in QUERIES if x.startswith("stored_")]:
            run(name)
            stored[name] = run(name)
            print(f"{name} {stored[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "stored": stored,
                "stored_build": build,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
