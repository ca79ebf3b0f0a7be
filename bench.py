"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from reelmill.session import build_session
from reelmill.testbed.registry import QUERIES, SHARED

HEADLINE = (
    "basics_clean", "ratings_clean", "tmdb_clean", "latest_per_key", "merge_basics",
    "merge_ratings", "fct_movies", "genre_exploded", "genre_summary", "genre_yearly_metrics",
    "feature_medians", "ml_features", "genre_rating_trends", "full_refresh", "scan_tsv_basics",
    "scan_json_pages", "rf_predictions", "daily_run",
)
RUNS = 3
LONG = 20.0                 # seconds; a query whose first run takes longer is timed by it


def seconds(spark, name: str, sf_dir: str) -> float:
    """Median of three runs after a warm-up; of a long query, the first run."""

    def once() -> float:
        SHARED.clear()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    first = once()
    return first if first > LONG else statistics.median(once() for _ in range(RUNS))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        spark = build_session(
            "bench",
            f"local[{cpus}]",
            **{
                "spark.sql.shuffle.partitions": cpus,
                "spark.driver.memory": "16g",
                "spark.checkpoint.dir": shared,
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.python.sql.dataFrameDebugging.enabled": "false",
            },
        )
        spark.sparkContext.setLogLevel("ERROR")
        QUERIES["genre_yearly_metrics"](spark, sf_dir).collect()
        took = {name: round(seconds(spark, name, sf_dir), 3) for name in HEADLINE}
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
