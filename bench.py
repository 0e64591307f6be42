"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Every query runs once, to a sink that reads all rows and columns and keeps none.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

import workload
from earshot.operators import factorize, recommend, similar
from earshot.sources import storage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FIT = {"rank": 10, "iterations": 5}

HEADLINES = (
    "interaction_faults", "support_counts_user", "support_counts_song", "clean_interactions",
    "cleaning_report", "user_stats", "user_stats_lookup", "history_top10", "history_all",
    "history_totals", "users_by_id", "unknown_users", "hash_split", "random_split",
    "truth_pairs", "ndcg_popularity", "eval_frame", "knn_exact", "knn_named", "csv_roundtrip",
    # The ways for tables that are too large for the usual ones.
    "clean_interactions_shuffled", "history_hot_users", "history_deep", "knn_exact_cells", "knn_lsh_wide",
    "grid_metrics", "train_and_save",
)
# Of the search by cells: vectors that cannot be broadcast, and buckets that prune.
CELLS = {"max_broadcast_bytes": 0}
PRUNING = 0.25


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("earshot-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="earshot-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def drained(df):
        df.write.format("noop").mode("overwrite").save()

    storage.ensure_checkpoint_dir(spark)
    # Starts the executor threads and the code generator.
    drained(workload.plays(spark, SF_DIR))

    # Cleaning and writing the split, which the later steps read.
    timed("write_split", lambda: workload.training_rows(spark, SF_DIR))
    for name in HEADLINES:
        timed(name, lambda: drained(workload.QUERIES[name](spark, SF_DIR)))

    ratings = workload.interactions.log_rating(workload.plays(spark, SF_DIR)).persist()
    ratings.count()
    model = timed("als_fit", lambda: factorize.train(ratings, seed=workload.SEED, **FIT))
    timed("als_top10_all_users", lambda: drained(recommend.top_items(model, 10)))
    vectors = factorize.user_vectors(model).persist()
    vectors.count()
    index = timed("lsh_fit", lambda: similar.fit_index(vectors, seed=workload.SEED))
    timed("lsh_one_user", lambda: similar.similar_to(vectors, 1, index).collect())
    fine = similar.fit_index(vectors, seed=workload.SEED, bucket_length=PRUNING)
    timed("exact_all_users", lambda: drained(similar.similar_users(vectors)))
    timed("lsh_all_users", lambda: drained(similar.similar_users(vectors, index=index)))
    timed("exact_cells", lambda: drained(similar.similar_users(vectors, **CELLS)))
    timed("lsh_cells", lambda: drained(similar.similar_users(vectors, index=fine, **CELLS)))
    timed("als_ndcg", lambda: drained(workload.als_ndcg(spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
