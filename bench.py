"""Time the headline queries; print one JSON line.

Each query runs once on the smallest tables to start the Python workers and warm
the JVM, then is timed on $BENCH_SF_DIR. Results go to a sink that reads every
row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfmark.functions.encoders import HashedEncoder  # noqa: E402
from shelfmark.plans import queries as Q  # noqa: E402
from shelfmark.plans.search import search  # noqa: E402
from shelfmark.session import new_work_dir  # noqa: E402
from shelfmark.sources import index  # noqa: E402

HEADLINE = (
    "judged_pairs",
    "label_score_histogram",
    "text_agreement",
    "mean_cosine_and_corr",
    "compare_models",
    "fit_metric_gram",
    "training_examples",
    "knn_exact_l2",
    "knn_exact_cosine",
    "knn_block",
    "knn_lists_scan",
    "encode_hashed",
    "semantic_search",
    "stream_search",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def line_items(spark, sf_dir: str):
    """Every line of every document as an item of its own: a catalog of many items."""
    lines = Q.document_items(spark, sf_dir).select(
        "item_id", "item_name", F.posexplode(F.split("item_text", "\n")).alias("line", "item_text")
    )
    width = lines.agg(F.max("line") + 1).first()[0]
    return lines.select((F.col("item_id") * width + F.col("line")).alias("item_id"), "item_name", "item_text")


def search_figures(spark, sf_dir: str) -> dict[str, float]:
    """Search of a stored index, encoding and texts included: one query's latency, and
    a batch's throughput."""
    encoder = HashedEncoder(Q.DIM)
    path = new_work_dir(spark, "bench-index")
    build = timed(lambda: index.write_index(line_items(spark, sf_dir), path, encoder))
    opened = index.read_index(spark, path, encoder)
    asked = Q.benchmark_queries(spark, sf_dir).cache()
    batch = asked.count()
    one = asked.limit(1).cache()
    one.count()
    run(search(one, opened, encoder))
    single = min(timed(lambda: run(search(one, opened, encoder))) for _ in range(3))
    together = min(timed(lambda: run(search(asked, opened, encoder))) for _ in range(3))
    return {
        "index_items": opened.rows,
        "index_build_sec": round(build, 3),
        "one_query_sec": round(single, 3),
        "batch_queries": batch,
        "batch_sec": round(together, 3),
        "batch_queries_per_sec": round(batch / together, 1),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds = {}
    for name in HEADLINE:
        if os.path.isdir(warm_dir):
            run(Q.QUERIES[name](spark, warm_dir))
        seconds[name] = round(timed(lambda: run(Q.QUERIES[name](spark, sf_dir))), 3)
    figures = search_figures(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "search": figures,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
