"""Time the headline queries and one complete run; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from catalog import frames
from catalog.queries import QUERIES
from termloom.models.candidates import CANDIDATES, fit_candidate
from termloom.operators import documents
from termloom.plans import jobs

HEADLINE = [
    "tokenise_report",
    "top_terms_by_sentiment",
    "top_terms_by_group",
    "term_report",
    "work_statistics",
    "most_common_terms",
    "term_frequency_check",
    "align_by_content",
    "classification_report",
    "exact_sample",
    "stratified_split",
    "document_frequency",
    "tfidf_word",
    "tfidf_bigram",
    "tfidf_char",
    "linear_scoring",
    "csv_roundtrip",
]


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(
            lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )

    # A complete run: score all documents, write predictions, report, statistics.
    train = documents.model_input(
        frames.labelled(spark, sf_dir, "lang").withColumnRenamed("sentiment", "label"), "lang"
    )
    chosen = next(c for c in CANDIDATES if c.name == "high_data_accuracy_logreg")
    model = fit_candidate(train.select("row_id", "label", "model_input"), chosen)
    folder = tempfile.mkdtemp(prefix="bench-")
    source = f"{folder}/documents"
    frames.docs(spark, sf_dir, "lang").write.parquet(source)
    n_docs = spark.read.parquet(source).count()
    seconds["run"] = timed(
        lambda: jobs.run(
            spark, source, f"{folder}/out", model, fmt="parquet", category_col="lang"
        )
    )

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir),
                "run_docs_per_second": round(n_docs / seconds["run"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
