"""Time the headline queries on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from opinara.catalog.queries import QUERIES  # noqa: E402
from opinara.catalog.tables import KEY, train_and_test  # noqa: E402
from opinara.operators.sampling import hash_sample  # noqa: E402
from opinara.plans.models import full_pipeline  # noqa: E402

HEADLINE = (
    "prep_reviews",
    "stratified_split",
    "hist_char_length",
    "length_summary",
    "length_density",
    "top_words_by_class",
    "accuracy_by_length",
    "metrics",
    "roc_points",
    "top_false_positives",
    "vocabulary",
    "bigram_vocabulary",
    "tfidf_terms",
    "features_tfidf",
    "nb_predict",
    "train_nb",
    "train_lr",
    "score_batch",
    "score_stream",
)


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("opinara-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("accuracy_by_length")  # start-up is not what is measured
    seconds = {name: round(timed(lambda: run(name)), 3) for name in HEADLINE}

    # The one published rate: rows per second of fitting logistic regression on term counts. A fit has fixed
    # costs, so it is taken at three sizes and the rate between the smallest and the largest is shown as well.
    train, _ = train_and_test(spark, sf_dir)
    train = train.select(KEY, "label", "combined_text").persist()
    train.count()
    fits = []
    for share in (0.25, 0.5, 1.0):
        part = hash_sample(train, KEY, share).select("label", "combined_text").persist()
        rows, size = part.count(), part.agg(F.sum(F.octet_length("combined_text"))).first()[0] or 0
        pipeline = full_pipeline("count_vectorizer", "logistic_regression")
        fits.append((rows, size, timed(lambda: pipeline.fit(part))))
        part.unpersist()
    rows, size, fit = fits[-1]
    more_rows, more_bytes, more = (large - small for large, small in zip(fits[-1], fits[0]))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "lr_fit_rows": rows,
                "lr_fit_sec": round(fit, 3),
                "lr_fit_rows_per_sec": round(rows / fit, 1),
                "lr_fit_sizes": [{"rows": r, "bytes": b, "sec": round(t, 3)} for r, b, t in fits],
                "lr_fit_marginal_rows_per_sec": round(more_rows / more, 1) if more > 0 else None,
                "lr_fit_marginal_bytes_per_sec": round(more_bytes / more, 1) if more > 0 else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
