"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query is run
once to warm up the JVM and then timed, result rows written to nowhere.
"""

from __future__ import annotations

import json
import os
import time

from brooktext.functions.features import TRAIN_WIDTH, hash_features
from brooktext.plans.queries import QUERIES, _texts
from brooktext.session import local_session
from brooktext.sources.tables import read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "wire_parse",
    "tokenize",
    "token_count",
    "hashing_tf_300",
    "hashing_tf_1000",
    "features_and_label",
    "batch_key_count",
    "running_key_count",
    "rate_limited_scan",
    "label_index_per_batch",
    "nb_counts",
    "nb_predict",
    "sgd_predict",
    "kmeans_step",
    "kmeans_predict",
    "batch_metrics",
    "lr_predict",
    "mlp_predict",
    "score_all",
    "train_nb",
    "train_all",
    "lr_grid_search",
    "score_stream",
]


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, app="bench", memory="16g")
    seconds = {}
    for name in HEADLINE:
        def run(name=name):
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(timed(run), 3)
    documents = read_table(spark, SF_DIR, "documents").count()
    labelled = read_table(spark, SF_DIR, "labels").count()
    events = read_table(spark, SF_DIR, "events").count()
    hashing = timed(
        lambda: hash_features(_texts(spark, SF_DIR), TRAIN_WIDTH).write.format("noop").mode("overwrite").save()
    )
    per_second = {
        "tokenize_and_hash": documents / hashing,
        "naive_bayes_update": labelled / seconds["nb_counts"],
        "running_key_count": events / seconds["running_key_count"],
        "train_all": labelled / seconds["train_all"],
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows_per_sec": {name: round(rate) for name, rate in per_second.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
