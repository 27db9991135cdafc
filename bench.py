"""Times the headline analyses; prints one JSON line.

Model entries time fit, batch scoring and the metric job on prepared rows, as
the baseline does; `prepare` is the assembly, scaling and split before them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.operators import classifiers, evaluation  # noqa: E402
from ledgerlens.plans import catalogue, studies  # noqa: E402
from ledgerlens.plans.fixture import KEY, transactions  # noqa: E402

TABLE_QUERIES = [
    "class_distribution",
    "hourly_class_counts",
    "amount_histogram",
    "boxplot_stats",
    "correlation_matrix",
    "undersample",
    "standard_scale",
    "naive_bayes_report",
    "threshold_sweep",
    "boost_histogram_level",
    "dbscan_clusters",
]
MODELS = {
    "linear_svc": ("linear_svc", {}),
    "logistic_regression": ("logistic_regression", {}),
    "decision_tree": ("decision_tree", {}),
    "gbt": ("gradient_boosted_trees", {}),
    "random_forest": ("random_forest", {"numTrees": 500}),
    "mlp": ("multilayer_perceptron", {}),
    "boosted_trees": ("boosted_trees", {"n_estimators": 50, "max_depth": 4}),
    "dense_net": ("dense_net", {"epochs": 20}),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    # Start the JVM's and Python's workers outside the clock.
    drain(catalogue.QUERIES["row_counts"](spark, folder))
    for name in TABLE_QUERIES:
        timed(name, lambda: drain(catalogue.QUERIES[name](spark, folder)))

    def prepare():
        train, test = (part.cache() for part in studies.prepare(transactions(spark, folder), KEY))
        train.count(), test.count()
        return train, test

    train, test = timed("prepare", prepare)
    quality = {}
    for name, (family, settings) in MODELS.items():

        def run():
            model = classifiers.fit(studies.FAMILIES[family](**settings), train)
            return evaluation.classification_report(classifiers.predict(model, test)).first()

        quality[name] = round(timed(name, run).f1, 4)

    line = {
        "metric": "fraud_analytics_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "f1": quality,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
