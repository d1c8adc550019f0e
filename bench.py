"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandpanel.operators import calendar as cal  # noqa: E402
from demandpanel.operators import classify, features  # noqa: E402
from demandpanel.plans import pipeline  # noqa: E402
from demandpanel.plans.policies import spec_for  # noqa: E402
from registry import panels, queries  # noqa: E402


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="demandpanel-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # The bench tables are a few megabytes: keep all cores busy on them.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _lumpy_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = queries.prepared(spark, sf, panels.part_month)
    return features.lag_features(rows, spec_for("Lumpy"))


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.training_frame(queries.prepared(spark, sf, panels.part_month), 12)


def _future(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.future_frame(queries.prepared(spark, sf, panels.part_month), 6, "MS", 12)


HEADLINE = {
    "read_series_panel": queries.read_series_panel,
    "fill_calendar": lambda s, sf: cal.fill_calendar(panels.part_month(s, sf), "MS"),
    "clean_all": lambda s, sf: queries.cleaned(s, sf, panels.part_month),
    "classify_demand": lambda s, sf: classify.classify_demand(
        queries.cleaned(s, sf, panels.part_month)
    ),
    "class_distribution": queries.class_distribution,
    "prepare_panel": lambda s, sf: queries.prepared(s, sf, panels.part_month),
    "lag_features_lumpy": _lumpy_features,
    "training_frame": _training,
    "future_frame": _future,
    "cv_folds": queries.cv_folds,
    "forecast_parts": queries.QUERIES["forecast_parts"],
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Start the JVM's SQL machinery outside the clock.
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name, query in HEADLINE.items():
        start = time.perf_counter()
        query(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
