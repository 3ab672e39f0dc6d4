"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  folder with the tables     (default /root/testdata/sf0.1)
    BENCH_CPUS    cores of the local session (default 8)

Each query runs twice to warm up and then `BENCH_RUNS` times (default 3); the best time counts.
Training, which is long, runs once.
"""

import glob
import json
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from riskflow.plans import queries as q
from riskflow.plans.oracles import ORACLES

HEADLINE = [
    "features_with_labels",
    "account_features",
    "account_stddev",
    "total_count_avg",
    "clean_transactions",
    "pattern_forward_fill",
    "pattern_transactions",
    "csv_roundtrip",
    "hash_split",
    "stratified_split",
    "oversample_bootstrap",
    "batch_score",
    "classification_report",
    "threshold_report",
    "auc_exact",
    "stream_rule_score",
    "gbt_train_score",
]
SLOW = {"gbt_train_score"}


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


# Controls are the same questions put to DuckDB, by the SQL that the tests hold the queries against, with as many
# threads. Questions that SQL has no form for have no control.


def duckdb_seconds(sql: str, sf_dir: str, cpus: str, runs: int) -> float:
    """Best time of the SQL over the same files, results fetched as Arrow."""
    con = duckdb.connect(config={"threads": int(cpus)})
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    best = float("inf")
    for _ in range(runs + 1):
        started = time.perf_counter()
        con.execute(sql).fetchall()
        best = min(best, time.perf_counter() - started)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    controls = "--controls" in sys.argv
    spark = session()
    times, controlled = {}, {}
    for name in HEADLINE:
        query = q.QUERIES[name]
        best = float("inf")
        for run in range(1 if name in SLOW else runs + 2):
            started = time.perf_counter()
            consume(query(spark, sf_dir))
            took = time.perf_counter() - started
            if run >= 2 or name in SLOW:
                best = min(best, took)
        times[name] = round(best, 3)
        if controls and name in ORACLES and name not in SLOW:
            controlled[name] = round(duckdb_seconds(ORACLES[name], sf_dir, os.environ.get("BENCH_CPUS", "8"), runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                **({"controls": controlled} if controls else {}),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
