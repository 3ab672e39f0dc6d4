import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.operators import models, scoring, trailing
from riskflow.operators.labels import features_with_labels
from riskflow.sources.sinks import bucketed_table
from riskflow.streaming.jobs import drain, score_stream_by_model
from tests.conftest import plan_of, rows
from tests.test_boosting import FEATURES, SMALL, plain_rows

SCHEMA = "From_Account string, Timestamp timestamp_ntz, Amount_Paid decimal(20,4), TrailingCount string, note string"
START = dt.datetime(2022, 3, 1)


def transactions(seed, n=400):
    pick = random.Random(seed)
    data = []
    for k in range(n):
        account = pick.choice(["hot", "hot", "hot", f"a{pick.randrange(9)}", None])
        at = START + dt.timedelta(minutes=pick.choice([pick.randrange(6000), 60 * pick.randrange(100)]))
        paid = pick.choice([None, *[Decimal(pick.randrange(1, 10**6)) / 100] * 9])
        data.append((account, pick.choice([at] * 20 + [None]), paid, "own", f"n{k}"))
    return data


def by_hand(data, period):
    found = {}
    for account, at, _, _, note in data:
        if at is None:
            found[note] = (None, None)
            continue
        near = [p for a, t, p, _, _ in data if a == account and t is not None and at - period < t <= at]
        found[note] = (len(near), sum((p for p in near if p is not None), Decimal(0)))
    return found


@pytest.mark.parametrize(("period", "delta"), [("1 day", dt.timedelta(days=1)), ("90 minute", dt.timedelta(minutes=90)), ("1 microsecond", dt.timedelta(microseconds=1))])
@pytest.mark.parametrize("slots", [1, 24])
def test_trailing_counts_by_hand(spark, period, delta, slots):
    data = transactions(period)
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = trailing.trailing_counts(frame, period, slots=slots)
    assert found.columns == ["From_Account", "Timestamp", "Amount_Paid", "note", "TrailingCount", "TrailingAmount"]
    assert {r.note: (r.TrailingCount, r.TrailingAmount) for r in found.collect()} == by_hand(data, delta)


def test_equal_and_repeated_rows(spark):
    data = [("a", START, Decimal(2), "x", "same")] * 5 + [("a", START + dt.timedelta(hours=24), Decimal(1), "x", "next")]
    found = rows(trailing.trailing_counts(spark.createDataFrame(data, SCHEMA)).select("note", "TrailingCount", "TrailingAmount"))
    assert sorted(found) == [("next", 1, Decimal(1))] + [("same", 5, Decimal(10))] * 5
    assert trailing.trailing_counts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_hot_account_is_spread(spark):
    """Rows of one account go to as many windows as it has slots."""
    plan = plan_of(trailing.trailing_counts(spark.createDataFrame(transactions(1), SCHEMA)))
    assert "hashpartitioning(_key" in plan and "_slot" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    features = spark.range(500).select(F.col("id").cast("string").alias("From_Account"), F.lit(1.5).alias("x"))
    found = spark.range(0, 500, 3).select(F.col("id").cast("string").alias("From_Account"), F.lit(1).alias("IsLaundering"))
    features = features.unionByName(spark.createDataFrame([(None, 2.0)], "From_Account string, x double"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = [bucketed_table(t, f"bucketed_{n}", str(tmp_path / n), "From_Account", 6) for n, t in (("features", features), ("labels", found))]
        joined = features_with_labels(*tables)
        assert "Exchange" not in plan_of(joined)
        assert sorted(rows(joined), key=repr) == sorted(rows(features_with_labels(features, found)), key=repr)
        per_account = tables[0].groupBy("From_Account").agg(F.sum("x"))
        assert "Exchange" not in plan_of(per_account)
        again = bucketed_table(found, "bucketed_labels", str(tmp_path / "labels2"), "From_Account", 6)
        assert again.count() == found.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(str(tmp_path / "features" / "*.parquet"))) <= 6


@pytest.fixture(scope="module")
def model(spark):
    view = spark.createDataFrame(plain_rows(), "From_Account string, a double, b double, c double, label double")
    return scoring.with_defaults(models.train(view, FEATURES, SMALL), {"a": 0.5, "b": 1.0, "c": 5.0}), view


def test_stream_scores_equal_batch_and_restart_writes_nothing_twice(spark, model, tmp_path, monkeypatch):
    fitted, view = model
    monkeypatch.setattr(scoring.S, "DEFAULT_FEATURES", {"a": 0, "b": 0, "c": 0})
    features = view.drop("label")
    arriving = spark.range(60).select("id", F.concat(F.lit("k"), F.col("id") * 9).alias("From_Account"), F.lit(0.25).alias("a"))
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(source)
        return drain(score_stream_by_model(stream, fitted, features), out, progress)

    arriving.where("id < 30").repartition(2).write.parquet(source)
    assert run().count() == 30
    arriving.where("id >= 30").coalesce(1).write.mode("append").parquet(source)
    scored = run()
    expected = scoring.score_batch_by_model(scoring.with_account_features(arriving, features), fitted)
    key = ["id", "From_Account", "a", "b", "c", "Imputed", "LaunderingProbability", "Prediction"]
    assert sorted(rows(scored.select(key)), key=repr) == sorted(rows(expected.select(key)), key=repr)
    assert expected.where("LaunderingProbability IS NULL").count() == expected.where("b IS NULL").count() > 0
    # A crash after the last batch was written and before it was committed: the batch runs again.
    last = max(glob.glob(f"{progress}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{progress}/commits/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    assert sorted(rows(run().select(key)), key=repr) == sorted(rows(expected.select(key)), key=repr)
    assert os.path.exists(last)
