from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.operators import scoring
from riskflow.sources.adapters import table, transfers_from_orders
from riskflow.sources.scratch import scratch_path
from riskflow.streaming.jobs import account_windows, drain, score_stream
from tests.conftest import plan_of, rows


def test_rule_bands(spark):
    amounts = [50000.01, 50000.0, 20000.01, 20000.0, -1.0, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "id int, amount double")
    scored = scoring.with_verdict(scoring.with_prediction(scoring.rule_scores(df, "amount", "id")))
    found = [r for r in scored.orderBy("id").collect()]
    ranges = [(0.7, 0.95), (0.4, 0.7), (0.4, 0.7), (0.05, 0.4), (0.05, 0.4), (0.05, 0.4)]
    for r, (low, high) in zip(found, ranges):
        assert low <= r.LaunderingProbability <= high
        assert round(r.LaunderingProbability, 4) == r.LaunderingProbability
        assert r.Prediction == int(r.LaunderingProbability >= 0.5)
        assert r.verdict == ("Likely Laundering" if r.Prediction else "Not Laundering")
    again = scoring.rule_scores(df.repartition(4), "amount", "id").orderBy("id").collect()
    assert [r.LaunderingProbability for r in again] == [r.LaunderingProbability for r in found]


def test_missing_columns_get_defaults_and_nulls_stay(spark):
    df = spark.createDataFrame([("a", None, 7)], "From_Account string, TotalAmount double, NumFormats int")
    filled = scoring.fill_missing_columns(df).first().asDict()
    assert filled["TotalAmount"] is None and filled["NumFormats"] == 7
    for name, value in S.DEFAULT_FEATURES.items():
        if name not in ("TotalAmount", "NumFormats"):
            assert filled[name] == value
    assert scoring.fill_missing_columns(df, fill_nulls=True).first().TotalAmount == 20000.0
    assert len(S.FEATURE_LISTS["boosted"]) == 9 and "StdDevAmount" not in S.FEATURE_LISTS["gbt"]


def test_batch_needs_an_account(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, amount double")
    with pytest.raises(ValueError, match="From_Account"):
        scoring.score_batch_by_rule(df, "amount", "id")


def test_batch_scoring_does_not_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "From_Account string, id int, amount double")
    plan = plan_of(scoring.score_batch_by_rule(df, "amount", "id"))
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonRDD", "")


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_scores_equal_batch_scores(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    orders = table(spark, sf_dir, "orders")
    orders.repartition(4).write.parquet(source)
    batch = scoring.score_batch_by_rule(transfers_from_orders(orders), "Amount_Paid", "transaction_id")
    stream = transfers_from_orders(stream_of(spark, source, orders.schema))
    scored = score_stream(stream, "Amount_Paid", "transaction_id")
    result = drain(scored, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert sorted(rows(result), key=repr) == sorted(rows(batch), key=repr)
    # A second run over the same input finds nothing new.
    assert drain(scored, str(tmp_path / "out"), str(tmp_path / "progress")).count() == orders.count()


def test_stream_windows(spark, tmp_path):
    data = [
        ("2024-01-01 01:00:00", "a", 5, "USD", 1),
        ("2024-01-01 09:00:00", "a", 7, "EUR", 9),
        ("2024-01-01 10:00:00", "b", 1, "EUR", 10),
        ("2024-01-02 00:30:00", "a", 2, "EUR", 0),
        ("2024-01-02 02:00:00", "b", 4, "EUR", 2),
    ]
    df = spark.createDataFrame(data, "t string, From_Account string, amount int, Payment_Currency string, Hour int").select(
        F.col("t").cast("timestamp_ntz").alias("Timestamp"),
        "From_Account",
        F.col("amount").cast("decimal(20,6)").alias("Amount_Paid"),
        "Payment_Currency",
        "Hour",
    )
    source = str(tmp_path / "in")
    df.coalesce(1).write.parquet(source)
    windows = account_windows(stream_of(spark, source, df.schema))
    found = drain(windows, str(tmp_path / "out"), str(tmp_path / "progress"))
    # The watermark is 01:00 on the second day, so only the first day is closed.
    assert sorted(rows(found.select("From_Account", "TxnCount", "TotalAmount", "ApproxCurrencies", "HourBucket"))) == [
        ("a", 2, 12.0, 2, 1),
        ("b", 1, 1.0, 1, 10),
    ]
    assert {str(r[0]) for r in found.select("window_end").collect()} == {"2024-01-02 00:00:00"}


def test_scratch_paths_follow_the_session_setting(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.endswith("/x")

    class Conf:
        def __init__(self, named):
            self.get = lambda key, default: named if key == "spark.checkpoint.dir" else default

    def session(named, master):
        return SimpleNamespace(conf=Conf(named), sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("hdfs://shared/dir/", "yarn"), "x").startswith("hdfs://shared/dir/riskflow-")
    assert scratch_path(session("/mnt/shared", "local[2]"), "x").startswith("/mnt/shared/riskflow-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session(None, "yarn"), "x")
