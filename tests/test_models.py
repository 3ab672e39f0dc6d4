import pytest
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions.columns import hash_uniform
from riskflow.operators import models, scoring
from riskflow.operators.metrics import auc_exact
from riskflow.operators.sampling import hash_split
from riskflow.plans import jobs
from riskflow.sources.readers import read_ml_dataset
from riskflow.sources.scratch import scratch_path
from riskflow.sources.sinks import write_csv
from riskflow.streaming.jobs import drain
from tests.conftest import rows

GBT = S.FEATURE_LISTS["gbt"]
SMALL = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.1}


@pytest.fixture(scope="module")
def dataset(spark):
    """Two thirds positive, positives pay more: a label index by frequency would flip the classes."""
    base = spark.range(300).withColumn("u", hash_uniform("id"))
    label = (F.col("id") % 3 > 0).cast("int")
    amount = F.col("u") * 100 + label * 60
    return base.select(
        F.concat(F.lit("a"), "id").alias("From_Account"),
        F.lit(3).alias("TxnCount"),
        (amount * 3).alias("TotalAmount"),
        amount.alias("AvgAmount"),
        (amount * 2).alias("MaxAmount"),
        (amount / 2).alias("MinAmount"),
        F.when(F.col("id") == 7, None).otherwise(F.lit(1.0)).alias("StdDevAmount"),
        F.lit(1).alias("NumCurrencies"),
        F.lit(1).alias("NumFormats"),
        F.when(F.col("id") == 5, "no hour").otherwise("12").alias("HourBucket"),
        label.alias("IsLaundering"),
    )


@pytest.fixture(scope="module")
def fitted(dataset):
    view = models.valid_rows(models.numeric_view(dataset, GBT), GBT)
    return view, models.train(view, GBT, SMALL)


def test_invalid_features_are_null_then_left_out(dataset, fitted):
    view = models.numeric_view(dataset, GBT)
    assert view.where("HourBucket IS NULL").count() == 1
    assert fitted[0].count() == 299


def test_scores_point_at_class_one(fitted):
    scored = models.predict(*fitted)
    assert auc_exact(scored, "IsLaundering", "LaunderingProbability").first().auc > 0.7
    for r in scored.collect():
        assert r.Prediction == int(r.LaunderingProbability >= 0.5)


def test_save_load_and_batch(spark, dataset, fitted, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(fitted[1], path)
    batch = dataset.drop("IsLaundering", "MinAmount").withColumn("HourBucket", F.col("HourBucket").try_cast("double"))
    fresh = scoring.score_batch_by_model(batch, fitted[1])
    loaded = scoring.score_batch_by_model(batch, models.load_model(path))
    assert sorted(rows(fresh)) == sorted(rows(loaded))
    # The account without an hour has no score unless it is given the default; it is the only one without.
    assert fresh.count() == 300 and [r.From_Account for r in fresh.where("LaunderingProbability IS NULL").collect()] == ["a5"]
    assert fresh.where("Prediction IS NULL").count() == 1 and fresh.where("Imputed = 1").count() == 299  # MinAmount is a default
    filled = scoring.score_batch_by_model(batch, fitted[1], fill_nulls=True)
    assert filled.where("LaunderingProbability IS NULL").count() == 0 and filled.where("Imputed = 1").count() == 300


def test_stream_scored_by_model_equals_batch(spark, dataset, fitted, tmp_path):
    batch = dataset.select("From_Account", "TotalAmount", "MaxAmount", "AvgAmount")
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    scored = drain(
        scoring.score_batch_by_model(stream, fitted[1]), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    assert sorted(rows(scored)) == sorted(rows(scoring.score_batch_by_model(batch, fitted[1])))


def test_gain_names_the_features_that_split(fitted):
    gain = models.feature_gain(fitted[0], fitted[1], GBT, scratch_path(fitted[0].sparkSession, "trees")).collect()
    assert gain and {r.feature for r in gain} <= {"TotalAmount", "AvgAmount", "MaxAmount", "MinAmount"}
    assert [r.gain for r in gain] == sorted((r.gain for r in gain), reverse=True)


def test_compare(dataset):
    view = models.numeric_view(dataset, GBT)
    table = models.compare(view, {"a": (GBT, SMALL), "b": (GBT, {**SMALL, "maxIter": 2})}).collect()
    assert [r.model for r in table] == ["a", "b"]
    split = [models.valid_rows(x, GBT).count() for x in hash_split(view, "From_Account")]
    for r in table:
        assert 0.5 < r.auc <= 1 and (r.n_train, r.n_test, r.n_dropped) == (*split, 1)


def test_null_spread_is_zero_on_both_sides(spark, dataset):
    """An account without spread is scored as it was trained on."""
    boosted = S.FEATURE_LISTS["boosted"]
    rows_ = dataset.withColumn("HourBucket", F.lit(12)).withColumn(
        "StdDevAmount", F.when(F.col("IsLaundering") == 1, F.lit(2000.0) + F.rand(1))
    )
    view = models.numeric_view(scoring.fill_spread(rows_), boosted)
    assert view.where("StdDevAmount = 0").count() == view.where("label = 0").count() > 0
    model = models.train(view, boosted, SMALL)
    trained = {r.From_Account: r.LaunderingProbability for r in models.predict(view, model).collect()}
    batch = scoring.score_batch_by_model(rows_.drop("IsLaundering"), model).collect()
    assert {r.From_Account: r.LaunderingProbability for r in batch} == trained and {r.Imputed for r in batch} == {0}


def test_fits_repeat(fitted):
    again = models.train(fitted[0], GBT, SMALL)
    assert sorted(rows(models.predict(fitted[0], again))) == sorted(rows(models.predict(*fitted)))


def test_unscored_rows_are_counted_not_ranked(spark):
    scored = spark.createDataFrame([(1, 0.9), (1, None), (0, 0.1), (0, float("nan")), (1, 0.4)], "label int, s double")
    assert rows(auc_exact(scored, "label", "s")) == [(1.0, 2, 1, 2)]


def test_one_class_is_an_error(dataset):
    view = models.numeric_view(dataset.where("IsLaundering = 1"), GBT)
    with pytest.raises(ValueError, match="both present"):
        models.train(view, GBT, SMALL)


def test_jobs_end_to_end(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(S.BOOSTERS, "gbt_50", SMALL)
    header = "Timestamp,From Bank,Account,To Bank,Account,A,B,C,D,E,F\n"
    lines, log = [], []
    for i in range(120):
        account, amount = f"acc{i % 30}", (i % 30) * 100 + i
        line = f"2022/09/0{1 + i % 9} {i % 24:02d}:15,01,{account},02,B,{amount},Euro,{amount},Euro,Wire,0"
        lines.append(line)
        if i % 30 > 20:
            log += ["BEGIN LAUNDERING ATTEMPT - CYCLE:  Max 2", line[:-1] + "1", "END LAUNDERING ATTEMPT - CYCLE"]
    (tmp_path / "tx.csv").write_text(header + "\n".join(lines) + "\n")
    (tmp_path / "log.txt").write_text("\n".join(log) + "\n")
    at = lambda name: str(tmp_path / name)
    jobs.extract_labels(spark, at("log.txt"), at("labels"))
    dataset = jobs.build_dataset(spark, {"small": at("tx.csv")}, at("labels"), at("dataset"))
    assert dataset.count() == 30 and dataset.where("IsLaundering = 1").count() == 9
    assert sorted(rows(read_ml_dataset(spark, at("dataset")))) == sorted(rows(dataset))
    jobs.train_and_save(dataset, at("model"), "boosted")
    write_csv(dataset.drop("IsLaundering", "NumFormats"), at("batch"))
    jobs.score_files(spark, at("batch"), at("model"), at("scores"), dataset)
    scores = spark.read.csv(at("scores"), header=True)
    report = jobs.train_balanced(dataset, at("balanced"), booster="gbt_50").collect()
    assert [r.threshold for r in report] == [0.5, 0.7] and all(r.tn + r.fp + r.fn + r.tp < 30 for r in report)
    spread = jobs.build_dataset(spark, {"small": at("tx.csv")}, at("labels"), at("with_spread"))
    write_csv(spread, at("spread_csv"))
    assert sorted(rows(read_ml_dataset(spark, at("spread_csv"), csv=True).select(spread.columns)), key=repr) == sorted(rows(spread), key=repr)
    assert scores.count() == 30 and {"LaunderingProbability", "Prediction", "NumFormats"} <= set(scores.columns)
