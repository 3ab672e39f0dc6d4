import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskflow.operators import metrics
from riskflow.operators.profiling import class_distribution
from tests.conftest import plan_of, rows


def frame(spark, data):
    return spark.createDataFrame(data, "label int, score double").repartition(3)


def pairwise_auc(data):
    positive = [s for y, s in data if y == 1]
    negative = [s for y, s in data if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return won / (len(positive) * len(negative))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.1000001, 0.5, 0.9, 1.0])), max_size=40))
def test_auc_equals_pairwise(spark, data):
    data = data + [(0, 0.3), (1, 0.4)]
    found = metrics.auc_exact(frame(spark, data), "label", "score", steps=3).first()
    assert found.auc == pytest.approx(pairwise_auc(data), abs=1e-12)
    assert (found.n_positive, found.n_negative) == (sum(y for y, _ in data), sum(1 - y for y, _ in data))


def test_auc_with_clustered_scores(spark):
    pick = random.Random(3)
    data = [(pick.randrange(2), 0.5 + pick.random() * 1e-9) for _ in range(400)]
    assert metrics.auc_exact(frame(spark, data), "label", "score").first().auc == pytest.approx(pairwise_auc(data))


def test_auc_of_one_class_is_an_error(spark):
    with pytest.raises(PySparkException, match="both classes"):
        metrics.auc_exact(frame(spark, [(1, 0.2), (1, 0.7)]), "label", "score").collect()


def test_auc_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "scored")
    frame(spark, [(i % 2, i / 100) for i in range(100)]).write.parquet(path)
    result = metrics.auc_exact(spark.read.parquet(path), "label", "score")
    result.collect()
    final = plan_of(result).split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len(scans) <= 1 and "Exchange" in final
    assert all("filter(" not in line for line in scans)


def test_confusion_matrix_keeps_empty_cells(spark):
    data = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, given int")
    assert rows(metrics.confusion_matrix(data, "label", "given")) == [(0, 0, 0), (0, 1, 1), (1, 0, 0), (1, 1, 2)]


def test_report_by_hand(spark):
    data = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4, "label int, given int")
    found = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(data, "label", "given").collect()}
    p0, r0, p1, r1 = 4 / 5, 4 / 6, 3 / 5, 3 / 4
    f0, f1 = 2 * p0 * r0 / (p0 + r0), 2 * p1 * r1 / (p1 + r1)
    assert found["0"] == pytest.approx((p0, r0, f0, 6))
    assert found["1"] == pytest.approx((p1, r1, f1, 4))
    assert found["accuracy"] == (None, None, pytest.approx(0.7), 10)
    assert found["macro avg"] == pytest.approx(((p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, 10))
    assert found["weighted avg"] == pytest.approx(
        ((6 * p0 + 4 * p1) / 10, (6 * r0 + 4 * r1) / 10, (6 * f0 + 4 * f1) / 10, 10)
    )


def test_report_without_predicted_positives(spark):
    data = spark.createDataFrame([(1, 0), (0, 0)], "label int, given int")
    found = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(data, "label", "given").collect()}
    assert found["1"] == (0.0, 0.0, 0.0, 1)


def test_thresholds_share_one_pass(spark):
    data = frame(spark, [(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.1)])
    report = metrics.threshold_report(data, "label", "score", [0.5, 0.7])
    assert [tuple(r)[:5] for r in report.collect()] == [(0.5, 1, 1, 0, 2), (0.7, 2, 0, 1, 1)]
    assert "Join" not in plan_of(report)


def test_class_distribution(spark):
    data = spark.range(8).select((F.col("id") < 2).cast("int").alias("y"))
    assert sorted(rows(class_distribution(data, "y"))) == [(0, 6, 0.75), (1, 2, 0.25)]
