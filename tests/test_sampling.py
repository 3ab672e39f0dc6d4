import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.functions.columns import bucket_of, hash_uniform
from riskflow.operators import sampling
from riskflow.operators.ordering import dense_index
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def dataset(spark):
    return spark.range(1000).select(
        F.concat(F.lit("a"), "id").alias("From_Account"), (F.col("id") % 8 == 0).cast("int").alias("IsLaundering")
    )


def test_uniform(spark, dataset):
    u = [r[0] for r in dataset.select(hash_uniform("From_Account")).collect()]
    assert all(0 <= x < 1 for x in u) and len(set(u)) == len(u)
    assert abs(sum(u) / len(u) - 0.5) < 0.05
    assert u != [r[0] for r in dataset.select(hash_uniform("From_Account", 7)).collect()]


def test_hash_split_is_complete_and_stable(dataset):
    train, test = sampling.hash_split(dataset, "From_Account")
    a, b = set(rows(train)), set(rows(test))
    assert not a & b and a | b == set(rows(dataset))
    assert 740 < len(a) < 860
    again, _ = sampling.hash_split(dataset.repartition(9), "From_Account")
    assert set(rows(again)) == a
    assert "Exchange" not in plan_of(train)


def test_null_keys_stay_in_the_split(spark):
    df = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    train, test = sampling.hash_split(df, "k", 0.5)
    assert train.count() + test.count() == 2


@pytest.mark.parametrize("share", [0.7, 0.333])
def test_stratified_split_is_exact_per_class(dataset, share):
    split = sampling.stratified_split(dataset, "IsLaundering", "From_Account", share)
    sizes = Counter((r.IsLaundering, r.split) for r in split.collect())
    for label, n in ((0, 875), (1, 125)):
        train = math.floor(n * share + 0.5)
        assert sizes[label, "train"] == train and sizes[label, "test"] == n - train
    again = sampling.stratified_split(dataset.repartition(5), "IsLaundering", "From_Account", share)
    assert set(rows(again)) == set(rows(split))


def test_rows_without_class_stay(spark):
    df = spark.range(50).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).cast("int").alias("y"))
    assert sampling.stratified_split(df, "y", "id").count() == 50


def test_dense_index(dataset):
    found = dense_index(dataset, hash_uniform("From_Account"), ["From_Account"], "i", buckets=16).collect()
    assert sorted(r.i for r in found) == list(range(1000))


def test_sample_and_relabel(dataset):
    sample = rows(sampling.exact_sample(dataset, "From_Account", 100))
    assert len(set(sample)) == 100
    assert set(rows(sampling.exact_sample(dataset.repartition(6), "From_Account", 100))) == set(sample)
    both = rows(sampling.with_relabelled_sample(dataset, "IsLaundering", "From_Account", 100))
    assert Counter(both) - Counter(rows(dataset)) == Counter((a, 1) for a, _ in sample)


@pytest.mark.parametrize("grow", [sampling.oversample_bootstrap, sampling.oversample_replicate])
@pytest.mark.parametrize("per_row", [1 << 16, 2])
def test_oversampling(dataset, monkeypatch, grow, per_row):
    monkeypatch.setattr(sampling, "COPIES_PER_ROW", per_row)
    grown = Counter(rows(grow(dataset, "IsLaundering", "From_Account")))
    original = Counter(rows(dataset))
    assert not original - grown
    classes = Counter()
    for (_, label), n in grown.items():
        classes[label] += n
    assert classes[0] == classes[1] == 875
    extra = grown - original
    assert {label for _, label in extra} == {1}
    if grow is sampling.oversample_replicate:
        assert set(extra.values()) == {6} and len(extra) == 125
    else:
        assert len(set(extra.values())) > 3


def test_single_class_is_an_error(dataset):
    with pytest.raises(ValueError, match="both present"):
        sampling.oversample_bootstrap(dataset.where("IsLaundering = 0"), "IsLaundering", "From_Account")
    with pytest.raises(ValueError, match="both present"):
        sampling.class_sizes(dataset.withColumn("IsLaundering", F.lit(2)), "IsLaundering")


def test_rows_without_a_key_are_spread(spark):
    """They are numbered in as many buckets as their rows have hashes, not in that of the null key."""
    data = spark.range(2000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("x"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    for balance in (sampling.oversample_bootstrap, sampling.oversample_replicate):
        assert dict(rows(balance(data, "label", "k").groupBy("label").count())) == {0: 1600, 1: 1600}
    buckets = data.select(bucket_of(sampling._row_uniform(data, "k", 1), 1 << 16).alias("b")).distinct().count()
    assert buckets > 1900
