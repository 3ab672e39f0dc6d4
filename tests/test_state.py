import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.operators import sketches, state
from riskflow.operators.features import account_features
from riskflow.schemas import ACCOUNT_STATE
from tests.conftest import plan_of, rows
from tests.test_features import SCHEMA, sample_rows

EXACT = ["From_Account", "TxnCount", "TotalAmount", "AvgAmount", "MaxAmount", "MinAmount", "NumCurrencies", "NumFormats", "HourBucket"]


@pytest.fixture(scope="module")
def data():
    return sample_rows() + [(None, Decimal("3.5"), "USD", "F1", 4), ("none", None, "USD", "F2", 5), ("none", None, None, None, None)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def features(df):
    return {r[0]: tuple(r)[1:] for r in df.select(EXACT).collect()}, {r.From_Account: r.StdDevAmount for r in df.collect()}


def same(found, expected):
    assert found[0] == expected[0]
    assert found[1].keys() == expected[1].keys()
    for account, spread in expected[1].items():
        other = found[1][account]
        assert (spread is None) == (other is None)
        assert spread is None or math.isclose(spread, other, rel_tol=1e-9, abs_tol=1e-9), account


def test_state_features_equal_account_features(spark, data):
    tx = frame(spark, data)
    same(features(state.state_features(state.account_state(tx))), features(account_features(tx, stddev=True)))


@pytest.mark.parametrize("seed", range(3))
def test_any_division_merges_to_the_whole(spark, data, seed):
    pick = random.Random(seed)
    parts = [[] for _ in range(4)]
    for r in data:
        parts[pick.randrange(3)].append(r)  # the last part stays empty
    states = [state.account_state(frame(spark, p) if p else spark.createDataFrame([], SCHEMA)) for p in parts]
    pick.shuffle(states)
    once = states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])
    nested = state.merge_states(states[0].unionByName(states[1])).unionByName(state.merge_states(states[2].unionByName(states[3])))
    whole = features(account_features(frame(spark, data), stddev=True))
    same(features(state.state_features(state.merge_states(once))), whole)
    same(features(state.state_features(state.merge_states(nested))), whole)
    assert once.schema.names == ACCOUNT_STATE.names


def test_spread_of_large_amounts(spark):
    """Small spreads around a large mean survive merging."""
    amounts = [Decimal(10**12) + Decimal(k) / 100 for k in (0, 1, 2, 50, 51, 99)]
    parts = [frame(spark, [("a", x, "USD", "F", 1)]) for x in amounts]
    merged = state.account_state(parts[0])
    for p in parts[1:]:
        merged = state.merge_states(merged.unionByName(state.account_state(p)))
    numbers = [float(x - 10**12) for x in amounts]
    mean = sum(numbers) / len(numbers)
    expected = math.sqrt(sum((x - mean) ** 2 for x in numbers) / (len(numbers) - 1))
    assert math.isclose(state.state_features(merged).first().StdDevAmount, expected, rel_tol=1e-3)


def test_a_lone_state_stays(spark, data):
    one = state.account_state(frame(spark, data))
    key = lambda df: sorted(rows(df.select(*[F.col(c) for c in ACCOUNT_STATE.names])), key=repr)
    assert key(state.merge_states(one)) == key(one)


def test_store_replaces_and_compacts(spark, data, tmp_path):
    store, newer = str(tmp_path / "store"), str(tmp_path / "newer")
    thirds = [frame(spark, data[k::3]) for k in range(3)]
    state.add_batch(frame(spark, data), store, "2022/09=01")
    state.add_batch(thirds[0], store, "2022/09=01")  # the same batch again, corrected
    state.add_batch(thirds[1], store, "007")
    merged = state.add_batch(thirds[2], store, "third")
    whole = features(account_features(frame(spark, data), stddev=True))
    same(features(state.state_features(merged)), whole)
    assert {r.batch for r in state.read_states(spark, store).select("batch").distinct().collect()} == {"2022/09=01", "007", "third"}
    assert state.read_states(spark, store, ["007"]).count() == state.account_state(thirds[1]).count()
    state.compact(spark, store, ["2022/09=01", "007"], "first two", newer)
    assert {r.batch for r in state.read_states(spark, newer).select("batch").distinct().collect()} == {"first two", "third"}
    same(features(state.state_features(state.merge_states(state.read_states(spark, newer)))), whole)
    with pytest.raises(ValueError, match="name"):
        state.write_batch(merged, store, "")


def test_empty_state(spark):
    none = state.account_state(spark.createDataFrame([], SCHEMA))
    assert state.state_features(state.merge_states(none)).collect() == []


def test_state_reduces_before_the_shuffle(spark, data):
    plan = plan_of(state.account_state(frame(spark, data)))
    assert "partial_sum" in plan and plan.count("Scan ExistingRDD") == 1


# Sketches


def numbers_frame(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 6000, F.concat(F.lit("k"), F.col("id") % 5))
    rows_ = spark.range(n).select(
        key.alias("k"), (F.col("id") % 7).alias("day"), F.col("id").alias("many"), (F.col("id") % 100).cast("string").alias("few"),
        F.when(F.col("id") % 11 > 0, F.hash("id") / 1000.0).alias("x"), F.lit(None).cast("string").alias("nothing"),
    )
    return rows_


def test_estimates_stay_within_their_error(spark):
    data = numbers_frame(spark)
    daily = sketches.sketch(data, ["k"], ["many", "few", "nothing"], "x", F.col("day"))
    merged = sketches.estimates(sketches.merge_sketches(daily, ["k"]))
    exact = data.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("many").alias("many"), F.count_distinct("few").alias("few"), F.sort_array(F.collect_list("x")).alias("x")
    )
    expected = {r.k: r for r in exact.collect()}
    found = merged.collect()
    assert {r.k for r in found} == expected.keys() and None in expected
    for r in found:
        e = expected[r.k]
        assert r.n == e.n and r.Numfew == e.few and r.Numnothing == 0
        assert abs(r.Nummany - e.many) <= 3 * sketches.distinct_error() * e.many
        if e.many <= 1 << sketches.DISTINCT_BITS:
            assert r.Nummany == e.many
        for q in sketches.QUANTILES:
            value = r[f"x_q{q * 100:g}"]
            below, upto = sum(v < value for v in e.x) / len(e.x), sum(v <= value for v in e.x) / len(e.x)
            assert below <= q + sketches.rank_error() and upto >= q - sketches.rank_error()


def test_merging_sketches_in_any_way(spark):
    data = numbers_frame(spark, 3000)
    daily = sketches.sketch(data, ["k"], ["many", "few"], "x", F.col("day"))
    assert daily.count() == data.select("k", "day").distinct().count()
    direct = sketches.estimates(sketches.sketch(data, ["k"], ["many", "few"], "x")).select("k", "n", "Nummany", "Numfew")
    halves = sketches.merge_sketches(daily.where("period < 3"), ["k"]).unionByName(sketches.merge_sketches(daily.where("period >= 3"), ["k"]))
    twice = sketches.estimates(sketches.merge_sketches(halves, ["k"])).select("k", "n", "Nummany", "Numfew")
    assert sorted(rows(direct), key=repr) == sorted(rows(twice), key=repr)


def test_sketches_of_little(spark):
    data = spark.createDataFrame([("a", "2020", None, None), (None, None, "v", 1.5)], "k string, day string, v string, x double")
    found = {r.k: r for r in sketches.estimates(sketches.sketch(data, ["k"], ["v"], "x", F.col("day"))).collect()}
    assert found["a"].Numv == 0 and found["a"].x_q50 is None
    assert found[None].Numv == 1 and found[None].x_q50 == 1.5 and found[None].period is None
    assert sketches.estimates(sketches.merge_sketches(sketches.sketch(data.limit(0), ["k"], ["v"], "x"), ["k"])).collect() == []
