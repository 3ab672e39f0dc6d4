import math
import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.operators.features import account_features, account_totals, distinct_counts, typical_hours
from riskflow.operators.labels import account_labels, features_with_bank_labels, features_with_labels
from tests.conftest import plan_of, rows

SCHEMA = "From_Account string, Amount_Paid decimal(20,6), Payment_Currency string, Payment_Format string, Hour int"


def sample_rows(n=600):
    pick = random.Random(7)
    data = []
    for _ in range(n):
        account = "hot" if pick.random() < 0.4 else f"a{pick.randrange(40)}"
        data.append(
            (
                account,
                Decimal(pick.randrange(1, 10**7)) / 100,
                pick.choice(["USD", "EUR", "JPY", None]),
                pick.choice([f"F{i}" for i in range(80)]),
                pick.choice([None, *range(24)]),
            )
        )
    return data + [("single", Decimal("5.00"), None, "F1", None), ("same", Decimal("1.1"), "USD", "F1", 3)] + [
        ("same", Decimal("1.1"), "USD", "F1", 9)
    ] * 2


def by_hand(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    result = {}
    for account, g in groups.items():
        amounts = [r[1] for r in g]
        hours = sorted(r[4] for r in g if r[4] is not None)
        result[account] = (
            len(g),
            float(sum(amounts)),
            float(max(amounts)),
            float(min(amounts)),
            float(statistics.stdev(amounts)) if len(g) > 1 else None,
            len({r[2] for r in g} - {None}),
            len({r[3] for r in g} - {None}),
            hours[(len(hours) - 1) // 2] if hours else None,
        )
    return result


def test_features_by_hand(spark):
    data = sample_rows()
    tx = spark.createDataFrame(data, SCHEMA).repartition(7)
    found = {
        r.From_Account: (
            r.TxnCount,
            r.TotalAmount,
            r.MaxAmount,
            r.MinAmount,
            r.StdDevAmount,
            r.NumCurrencies,
            r.NumFormats,
            r.HourBucket,
        )
        for r in account_features(tx, stddev=True).collect()
    }
    expected = by_hand(data)
    assert found.keys() == expected.keys()
    for account, e in expected.items():
        f = found[account]
        assert f[:4] + f[5:] == e[:4] + e[5:], account
        assert (f[4] is None and e[4] is None) or math.isclose(f[4], e[4], rel_tol=1e-9, abs_tol=1e-12), account
    assert found["same"][4] == 0.0
    hours = dict(rows(typical_hours(tx)))
    counts = {r[0]: r[1:] for r in rows(distinct_counts(tx))}
    assert all(hours[a] == e[7] and counts[a] == e[5:7] for a, e in expected.items())


@pytest.mark.parametrize(
    "amounts",
    [
        ["0.002", "0.004"],
        ["0.01", "0.011", "0.013"],
        ["1000000000", "1000000001", "1000000002"],
        ["50000000.10", "50000000.20", "50000000.30", "50000000.40"],
        ["0.000001", "0.000002", "99999999999999.999999"],
    ],
)
def test_spread_of_tiny_and_of_large_amounts(spark, amounts):
    data = [("a", Decimal(x), f"c{i % 2}", f"f{i}", i % 3) for i, x in enumerate(amounts)]
    found = account_features(spark.createDataFrame(data, SCHEMA).repartition(3), stddev=True).first().StdDevAmount
    assert math.isclose(found, float(statistics.stdev(map(Decimal, amounts))), rel_tol=1e-7)


def test_features_do_not_depend_on_layout(spark):
    tx = spark.createDataFrame(sample_rows(), SCHEMA)
    layouts = [account_features(tx.repartition(n), stddev=True).withColumn("StdDevAmount", F.round("StdDevAmount", 4)) for n in (1, 13)]
    one, many = (sorted(rows(x), key=repr) for x in layouts)
    assert one == many


def test_median_of_a_long_even_group_is_exact(spark):
    tx = spark.range(60000).select(
        F.lit("a").alias("From_Account"),
        F.lit(1).cast("decimal(20,6)").alias("Amount_Paid"),
        F.lit("c").alias("Payment_Currency"),
        F.lit("f").alias("Payment_Format"),
        F.when(F.col("id") < 30000, 4).otherwise(17).alias("Hour"),
    )
    assert account_features(tx).first().HourBucket == 4 and typical_hours(tx).first().HourBucket == 4


def test_odd_and_absent_category_values(spark):
    odd = ['a"b', "c'd", "back\\slash", "tab\t,comma", "é漢", ""]
    tx = spark.createDataFrame([("x", Decimal(1), v, None, 1) for v in odd + odd[:2]], SCHEMA)
    row = account_features(tx).first()
    assert (row.NumCurrencies, row.NumFormats) == (6, 0)


def test_plans(spark, sf_dir):
    from riskflow.sources.adapters import table, transfers_from_events

    tx = transfers_from_events(table(spark, sf_dir, "events"))
    plan = plan_of(account_features(tx))
    # One read of the source; the exchanges after the first hold one row per combination.
    assert plan.count("FileScan") == 1
    assert "SinglePartition" not in plan and "Python" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan
    assert plan_of(typical_hours(tx)).count("Exchange hashpartitioning") == 1


def test_totals(spark):
    tx = spark.createDataFrame(
        [("a", Decimal("1")), ("a", Decimal("2")), ("b", None), (None, Decimal("9"))],
        "From_Account string, Amount_Paid decimal(20,6)",
    )
    assert rows(account_totals(tx)) == [("a", 3.0, 2, 1.5)]


def test_labels(spark):
    labels = spark.createDataFrame(
        [("010", "a", "0"), ("010", "a", "1"), ("7", "b", "0"), ("x", "c", "bad")],
        "From_Bank string, From_Account string, isLaundering string",
    )
    features = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("10",), ("7",)], "From_Account string")
    joined = features_with_labels(features, account_labels(labels))
    assert sorted(rows(joined)) == [("10", 0), ("7", 0), ("a", 1), ("b", 0), ("c", 0), ("d", 0)]
    by_bank = features_with_bank_labels(features, labels)
    assert sorted(rows(by_bank)) == [("10", 1), ("7", 0), ("a", 0), ("b", 0), ("c", 0), ("d", 0)]
