import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions.columns import hash_uniform
from riskflow.operators import boosting, labels, models, scoring
from riskflow.operators.metrics import auc_exact
from riskflow.operators.sampling import class_weights
from riskflow.operators.stages import FillDefaults
from tests.conftest import rows

FEATURES = ["a", "b", "c"]
SMALL = boosting.Booster(rounds=3, depth=3, rate=0.3, bins=16)


def plain_rows(n=400, seed=1):
    pick = random.Random(seed)
    data = []
    for k in range(n):
        a, b = round(pick.random(), 3), pick.randrange(4)
        chance = 0.8 if (a > 0.6) == (b >= 2) else 0.15
        data.append((f"k{k}", a, float(b), 5.0, float(pick.random() < chance)))
    return data


@pytest.fixture(scope="module")
def view(spark):
    return spark.createDataFrame(plain_rows(), "From_Account string, a double, b double, c double, label double")


def by_hand(data, booster, weights=None):
    """The same trees with plain loops: a list of {node: (feature, cut, gain, n)} and the margins."""
    n, unit = len(data), boosting.UNIT
    weights = weights or [1.0] * n
    xs = [r[1:4] for r in data]
    cuts = []
    for f in range(3):
        ordered = sorted(x[f] for x in xs)
        cuts.append(sorted({ordered[math.ceil(k / booster.bins * n) - 1] for k in range(1, booster.bins)}))
    margins, trees = [0.0] * n, []
    for _ in range(booster.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [math.floor((q - r[4]) * w * unit + 0.5) for q, r, w in zip(p, data, weights, strict=True)]
        h = [math.floor(q * (1 - q) * w * unit + 0.5) for q, w in zip(p, weights, strict=True)]
        place, tree, leaf = [1] * n, {}, {}
        for depth in range(booster.depth):
            for node in range(1 << depth, 2 << depth):
                mine = [i for i in range(n) if place[i] == node]
                if not mine:
                    continue
                score = lambda part: sum(g[i] for i in part) ** 2 / unit**2 / (sum(h[i] for i in part) / unit + booster.l2)
                best = None
                for f in range(3):
                    for cut in cuts[f]:
                        left, right = [i for i in mine if xs[i][f] < cut], [i for i in mine if xs[i][f] >= cut]
                        if not left or not right or min(sum(h[i] for i in s) / unit for s in (left, right)) < booster.min_hessian:
                            continue
                        gain = (score(left) + score(right) - score(mine)) / 2 - booster.min_gain
                        if gain > 1e-9 and (best is None or gain > best[2] + 1e-12):
                            best = (f, cut, gain, len(mine))
                if best:
                    tree[node] = best
                    for i in mine:
                        place[i] = 2 * node + (xs[i][best[0]] >= best[1])
        for node in set(place):
            mine = [i for i in range(n) if place[i] == node]
            leaf[node] = -booster.rate * (sum(g[i] for i in mine) / unit) / (sum(h[i] for i in mine) / unit + booster.l2)
        margins = [m + leaf[node] for m, node in zip(margins, place, strict=True)]
        trees.append(tree)
    return trees, margins


def compare_with_hand(spark, view, data, booster, weight=None, weights=None):
    model = boosting.fit(view, FEATURES, booster, weight)
    trees, margins = by_hand(data, booster, weights)
    found = boosting.splits(spark, model).where("feature IS NOT NULL").collect()
    assert len(found) == sum(map(len, trees)) > 0
    for r in found:
        f, _, gain, n = trees[r.tree][r.node]
        # Cuts between the same two values of the node are equal in effect; gain and size tell the split.
        assert r.feature == FEATURES[f] and r.n == n and math.isclose(r.gain, gain, rel_tol=1e-9)
    scored = {r.From_Account: r.m for r in view.select("From_Account", boosting.margin(model).alias("m")).collect()}
    for r, m in zip(data, margins, strict=True):
        assert math.isclose(scored[r[0]], m, rel_tol=1e-9, abs_tol=1e-12)
    return model


@pytest.mark.parametrize("booster", [SMALL, boosting.Booster(rounds=2, depth=2, l2=5.0, min_gain=0.5, min_hessian=4.0, bins=8)])
def test_trees_by_hand(spark, view, booster):
    compare_with_hand(spark, view, plain_rows(), booster)


def test_weighted_trees_by_hand(spark, view):
    data = plain_rows()
    positive = sum(r[4] for r in data)
    weights = [len(data) / (2 * positive) if r[4] else len(data) / (2 * (len(data) - positive)) for r in data]
    mean = sum(weights) / len(weights)
    compare_with_hand(spark, class_weights(view, "label"), data, SMALL, "weight", [w / mean for w in weights])


def test_same_model_for_every_layout(spark, view):
    one = boosting.fit(view.coalesce(1), FEATURES, SMALL)
    assert boosting.fit(view.repartition(7, "b"), FEATURES, SMALL) == one
    assert boosting.from_json(boosting.to_json(one)) == one


def test_more_rounds_than_between_checkpoints(spark, view):
    booster = boosting.Booster(rounds=12, depth=1, bins=4)
    model = compare_with_hand(spark, view, plain_rows(), booster)
    assert len(model.trees) == 12


def test_same_model_through_a_shuffle_and_small_blocks(spark, view, monkeypatch):
    one = boosting.fit(view, FEATURES, SMALL)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    monkeypatch.setattr(boosting, "LEAST_TASK_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        assert boosting.fit(view, FEATURES, SMALL) == one
        monkeypatch.setattr(boosting, "DRIVER_SUMS", 0)
        assert boosting.fit(view, FEATURES, SMALL) == one
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_passes_over_many_rows_have_several_tasks(spark):
    """A row of the binned table is a few bytes, so sizes of files don't tell how much work a pass is."""
    data = spark.range(600_000).select(*[hash_uniform("id", k).alias(f) for k, f in enumerate(FEATURES)], (F.col("id") % 2).cast("double").alias("label"))
    sc = spark.sparkContext
    sc.setJobGroup("several-tasks", "a fit")
    try:
        boosting.fit(data, FEATURES, boosting.Booster(rounds=1, depth=2, bins=8))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    last = tracker.getJobInfo(max(tracker.getJobIdsForGroup("several-tasks")))
    assert max(s.numTasks for s in map(tracker.getStageInfo, last.stageIds) if s) == 5


def test_large_sums_are_exact():
    values = np.array([2**60 + 1, -(2**59) - 3, 5, 2**60 - 7, -1], np.int64)
    at = np.array([0, 1, 1, 0, 1])
    sums = sum(np.bincount(at, part).astype(np.int64) * factor for part, factor in boosting._addends(values))
    assert sums.tolist() == [2**61 - 6, -(2**59) + 1]
    assert boosting._units(np.array([0.5, -0.5, 1.5, 0.49999999999999994]) / boosting.UNIT).tolist() == [1, -1, 2, 0]


def test_not_below_the_stand_in(spark):
    base = spark.range(3000).select(
        F.concat(F.lit("a"), "id").alias("From_Account"), hash_uniform("id", 1).alias("a"), hash_uniform("id", 2).alias("b"), hash_uniform("id", 3).alias("c")
    )
    odds = hash_uniform("From_Account", 4) < F.when((F.col("a") > 0.5) == (F.col("b") > 0.5), 0.75).otherwise(0.2) + 0.2 * F.col("c")
    data = base.withColumn("label", odds.cast("double")).persist()
    choices = {"second": (FEATURES, boosting.Booster(rounds=15, depth=4)), "mllib": (FEATURES, {"maxIter": 15, "maxDepth": 4, "stepSize": 0.1})}
    found = {r.model: r for r in models.compare(data, choices).collect()}
    assert found["second"].auc >= found["mllib"].auc - 0.005 and found["second"].auc > 0.75
    assert found["second"].n_train == found["mllib"].n_train and found["second"].n_dropped == 0


def test_bad_rows(spark, view):
    with pytest.raises(Exception, match="lacks a feature"):
        boosting.fit(view.withColumn("b", F.when(F.col("a") > 0.1, F.col("b"))), FEATURES, SMALL)
    with pytest.raises(ValueError, match="both present"):
        boosting.fit(view.where("label = 1"), FEATURES, SMALL)
    with pytest.raises(ValueError, match="both present"):
        boosting.fit(view.limit(0), FEATURES, SMALL)
    flat = boosting.fit(view.withColumns({f: F.lit(1.0) for f in FEATURES}), FEATURES, SMALL)
    assert boosting.splits(spark, flat).where("feature IS NOT NULL").count() == 0
    assert view.select(F.round(boosting.probability(flat), 3)).distinct().count() == 1
    model = boosting.fit(view, FEATURES, SMALL)
    missing = view.withColumn("b", F.lit(None).cast("double"))
    assert missing.where(boosting.probability(model).isNotNull()).count() == 0


# Stages


def test_a_saved_pipeline_brings_its_defaults(spark, view, tmp_path, monkeypatch):
    path = str(tmp_path / "pipeline")
    for booster in (SMALL, {"maxIter": 2, "maxDepth": 2, "stepSize": 0.1}):
        fitted = scoring.with_defaults(models.train(view, FEATURES, booster), {"a": 0.7, "b": 3, "c": 5.0, "other": 1}, zeros=("a",))
        batch = view.drop("b", "label").withColumn("a", F.when(F.col("a") > 0.2, F.col("a")))
        expected = scoring.score_batch_by_model(batch, fitted)
        models.save_model(fitted, path)
        with monkeypatch.context() as patch:
            patch.setattr(S, "DEFAULT_FEATURES", {})
            loaded = models.load_model(path)
            found = scoring.score_batch_by_model(batch, loaded)
            assert [c for c in found.columns if c in ("b", "other")] == ["b"]
            assert {(r.b, r.Imputed) for r in found.collect()} == {(3, 1)}
            assert found.where("a IS NULL").count() == 0 and found.where("LaunderingProbability IS NULL").count() == 0
            key = ["From_Account", "LaunderingProbability", "Prediction"]
            assert sorted(rows(found.select(key))) == sorted(rows(expected.select(key)))
        assert PipelineModel.load(path).transform(batch).where("probability IS NULL").count() == 0


def test_fill_defaults(spark):
    data = spark.createDataFrame([("x", None, 1.0, "own"), ("y", 2.0, None, "own"), ("z", 2.0, 3.0, None)], "k string, p double, q double, Imputed string")
    kept = FillDefaults.of({"p": 9.0, "r": 7.0}).transform(data)
    assert {(r.k, r.p, r.q, r.r, r.Imputed) for r in kept.collect()} == {("x", None, 1.0, 7.0, 1), ("y", 2.0, None, 7.0, 1), ("z", 2.0, 3.0, 7.0, 1)}
    filled = FillDefaults.of({"p": 9.0, "q": 8.0}, zeros=("q",), fill_nulls=True).transform(data)
    assert {(r.k, r.p, r.q, r.Imputed) for r in filled.collect()} == {("x", 9.0, 1.0, 1), ("y", 2.0, 0.0, 0), ("z", 2.0, 3.0, 0)}
    assert FillDefaults.of({"p": 1.0}).transform(data.limit(0)).collect() == []


def test_text_labels_train_and_score(spark, view, tmp_path):
    text = F.when(F.col("label") == 1, "suspicious").otherwise("normal")
    data = view.drop("label").join(view.select("From_Account", text.alias("flag")), "From_Account")
    index = labels.label_index(data, "flag")
    assert list(index.labels) == ["normal", "suspicious"]
    index.write().overwrite().save(str(tmp_path / "index"))
    index = type(index).load(str(tmp_path / "index"))
    more = data.unionByName(data.limit(5).withColumn("flag", F.lit("unknown"))).unionByName(data.limit(2).withColumn("flag", F.lit(None).cast("string")))
    assert {tuple(r) for r in labels.unseen_labels(more, "flag", index).collect()} == {("unknown", 5), (None, 2)}
    numbered = models.numeric_view(more, FEATURES, "flag", index)
    assert numbered.where("label IS NULL").count() == 7
    fitted = models.train(numbered.where("label IS NOT NULL"), FEATURES, SMALL)
    direct = models.train(view, FEATURES, SMALL)
    assert fitted.stages[0].fitted() == direct.stages[0].fitted()
    assert labels.with_label_index(more, "flag", index).where("label = 2").count() == 7
    assert labels.unseen_labels(more.limit(0), "flag", index).collect() == []


def test_weights_balance(spark, view):
    weighted = class_weights(view, "label")
    sums = {r.label: r.w for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert math.isclose(sums[0.0], 200.0) and math.isclose(sums[1.0], 200.0) and weighted.count() == 400
    with pytest.raises(ValueError, match="both present"):
        class_weights(view.where("label = 0"), "label")
    unweighted = auc_exact(models.predict(view, models.train(view, FEATURES, SMALL)), "IsLaundering", "LaunderingProbability").first().auc
    balanced = models.train(weighted, FEATURES, SMALL, weight="weight")
    assert abs(auc_exact(models.predict(view, balanced), "IsLaundering", "LaunderingProbability").first().auc - unweighted) < 0.05
    assert models.train(weighted, FEATURES, {"maxIter": 1, "maxDepth": 1, "stepSize": 0.1}, weight="weight").stages[-1].getWeightCol() == "weight"
