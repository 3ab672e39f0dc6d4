"""Boosted-tree training, comparison and importance: Spark MLlib's trees and the second-order booster of `boosting`."""

from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.operators.boosting import Booster
from riskflow.operators.labels import with_label_index
from riskflow.operators.metrics import auc_exact
from riskflow.operators.sampling import class_sizes, hash_split
from riskflow.operators.stages import BoostedTrees
from riskflow.sources.scratch import ensure_checkpoint_dir, scratch_path
from riskflow.sources.sinks import through_table


def numeric_view(
    dataset: DataFrame, features: list[str], label: str = "IsLaundering", index: StringIndexerModel | None = None
) -> DataFrame:
    """Account, features and label, numbers as double. What cannot be read as a number is null.

    The label is cast, or looked up in an index with a fixed order (`labels.label_index`), never numbered by frequency, which
    would swap 0 and 1 on balanced data. A label that the index doesn't know is null, and `labels.unseen_labels` counts it.
    """
    rows = dataset
    number = F.col(label).try_cast("double")
    if index is not None:
        rows = with_label_index(dataset, label, index, "__label")
        number = F.when(F.col("__label") < len(index.labels), F.col("__label"))
    return rows.select("From_Account", *[F.col(c).try_cast("double").alias(c) for c in features], number.alias("label"))


def valid_rows(view: DataFrame, features: list[str]) -> DataFrame:
    """Rows whose features are all present; compare `profiling.null_counts` for what is left out."""
    return view.dropna(subset=features)


def positive_probability() -> Column:
    return vector_to_array("probability")[1]


def boosted_trees(features: list[str], booster: dict | Booster, seed: int = S.SEED, weight: str | None = None) -> Pipeline:
    """MLlib's trees for a dict of their parameters, the second-order booster for a `Booster`."""
    if isinstance(booster, Booster):
        return Pipeline(stages=[BoostedTrees.of(features, booster, weight)])
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    weights = {"weightCol": weight} if weight else {}
    trees = GBTClassifier(featuresCol="features", labelCol="label", seed=seed, checkpointInterval=10, **weights, **booster)
    return Pipeline(stages=[assembler, trees])


def booster_named(name: str) -> dict | Booster:
    return Booster(**S.HISTOGRAM_BOOSTERS[name]) if name in S.HISTOGRAM_BOOSTERS else S.BOOSTERS[name]


def input_columns(model: PipelineModel) -> list[str]:
    """The features a fitted pipeline reads."""
    return next(s.getInputCols() for s in model.stages if hasattr(s, "getInputCols"))


@contextmanager
def held(view: DataFrame):
    """Keep a view for several passes; raises when only one class is present.

    Spilled blocks go to disk and lost ones are recomputed. Rows are placed by a hash of the whole row and ordered by account,
    so that a fit sees the same order on every run, in as many partitions as the session shuffles to: a fit runs
    hundreds of short jobs, and each pays for every partition. For balance use weights, not copies: equal rows lie in one task.
    """
    tasks = int(view.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = view.repartition(tasks, *view.columns).sortWithinPartitions("From_Account")
    kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        class_sizes(kept, "label")
        yield kept
    finally:
        kept.unpersist()


def train(
    view: DataFrame, features: list[str], booster: dict | Booster, seed: int = S.SEED, weight: str | None = None
) -> PipelineModel:
    """Fit on a numeric view, with a column of row weights if one is named. Every tenth round is checkpointed, which keeps the lineage short."""
    ensure_checkpoint_dir(view.sparkSession)
    with held(view) as kept:
        return boosted_trees(features, booster, seed, weight).fit(kept)


def predict(view: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(view).select(
        "From_Account",
        F.col("label").cast("int").alias("IsLaundering"),
        positive_probability().alias("LaunderingProbability"),
        F.col("prediction").cast("int").alias("Prediction"),
    )


Boosters = dict[str, tuple[list[str], dict | Booster]]


def compare_scores(
    view: DataFrame, boosters: Boosters, seed: int = S.SEED, parallelism: int = 3
) -> tuple[DataFrame, dict[str, int]]:
    """The test rows as each booster scores them, with `model`, and the number of rows each has learned from.

    All use the same split of the view, each its rows that have all its features. The fits run side by side: the many
    short jobs of one leave room for those of another. Scores are written to a table, once.
    """
    training, testing = hash_split(view, "From_Account", 0.8, seed)
    ensure_checkpoint_dir(view.sparkSession)

    with held(training) as kept:

        def fit(choice: tuple[list[str], dict | Booster]) -> tuple[PipelineModel, int]:
            features, booster = choice
            usable = valid_rows(kept, features)
            return boosted_trees(features, booster, seed).fit(usable), sum(class_sizes(usable, "label").values())

        with ThreadPool(min(parallelism, len(boosters))) as pool:
            fitted = pool.map(inheritable_thread_target(view.sparkSession)(fit), boosters.values())
    scored = [
        predict(valid_rows(testing, features), model).withColumn("model", F.lit(name))
        for (name, (features, _)), (model, _) in zip(boosters.items(), fitted)
    ]
    table = through_table(reduce(DataFrame.unionByName, scored), scratch_path(view.sparkSession, "compared"))
    return table, {name: n for name, (_, n) in zip(boosters, fitted)}


def compare(view: DataFrame, boosters: Boosters, seed: int = S.SEED, parallelism: int = 3) -> DataFrame:
    """One row (model, auc, n_train, n_test, n_dropped) per booster, all on the same split of the view.

    `n_dropped` counts the rows of the view that lack a feature of the booster.
    """
    scored, sizes = compare_scores(view, boosters, seed, parallelism)
    results = []
    for name, (features, _) in boosters.items():
        missing = F.greatest(F.lit(0), *[F.col(f).isNull().cast("int") for f in features])
        dropped = view.agg(F.coalesce(F.sum(missing), F.lit(0)))
        own = scored.where(F.col("model") == name)
        results.append(
            auc_exact(own, "IsLaundering", "LaunderingProbability").select(
                F.lit(name).alias("model"),
                "auc",
                F.lit(sizes[name]).cast("bigint").alias("n_train"),
                (F.col("n_positive") + F.col("n_negative")).alias("n_test"),
                dropped.scalar().alias("n_dropped"),
            )
        )
    return reduce(DataFrame.unionByName, results)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_gain(view: DataFrame, model: PipelineModel, features: list[str], path: str, top: int = 10) -> DataFrame:
    """Average split gain per feature, largest first, from the saved tree nodes at `path`."""
    trees = model.stages[-1]
    trees.write().overwrite().save(path)
    names = F.array(*[F.lit(f) for f in features])
    return (
        view.sparkSession.read.parquet(f"{path}/data")
        .where("nodeData.split.featureIndex >= 0")
        .groupBy(F.col("nodeData.split.featureIndex").alias("_feature"))
        .agg(F.avg("nodeData.gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
        .select(F.get(names, F.col("_feature")).alias("feature"), "gain", "splits")
        .orderBy(F.desc("gain"), "feature")
        .limit(top)
    )
