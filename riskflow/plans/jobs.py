"""End-to-end jobs: read, transform, write. Each stage hands the next a table, not a live plan."""

from pyspark.sql import DataFrame, SparkSession

from riskflow import schemas as S
from riskflow.operators.clean import clean_transactions
from riskflow.operators.features import account_features
from riskflow.operators.labels import account_labels, features_with_labels
from riskflow.operators.metrics import threshold_report
from riskflow.operators.models import booster_named, compare, load_model, numeric_view, predict, save_model, train, valid_rows
from riskflow.operators.patterns import pattern_labels, pattern_transactions
from riskflow.operators.sampling import class_weights, hash_split
from riskflow.operators.scoring import fill_spread, score_batch_by_model, with_account_features, with_defaults
from riskflow.sources.readers import (
    read_label_rows,
    read_pattern_lines,
    read_raw_transactions,
    read_scoring_batch,
    union_sources,
)
from riskflow.sources.sinks import through_table, write_csv


def labelled_features(tx: DataFrame, label_rows: DataFrame, stddev: bool = False) -> DataFrame:
    """Account features with labels, from clean transactions and label rows."""
    return features_with_labels(account_features(tx, stddev), account_labels(label_rows))


def extract_labels(spark: SparkSession, logs: str | list[str], out: str, stop_at_end: bool = False) -> None:
    """Pattern logs to a CSV folder of labelled rows."""
    rows = pattern_transactions(read_pattern_lines(spark, logs), stop_at_end=stop_at_end)
    write_csv(pattern_labels(rows), out)


def build_dataset(
    spark: SparkSession,
    transactions: dict[str, str],
    label_path: str,
    out: str,
    stddev: bool = True,
) -> DataFrame:
    """Raw transfer files of one or more origins and a label folder to a Parquet dataset."""
    raw = union_sources({name: read_raw_transactions(spark, path) for name, path in transactions.items()})
    labels = read_label_rows(spark, label_path)
    return through_table(labelled_features(clean_transactions(raw), labels, stddev), out)


ALL_BOOSTERS = (*S.BOOSTERS, *S.HISTOGRAM_BOOSTERS)


def compare_models(dataset: DataFrame, names: tuple[str, ...] = ALL_BOOSTERS) -> DataFrame:
    """AUC of the configured boosters on one 80/20 split of a dataset without spread column."""
    features = S.FEATURE_LISTS["gbt"]
    view = numeric_view(dataset, features)
    return compare(view, {name: (features, booster_named(name)) for name in names})


def train_and_save(dataset: DataFrame, path: str, model: str = "gbt", booster: str = "gbt_50") -> None:
    features = S.FEATURE_LISTS[model]
    view = valid_rows(numeric_view(fill_spread(dataset), features), features)
    save_model(with_defaults(train(view, features, booster_named(booster))), path)


def train_balanced(
    dataset: DataFrame, path: str, model: str = "boosted", booster: str = "boosted_100_depth6", train_share: float = 0.8
) -> DataFrame:
    """Split, balance the training part by weights, fit, save; returns the report at both thresholds on the untouched rest."""
    features = S.FEATURE_LISTS[model]
    view = valid_rows(numeric_view(fill_spread(dataset), features), features)
    training, testing = hash_split(view, "From_Account", train_share)
    fitted = train(class_weights(training, "label"), features, booster_named(booster), weight="weight")
    save_model(with_defaults(fitted), path)
    scored = predict(testing, fitted)
    return threshold_report(scored, "IsLaundering", "LaunderingProbability", [S.DECISION_THRESHOLD, S.STRICT_THRESHOLD])


def score_files(
    spark: SparkSession, batch: str | list[str], model_path: str, out: str, features: DataFrame | None = None, fill_nulls: bool | None = None
) -> None:
    """Score CSV files with a saved model into a CSV folder. `features` are those of accounts, for columns the files lack."""
    rows = read_scoring_batch(spark, batch)
    if features is not None:
        rows = with_account_features(rows, features)
    write_csv(score_batch_by_model(rows, load_model(model_path), fill_nulls=fill_nulls), out)
