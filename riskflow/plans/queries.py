"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions.columns import wall_clock
from riskflow.operators import boosting, labels, metrics, models, patterns, profiling, sampling, scoring, sketches, state, trailing
from riskflow.operators.clean import clean_transactions as clean
from riskflow.operators.clean import reject_counts as reject_counts_of
from riskflow.operators.features import account_features as features_of
from riskflow.operators.features import account_totals, typical_hours
from riskflow.operators.features import distinct_counts as distinct_counts_of
from riskflow.plans.jobs import ALL_BOOSTERS, labelled_features
from riskflow.sources import adapters
from riskflow.sources.readers import (
    malformed_counts,
    read_csv,
    read_label_rows,
    read_pattern_lines,
    read_raw_transactions,
    read_scoring_batch,
    union_sources,
)
from riskflow.sources.scratch import scratch_path
from riskflow.sources.sinks import bucketed_table, through_table, write_csv, write_lines
from riskflow.streaming.jobs import account_windows, drain, last_windows, score_stream, score_stream_by_model

Query = Callable[[SparkSession, str], DataFrame]
GBT = S.FEATURE_LISTS["gbt"]
BOOSTED = S.FEATURE_LISTS["boosted"]
#: Queries round the spread, whose last digits depend on the order of additions.
SPREAD_DIGITS = 2
FEATURE_BUCKETS = 8


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.table(spark, sf, "events")


def _transfers(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.transfers_from_events(_events(spark, sf))


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.raw_transfers_from_events(_events(spark, sf))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.transfers_from_orders(adapters.table(spark, sf, "orders"))


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.log_from_events(_events(spark, sf))


def _pattern_rows(spark: SparkSession, sf: str, **options) -> DataFrame:
    return patterns.pattern_transactions(_log(spark, sf), **options)


def _dataset(spark: SparkSession, sf: str, stddev: bool = False) -> DataFrame:
    orders = _orders(spark, sf)
    return labelled_features(orders, orders.select("From_Account", "isLaundering"), stddev)


def _rule_scored(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("Amount_Paid").cast("double").alias("amount")
    rows = _orders(spark, sf).select("transaction_id", "From_Account", amount, "isLaundering")
    return scoring.rule_scores(rows, "amount", "transaction_id")


def _batch(transfers: DataFrame) -> DataFrame:
    """A scoring input with two of the feature columns."""
    amount = F.col("Amount_Paid").cast("double")
    return transfers.select(
        "transaction_id", "From_Account", amount.alias("TotalAmount"), amount.alias("MaxAmount")
    )


# Cleaning and features


def clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean(_raw(spark, sf))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("Amount_Received", "Amount_Paid")})


def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select(
        "event_id", "Timestamp_str", wall_clock(F.col("Timestamp_str")).alias("Timestamp")
    )


def account_features(spark: SparkSession, sf: str) -> DataFrame:
    return features_of(_transfers(spark, sf))


def account_features_any_categories(spark: SparkSession, sf: str) -> DataFrame:
    """With the spread left out, as there is one path whatever the categories are."""
    return features_of(_transfers(spark, sf), stddev=True).drop("StdDevAmount")


def account_stddev(spark: SparkSession, sf: str) -> DataFrame:
    rows = features_of(_orders(spark, sf), stddev=True)
    return rows.select("From_Account", F.round("StdDevAmount", SPREAD_DIGITS).alias("StdDevAmount"))


def hour_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return typical_hours(_transfers(spark, sf))


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_counts_of(_transfers(spark, sf))


def total_count_avg(spark: SparkSession, sf: str) -> DataFrame:
    return account_totals(_transfers(spark, sf))


def labels_max(spark: SparkSession, sf: str) -> DataFrame:
    return labels.account_labels(adapters.label_rows_from_events(_events(spark, sf)))


def features_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    return labelled_features(adapters.transfers_from_events(events), adapters.label_rows_from_events(events))


def features_with_bank_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.features_with_bank_labels(
        account_features(spark, sf), adapters.label_rows_from_events(_events(spark, sf))
    )


def account_states(spark: SparkSession, sf: str) -> DataFrame:
    """What is stored of each account, arrays as text."""
    rows = state.account_state(_transfers(spark, sf))
    text = [F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in ("hours", "currencies", "formats")]
    amounts = [F.col(c).cast("double").alias(c) for c in ("total", "high", "low")]
    return rows.select("From_Account", "n", "paid", *amounts, *text)


def merged_state_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features from stored states of three batches: one was written twice, two were made one later."""
    transfers = adapters.transfers_from_events(_events(spark, sf), keep=("event_id",))
    store, newer = scratch_path(spark, "states"), scratch_path(spark, "states")
    part = F.pmod("event_id", F.lit(3))
    state.write_batch(state.account_state(transfers.where(part < 2)), store, "day 0")  # replaced by the next line
    for k in range(2):
        state.write_batch(state.account_state(transfers.where(part == k)), store, f"day {k}")
    state.compact(spark, store, ["day 0", "day 1"], "days", newer)
    merged = state.add_batch(transfers.where(part == 2), newer, "day 2")
    return state.state_features(merged).withColumn("StdDevAmount", F.round("StdDevAmount", SPREAD_DIGITS))


def trailing_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with the number and amount of its customer's orders of the 90 days up to it."""
    found = trailing.trailing_counts(_orders(spark, sf), "90 day")
    return found.select("transaction_id", "From_Account", "TrailingCount", F.col("TrailingAmount").cast("double").alias("TrailingAmount"))


def bucketed_features_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Features and labels as tables dealt by account; their join shuffles nothing."""
    events = _events(spark, sf)
    features = features_of(adapters.transfers_from_events(events))
    found = labels.account_labels(adapters.label_rows_from_events(events))
    tables = [
        bucketed_table(rows, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), "From_Account", FEATURE_BUCKETS)
        for name, rows in (("features", features), ("labels", found))
    ]
    return labels.features_with_labels(*tables)


SKETCH_QUANTILES = (0.25, 0.5, 0.9)


def sketch_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly sketches per currency, merged to all months, held against exact counts and ranks.

    Where an exact count is one that a sketch keeps exactly, the estimate itself is returned; else, and for
    quantiles, whether it lies within the stated error (three standard errors for counts).
    """
    rows = _orders(spark, sf)
    month = F.date_trunc("month", F.col("Timestamp"))
    counted = ["transaction_id", "From_Account"]
    monthly = sketches.sketch(rows, ["Payment_Currency"], counted, "Amount_Paid", month)
    stored = through_table(monthly, scratch_path(spark, "sketches"))
    found = sketches.estimates(sketches.merge_sketches(stored, ["Payment_Currency"]), SKETCH_QUANTILES)
    found = found.withColumnRenamed("n", "n_sketched")
    both = rows.join(found, "Payment_Currency")
    amount = F.col("Amount_Paid").cast("double")
    places = [F.col(f"Amount_Paid_q{q * 100:g}") for q in SKETCH_QUANTILES]
    exact = both.groupBy("Payment_Currency").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("n_sketched").alias("n_sketched"),
        *[F.count_distinct(c).alias(f"exact_{c}") for c in counted],
        *[F.max(f"Num{c}").alias(f"Num{c}") for c in counted],
        *[F.count_if(amount < p).alias(f"below{k}") for k, p in enumerate(places)],
        *[F.count_if(amount <= p).alias(f"upto{k}") for k, p in enumerate(places)],
    )

    def near(c: str):
        gap = F.abs(F.col(f"Num{c}") - F.col(f"exact_{c}"))
        return (gap <= 3 * sketches.distinct_error() * F.col(f"exact_{c}")).cast("int").alias(f"{c}_near")

    def kept(c: str):
        small = F.col(f"exact_{c}") <= 1 << sketches.DISTINCT_BITS
        return F.when(small, F.col(f"Num{c}")).alias(f"{c}_kept")

    def ranked(k: int, q: float):
        n = F.col("n")
        inside = (F.col(f"below{k}") / n <= q + sketches.rank_error()) & (F.col(f"upto{k}") / n >= q - sketches.rank_error())
        return inside.cast("int").alias(f"q{q * 100:g}_near")

    checks = [f(c) for c in counted for f in (near, kept)] + [ranked(k, q) for k, q in enumerate(SKETCH_QUANTILES)]
    return exact.select("Payment_Currency", "n_sketched", *[f"exact_{c}" for c in counted], *checks)


# Pattern log


def pattern_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    write_lines(_log(spark, sf), path)
    return read_pattern_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n_lines"))


def pattern_header(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.with_header(_log(spark, sf)).select("source", "line_no", "Pattern_Type")


def pattern_lines_no_end(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.without_end_lines(_log(spark, sf)).select("source", "line_no", "value")


def pattern_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = patterns.with_pattern(_log(spark, sf))
    return filled.select("source", "line_no", "Pattern_Type")


def pattern_block_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = patterns.with_pattern(_log(spark, sf), stop_at_end=True)
    return filled.select("source", "line_no", "Pattern_Type")


def pattern_file_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Logs as text files, one for each bank, read back in splits and filled."""
    path = scratch_path(spark, "logs")
    ordered = _log(spark, sf).repartition("source").sortWithinPartitions("source", "line_no")
    ordered.select("source", "value").write.partitionBy("source").text(path)
    filled = patterns.with_pattern(read_pattern_lines(spark, path))
    bank = F.regexp_extract("source", "source=([^/]*)", 1)
    return filled.groupBy(bank.alias("source"), "value", "Pattern_Type").agg(F.count(F.lit(1)).alias("n_lines"))


def pattern_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _pattern_rows(spark, sf)


def pattern_narrow(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.pattern_labels(_pattern_rows(spark, sf, clean_names=False), with_account=False)


def pattern_name_clean(spark: SparkSession, sf: str) -> DataFrame:
    named = patterns.with_header(_log(spark, sf)).where("Pattern_Type IS NOT NULL")
    return named.select(
        "source", "line_no", "Pattern_Type", patterns.short_pattern_name(F.col("Pattern_Type")).alias("short_name")
    )


def pattern_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.pattern_counts(_pattern_rows(spark, sf))


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.value_counts(_pattern_rows(spark, sf, label="field"), "isLaundering")


def empty_string_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.empty_string_counts(_pattern_rows(spark, sf), [*S.PATTERN_FIELDS, "Pattern_Type"])


def union_sources_query(spark: SparkSession, sf: str) -> DataFrame:
    """Banks with even and odd numbers as two logs that number their banks alike; fills stay in their log."""
    log = _log(spark, sf)
    number = F.col("source").cast("int")
    half = F.floor(number / 2).cast("string")
    both = union_sources({name: log.where(number % 2 == n).withColumn("source", half) for n, name in enumerate(("even", "odd"))})
    rows = patterns.with_pattern(both)
    return rows.select("origin", "source", "line_no", "Pattern_Type")


def union_transactions(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["From_Account", "Amount_Paid", "Payment_Currency", "Payment_Format", "Timestamp"]
    both = union_sources(
        {"events": _transfers(spark, sf).select(columns), "orders": _orders(spark, sf).select(columns)}
    )
    return both.withColumn("Amount_Paid", F.col("Amount_Paid").cast("double"))


# Profiling


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean(_raw(spark, sf))
    return profiling.null_counts(rows, ["From_Account", "Amount_Paid", "Timestamp", "Hour"])


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    stages = {"raw": raw, "clean": clean(raw)}
    return union_sources({name: profiling.row_counts(rows) for name, rows in stages.items()}, "stage")


def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.class_distribution(_dataset(spark, sf), "IsLaundering")


# Sampling


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf).select("transaction_id", "From_Account")
    return rows.withColumn("split", sampling.split_name("transaction_id", 0.8))


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _dataset(spark, sf).select("From_Account", "IsLaundering")
    return sampling.stratified_split(rows, "IsLaundering", "From_Account")


def exact_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.exact_sample(_dataset(spark, sf), "From_Account", 100)


def relabel_sample_union(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.with_relabelled_sample(_dataset(spark, sf), "IsLaundering", "From_Account")


def oversample_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.oversample_bootstrap(_training_table(spark, sf), "IsLaundering", "From_Account")


def oversample_replicate(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.oversample_replicate(_training_table(spark, sf), "IsLaundering", "From_Account")


# Model inputs and scoring


def ml_numeric_view(spark: SparkSession, sf: str) -> DataFrame:
    view = models.numeric_view(_dataset(spark, sf, stddev=True), BOOSTED)
    return view.withColumn("StdDevAmount", F.round("StdDevAmount", SPREAD_DIGITS))


def ml_valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return models.valid_rows(ml_numeric_view(spark, sf), BOOSTED)


def feature_list_select(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.select_features(_dataset(spark, sf, stddev=True), "boosted")
    return rows.withColumn("StdDevAmount", F.round("StdDevAmount", SPREAD_DIGITS))


def fill_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.fill_missing_columns(_batch(_orders(spark, sf)))


def rule_score(spark: SparkSession, sf: str) -> DataFrame:
    return _rule_scored(spark, sf).drop("isLaundering")


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.with_verdict(scoring.with_prediction(rule_score(spark, sf)))


def threshold_predictions(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("LaunderingProbability")
    return rule_score(spark, sf).select(
        "transaction_id",
        scoring.at_least(score, S.DECISION_THRESHOLD).alias("at_default"),
        scoring.at_least(score, S.STRICT_THRESHOLD).alias("at_strict"),
    )


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_batch_by_rule(_batch(_orders(spark, sf)), "TotalAmount", "transaction_id")


def preview_100(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.preview(batch_score(spark, sf), "transaction_id", 100)


def preview_20(spark: SparkSession, sf: str) -> DataFrame:
    return total_count_avg(spark, sf).orderBy("Account").limit(20)


# Metrics


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(scoring.with_prediction(_rule_scored(spark, sf)), "isLaundering", "Prediction")


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.with_prediction(_rule_scored(spark, sf))
    return metrics.classification_report(scored, "isLaundering", "Prediction")


def threshold_report(spark: SparkSession, sf: str) -> DataFrame:
    thresholds = [S.DECISION_THRESHOLD, S.STRICT_THRESHOLD]
    return metrics.threshold_report(_rule_scored(spark, sf), "isLaundering", "LaunderingProbability", thresholds)


def auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.auc_exact(_rule_scored(spark, sf), "isLaundering", "LaunderingProbability")


# Models. The dataset is written first, as between jobs, so that training never recomputes it.


def _training_table(spark: SparkSession, sf: str, stddev: bool = False) -> DataFrame:
    return through_table(_dataset(spark, sf, stddev), scratch_path(spark, "dataset"))


def _fitted(spark: SparkSession, sf: str):
    view = models.valid_rows(models.numeric_view(_training_table(spark, sf), GBT), GBT)
    training, testing = sampling.hash_split(view, "From_Account")
    return models.train(training, GBT, S.BOOSTERS["gbt_50"]), training, testing


def gbt_train_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every test account with its label, and whether its score is a probability that the prediction follows from."""
    model, _, testing = _fitted(spark, sf)
    score = F.col("LaunderingProbability")
    follows = F.col("Prediction") == scoring.at_least(score, S.DECISION_THRESHOLD)
    return models.predict(testing, model).select(
        "From_Account",
        "IsLaundering",
        score.between(0, 1).cast("int").alias("is_probability"),
        follows.cast("int").alias("prediction_follows"),
    )


def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of both parts for each booster, and whether its AUC is that of the mean rank of the positives, which is above chance."""
    view = models.numeric_view(_training_table(spark, sf), GBT)
    boosters = {name: (GBT, models.booster_named(name)) for name in ALL_BOOSTERS}
    scored, sizes = models.compare_scores(view, boosters)
    positive = F.col("IsLaundering") == 1
    counts = scored.groupBy("model", "LaunderingProbability").agg(F.count_if(positive).alias("p"), F.count(F.lit(1)).alias("n"))
    # Scores are few beside rows, and there is a window for each booster.
    upto = F.sum("n").over(Window.partitionBy("model").orderBy("LaunderingProbability"))
    ranked = counts.withColumn("rank", upto - (F.col("n") - 1) / 2)
    ranks = ranked.groupBy("model").agg(F.sum(F.col("p") * F.col("rank")).alias("ranks"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, n = F.col("p"), F.col("n")
    by_rank = (F.col("ranks") - p * (p + 1) / 2) / (p * (n - p))
    learned = F.create_map(*[F.lit(x) for name, size in sizes.items() for x in (name, size)])
    exact = union_sources({name: metrics.auc_exact(scored.where(F.col("model") == name), "IsLaundering", "LaunderingProbability") for name in boosters}, "model")
    dropped = F.count_if(F.greatest(F.lit(0), *[F.col(f).isNull().cast("int") for f in GBT]) == 1)
    return exact.join(ranks.select("model", by_rank.alias("by_rank")), "model").select(
        "model",
        learned[F.col("model")].cast("bigint").alias("n_train"),
        (F.col("n_positive") + F.col("n_negative")).alias("n_test"),
        view.agg(dropped).scalar().alias("n_dropped"),
        (F.abs(F.col("auc") - F.col("by_rank")) < 1e-9).cast("int").alias("auc_agrees"),
        (F.col("auc") > 0.5).cast("int").alias("beats_chance"),
    )


def feature_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature of the model, and whether its gain is positive if it is used, and ranked by its size."""
    model, training, _ = _fitted(spark, sf)
    gain = models.feature_gain(training, model, GBT, scratch_path(spark, "trees"), top=len(GBT))
    ranks = gain.select("feature", "gain", F.row_number().over(Window.orderBy(F.desc("gain"))).alias("rank"))  # a row for each feature
    listed = spark.createDataFrame([(f,) for f in GBT], "feature string").join(ranks, "feature", "left")
    return listed.select("feature", F.coalesce(F.col("gain") > 0, F.lit(True)).cast("int").alias("gain_is_positive"))


def booster_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Every split of the first two trees of the second-order booster: node, feature, cut, gain and number of rows."""
    view = models.valid_rows(models.numeric_view(_training_table(spark, sf), GBT), GBT)
    training, _ = sampling.hash_split(view, "From_Account")
    booster = boosting.Booster(**S.HISTOGRAM_BOOSTERS["boosted_100_depth6"] | {"rounds": 2})
    found = boosting.splits(spark, boosting.fit(training, GBT, booster)).where("feature IS NOT NULL")
    return found.select("tree", "node", "feature", "cut", F.round("gain", 6).alias("gain"), "n")


def booster_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Average gain and number of splits of each feature in the first two trees, and the number of times it is the best of its tree."""
    found = booster_splits(spark, sf)
    best = F.max_by("feature", F.struct("gain", -F.col("node")))
    top = found.groupBy("tree").agg(best.alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n_best"))
    gains = found.groupBy("feature").agg(F.round(F.avg("gain"), 4).alias("gain"), F.count(F.lit(1)).alias("splits"), F.sum("n").alias("n_rows"))
    return gains.join(top, "feature", "left").select("feature", "gain", "splits", "n_rows", F.coalesce("n_best", F.lit(0)).alias("n_best"))


def _spread_fitted(spark: SparkSession, sf: str):
    dataset = _training_table(spark, sf, stddev=True)
    view = models.valid_rows(models.numeric_view(scoring.fill_spread(dataset), BOOSTED), BOOSTED)
    return dataset, models.train(view, BOOSTED, S.BOOSTERS["gbt_50"])


def model_batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of transactions scored by a model on the features of their accounts."""
    dataset, model = _spread_fitted(spark, sf)
    batch = scoring.with_account_features(_orders(spark, sf).select("transaction_id", "From_Account"), dataset)
    return _model_scored(scoring.score_batch_by_model(batch, model))


def _model_scored(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_id",
        "From_Account",
        "TxnCount",
        F.round("StdDevAmount", SPREAD_DIGITS).alias("StdDevAmount"),
        "Imputed",
        F.col("LaunderingProbability").between(0, 1).cast("int").alias("is_probability"),
    )


def pipeline_batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that lacks features, scored by a saved and loaded pipeline that brings its defaults; and as before it was saved."""
    view = models.valid_rows(models.numeric_view(_training_table(spark, sf), GBT), GBT)
    fitted = scoring.with_defaults(models.train(view, GBT, S.BOOSTERS["gbt_50"]))
    path = scratch_path(spark, "pipeline")
    models.save_model(fitted, path)
    rows = _batch(_orders(spark, sf))
    rows = rows.withColumn("MaxAmount", F.when(F.col("transaction_id") % 5 > 0, F.col("MaxAmount")))

    def scored(model) -> DataFrame:
        return scoring.score_batch_by_model(rows, model)

    fresh = scored(fitted).select("transaction_id", F.col("LaunderingProbability").alias("fresh"))
    loaded = scored(models.load_model(path)).join(fresh, "transaction_id")
    score = F.col("LaunderingProbability")
    return loaded.select(
        "transaction_id",
        *GBT,
        "Imputed",
        score.isNotNull().cast("int").alias("is_scored"),
        score.eqNullSafe(F.col("fresh")).cast("int").alias("unchanged"),
    )


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    """Priorities as labels, indexed by the orders of one status; what the others have besides falls into one bucket more."""
    rows = _orders(spark, sf)
    known = rows.where("Payment_Currency = 'F' AND Payment_Format <> '3-MEDIUM'")
    index = labels.label_index(known, "Payment_Format")
    found = labels.with_label_index(rows, "Payment_Format", index)
    unseen = labels.unseen_labels(rows, "Payment_Format", index).withColumnsRenamed({"label": "Payment_Format", "n_rows": "n_unseen"})
    counts = found.groupBy("Payment_Format", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(unseen, "Payment_Format", "left").withColumn("n_unseen", F.coalesce("n_unseen", F.lit(0)))


def balanced_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, accounts and sum of weights of each class, and the splits of a first tree grown with them."""
    view = models.valid_rows(models.numeric_view(_training_table(spark, sf), GBT), GBT)
    weighted = sampling.class_weights(view, "label")
    booster = boosting.Booster(rounds=1, depth=1)
    tree = boosting.splits(spark, boosting.fit(weighted, GBT, booster, "weight")).where("node = 1")
    sums = weighted.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("From_Account").alias("n_accounts"), F.round(F.sum("weight"), 6).alias("weight")
    )
    return sums.withColumns({c: tree.select(c).scalar() for c in ("feature", "cut")})


def balanced_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and accounts of each class in both parts, and accounts that are in both."""
    training, testing = sampling.balanced_split(_training_table(spark, sf), "IsLaundering", "From_Account")
    columns = ["From_Account", "IsLaundering"]
    both = union_sources({"train": training.select(columns), "test": testing.select(columns)}, "split")
    sides = F.size(F.collect_set("split"))
    per_account = both.groupBy("From_Account", "IsLaundering").agg(sides.alias("sides"))
    counts = both.groupBy("split", "IsLaundering").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("From_Account").alias("n_accounts"))
    mixed = per_account.groupBy("IsLaundering").agg(F.count_if(F.col("sides") > 1).alias("n_mixed"))
    return counts.join(mixed, "IsLaundering")


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every test account with a flag: the saved model scores it as the fitted one does."""
    model, _, testing = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    batch = testing.drop("label")
    fresh = scoring.score_batch_by_model(batch, model).select("From_Account", "LaunderingProbability")
    saved = scoring.score_batch_by_model(batch, models.load_model(path)).select(
        "From_Account", F.col("LaunderingProbability").alias("_loaded")
    )
    same = (F.col("LaunderingProbability") == F.col("_loaded")).cast("int")
    return fresh.join(saved, "From_Account").select("From_Account", same.alias("unchanged"))


# Files and streams


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(features_with_labels(spark, sf), path)
    return read_csv(spark, path, S.ML_DATASET)


def _raw_file(spark: SparkSession, sf: str) -> str:
    """The raw transfers as a folder of CSV files, with amounts of purchases spoilt."""
    path = scratch_path(spark, "raw")
    paid = F.col("Amount_Paid").cast("string")
    spoilt = F.when(F.col("Payment_Format") == "purchase", F.concat(paid, F.lit(" EUR"))).otherwise(paid)
    rows = _raw(spark, sf).withColumn("Amount_Paid", spoilt)
    write_csv(rows.select(*[f.name for f in S.RAW_TRANSACTIONS]), path)
    return path


def raw_csv_features(spark: SparkSession, sf: str) -> DataFrame:
    """From raw files to features, through the library's reader and cleaning."""
    return features_of(clean(read_raw_transactions(spark, _raw_file(spark, sf))))


def raw_csv_any_order(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files in two folders, one with its columns turned round; both are read by their headers."""
    path, turned = _raw_file(spark, sf), scratch_path(spark, "turned")
    rows = read_csv(spark, path, S.RAW_TRANSACTIONS)
    half = F.pmod(F.xxhash64("From_Account", "Timestamp_str"), F.lit(2))
    straight = scratch_path(spark, "straight")
    write_csv(rows.where(half == 0), straight)
    write_csv(rows.where(half == 1).select(*reversed(rows.columns)), turned)
    return features_of(clean(read_raw_transactions(spark, [straight, turned])))


def _spoilt_file(spark: SparkSession, sf: str) -> str:
    """Raw transfers as text: signups lack their last fields, errors have one more, large views have a line end in quotes."""
    path = scratch_path(spark, "spoilt")
    names = [f.name for f in S.RAW_TRANSACTIONS]
    rows = _raw(spark, sf).select("event_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])
    kind = F.col("Payment_Format")
    line = F.when(kind == "signup", F.concat_ws(",", *names[:8])).when(kind == "error", F.concat_ws(",", *names, F.lit("more")))
    broken = F.concat(F.lit('"one\ntwo"'), F.lit(","), F.concat_ws(",", *names[1:]))
    line = line.when((kind == "view") & (F.col("Amount_Received").cast("double") > 150), broken).otherwise(F.concat_ws(",", *names))
    lines = rows.select((F.col("event_id") % 4).alias("part"), F.col("event_id").alias("place"), line.alias("value"))
    headers = spark.range(4).select(F.col("id").alias("part"), F.lit(-1).cast("bigint").alias("place"), F.lit(",".join(names)).alias("value"))
    ordered = lines.unionByName(headers).repartition("part").sortWithinPartitions("part", "place")
    ordered.select("part", "value").write.partitionBy("part").text(path)
    return path


def corrupt_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a wrong length by kind, and the reasons for which rows are rejected."""
    raw = read_raw_transactions(spark, _spoilt_file(spark, sf), corrupt=True)
    kinds = malformed_counts(raw).select(F.concat(F.lit("line: "), "kind").alias("reason"), "n_rows")
    return kinds.unionByName(reject_counts_of(raw))


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reject_counts_of(read_raw_transactions(spark, _raw_file(spark, sf)))


def label_csv_join(spark: SparkSession, sf: str) -> DataFrame:
    """Label files as the extractor writes them, read back and joined to features."""
    path = scratch_path(spark, "labels")
    write_csv(patterns.pattern_labels(_pattern_rows(spark, sf, label="field")), path)
    found = labels.account_labels(read_label_rows(spark, path))
    return labels.features_with_labels(typical_hours(_transfers(spark, sf)), found)


def batch_csv_score(spark: SparkSession, sf: str) -> DataFrame:
    """A batch in two folders of files whose columns have another order."""
    batch = _batch(_orders(spark, sf))
    paths = [scratch_path(spark, "batch") for _ in range(2)]
    half = F.col("transaction_id") % 2
    write_csv(batch.where(half == 0), paths[0])
    write_csv(batch.where(half == 1).select(*reversed(batch.columns)), paths[1])
    scored = scoring.score_batch_by_rule(read_scoring_batch(spark, paths), "TotalAmount", "transaction_id")
    return scored.withColumn("transaction_id", F.col("transaction_id").cast("long"))


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = adapters.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def stream_rule_score(spark: SparkSession, sf: str) -> DataFrame:
    transfers = adapters.transfers_from_orders(_stream(spark, sf, "orders"))
    scored = score_stream(_batch(transfers), "TotalAmount", "transaction_id")
    return drain(scored, scratch_path(spark, "scores"), scratch_path(spark, "progress"))


def stream_model_score(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving orders scored by a model on the features of their accounts; the query is run again, as after a restart."""
    dataset, model = _spread_fitted(spark, sf)
    progress, out = scratch_path(spark, "progress"), scratch_path(spark, "scores")
    for _ in range(2):
        arriving = adapters.transfers_from_orders(_stream(spark, sf, "orders")).select("transaction_id", "From_Account")
        scored = drain(score_stream_by_model(arriving, model, dataset), out, progress)
    return _model_scored(scored)


def stream_window_features(spark: SparkSession, sf: str) -> DataFrame:
    """All windows, those the stream closes and the last ones."""
    windows = account_windows(adapters.transfers_from_events(_stream(spark, sf, "events")))
    closed = drain(windows, scratch_path(spark, "windows"), scratch_path(spark, "progress"))
    return closed.unionByName(last_windows(_transfers(spark, sf), closed))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        clean_transactions,
        parse_timestamp,
        account_features,
        account_features_any_categories,
        account_stddev,
        hour_bucket,
        distinct_counts,
        total_count_avg,
        trailing_counts,
        bucketed_features_with_labels,
        account_states,
        merged_state_features,
        sketch_estimates,
        labels_max,
        features_with_labels,
        features_with_bank_labels,
        pattern_lines,
        pattern_header,
        pattern_lines_no_end,
        pattern_forward_fill,
        pattern_block_fill,
        pattern_file_fill,
        pattern_transactions,
        pattern_narrow,
        pattern_name_clean,
        pattern_counts,
        label_counts,
        empty_string_counts,
        union_transactions,
        null_counts,
        row_counts,
        class_distribution,
        hash_split,
        stratified_split,
        exact_sample,
        relabel_sample_union,
        oversample_bootstrap,
        oversample_replicate,
        ml_numeric_view,
        ml_valid_rows,
        feature_list_select,
        fill_missing_columns,
        rule_score,
        rule_predictions,
        threshold_predictions,
        batch_score,
        preview_100,
        preview_20,
        confusion_matrix,
        classification_report,
        threshold_report,
        auc_exact,
        gbt_train_score,
        compare_models,
        feature_gain,
        booster_splits,
        booster_gain,
        balanced_weights,
        label_index,
        pipeline_batch_score,
        model_roundtrip,
        model_batch_score,
        balanced_split,
        csv_roundtrip,
        raw_csv_features,
        raw_csv_any_order,
        corrupt_counts,
        reject_counts,
        label_csv_join,
        batch_csv_score,
        stream_rule_score,
        stream_model_score,
        stream_window_features,
    )
} | {"union_sources": union_sources_query}
