"""Scoring of single rows, batches and streams, by rule or by model. All row-wise, no shuffle."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions.columns import at_least, hash_uniform, round_half_up
from riskflow.operators.models import input_columns, positive_probability
from riskflow.operators.stages import FillDefaults
from riskflow.sources.readers import require_columns


def fill_missing_columns(rows: DataFrame, fill_nulls: bool = False) -> DataFrame:
    """Add each feature column that is absent, with its default.

    Nulls in columns that are present stay, unless `fill_nulls` is set.
    """
    defaults = {c: F.lit(v) for c, v in S.DEFAULT_FEATURES.items()}
    filled = rows.withColumns({c: v for c, v in defaults.items() if c not in rows.columns})
    if fill_nulls:
        filled = filled.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items() if c in rows.columns})
    return filled


def select_features(rows: DataFrame, model: str, keep: tuple[str, ...] = ("From_Account",)) -> DataFrame:
    """The feature list that a model reads, in its order."""
    return rows.select(*keep, *S.FEATURE_LISTS[model])


def rule_probability(amount: Column, key: str, seed: int = S.SEED) -> Column:
    """A number in the range of the amount's band, rounded to 4 digits, fixed by key and seed."""
    u = hash_uniform(key, seed)
    score = None
    for floor, low, high in S.RULE_BANDS:
        value = F.lit(low) + (F.lit(high) - F.lit(low)) * u
        if floor is None:
            score = score.otherwise(value)
        else:
            over = amount > F.lit(floor)
            score = F.when(over, value) if score is None else score.when(over, value)
    return round_half_up(score, 4)


def rule_scores(rows: DataFrame, amount: str, key: str, seed: int = S.SEED) -> DataFrame:
    return rows.withColumn("LaunderingProbability", rule_probability(F.col(amount).cast("double"), key, seed))


def with_prediction(rows: DataFrame, threshold: float = S.DECISION_THRESHOLD) -> DataFrame:
    return rows.withColumn("Prediction", at_least(F.col("LaunderingProbability"), threshold))


def with_verdict(rows: DataFrame) -> DataFrame:
    text = F.when(F.col("Prediction") == 1, F.lit(S.VERDICTS[1])).otherwise(F.lit(S.VERDICTS[0]))
    return rows.withColumn("verdict", text)


def score_batch_by_rule(batch: DataFrame, amount: str, key: str, seed: int = S.SEED) -> DataFrame:
    """Batch with missing features filled, `LaunderingProbability` and `Prediction`."""
    require_columns(batch, ["From_Account"])
    return with_prediction(rule_scores(fill_missing_columns(batch), amount, key, seed))


def fill_spread(rows: DataFrame) -> DataFrame:
    """Accounts with one transaction have no spread; models see 0 for it, in training and in scoring."""
    if "StdDevAmount" not in rows.columns:
        return rows
    return rows.withColumn("StdDevAmount", F.coalesce(F.col("StdDevAmount").cast("double"), F.lit(0.0)))


def with_account_features(batch: DataFrame, features: DataFrame) -> DataFrame:
    """The batch with the features of its accounts, where it lacks a column; unknown accounts get nulls."""
    wanted = [c for c in features.columns if c in S.DEFAULT_FEATURES and c not in batch.columns]
    return batch.join(features.select("From_Account", *wanted), "From_Account", "left")


def with_defaults(model: PipelineModel, defaults: dict[str, float] = S.DEFAULT_FEATURES, zeros: tuple[str, ...] = ("StdDevAmount",), fill_nulls: bool = False) -> PipelineModel:
    """A fitted pipeline that fills features by itself: saved and loaded, it needs no list of defaults.

    Only the features it reads get a default. Nulls in `zeros` become 0, as in training.
    """
    read = input_columns(model)
    fill = FillDefaults.of({c: v for c, v in defaults.items() if c in read}, zeros, fill_nulls)
    return PipelineModel([fill, *(s for s in model.stages if not isinstance(s, FillDefaults))])


def score_batch_by_model(
    batch: DataFrame, model: PipelineModel, threshold: float = S.DECISION_THRESHOLD, fill_nulls: bool | None = None
) -> DataFrame:
    """Like `score_batch_by_rule` with a fitted pipeline, and `Imputed`.

    A pipeline from `with_defaults` fills features as it was saved to, unless `fill_nulls` says otherwise; another one gets the default list. A null spread is
    0, as in training. A row that lacks another feature has no score and no prediction, unless nulls are filled.
    `Imputed` is 1 for rows of which a feature that the model reads is a default.
    """
    require_columns(batch, ["From_Account"])
    if not isinstance(model.stages[0], FillDefaults):
        model = with_defaults(model, fill_nulls=bool(fill_nulls))
    fill, rest = model.stages[0], model.stages[1:]
    if fill_nulls is not None:
        fill = fill.copy({fill.fillNulls: "true" if fill_nulls else "false"})
    read = input_columns(model)
    filled = fill.transform(batch)
    others = {c: F.lit(v) for c, v in S.DEFAULT_FEATURES.items() if c not in filled.columns}
    usable = F.lit(True)
    for c in read:
        usable = usable & F.col(c).isNotNull()
    keeping = [s.copy().setHandleInvalid("keep") if hasattr(s, "setHandleInvalid") else s for s in rest]
    scored = PipelineModel(keeping).transform(filled)
    scored = scored.withColumn("LaunderingProbability", F.when(usable, positive_probability()))
    scored = scored.withColumn("Imputed", F.when(usable, F.col("Imputed")).otherwise(0))
    scored = scored.select(*filled.columns, "LaunderingProbability").withColumns(others)
    return with_prediction(scored.select(*filled.columns, *others, "LaunderingProbability"), threshold)


def preview(scored: DataFrame, key: str, n: int = 100) -> DataFrame:
    """First `n` scored rows by key."""
    return scored.orderBy(key).select("From_Account", "LaunderingProbability", "Prediction").limit(n)
