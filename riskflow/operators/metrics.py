"""Binary-classifier metrics as DataFrame queries. Labels and predictions are 0 or 1."""

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.columns import at_least, ratio
from riskflow.operators.ordering import BEFORE


def _cells(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((label == 0) & (prediction == 0)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tp": F.count_if((label == 1) & (prediction == 1)),
    }


def _one_row_of_cells(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.agg(*[c.alias(name) for name, c in _cells(F.col(label), F.col(prediction)).items()])


def confusion_matrix(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Four rows (label, prediction, count); empty cells are present with 0."""
    cells = [
        F.struct(F.lit(actual).alias("label"), F.lit(given).alias("prediction"), F.col(name).alias("count"))
        for name, actual, given in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]
    return _one_row_of_cells(scored, label, prediction).select(F.inline(F.array(*cells)))


def _class_scores(hit: Column, false_alarm: Column, miss: Column) -> tuple[Column, Column, Column, Column]:
    precision = ratio(hit, hit + false_alarm)
    recall = ratio(hit, hit + miss)
    return precision, recall, ratio(2 * hit, 2 * hit + false_alarm + miss), hit + miss


def classification_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted averages.

    Undefined values are 0. The accuracy row carries accuracy in the f1 column.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    zero = _class_scores(tn, fn, fp)
    one = _class_scores(tp, fp, fn)
    total = tn + fp + fn + tp

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(i: int) -> Column:
        return (zero[i] + one[i]) / 2

    def weighted(i: int) -> Column:
        return ratio(zero[i] * zero[3] + one[i] * one[3], total)

    none = F.lit(None).cast("double")
    rows = [
        row("0", *zero),
        row("1", *one),
        row("accuracy", none, none, ratio(tn + tp, total), total),
        row("macro avg", macro(0), macro(1), macro(2), total),
        row("weighted avg", weighted(0), weighted(1), weighted(2), total),
    ]
    return _one_row_of_cells(scored, label, prediction).select(F.inline(F.array(*rows)))


def threshold_report(scored: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Confusion cells and positive-class scores for several thresholds, from one pass."""
    counts, rows = [], []
    for i, threshold in enumerate(thresholds):
        cells = _cells(F.col(label), at_least(F.col(score), threshold))
        counts += [c.alias(f"{name}{i}") for name, c in cells.items()]
        tn, fp, fn, tp = (F.col(f"{c}{i}") for c in ("tn", "fp", "fn", "tp"))
        precision, recall, f1, _ = _class_scores(tp, fp, fn)
        rows.append(
            F.struct(
                F.lit(float(threshold)).alias("threshold"),
                tn.alias("tn"),
                fp.alias("fp"),
                fn.alias("fn"),
                tp.alias("tp"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1.alias("f1"),
                ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
            )
        )
    return scored.agg(*counts).select(F.inline(F.array(*rows)))


def _range_of(score: str, steps: int) -> Column:
    """How many of the sorted `_cuts` are at most the score: first in strides, then inside one stride.

    Never null: else a join on it would infer a null filter and evaluate this on raw rows.
    """
    stride = f"size(filter(sequence({steps}, {steps * (steps - 1)}, {steps}), i -> _cuts[i - 1] <= {score}))"
    rest = f"size(filter(slice(_cuts, {steps} * {stride} + 1, {steps - 1}), cut -> cut <= {score}))"
    return F.expr(f"coalesce({steps} * {stride} + {rest}, 0)")


def auc_exact(scored: DataFrame, label: str, score: str, steps: int | None = None) -> DataFrame:
    """Area under the ROC curve without binning: one row (auc, n_positive, n_negative, n_unscored).

    Rows without a score, or with NaN, are counted in `n_unscored` only. `steps` squared is at least the
    session's number of shuffle partitions unless it is given.

    Equals the share of (positive, negative) pairs ranked right, ties counting half. Rows are
    first counted per distinct score. Scores are then cut into `steps` squared ranges holding about
    equally many distinct scores; the negatives below a score are those of the lower ranges plus
    those below it in its own range. Any cut gives the same result; an even one spreads the work.
    """
    if steps is None:
        steps = max(4, isqrt(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1) + 1)
    by_score = scored.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_all_pos"), F.count_if(F.col(label) == 0).alias("_all_neg")
    )
    unscored = F.isnull("_score") | F.isnan("_score")
    by_score = by_score.select(
        "_score",
        F.when(unscored, 0).otherwise(F.col("_all_pos")).alias("_pos"),
        F.when(unscored, 0).otherwise(F.col("_all_neg")).alias("_neg"),
        F.when(unscored, F.col("_all_pos") + F.col("_all_neg")).otherwise(0).alias("_un"),
    )
    # The cuts and the range sums read the same columns as the main branch, so that all three share
    # one exchange of `by_score` and the scores are computed once.
    labelled = F.when(F.col("_pos") + F.col("_neg") > 0, F.col("_score"))
    ranges = steps * steps
    cuts = by_score.agg(F.percentile_approx(labelled, [i / ranges for i in range(1, ranges)]))
    ranged = by_score.withColumn("_cuts", cuts.scalar()).withColumn("_range", _range_of("_score", steps)).drop("_cuts")
    lower = Window.orderBy("_range").rowsBetween(*BEFORE)  # at most `ranges` rows
    below_range = (
        ranged.groupBy("_range")
        .agg(F.sum("_neg").alias("_range_neg"), F.sum("_pos").alias("_range_pos"))
        .where("_range_neg + _range_pos >= 0")
        .select("_range", F.coalesce(F.sum("_range_neg").over(lower), F.lit(0)).alias("_below_range"))
    )
    inside = Window.partitionBy("_range").orderBy("_score").rowsBetween(*BEFORE)
    below = F.col("_below_range") + F.coalesce(F.col("_below_inside"), F.lit(0))
    # Twice the number of pairs won, as a whole number.
    won = F.col("_pos").cast("decimal(19,0)") * (2 * below + F.col("_neg")).cast("decimal(19,0)")
    totals = (
        ranged.withColumn("_below_inside", F.sum("_neg").over(inside))
        .join(below_range, "_range")
        .agg(
            F.sum(won).alias("_won"),
            F.sum("_pos").alias("n_positive"),
            F.sum("_neg").alias("n_negative"),
            F.sum("_un").alias("n_unscored"),
        )
    )
    positive, negative = F.col("n_positive"), F.col("n_negative")
    both = F.when(
        (positive > 0) & (negative > 0),
        F.col("_won").cast("double") / (2.0 * positive.cast("double") * negative.cast("double")),
    ).otherwise(F.raise_error(F.lit("AUC needs rows of both classes")).cast("double"))
    return totals.select(both.alias("auc"), "n_positive", "n_negative", "n_unscored")
