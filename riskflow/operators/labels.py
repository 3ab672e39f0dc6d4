"""Label tables and their join to features."""

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 1024


def account_labels(rows: DataFrame, key: str = "From_Account", label: str = "isLaundering") -> DataFrame:
    """One row per key: the largest label seen for it."""
    return rows.groupBy(key).agg(F.max(F.col(label).try_cast("int")).alias("IsLaundering"))


def features_with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Every feature row with its label, 0 where there is none.

    Both sides hold one row per account, so no key of the join is hot. No broadcast hint: the
    label table grows with the data, and adaptive execution broadcasts it when it is small.
    """
    return features.join(labels, "From_Account", "left").withColumn(
        "IsLaundering", F.coalesce("IsLaundering", F.lit(0))
    )


def features_with_bank_labels(features: DataFrame, rows: DataFrame, label: str = "isLaundering") -> DataFrame:
    """Compatibility form that matches a numeric account id against the labelled bank id.

    Accounts that are not numbers cannot match; a salt spreads them instead of leaving all of
    them on the null key.
    """
    banks = account_labels(rows.select(F.col("From_Bank").try_cast("bigint").alias("_bank"), label), "_bank", label)
    account = F.col("From_Account").try_cast("bigint")
    salt = F.when(account.isNull(), F.pmod(F.xxhash64("From_Account"), F.lit(SALTS)) + 1).otherwise(F.lit(0))
    keyed = features.withColumns({"_bank": F.coalesce(account, F.lit(0)), "_salt": salt.cast("bigint")})
    banks = banks.where("_bank IS NOT NULL").withColumn("_salt", F.lit(0).cast("bigint"))
    return (
        keyed.join(banks, ["_bank", "_salt"], "left")
        .drop("_bank", "_salt")
        .withColumn("IsLaundering", F.coalesce("IsLaundering", F.lit(0)))
    )


def label_index(rows: DataFrame, label: str) -> StringIndexerModel:
    """An index of label texts in their alphabetical order, whatever their frequencies, with one bucket more for all others.

    The bucket's number is that of the labels; nulls and texts not seen here fall into it. The model can be saved. Labels are
    few, by their nature: the model holds all of them.
    """
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep").fit(rows)


def with_label_index(rows: DataFrame, label: str, index: StringIndexerModel, out: str = "label") -> DataFrame:
    """The rows with the number of their label in `out`, as double."""
    return index.copy().setInputCol(label).setOutputCol(out).transform(rows)


def unseen_labels(rows: DataFrame, label: str, index: StringIndexerModel) -> DataFrame:
    """label, n_rows for each text (or null) that the index doesn't know."""
    other = with_label_index(rows.select(label), label, index, "__label").where(F.col("__label") == len(index.labels))
    return other.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
