"""One feature row per sending account."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.columns import hours_up_to, median_hour

ACCOUNT, CURRENCY, FORMAT, HOUR = "From_Account", "Payment_Currency", "Payment_Format", "Hour"


def account_features(tx: DataFrame, stddev: bool = False) -> DataFrame:
    """Counts, sums, extremes, distinct currencies and formats and typical hour per account.

    Rows are first reduced per (account, currency, format, hour), on the map side too, so a hot account
    stays spread. What follows, also the two distinct counts, works on these far fewer rows. It is
    exact for any number of categories, and reads the source once.
    """
    amount = F.col("Amount_Paid")
    parts = tx.groupBy(ACCOUNT, CURRENCY, FORMAT, HOUR).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(amount).alias("_sum"),
        F.max(amount).alias("_max"),
        F.min(amount).alias("_min"),
        *([F.avg(amount.cast("double")).alias("_mean"), F.var_pop(amount.cast("double")).alias("_variance")] if stddev else []),
    )
    if stddev:
        # Squared distances from the account's mean: those from the part's own, and of the part's from it.
        # Nothing large is subtracted, so small spreads around large means stay right.
        account = Window.partitionBy(ACCOUNT)
        mean = F.sum(F.col("_n") * F.col("_mean")).over(account) / F.sum("_n").over(account)
        between = F.col("_mean") - mean
        parts = parts.withColumn("_squares", F.col("_n") * (F.col("_variance") + between * between))
    n, total = F.sum("_n"), F.sum("_sum").cast("double")
    spread = F.when(n > 1, F.when(F.max("_max") == F.min("_min"), F.lit(0.0)).otherwise(F.sqrt(F.sum("_squares") / (n - 1))))
    sums = parts.groupBy(ACCOUNT).agg(
        n.alias("TxnCount"),
        total.alias("TotalAmount"),
        (total / n).alias("AvgAmount"),
        F.max("_max").cast("double").alias("MaxAmount"),
        F.min("_min").cast("double").alias("MinAmount"),
        *([spread.alias("StdDevAmount")] if stddev else []),
        F.count_distinct(CURRENCY).alias("NumCurrencies"),
        F.count_distinct(FORMAT).alias("NumFormats"),
        *hours_up_to(HOUR, "_n"),
    )
    hours = [c for c in sums.columns if c.startswith("_to")]
    return sums.withColumn("HourBucket", median_hour()).drop(*hours)


def typical_hours(tx: DataFrame) -> DataFrame:
    """Only the typical hour per account: one aggregate of 24 counts."""
    return tx.groupBy(ACCOUNT).agg(*hours_up_to(HOUR, "1L")).select(ACCOUNT, median_hour().alias("HourBucket"))


def distinct_counts(tx: DataFrame) -> DataFrame:
    """Only the distinct currencies and formats per account, from the distinct combinations of the three."""
    combinations = tx.select(ACCOUNT, CURRENCY, FORMAT).distinct()
    return combinations.groupBy(ACCOUNT).agg(
        F.count_distinct(CURRENCY).alias("NumCurrencies"), F.count_distinct(FORMAT).alias("NumFormats")
    )


def account_totals(tx: DataFrame) -> DataFrame:
    """Total, count and average amount per account.

    The count is a bigint: a 32-bit count overflows on an account with over 2^31 rows.
    """
    total = F.sum("Amount_Paid").cast("double")
    count = F.count(F.lit(1))
    return (
        tx.where("From_Account IS NOT NULL AND Amount_Paid IS NOT NULL")
        .groupBy(F.col("From_Account").alias("Account"))
        .agg(total.alias("TotalAmount"), count.alias("TxnCount"), (total / count).alias("AvgAmount"))
    )
