"""Stream forms of scoring and account features."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import hours_up_to, median_hour, utc_instant, utc_wall_clock
from riskflow.operators.scoring import score_batch_by_model, score_batch_by_rule, with_account_features

CURRENCY_BITS = 8


def score_stream(stream: DataFrame, amount: str, key: str) -> DataFrame:
    """The batch scoring, row by row over an unbounded input."""
    return score_batch_by_rule(stream, amount, key)


def score_stream_by_model(
    stream: DataFrame, model: PipelineModel, features: DataFrame | None = None, fill_nulls: bool | None = None
) -> DataFrame:
    """Arriving rows scored by a model, with the features of their accounts from a table where they lack a column.

    The join is one of a stream with a table: no state. The table is read anew for each batch, so features that another job writes
    between two batches count from then on. Written by `drain` or any file sink, each batch is written once, also when
    a restarted query repeats it, as the sink logs its files by batch.
    """
    rows = stream if features is None else with_account_features(stream, features)
    return score_batch_by_model(rows, model, fill_nulls=fill_nulls)


def account_windows(stream: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Features per account and tumbling window of `Timestamp`.

    State is a fixed number of values per open (window, account). Distinct currencies come from a theta sketch of 2 kB
    at most: exact up to 2^CURRENCY_BITS of them, and 6 % off beyond (standard error).
    """
    amount = F.col("Amount_Paid")
    sums = (
        stream.withColumn("Timestamp", utc_instant(F.col("Timestamp")))
        .withWatermark("Timestamp", delay)
        .groupBy(F.window("Timestamp", window).alias("_window"), "From_Account")
        .agg(
            F.count(F.lit(1)).alias("TxnCount"),
            F.sum(amount).cast("double").alias("TotalAmount"),
            F.max(amount).cast("double").alias("MaxAmount"),
            F.min(amount).cast("double").alias("MinAmount"),
            F.theta_sketch_agg("Payment_Currency", CURRENCY_BITS).alias("_currencies"),
            *hours_up_to("Hour", "1L"),
        )
    )
    return sums.select(
        utc_wall_clock(F.col("_window.start")).alias("window_start"),
        utc_wall_clock(F.col("_window.end")).alias("window_end"),
        "From_Account",
        "TxnCount",
        "TotalAmount",
        "MaxAmount",
        "MinAmount",
        F.theta_sketch_estimate("_currencies").alias("ApproxCurrencies"),
        median_hour().alias("HourBucket"),
    )


def last_windows(rows: DataFrame, closed: DataFrame, window: str = "1 day") -> DataFrame:
    """The windows that a drained stream has left open, from the same rows as a table.

    Windows close in order of time, so they are those from the end of the last closed one on; all, if none has closed.
    """
    end = closed.agg(F.max("window_end")).scalar()
    later = rows.where(end.isNull() | (F.col("Timestamp") >= end))
    return account_windows(later, window).select(closed.columns)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything that is there, append it to a Parquet folder, and read that."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
