"""From raw transfers to typed transactions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import wall_clock
from riskflow.schemas import AMOUNT, CORRUPT, TRANSACTION_COLUMNS

AMOUNTS = ("Amount_Received", "Amount_Paid")


def reject_reason(marked: bool = False) -> Column:
    """Why a raw row is no transaction, null if it is one. An amount must be a number that fits exactly.

    `marked`: the rows have the column of lines of a wrong length; such a row is none, whatever its fields are.
    """
    paid = F.col("Amount_Paid")
    fits = paid.try_cast(AMOUNT).isNotNull() & F.coalesce(paid.try_cast("decimal(38,18)") == paid.try_cast(AMOUNT), F.lit(True))
    return (
        F.when(F.col(CORRUPT).isNotNull() if marked else F.lit(False), "malformed line")
        .when(F.col("From_Account").isNull(), "no sender")
        .when(paid.isNull(), "no amount")
        .when(~fits, "amount not readable")
        .when(F.col("Timestamp_str").isNull(), "no time")
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Keep rows with a sender, an amount and a time text; add `Timestamp` and `Hour`.

    A time text that cannot be parsed leaves both null; the row stays. Amounts may be text or numbers. What
    is left out is in `rejected_transactions`.
    """
    stamp = wall_clock(F.col("Timestamp_str"))
    columns = [F.col(c).try_cast(AMOUNT).alias(c) if c in AMOUNTS else F.col(c) for c in TRANSACTION_COLUMNS]
    return raw.where(reject_reason(CORRUPT in raw.columns).isNull()).select(*columns, stamp.alias("Timestamp"), F.hour(stamp).alias("Hour"))


def rejected_transactions(raw: DataFrame) -> DataFrame:
    """The rows that `clean_transactions` leaves out, as they are, with `reason`."""
    return raw.withColumn("reason", reject_reason(CORRUPT in raw.columns)).where("reason IS NOT NULL")


def reject_counts(raw: DataFrame) -> DataFrame:
    """reason, n_rows for each reason that occurs."""
    return rejected_transactions(raw).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
