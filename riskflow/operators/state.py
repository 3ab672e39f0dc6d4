"""Account features from mergeable partial states, so that new files are added without reading the old ones.

A state is one row per account: `n`, `total`, `high`, `low`, `mean` and `squares` (the sum of squared distances from the mean),
`hours` (24 counts), `currencies` and `formats` (sorted sets). States of disjoint rows merge in any number and order to
the state of all of them; counts, sums, extremes, hours and sets do so exactly, the spread to the last digits.

Sets hold every category of an account; a key with an unbounded number of them belongs into `sketches`.

A store is a folder with one folder of states per batch. Writing a batch again replaces it, so a repeated job counts nothing twice.
Nulls are treated as by `account_features`: a null account is an account, null categories aren't counted, null hours neither; an
amount that is null counts as a transaction without amount.
"""

import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskflow.functions.columns import histogram_median
from riskflow.operators.features import ACCOUNT, CURRENCY, FORMAT, HOUR
from riskflow.schemas import ACCOUNT_STATE
from riskflow.sources.sinks import write_table

SETS = {CURRENCY: "currencies", FORMAT: "formats"}


def _merged_moments(parts: Column) -> Column:
    """(n, mean, squares) of all parts, two at a time: nothing large is subtracted.

    Parts without amounts (n 0) change nothing. Sorting makes the result the same in every order of rows.
    """

    def two(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        step = b["mean"] - a["mean"]
        share = b["n"].cast("double") / n
        both = F.struct(
            n.alias("n"),
            (a["mean"] + step * share).alias("mean"),
            (a["squares"] + b["squares"] + step * step * a["n"].cast("double") * share).alias("squares"),
        )
        return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)

    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    return F.aggregate(F.array_sort(parts), none, two)


def _moments(n: str, mean: str, squares: str) -> Column:
    columns = (F.col(n), F.coalesce(mean, F.lit(0.0)), F.coalesce(squares, F.lit(0.0)))
    return _merged_moments(F.collect_list(F.struct(*[c.alias(a) for c, a in zip(columns, ("n", "mean", "squares"), strict=True)])))


def _with_moments(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns({"paid": F.col("_moments.n"), "mean": F.col("_moments.mean"), "squares": F.col("_moments.squares")})
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ACCOUNT_STATE])


def account_state(tx: DataFrame) -> DataFrame:
    """The state of each account of clean transactions.

    Rows are first reduced per (account, currency, format, hour) on the map side, with centred moments; sets, hours and
    moments come from these far fewer rows, so a hot account stays spread.
    """
    amount = F.col("Amount_Paid")
    number = amount.cast("double")
    parts = tx.groupBy(ACCOUNT, CURRENCY, FORMAT, HOUR).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(amount).alias("_paid"),
        F.sum(amount).alias("_total"),
        F.max(amount).alias("_high"),
        F.min(amount).alias("_low"),
        F.avg(number).alias("_mean"),
        (F.var_pop(number) * F.count(amount)).alias("_squares"),
    )
    return _with_moments(
        parts.groupBy(ACCOUNT).agg(
            F.sum("_n").alias("n"),
            F.sum("_total").alias("total"),
            F.max("_high").alias("high"),
            F.min("_low").alias("low"),
            _moments("_paid", "_mean", "_squares").alias("_moments"),
            F.array(*[F.sum(F.when(F.col(HOUR) == h, F.col("_n")).otherwise(0)) for h in range(24)]).alias("hours"),
            *[F.array_sort(F.collect_set(c)).alias(name) for c, name in SETS.items()],
        )
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per account from any number of them; a lone state stays as it is."""
    hours = F.array(*[F.sum(F.col("hours")[h]) for h in range(24)])
    return _with_moments(
        states.groupBy(ACCOUNT).agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            _moments("paid", "mean", "squares").alias("_moments"),
            hours.alias("hours"),
            *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(s)))).alias(s) for s in SETS.values()],
        )
    )


def state_features(state: DataFrame, stddev: bool = True) -> DataFrame:
    """The feature rows that `account_features` makes of the same transactions."""
    n, paid, total = F.col("n"), F.col("paid"), F.col("total").cast("double")
    spread = F.when(paid > 1, F.when(F.col("high") == F.col("low"), F.lit(0.0)).otherwise(F.sqrt(F.col("squares") / (paid - 1))))
    return state.select(
        ACCOUNT,
        n.alias("TxnCount"),
        total.alias("TotalAmount"),
        (total / n).alias("AvgAmount"),
        F.col("high").cast("double").alias("MaxAmount"),
        F.col("low").cast("double").alias("MinAmount"),
        *([spread.alias("StdDevAmount")] if stddev else []),
        F.size("currencies").cast("bigint").alias("NumCurrencies"),
        F.size("formats").cast("bigint").alias("NumFormats"),
        histogram_median("hours").alias("HourBucket"),
    )


# The store


def _batch_folder(store: str, batch: str) -> str:
    if not re.search(r"[^._]", batch):
        raise ValueError(f"no name for a batch: {batch!r}")
    return f"{store}/batch={quote(batch, safe='')}"


def write_batch(state: DataFrame, store: str, batch: str) -> None:
    """Put the states of one batch of transactions into the store; a batch of that name is replaced."""
    write_table(state.select(*ACCOUNT_STATE.names), _batch_folder(store, batch))


def read_states(spark: SparkSession, store: str, batches: list[str] | None = None) -> DataFrame:
    """States of all batches, or of some, with `batch`; several rows for an account that is in several batches."""
    paths = [store] if batches is None else [_batch_folder(store, b) for b in batches]
    rows = spark.read.schema(StructType([*ACCOUNT_STATE, StructField("batch", StringType())])) if batches is None else spark.read.schema(ACCOUNT_STATE)
    rows = rows.option("basePath", store) if batches is not None else rows
    return rows.parquet(*paths)


def add_batch(tx: DataFrame, store: str, batch: str) -> DataFrame:
    """Add new transactions to the store and return the merged states of all accounts; old transactions aren't read."""
    write_batch(account_state(tx), store, batch)
    return merge_states(read_states(tx.sparkSession, store))


def compact(spark: SparkSession, store: str, batches: list[str], into: str, new_store: str) -> None:
    """Merge some batches into one and copy the others to a new store: readers of the old store aren't disturbed."""
    states = read_states(spark, store)
    old = F.col("batch").isin(batches)
    write_batch(merge_states(states.where(old)), new_store, into)
    for (batch,) in states.where(~old).select("batch").distinct().collect():  # a row for each batch
        write_batch(read_states(spark, store, [batch]), new_store, batch)
