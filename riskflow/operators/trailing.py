"""How much an account did in the period before each of its transactions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.sources.scratch import scratch_path
from riskflow.sources.sinks import through_table

#: Slots that a period is cut into. A task holds one account's transactions of one slot and the probes that fall into it.
SLOTS = 24


def _micros(time: Column) -> Column:
    return F.unix_micros(F.concat(time.cast("string"), F.lit("Z")).cast("timestamp"))


def trailing_counts(
    tx: DataFrame, period: str = "1 day", account: str = "From_Account", time: str = "Timestamp", amount: str = "Amount_Paid", slots: int = SLOTS
) -> DataFrame:
    """The rows with `TrailingCount` and `TrailingAmount`: transactions of the account in (t - period, t], the row's own and others at
    its very time included.

    Both are differences of running totals, at t and at t - period. An account's time is cut into slots; totals
    inside a slot are running ones, those of the slots before it are added from one row per slot. So a hot account lies in as many
    tasks as it has slots, and no row is copied for each period it belongs to: each makes two, an event and a probe.

    Rows without a time have nulls. A null account is an account; a null amount counts as a transaction without amount.
    Amounts are decimals, so totals are exact. Columns of the input stay; those with names of results are replaced.
    """
    # A day is 24 hours here: times have no zone.
    width = F.expr(f"bigint(unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {period}))")
    step = F.ceil(width / F.lit(slots)).cast("bigint")
    own = [c for c in tx.columns if c not in ("TrailingCount", "TrailingAmount")]
    payload = F.struct(*[F.col(c) for c in own])
    rows = tx.select(
        payload.alias("_row"), F.col(account).cast("string").alias("_key"), _micros(F.col(time)).alias("_at"), F.col(amount).cast("decimal(28,8)").alias("_paid")
    )
    untimed = rows.where("_at IS NULL")
    # Written once, so that a task that runs again finds the same numbers.
    timed = rows.where("_at IS NOT NULL").withColumn("_id", F.monotonically_increasing_id())
    timed = through_table(timed, scratch_path(tx.sparkSession, "timed"))
    # An event adds at its time; probes read after all events of their time.
    events = F.struct(F.col("_at").alias("at"), F.lit(0).alias("sign"), F.lit(1).cast("bigint").alias("one"), F.col("_paid").alias("paid"))
    probe = lambda at, sign: F.struct(at.alias("at"), F.lit(sign).alias("sign"), F.lit(0).cast("bigint").alias("one"), F.lit(None).cast("decimal(28,8)").alias("paid"))
    marks = timed.select("_id", "_key", "_row", F.explode(F.array(events, probe(F.col("_at") - width, -1))).alias("_m"))
    marks = marks.select("_id", "_key", "_m.*", F.when(F.col("_m.sign") == 0, F.col("_row")).alias("_row"))
    marks = marks.withColumn("_slot", F.floor(F.col("at") / step).cast("bigint"))
    inside = Window.partitionBy("_key", "_slot").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots_of = marks.groupBy("_key", "_slot").agg(F.sum("one").alias("one"), F.sum("paid").alias("paid"))
    starts = slots_of.select(
        F.col("_key").alias("_k"),
        F.col("_slot").alias("_s"),
        F.coalesce(F.sum("one").over(before), F.lit(0)).alias("_ones"),
        F.coalesce(F.sum("paid").over(before), F.lit(0)).alias("_paids"),
    )
    running = marks.withColumns({"_n": F.sum("one").over(inside), "_sum": F.coalesce(F.sum("paid").over(inside), F.lit(0))})
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_slot") == F.col("_s"))
    sign = F.when(F.col("sign") == 0, 1).otherwise(-1)
    totals = running.join(starts, same).select(
        "_id",
        "_row",
        (sign * (F.col("_n") + F.col("_ones"))).cast("bigint").alias("_n"),
        (sign * (F.col("_sum") + F.col("_paids"))).cast("decimal(38,8)").alias("_sum"),
    )
    both = totals.groupBy("_id").agg(F.sum("_n").alias("TrailingCount"), F.sum("_sum").alias("TrailingAmount"), F.max_by("_row", F.col("_row").isNotNull()).alias("_row"))
    results = ["TrailingCount", "TrailingAmount"]
    none = untimed.select("_row", F.lit(None).cast("bigint").alias(results[0]), F.lit(None).cast("decimal(38,8)").alias(results[1]))
    return both.select("_row", *results).unionByName(none).select("_row.*", *results)
