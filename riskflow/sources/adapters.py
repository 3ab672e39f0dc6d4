"""Views of the benchmark tables in the library's layouts.

The tables hold no bank transfers, so `events` and `orders` stand in for them; whole tables are
read, and every column is derived from theirs.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.schemas import AMOUNT

BANKS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bank(account: Column) -> Column:
    return F.pmod(account, F.lit(BANKS))


def _transfer_columns() -> dict[str, Column]:
    payer = F.col("user_id")
    payee = payer + 1
    amount = F.col("value").cast(AMOUNT)
    return {
        "From_Bank": _bank(payer).cast("string"),
        "From_Account": payer.cast("string"),
        "To_Bank": _bank(payee).cast("string"),
        "To_Account": payee.cast("string"),
        "Amount_Received": amount,
        "Receiving_Currency": F.col("props"),
        "Amount_Paid": amount,
        "Payment_Currency": F.col("props"),
        "Payment_Format": F.col("event_type"),
        "Is_Laundering": ((F.col("event_type") == "error") & (F.col("value") > 200)).cast("int"),
    }


def transfers_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean transactions; the payer is the user, the payee the next user. `keep` names further columns."""
    return events.select(
        *keep,
        *[c.alias(name) for name, c in _transfer_columns().items()],
        F.col("ts").alias("Timestamp"),
        F.hour("ts").alias("Hour"),
    )


def raw_transfers_from_events(events: DataFrame) -> DataFrame:
    """The same before cleaning, with an id. Purchases lack seconds, signups have a malformed
    time, and amounts under 1 are missing.
    """
    kind = F.col("event_type")
    text = (
        F.when(kind == "purchase", F.date_format("ts", "yyyy/MM/dd HH:mm"))
        .when(kind == "signup", F.date_format("ts", "dd-MM-yyyy"))
        .otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
    )
    columns = _transfer_columns()
    columns["Amount_Paid"] = F.when(F.col("value") >= 1, columns["Amount_Paid"])
    return events.select("event_id", text.alias("Timestamp_str"), *[c.alias(name) for name, c in columns.items()])


def label_rows_from_events(events: DataFrame) -> DataFrame:
    """Label rows: errors are the investigated transfers, large ones are laundering."""
    rows = transfers_from_events(events.where("event_type = 'error'"))
    return rows.select("From_Bank", "From_Account", F.col("Is_Laundering").alias("isLaundering"))


def transfers_from_orders(orders: DataFrame) -> DataFrame:
    """Clean transactions with an id; the payer is the customer."""
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("From_Account"),
        F.col("o_totalprice").cast(AMOUNT).alias("Amount_Paid"),
        F.col("o_orderstatus").alias("Payment_Currency"),
        F.col("o_orderpriority").alias("Payment_Format"),
        F.col("o_orderdate").alias("Timestamp"),
        F.hour("o_orderdate").alias("Hour"),
        (
            (F.col("o_orderpriority") == "1-URGENT")
            & (F.col("o_orderstatus") == "F")
            & (F.col("o_totalprice") > 300000)
        )
        .cast("int")
        .alias("isLaundering"),
    )


def log_from_events(events: DataFrame) -> DataFrame:
    """A pattern log: one source per bank, lines in event order.

    Errors open a block, signups close it, other events are data lines. Views over 150 are cut
    short, and amounts under 1 leave a field empty. Segment k holds the events k^2 to (k+1)^2 - 1,
    so both the number of segments and their size grow with the root of the table.
    """
    bank = f"string(user_id % {BANKS})"
    payee_bank = f"string((user_id + 1) % {BANKS})"
    amount = "string(cast(value AS decimal(18,2)))"
    short = f"concat_ws(',', date_format(ts, 'yyyy/MM/dd HH:mm'), {bank}, user_id)"
    line = f"""CASE
        WHEN event_type = 'error'
        THEN concat('BEGIN LAUNDERING ATTEMPT - P', user_id % 8, ':  Max ', user_id)
        WHEN event_type = 'signup' THEN 'END LAUNDERING ATTEMPT - P'
        WHEN event_type = 'view' AND value > 150 THEN {short}
        ELSE concat_ws(',', {short}, {payee_bank}, user_id + 1, CASE WHEN value >= 1 THEN {amount} ELSE '' END,
                       props, {amount}, props, event_type, CASE WHEN value > 100 THEN '1' ELSE '0' END)
        END AS value"""
    segment = "coalesce(bigint(floor(sqrt(event_id))), 0L) AS segment"
    return events.selectExpr(f"{bank} AS source", segment, "event_id AS line_no", line)
