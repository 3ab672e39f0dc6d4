"""Column layouts, feature lists and scoring constants.

Everything in this file is a fixed value that results depend on.
"""

from pyspark.sql import types as T

# Money is decimal so that sums are exact and do not depend on task order. Eight
# fractional digits hold crypto-currency amounts, twenty integer digits the rest.
AMOUNT = T.DecimalType(28, 8)

# Raw transfer files, by position. The file repeats the header "Account", so the
# names are declared here instead of being taken from the header line. Amounts are text here:
# one that doesn't fit is rejected and counted, not lost on the way.
RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("Timestamp_str", T.StringType()),
        T.StructField("From_Bank", T.StringType()),
        T.StructField("From_Account", T.StringType()),
        T.StructField("To_Bank", T.StringType()),
        T.StructField("To_Account", T.StringType()),
        T.StructField("Amount_Received", T.StringType()),
        T.StructField("Receiving_Currency", T.StringType()),
        T.StructField("Amount_Paid", T.StringType()),
        T.StructField("Payment_Currency", T.StringType()),
        T.StructField("Payment_Format", T.StringType()),
        T.StructField("Is_Laundering", T.IntegerType()),
    ]
)

# Names that raw files give these fields, in small letters with _ for everything else. "account" depends on its place.
RAW_NAMES = {
    "timestamp": "Timestamp_str",
    "timestamp_str": "Timestamp_str",
    "from_bank": "From_Bank",
    "from_account": "From_Account",
    "account2": "From_Account",
    "to_bank": "To_Bank",
    "to_account": "To_Account",
    "account4": "To_Account",
    "amount_received": "Amount_Received",
    "receiving_currency": "Receiving_Currency",
    "amount_paid": "Amount_Paid",
    "payment_currency": "Payment_Currency",
    "payment_format": "Payment_Format",
    "is_laundering": "Is_Laundering",
}
# Column with the text of a line that has too few or too many fields.
CORRUPT = "_corrupt"

TRANSACTION_COLUMNS = [f.name for f in RAW_TRANSACTIONS if f.name != "Timestamp_str"]

# Comma-separated fields of a data line in a pattern log.
PATTERN_FIELDS = [
    "Timestamp",
    "From_Bank",
    "From_Account",
    "To_Bank",
    "To_Account",
    "Amount_Received",
    "Receiving_Currency",
    "Amount_Paid",
    "Payment_Currency",
    "Payment_Format",
]

PATTERN_LABELS = T.StructType(
    [
        T.StructField("Timestamp", T.StringType()),
        T.StructField("From_Bank", T.StringType()),
        T.StructField("From_Account", T.StringType()),
        T.StructField("Pattern_Type", T.StringType()),
        T.StructField("isLaundering", T.IntegerType()),
    ]
)

# Log markers and patterns.
BEGIN_MARKER = "BEGIN LAUNDERING ATTEMPT - "
BEGIN_PATTERN = BEGIN_MARKER + "(.+)"
END_MARKER = "END LAUNDERING ATTEMPT"
DATE_PATTERN = r"\d{4}/\d{2}/\d{2}"
NAME_SUFFIX = ":.*"

# Values given to feature columns that a scoring input lacks.
DEFAULT_FEATURES = {
    "TxnCount": 5,
    "TotalAmount": 20000.0,
    "AvgAmount": 5000.0,
    "MaxAmount": 10000.0,
    "MinAmount": 100.0,
    "StdDevAmount": 2000.0,
    "NumCurrencies": 2,
    "NumFormats": 2,
    "HourBucket": 14,
}

# Features read by each model.
FEATURE_LISTS = {
    "gbt": [
        "TxnCount",
        "TotalAmount",
        "AvgAmount",
        "MaxAmount",
        "MinAmount",
        "NumCurrencies",
        "NumFormats",
        "HourBucket",
    ],
    "boosted": list(DEFAULT_FEATURES),
}

FEATURES = T.StructType(
    [
        T.StructField("From_Account", T.StringType()),
        T.StructField("TxnCount", T.LongType()),
        T.StructField("TotalAmount", T.DoubleType()),
        T.StructField("AvgAmount", T.DoubleType()),
        T.StructField("MaxAmount", T.DoubleType()),
        T.StructField("MinAmount", T.DoubleType()),
        T.StructField("NumCurrencies", T.LongType()),
        T.StructField("NumFormats", T.LongType()),
        T.StructField("HourBucket", T.IntegerType()),
    ]
)
# What is kept of an account so that features of more transactions can be made without reading these again.
ACCOUNT_STATE = T.StructType(
    [
        T.StructField("From_Account", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("paid", T.LongType()),
        T.StructField("total", T.DecimalType(38, 8)),
        T.StructField("high", AMOUNT),
        T.StructField("low", AMOUNT),
        T.StructField("mean", T.DoubleType()),
        T.StructField("squares", T.DoubleType()),
        T.StructField("hours", T.ArrayType(T.LongType())),
        T.StructField("currencies", T.ArrayType(T.StringType())),
        T.StructField("formats", T.ArrayType(T.StringType())),
    ]
)

ML_DATASET = T.StructType([*FEATURES, T.StructField("IsLaundering", T.IntegerType())])

# Rule score: probability range by amount paid, highest band first; the last band has no floor.
RULE_BANDS = [
    (50000.0, 0.7, 0.95),
    (20000.0, 0.4, 0.7),
    (None, 0.05, 0.4),
]
DECISION_THRESHOLD = 0.5
STRICT_THRESHOLD = 0.7
VERDICTS = {1: "Likely Laundering", 0: "Not Laundering"}

# Rounds, depth and learning rate of the boosted-tree models that are compared.
BOOSTERS = {
    "gbt_50": {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1},
}
# The same for the second-order booster, whose other parameters are its usual defaults.
HISTOGRAM_BOOSTERS = {
    "boosted_100_depth6": {"rounds": 100, "depth": 6, "rate": 0.1},
    "boosted_100_depth5": {"rounds": 100, "depth": 5, "rate": 0.1},
}
SEED = 42
