import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.functions.columns import wall_clock
from riskflow.operators.clean import clean_transactions, reject_counts
from riskflow.schemas import RAW_TRANSACTIONS
from riskflow.sources.readers import (
    files_by_header,
    malformed_counts,
    raw_positions,
    read_csv,
    read_label_rows,
    read_raw_transactions,
    read_scoring_batch,
    require_columns,
    union_sources,
)
from riskflow.sources.sinks import write_csv
from tests.conftest import rows

HEADER = (
    "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,"
    "Amount Paid,Payment Currency,Payment Format,Is Laundering"
)
LINES = [
    "2022/09/01 00:20,010,A1,020,B1,100.00,Dollar,100.00,Dollar,Wire,0",
    "2022/09/01 13:26:10,010,A1,021,B2,50.00,Euro,,Euro,Cheque,1",
    "2022/09/02 07:05,012,100,021,B2,7.25,Euro,7.25,Euro,Cheque,0",
    "bad-date,012,100,021,B2,7.25,Euro,7.25,Euro,Cheque,0",
    "2022/09/03 23:59:59,013,C1,021,B2,1.5,Bitcoin,0.000214,Bitcoin,Bitcoin,0",
    "2022/09/03 01:00,013,,021,B2,1,Euro,1,Euro,Wire,0",
]


@pytest.fixture
def raw_path(tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_clean(spark, raw_path, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = rows(
            clean_transactions(read_raw_transactions(spark, raw_path)).select(
                "From_Bank", "From_Account", "To_Account", "Amount_Paid", "Timestamp", "Hour"
            )
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert found == [
        ("010", "A1", "B1", Decimal("100"), dt.datetime(2022, 9, 1, 0, 20), 0),
        ("012", "100", "B2", Decimal("7.25"), dt.datetime(2022, 9, 2, 7, 5), 7),
        ("012", "100", "B2", Decimal("7.25"), None, None),
        ("013", "C1", "B2", Decimal("0.000214"), dt.datetime(2022, 9, 3, 23, 59, 59), 23),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock_has_no_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day does not exist in New York.
        texts = ["2022/03/13 02:30", "2022/03/13 02:30:05", "2022/13/01 00:00", "2022-03-13 02:30", "", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        found = rows(df.select(wall_clock(F.col("t")).cast("string"), F.hour(wall_clock(F.col("t")))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [("2022-03-13 02:30:00", 2), ("2022-03-13 02:30:05", 2)] + [(None, None)] * 4


def test_csv_keeps_null_apart_from_values(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a,b", 0.1, None), ('q"q', 1e-7, "x")], "s string, d double, n string")
    write_csv(df, path)
    assert sorted(rows(read_csv(spark, path, df.schema))) == sorted(rows(df))


def test_union_and_required_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    both = union_sources({"a": a, "b": b})
    assert sorted(rows(both.select("origin", "k", "v"))) == [("a", 1, "x"), ("b", 2, "y")]
    with pytest.raises(ValueError, match="From_Account"):
        require_columns(a, ["k", "From_Account"])


def test_large_amounts_stay_and_others_are_counted(spark, tmp_path):
    amounts = ["123456789012345.5", "0.12345678", "0.123456789", "1e30", "abc", ""]
    lines = [f"2022/09/01 00:20,010,A{i},020,B1,1,Dollar,{a},Dollar,Wire,0" for i, a in enumerate(amounts)]
    (tmp_path / "t.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    raw = read_raw_transactions(spark, str(tmp_path / "t.csv"))
    kept = {r.From_Account: r.Amount_Paid for r in clean_transactions(raw).collect()}
    assert kept == {"A0": Decimal("123456789012345.5"), "A1": Decimal("0.12345678")}
    assert dict(rows(reject_counts(raw))) == {"amount not readable": 3, "no amount": 1}


def test_batches_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("From_Account,TxnCount,note\nx,3,n\n")
    (tmp_path / "b.csv").write_text("TxnCount,From_Account,MaxAmount\n1000,y,7.5\n")
    found = read_scoring_batch(spark, str(tmp_path / "*.csv")).select("From_Account", "TxnCount", "MaxAmount", "note")
    assert sorted(rows(found)) == [("x", 3.0, None, "n"), ("y", 1000.0, 7.5, None)]


def test_both_forms_of_label_files(spark, tmp_path):
    (tmp_path / "long.csv").write_text("Timestamp,From_Bank,From_Account,Pattern_Type,isLaundering\nt,01,acc,CYCLE,1\n")
    (tmp_path / "short.csv").write_text("Timestamp,From_Bank,Pattern_Type,isLaundering\nt,01,CYCLE,1\n")
    assert rows(read_label_rows(spark, str(tmp_path / "long.csv"))) == [("t", "01", "acc", "CYCLE", 1)]
    assert rows(read_label_rows(spark, str(tmp_path / "short.csv"))) == [("t", "01", None, "CYCLE", 1)]


def test_raw_files_are_read_by_their_headers(spark, tmp_path):
    names = HEADER.split(",")
    fields = ["2022/09/01 00:20", "010", "A1", "020", "B1", "100.00", "Dollar", "99.00", "Euro", "Wire", "0"]
    order = [9, 3, 4, 10, 1, 2, 8, 7, 6, 5, 0]  # both banks keep their account beside them
    for name, places in (("straight", range(11)), ("turned", order)):
        (tmp_path / f"{name}.csv").write_text(",".join(names[k] for k in places) + "\n" + ",".join(fields[k] for k in places) + "\n")
    expected = rows(read_raw_transactions(spark, str(tmp_path / "straight.csv")))
    assert rows(read_raw_transactions(spark, str(tmp_path / "turned.csv"))) == expected
    assert rows(read_raw_transactions(spark, [str(tmp_path / f"{n}.csv") for n in ("straight", "turned")])) == expected * 2
    (tmp_path / "empty.csv").write_text("")
    assert rows(read_raw_transactions(spark, str(tmp_path / "*.csv"))) == expected * 2


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda h: h.replace("Amount Paid,Payment Currency", "Payment Currency,Paid"), "Amount_Paid"),
        (lambda h: h.replace("Amount Received", "Amount Paid"), "two columns for Amount_Paid"),
        (lambda h: ",".join(h.split(",")[:7]), "Amount_Paid, Payment_Currency"),
    ],
)
def test_headers_that_cannot_be_read(spark, tmp_path, change, message):
    (tmp_path / "t.csv").write_text(change(HEADER) + "\n" + ",".join("x" * 11) + "\n")
    with pytest.raises(ValueError, match=message):
        read_raw_transactions(spark, str(tmp_path / "t.csv"))


def test_header_names():
    assert raw_positions(("TIMESTAMP", "from_bank", "Account2", "To Bank", "Account4", "u", "v", "w", "x", "y", "z")) == {
        f: k for k, f in enumerate(RAW_TRANSACTIONS.names)
    }
    assert raw_positions(("To Bank", "Account", "From Bank", "Account", *HEADER.split(",")[5:], "Timestamp"))["To_Account"] == 1


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no file with a header"):
        read_raw_transactions(spark, str(tmp_path / "empty.csv"))


def test_lines_of_a_wrong_length_are_counted(spark, tmp_path):
    good = "2022/09/01 00:20,010,A{},020,B1,1,Dollar,5,Dollar,Wire,0"
    lines = [HEADER, good.format(1), "2022/09/01 00:20,010,A2", good.format(3) + ",more,fields", good.format(4).replace("Wire", '"Wi\nre"'), good.format(5)]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    raw = read_raw_transactions(spark, str(tmp_path / "t.csv"), corrupt=True)
    assert dict(rows(malformed_counts(raw))) == {"short": 1, "long": 1, "quote": 2}
    assert dict(rows(reject_counts(raw))) == {"malformed line": 4}
    assert {r.From_Account for r in clean_transactions(raw).collect()} == {"A1", "A5"}
    # Counted, too, when a query reads one column only.
    assert raw.where("_corrupt IS NOT NULL").count() == 4
    (tmp_path / "batch.csv").write_text("From_Account,TxnCount\nx,1\ny\nz,2,3\n")
    batch = read_scoring_batch(spark, str(tmp_path / "batch.csv"), corrupt=True)
    assert dict(rows(malformed_counts(batch))) == {"short": 1, "long": 1}
    (tmp_path / "twice.csv").write_text("From_Account,a,a\nx,1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_scoring_batch(spark, str(tmp_path / "twice.csv"))


def test_headers_are_read_without_the_text(spark, tmp_path):
    """The task for a file's header stops after its first batch of rows."""
    (tmp_path / "t.csv").write_text(HEADER + "\n" + "x,y\n" * 200_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert list(files_by_header(spark, str(tmp_path / "t.csv"))) == [tuple(HEADER.split(","))]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
