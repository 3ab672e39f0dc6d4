import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.operators import patterns, profiling
from riskflow.sources.adapters import log_from_events, table
from riskflow.sources.readers import read_pattern_lines
from tests.conftest import plan_of, rows

LOG = """2022/09/01 00:01,001,Z0,002,Z1,1.00,Dollar,1.00,Dollar,Wire,1
BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 3-degree
2022/09/01 00:06,010,A1,020,B1,10.00,Dollar,10.00,Dollar,Wire,1
2022/09/01 00:07,010,A1
END LAUNDERING ATTEMPT - FAN-OUT

2022/09/01 00:09,011,C1,020,B1,10.00,Dollar,10.00,Dollar,Wire,1
BEGIN LAUNDERING ATTEMPT - CYCLE
2022/09/01 01:00,012,D1,020,B1,,Dollar,10.00,Dollar,Wire,0
END LAUNDERING ATTEMPT - CYCLE
"""


def sequential_fill(lines, stop_at_end):
    name, result = None, []
    for line in lines:
        header = re.search("BEGIN LAUNDERING ATTEMPT - (.+)", line)
        if header:
            name = header.group(1)
        if stop_at_end and "END LAUNDERING ATTEMPT" in line:
            name = None
        result.append(name)
    return result


@pytest.fixture
def log_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text(LOG)
    return read_pattern_lines(spark, str(tmp_path / "log.txt"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rows_of_a_log(spark, log_lines, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        literal = rows(
            patterns.pattern_transactions(log_lines)
            .orderBy("line_no")
            .select("From_Account", "Amount_Received", "Pattern_Type", "isLaundering")
        )
        field = rows(
            patterns.pattern_transactions(log_lines, label="field", stop_at_end=True, clean_names=False)
            .orderBy("line_no")
            .select("From_Account", "Payment_Format", "Pattern_Type", "isLaundering")
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert literal == [
        ("Z0", "1.00", None, 1),
        ("A1", "10.00", "FAN-OUT", 1),
        ("A1", None, "FAN-OUT", 1),
        ("C1", "10.00", "FAN-OUT", 1),
        ("D1", "", "CYCLE", 1),
    ]
    assert field == [
        ("Z0", "Wire", None, 1),
        ("A1", "Wire", "FAN-OUT:  Max 3-degree", 1),
        ("A1", None, "FAN-OUT:  Max 3-degree", None),
        ("C1", "Wire", None, 1),
        ("D1", "Wire", "CYCLE", 0),
    ]


def test_profile_of_a_log(log_lines):
    found = patterns.pattern_transactions(log_lines)
    assert dict(rows(profiling.pattern_counts(found))) == {None: 0, "FAN-OUT": 3, "CYCLE": 1}
    assert rows(profiling.empty_string_counts(found, ["Amount_Received", "Pattern_Type"])) == [(1, 0)]
    assert rows(profiling.null_counts(found, ["Pattern_Type", "Payment_Format"])) == [(5, 1, 1)]
    narrow = patterns.pattern_labels(found)
    assert narrow.columns == ["Timestamp", "From_Bank", "From_Account", "Pattern_Type", "isLaundering"]


@pytest.mark.parametrize("stop_at_end", [False, True])
def test_fill_over_files_cut_into_small_splits(spark, tmp_path, stop_at_end):
    texts = {}
    for f in range(3):
        lines = []
        for i in range(300):
            kind = (i * 7 + f * 3) % 23
            if kind == 5 and i > 40:
                lines.append(f"BEGIN LAUNDERING ATTEMPT - F{f}-{i}")
            elif kind == 11:
                lines.append("END LAUNDERING ATTEMPT - X")
            else:
                lines.append(f"2022/09/01 00:00,{f},line-{f}-{i}" + "x" * (i % 31))
        texts[f"log{f}.txt"] = lines
        (tmp_path / f"log{f}.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = read_pattern_lines(spark, str(tmp_path))
        assert lines.select("source", "segment").distinct().count() > 15
        filled = patterns.with_pattern(lines, stop_at_end)
        found = {}
        for r in filled.orderBy("source", "segment", "line_no").collect():
            found.setdefault(r.source.rsplit("/", 1)[1], []).append((r.value, r.Pattern_Type))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {n: list(zip(t, sequential_fill(t, stop_at_end))) for n, t in texts.items()}


LINE = st.sampled_from(["BEGIN LAUNDERING ATTEMPT - A", "BEGIN LAUNDERING ATTEMPT - B", "END LAUNDERING ATTEMPT", "x"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(LINE, min_size=1, max_size=40),
    st.lists(LINE, max_size=20),
    st.integers(1, 7),
    st.booleans(),
)
def test_fill_equals_sequential_fill(spark, first, second, width, stop_at_end):
    data = [(s, i // width * width, i, v) for s, t in (("p", first), ("q", second)) for i, v in enumerate(t)]
    lines = spark.createDataFrame(data, "source string, segment long, line_no long, value string").repartition(3)
    filled = patterns.with_pattern(lines, stop_at_end)
    for source, text in (("p", first), ("q", second)):
        found = [r.Pattern_Type for r in filled.where(F.col("source") == source).orderBy("line_no").collect()]
        assert found == sequential_fill(text, stop_at_end)


def test_no_source_is_filled_in_one_task(spark, sf_dir):
    log = log_from_events(table(spark, sf_dir, "events"))
    plan = plan_of(patterns.pattern_transactions(log))
    assert "SinglePartition" not in plan and "Python" not in plan
    windows = [line for line in plan.splitlines() if "Window [last(_event" in line]
    assert windows and all("segment" in w for w in windows)
    # The line text crosses one exchange, the one its segment is filled in.
    assert plan.count("Exchange hashpartitioning") == 3
