"""Block-structured pattern logs to labelled transaction rows.

Input lines have the columns `source`, `segment`, `line_no`, `value` (see
`riskflow.sources.readers.read_pattern_lines`): a segment is a piece of one source, and lines of a
source are ordered by (segment, line_no).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import is_dated, is_end, pattern_header, short_pattern_name
from riskflow.operators.ordering import fill_forward
from riskflow.schemas import PATTERN_FIELDS


def with_header(lines: DataFrame) -> DataFrame:
    """Add `Pattern_Type`, set on BEGIN lines only."""
    return lines.withColumn("Pattern_Type", pattern_header(F.col("value")))


def without_end_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~is_end(F.col("value")))


def _event(stop_at_end: bool) -> Column:
    """What a line does to the current name: sets it, clears it (""), or nothing (null)."""
    header = pattern_header(F.col("value"))
    if not stop_at_end:
        return header
    return F.when(is_end(F.col("value")), F.lit("")).otherwise(header)  # no real name is empty


def _filled(lines: DataFrame, stop_at_end: bool) -> DataFrame:
    marked = lines.withColumn("_event", _event(stop_at_end))
    # Lines of several origins may have equal sources, see `union_sources`.
    origin = F.struct("origin", "source") if "origin" in lines.columns else F.col("source")
    marked = marked.withColumn("_source", origin)
    filled = fill_forward(marked, "_event", "Pattern_Type", source="_source", segment="segment", order="line_no").drop("_source")
    if stop_at_end:
        filled = filled.withColumn("Pattern_Type", F.nullif("Pattern_Type", F.lit("")))
    return filled


def with_pattern(lines: DataFrame, stop_at_end: bool = False) -> DataFrame:
    """Add `Pattern_Type`, the name on the latest BEGIN line of the same source.

    By default a name holds until the next BEGIN line. With `stop_at_end` it holds until the END
    line, which gets none itself.
    """
    return _filled(lines, stop_at_end).drop("_event")


def pattern_transactions(
    lines: DataFrame,
    label: str = "literal",
    stop_at_end: bool = False,
    clean_names: bool = True,
) -> DataFrame:
    """Dated lines split into fields, with pattern name and label.

    `label="literal"` marks every row 1; `label="field"` reads the eleventh field. Missing fields
    of a short line are null. Lines that neither change the name nor become a row are dropped
    before the fill, so they are never shuffled.
    """
    if label not in ("literal", "field"):
        raise ValueError(f"label must be 'literal' or 'field', not {label!r}")
    value = F.col("value")
    row = is_dated(value) & ~is_end(value)
    kept = lines.where(row | _event(stop_at_end).isNotNull())
    # A kept line without event is a row; only the few with one are tested again.
    rows = _filled(kept, stop_at_end).where(F.col("_event").isNull() | row)
    parts = F.split("value", ",")
    name = short_pattern_name(F.col("Pattern_Type")) if clean_names else F.col("Pattern_Type")
    flag = F.lit(1) if label == "literal" else F.get(parts, F.lit(len(PATTERN_FIELDS))).try_cast("int")
    return rows.select(
        "source",
        "line_no",
        *[F.get(parts, F.lit(i)).alias(field) for i, field in enumerate(PATTERN_FIELDS)],
        name.alias("Pattern_Type"),
        flag.alias("isLaundering"),
    )


def pattern_labels(rows: DataFrame, with_account: bool = True) -> DataFrame:
    """The narrow label rows. Keep the account: it is the key features are joined on."""
    account = ["From_Account"] if with_account else []
    return rows.select("Timestamp", "From_Bank", *account, "Pattern_Type", "isLaundering")
